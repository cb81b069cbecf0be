"""What the operators share: tables, cut lineage, scratch folders, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from flowgauge.session import new_folder

# Unicode White_Space as a character class, which is what the tokenizers' patterns mean by \s; Python's own
# \s also takes the separators 1C to 1F.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

PIECE_BYTES = 6 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the shared checkpoint folder from then on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_folder(df.sparkSession, "checkpoints"))  # ends with the application
    return df.checkpoint(eager=True)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables written to a folder that all executors reach."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, new_folder(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Scratch]:
    """A scratch folder that is removed at the end, also after a failure.

    What leaves the block must not read it any more: ``cut`` it before.
    """
    place = Scratch(spark, label)
    try:
        yield place
    finally:
        place.remove()


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows at most in an Arrow batch, for jobs run in the block; ten thousand whole texts would fill a worker."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = 512, texts: int | None = None, piece_bytes: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few values at a time are Python objects.

    A piece has ``rows`` rows at most or, if ``texts`` names a column, about ``piece_bytes`` bytes of text.
    """
    for batch in batches:
        if texts is None:
            borders = [*range(0, batch.num_rows, rows), batch.num_rows]
        else:
            sizes = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
            pieces = np.cumsum(sizes, dtype=np.int64) // piece_bytes
            borders = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), batch.num_rows]
        for start, end in zip(borders, borders[1:]):
            if end > start:
                yield batch.slice(start, end - start)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def give_back() -> None:
    """Return freed memory to the system: workers live long, and the allocators would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


_memory: dict[Hashable, Any] = {}


def remembered_by_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under a key; what it kept under another is dropped.

    Workers serve one operator after the other, and their memories would add up.
    """
    if key not in _memory:
        _memory.clear()
        give_back()
        _memory[key] = make()
    return _memory[key]


def word_hashes() -> WordHashes:
    return remembered_by_worker("word hashes", WordHashes)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits (multiply and shift, twice)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; fewer words make one run of all, none make none."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for at in range(size):
        total = (total ^ words[at : at + count]) * np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(31)
    return mixed(total)
