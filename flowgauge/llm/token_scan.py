"""Token counts of documents in flat token streams that have no index.

A stream is cut into blocks of bytes wherever they happen to end. Each block is searched for the
end-of-document id on its own, in one vectorised comparison. What a block knows in the end is how many tokens
stand before its first end, the counts between its ends, and what hangs over after the last. A prefix
scan over these summaries, first within runs of blocks and then over the runs, tells each
block how many tokens and how many documents came before it, which stitches documents across blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import slices
from flowgauge.llm.trie_bpe import encoder, read_vocabulary

BLOCK_BYTES = 1 << 20
RUN = 1024  # blocks per run of the two-level scan
LABEL_BYTES = 16
DTYPES = {2: "<u2", 4: "<u4"}


def token_blocks(documents: DataFrame, vocabulary_path: str, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents as flat token streams, one per task, in blocks: kind, stream, block, data.

    ``block_bytes`` must hold whole ids and labels: a multiple of 16. The ids of a document are followed by ``end_id``; strings of special tokens are ordinary text here, so that no
    other id equals it. Beside the blocks (kind 0) the documents' ids travel in stream order
    (kind 1), to label the counts; the scan does not see them.
    """
    if block_bytes % LABEL_BYTES or end_id >= 1 << 8 * width:
        raise ValueError(f"blocks are multiples of {LABEL_BYTES} bytes, and the end must fit in {width} bytes")
    text = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = "kind int, stream long, block long, data binary"

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stream = encoder(text.value), TaskContext.get().partitionId()
        buffers, counts, names = (bytearray(), bytearray()), [0, 0], ["kind", "stream", "block", "data"]

        def full(kind: int, least: int) -> Iterator[pa.RecordBatch]:
            while len(buffers[kind]) >= least:
                data = bytes(buffers[kind][:block_bytes])
                del buffers[kind][:block_bytes]
                columns = [pa.array([kind], pa.int32()), pa.array([stream]), pa.array([counts[kind]]), pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
                counts[kind] += 1

        for batch in slices(batches, texts=1):
            ids = words.encode_texts([value or "" for value in batch.column(1).to_pylist()], special=False)
            for own in ids:
                tokens = np.frombuffer(own, "<u4")
                if len(tokens) and tokens.max() >= 1 << 8 * width:
                    raise ValueError(f"id {tokens.max()} does not fit in {width} bytes")
                buffers[0].extend(np.append(np.frombuffer(own, "<u4"), np.uint32(end_id)).astype(DTYPES[width]).tobytes())
            # two numbers a document: whether it has an id, and the id
            known = [(doc_id is not None, doc_id or 0) for doc_id in batch.column(0).to_pylist()]
            buffers[1].extend(np.asarray(known, "<i8").tobytes())
            yield from full(0, block_bytes)
            yield from full(1, block_bytes)
        yield from full(0, 1)
        yield from full(1, 1)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(flatten, schema)


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Raw token files as blocks; a file is a stream and, by Spark's binary reader, at most 2 GB."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            name, data = batch.column(0)[0].as_py(), batch.column(1)[0].as_buffer()
            for block, at in enumerate(range(0, data.size, block_bytes)):
                part = pa.array([data.slice(at, min(block_bytes, data.size - at)).to_pybytes()], pa.binary())
                columns = [pa.array([name]), pa.array([block], pa.int64()), part]
                yield pa.RecordBatch.from_arrays(columns, ["stream", "block", "data"])

    return files.mapInArrow(blocks, "stream string, block long, data binary")


def block_summaries(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """stream, block, ends (how many), head, inner (counts between ends), tail.

    A block without an end has its tokens in ``tail`` and a null head.
    """
    stream_type = blocks.schema["stream"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            rows: tuple[list, ...] = ([], [], [], [])
            for data in batch.column(2):
                tokens = np.frombuffer(data.as_buffer(), DTYPES[width])
                ends = np.flatnonzero(tokens == end_id)
                rows[0].append(len(ends))
                rows[1].append(int(ends[0]) if len(ends) else None)
                rows[2].append((np.diff(ends) - 1).tolist())
                rows[3].append(len(tokens) - (int(ends[-1]) + 1 if len(ends) else 0))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64())
            found = [pa.array(own, kind) for own, kind in zip(rows, kinds)]
            names = ["stream", "block", "ends", "head", "inner", "tail"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names)

    schema = f"stream {stream_type}, block long, ends long, head long, inner array<bigint>, tail long"
    return blocks.select("stream", "block", "data").mapInArrow(scan, schema)


def _open_before(df: DataFrame, order: str, *keys: str) -> DataFrame:
    """Adds ``open_in`` and ``ends_in``: tokens and ends before a row among those of its keys.

    Tokens count from the last end on. A running count of ends names the document that is open.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = df.withColumns(
        {
            "ends_in": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "with_end": F.sum((F.col("ends") > 0).cast("long")).over(upto),
        }
    )
    same = Window.partitionBy(*keys, "with_end").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    carried = counted.withColumn("open_out", F.sum("tail").over(same)).drop("with_end")
    last = Window.partitionBy(*keys).orderBy(order)
    return carried.withColumn("open_in", F.coalesce(F.lag("open_out").over(last), F.lit(0)))


def stitched(summaries: DataFrame) -> DataFrame:
    """stream, ordinal and n_tokens of each document, ordinals from 0 in stream order.

    Tokens after the last end of a stream are a document of their own. ``summaries`` should be settled: it is read twice.
    """
    runs = summaries.withColumn("run", F.floor(F.col("block") / RUN))
    within = _open_before(runs.drop("inner"), "block", "stream", "run")
    per_run = within.groupBy("stream", "run").agg(
        F.sum("ends").alias("ends"), F.max_by("open_out", "block").alias("tail"), F.max("block").alias("last_block")
    )
    scanned = _open_before(per_run, "run", "stream")
    later = Window.partitionBy("stream").orderBy("run")
    carry = scanned.select(
        "stream",
        "run",
        F.col("open_in").alias("run_open"),
        F.col("ends_in").alias("run_ends"),
        F.when(F.lead("run").over(later).isNull(), F.col("last_block")).alias("last_block"),
    )
    placed = within.join(carry, ["stream", "run"]).select(
        "stream",
        "block",
        (F.col("ends_in") + F.col("run_ends")).alias("first"),
        # tokens left open before the run count while the run has had no end
        (F.col("open_in") + F.when(F.col("ends_in") == 0, F.col("run_open")).otherwise(0)).alias("open_in"),
        (F.col("block") == F.col("last_block")).alias("is_last"),
    )
    rows = summaries.join(placed, ["stream", "block"])
    ended = F.when(F.col("ends") > 0, F.concat(F.array(F.col("open_in") + F.col("head")), "inner")).otherwise(
        F.array().cast("array<bigint>")
    )
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open_in") + F.col("tail"))
    left = F.when(F.coalesce("is_last", F.lit(False)) & (rest > 0), F.array(rest)).otherwise(F.array().cast("array<bigint>"))
    counts = rows.select("stream", "first", F.posexplode(F.concat(ended, left)).alias("at", "n_tokens"))
    return counts.select("stream", (F.col("first") + F.col("at")).alias("ordinal"), "n_tokens")


def labels_of(blocks: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """stream, ordinal and doc_id from the label blocks that travel beside the token blocks, written in ``block_bytes`` too."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            known, ids = np.frombuffer(batch.column(2)[0].as_buffer(), "<i8").reshape(-1, 2).T
            first = batch.column(1)[0].as_py() * (block_bytes // LABEL_BYTES)
            columns = [
                pa.array(np.full(len(ids), batch.column(0)[0].as_py())),
                pa.array(first + np.arange(len(ids), dtype=np.int64)),
                pa.array(ids, mask=known == 0),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["stream", "ordinal", "doc_id"])

    labels = blocks.filter("kind = 1").select("stream", "block", "data")
    return labels.mapInArrow(unfold, "stream long, ordinal long, doc_id long")
