"""Document fingerprints by one-permutation MinHash.

One hash per shingle: its high bits name a bin, and a bin keeps its smallest hash. Empty bins are
filled by optimal densification, which draws a bin anew for each empty one until it meets a full one; the draws
depend on the bin alone, so equal sets are filled alike. Only the low bits of the minima are stored, and the
share of equal ones is corrected for those that are equal by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import mixed, shingle_hashes, slices, word_hashes

SHINGLE = 5
BIN_BITS, LOW_BITS = 8, 8
BINS = 1 << BIN_BITS
DRAWS = 64  # draws looked up at once
EMPTY = "00" * BINS + "-"  # no shingle at all; like to nothing but itself


def _draw(first: int) -> np.ndarray:
    """Bins drawn for each bin, draws ``first`` and on: (draws, bins)."""
    draws = np.arange(first, first + DRAWS, dtype=np.uint64)[:, None] * np.uint64(BINS)
    return (mixed(draws + np.arange(1, BINS + 1, dtype=np.uint64)) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


FIRST_DRAWS = _draw(0)


def sketch(text: str) -> np.ndarray | None:
    """Low bits of the minimum of each bin; none for a text without words."""
    words = word_hashes().of(text.lower().split())
    if not len(words):
        return None
    hashes = np.sort(shingle_hashes(words, SHINGLE))
    bins = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    low = np.zeros(BINS, np.uint8)
    full = np.zeros(BINS, bool)
    low[bins[first]] = (hashes[first] & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)
    full[bins[first]] = True
    empty, drawn = np.flatnonzero(~full), 0
    while len(empty):
        table = FIRST_DRAWS if not drawn else _draw(drawn)
        hit = full[table[:, empty]]
        at = hit.argmax(axis=0)
        done = hit[at, np.arange(len(empty))]
        low[empty[done]] = low[table[at[done], empty[done]]]
        empty, drawn = empty[~done], drawn + DRAWS
    return low


def packed(low: np.ndarray | None) -> str:
    return EMPTY if low is None else low.tobytes().hex()


def likeness(one: np.ndarray | None, other: np.ndarray | None) -> float:
    """Estimated Jaccard likeness of the shingle sets, from 0 to 1."""
    if one is None or other is None:
        return float(one is other)
    by_chance = 1 / (1 << LOW_BITS)
    return float(max(0.0, (np.count_nonzero(one == other) / BINS - by_chance) / (1 - by_chance)))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _buckets(documents: DataFrame) -> tuple[Column, DataFrame, int]:
    """Ranges of doc_id of like size, and the first row of each: (bucket of a row, firsts, how many ranges)."""
    spark = documents.sparkSession
    count = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = documents.filter("doc_id is not null").approxQuantile("doc_id", [k / count for k in range(1, count)], 0.1 / count)
    listed = F.array(*[F.lit(int(border)) for border in sorted(set(borders))]).cast("array<bigint>")
    bucket = F.size(F.filter(listed, lambda border: border <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), 0).otherwise(bucket), len(set(borders)) + 1


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how like they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. A text's next is
    that of the next row by doc_id, after the last the first. Rows without an id come first; equal ids go by
    their texts. A null text is an empty one. Further columns are left out.

    Rows are dealt by ranges of doc_id and go through each range in order. The first row of a range is also sent
    to the range before it, so no task needs more than its own rows.
    """
    narrow = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    bucket, count = _buckets(narrow)
    rank = F.struct(F.col("doc_id"), F.xxhash64("text"))
    placed = narrow.withColumn("bucket", bucket)
    ids_only = narrow.select("doc_id").withColumn("bucket", bucket)
    firsts = {
        row["bucket"]: (row["nulls"] > 0, row["low"])
        for row in ids_only.groupBy("bucket").agg(
            F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("low")
        ).collect()  # one row per range
    }
    full = sorted(firsts)
    before = {own: full[at - 1] for at, own in enumerate(full)}  # of the first: the last
    if not full:
        return narrow.limit(0).mapInArrow(_fingerprints, SCHEMA)
    to = F.create_map(*[F.lit(x) for own in full for x in (own, before[own])])
    lowest = {own: None if nulls else first for own, (nulls, first) in firsts.items()}
    low = F.create_map(*[x for own in full for x in (F.lit(own), F.lit(lowest[own]).cast("long"))])
    is_first = F.col("doc_id").eqNullSafe(low[F.col("bucket")])
    copies = F.when(
        is_first,
        F.array(
            F.struct(F.col("bucket").alias("part"), F.lit(False).alias("ahead")),
            F.struct(to[F.col("bucket")].alias("part"), F.lit(True).alias("ahead")),
        ),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("part"), F.lit(False).alias("ahead"))))
    dealt = placed.select("doc_id", "text", rank["col2"].alias("tie"), F.explode(copies).alias("c")).select(
        "c.part", "c.ahead", "doc_id", "tie", "text"
    )
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "ahead", F.col("doc_id").asc_nulls_first(), "tie", "text")
    return ordered.mapInArrow(_fingerprints, SCHEMA)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part, a part's own rows in order, then what follows them (``ahead``)."""
    names = SCHEMA.replace(",", "").split()[::2]
    waiting = None  # (part, doc_id, text, sketch) whose next is not known yet
    for batch in slices(batches):
        rows = []
        columns = [batch.column(at).to_pylist() for at in (0, 1, 2, 4)]
        for part, ahead, doc_id, text in zip(*columns):
            if ahead and (waiting is None or waiting[0] != part):
                continue  # of equal first rows, one is enough
            own = sketch(text)
            if waiting is not None:
                _, id_before, text_before, sketch_before = waiting
                edited = edited_text(text_before, text)
                other = sketch(edited)
                rows.append(
                    (
                        id_before,
                        len(text_before),
                        hashlib.sha256(edited.encode()).hexdigest(),
                        packed(sketch_before),
                        packed(other),
                        likeness(sketch_before, other),
                        likeness(sketch_before, own),
                    )
                )
            waiting = None if ahead else (part, doc_id, text, own)
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)
