"""SimHash near-duplicates, found by balls that meet in the middle.

Fingerprints within three bits of each other share a point half way: with a radius of two, a point within one
bit of both. Three is odd, so one of three blocks of bits is left out in turn. Of two to three differing bits one
block holds at least one, which leaves two to bridge; every fingerprint emits what remains of it and all variants
within one bit. Variants are shuffled, and fingerprints that collide in one are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import cut, remembered_by_worker, scratch, unused_name
from flowgauge.llm.graph import components

RADIUS = 3
SHINGLE = 3
SEED = 42
BLOCKS = (range(0, 22), range(22, 43), range(43, 64))
COMPARED = 2048  # colliding fingerprints compared at once


def simhash(text: str | None) -> int:
    """The fingerprint as a signed 64-bit integer; zero if the text has no words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts, digest = (ends - lengths).tolist(), xxhash.xxh64_intdigest
        hashes = [digest(joined[start:end], SEED) for start, end in zip(starts, ends[SHINGLE - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    remembered_by_worker("simhash", dict)
    for batch in texts:
        yield pd.Series(np.fromiter(map(simhash, batch), np.int64, len(batch)))


def fingerprint(text: Column | str) -> Column:
    return _simhash(text)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def ball(fingerprints: DataFrame) -> DataFrame:
    """block, variant and fp: per block left out, the rest of ``fp`` and all that differ from it in one bit."""
    emitted = []
    for block, out in enumerate(BLOCKS):
        kept = [bit for bit in range(64) if bit not in out]
        rest = _signed(sum(1 << bit for bit in kept))
        emitted += [(block, rest, flip) for flip in [0, *(_signed(1 << bit) for bit in kept)]]
    variants = F.explode(
        F.array(
            *[
                F.struct(F.lit(block).cast("byte").alias("block"), F.lit(rest).alias("rest"), F.lit(flip).alias("flip"))
                for block, rest, flip in emitted
            ]
        )
    )
    return fingerprints.select("fp", variants.alias("v")).select(
        F.col("v.block").alias("block"),
        F.col("fp").bitwiseAND(F.col("v.rest")).bitwiseXOR(F.col("v.flip")).alias("variant"),
        "fp",
    )


def _forest(points: np.ndarray) -> list[tuple[int, int]]:
    """Links within the radius that join distinct fingerprints; a spanning forest, not all pairs."""
    if len(points) == 2:
        near = int(points[0] ^ points[1]).bit_count() <= RADIUS
        return [(int(points[0]), int(points[1]))] if near else []
    links, left = [], points
    while len(left):
        # grow one tree: compare what was reached last with all that is not reached yet
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            parent = np.full(len(left), -1, np.int64)
            for start in range(0, len(reached), COMPARED):
                part = reached[start : start + COMPARED]
                for at in range(0, len(left), COMPARED):
                    near = np.bitwise_count(left[at : at + COMPARED, None] ^ part[None, :]) <= RADIUS
                    found = np.where(near.any(axis=1), near.argmax(axis=1) + start, -1)
                    own = parent[at : at + COMPARED]
                    own[own < 0] = found[own < 0]
            hit = parent >= 0
            links += zip(reached[parent[hit]].tolist(), left[hit].tolist())
            reached, left = left[hit], left[~hit]
    return links


def near_links(fingerprints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fp`` that differ in three bits or fewer.

    Within a colliding bucket enough links are returned to connect what is connected, so a bucket of many does
    not become all its pairs.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = variant = fp = np.empty(0, np.int64)
        for batch in batches:
            columns = [batch.column(at).to_numpy() for at in range(3)]
            block, variant, fp = (np.concatenate(pair) for pair in zip((block, variant, fp), columns))
            if not len(fp):
                continue
            new = np.flatnonzero((np.diff(variant) != 0) | (np.diff(block) != 0)) + 1
            last = int(new[-1]) if len(new) else 0  # the last bucket may go on in the next batch
            yield _links(fp[:last], np.concatenate([[0], new])[: len(new)], last)
            block, variant, fp = block[last:], variant[last:], fp[last:]
        if len(fp):
            yield _links(fp, np.zeros(1, np.int64), len(fp))

    def _links(points: np.ndarray, starts: np.ndarray, end: int) -> pa.RecordBatch:
        ends = np.append(starts[1:], end)
        points = points.view(np.uint64)
        found = []
        for start, stop in zip(starts.tolist(), ends.tolist()) if len(starts) else ():
            if stop - start > 1:
                found += _forest(points[start:stop])
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    dealt = ball(fingerprints).repartition("block", "variant").sortWithinPartitions("block", "variant", "fp")
    return dealt.mapInArrow(meet, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fp, fingerprint (hex) and component_id of each document.

    ``component_id`` is the smallest doc_id reachable over links of three bits or fewer, itself included. Texts without
    words, null ones too, have fingerprint zero and link like any other. Repeated rows stay; a null doc_id counts in
    no minimum, and a component of null ids alone has a null component_id. Further columns are left out.
    """
    spark = documents.sparkSession
    with scratch(spark, "simhash") as place:
        prints = place.keep(documents.select(F.col("doc_id").cast("long"), fingerprint("text").alias("fp")), "prints")
        classes = place.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
        roots = components(near_links(classes.select("fp")))
        rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        )
        least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        named = rooted.join(least, "root").select("fp", "component_id")
        joined = prints.join(named, "fp").select(
            "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
        )
        return cut(joined)


def one_per_component(documents: DataFrame) -> DataFrame:
    """The documents whose id names their component, once each.

    Of rows that repeat an id one stays. Documents without an id stay where no document with one is near:
    one per fingerprint.
    """
    found = near_duplicates(documents)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    named = documents.filter("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    own = unused_name(documents, "fp")
    nameless = documents.filter("doc_id is null").withColumn(own, fingerprint("text"))
    alone = found.filter("component_id is null").select(F.col("fp").alias(own)).distinct()
    unnamed = nameless.join(alone, own, "left_semi").dropDuplicates([own])
    return named.select(*documents.columns).unionByName(unnamed.select(*documents.columns))
