"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Features are binary: whether a word, two adjacent words, or two words with one between them occur. FTRL-proximal
gives each coordinate its own rate, and its L1 term leaves most weights at exactly zero, so a fitted model is a
short list of weights that travels with the scoring tasks. Shards of the labelled rows are trained side by side;
their accumulators are averaged per coordinate after each round, and the next round goes on from there.

Features are hashes of 40 bits, so that two of a sample's ten million hardly ever share a coordinate. They travel packed: a task
sends its distinct features as sorted arrays, by ranges of the hash, of which each holds the low 32 bits and whether a second row of
the task has it; a shard sends its accumulators as one array of 32-bit numbers, and its rows stay where they were written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import mixed, scratch, slices, word_hashes

WORD = re.compile(r"[^\W_]+")
BITS, LOW_BITS = 40, 32  # of a feature, and those that its range leaves open
SAMPLE_ROWS = 16_000  # labelled rows to fit on, in expectation; fewer labels are all used
SHARDS, ROUNDS, EPOCHS = 2, 3, 5
LEAST_ROWS = 2  # training rows of any shard that hold a feature before it gets a coordinate
ALPHA, BETA, L1, L2 = 3.0, 1.0, 3.0, 0.1

PAIR, SKIP = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(text: str) -> np.ndarray:
    """Distinct hashed features of a whole text, ascending."""
    words = word_hashes().of(WORD.findall(text.lower()))
    parts = [words, words[:-1] * PAIR + words[1:], words[:-2] * SKIP + words[2:]]
    return np.unique(mixed(np.concatenate(parts)) >> np.uint64(64 - BITS))


def places_in(known: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where those of ``own`` that are known stand; both ascend."""
    if not len(known):
        return np.empty(0, np.int64)
    places = np.searchsorted(known, own)
    return places[known[np.minimum(places, len(known) - 1)] == own]


@dataclass(frozen=True)
class Model:
    """Weights other than zero, by feature in ascending order, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        return self.bias + float(self.weights[places_in(self.features, features(text))].sum())


def weights_of(z: np.ndarray, n: np.ndarray, regular: bool = True) -> np.ndarray:
    """Weights from the accumulators; those that are not ``regular`` have no L1 term."""
    l1 = L1 if regular else 0.0
    small = np.abs(z) <= l1
    return np.where(small, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, epochs: int) -> None:
    """Passes over the rows in order, updating ``z`` and ``n`` in place; the last coordinate is the bias, without L1."""
    bias = len(z) - 1
    for _ in range(epochs):
        for row, label in zip(rows, labels):
            own_z, own_n = z[row], n[row]
            weights = weights_of(own_z, own_n)
            start = weights_of(z[bias:], n[bias:], regular=False)[0]
            score = min(35.0, max(-35.0, start + weights.sum()))
            slope = 1 / (1 + np.exp(-score)) - label
            if not slope:
                continue
            square = slope * slope
            grown = own_n + square
            z[row] = own_z + slope - (np.sqrt(grown) - np.sqrt(own_n)) / ALPHA * weights
            n[row] = grown
            wider = n[bias] + square
            z[bias] += slope - (np.sqrt(wider) - np.sqrt(n[bias])) / ALPHA * start
            n[bias] = wider


def held_out(doc_id: Column) -> Column:
    """Whether labels of the row are kept from training; a row without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """doc_id, text and toxic of labelled rows outside the held-out fold, about ``sample_rows`` at most."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    once = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, sample_rows / max(1, once.count()))
    sampled = once.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # the sample is bounded by its parameter, so it is sent to the texts and not the texts to it
    return texts.join(F.broadcast(sampled), "doc_id")


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labels outside the held-out fold. Without any such labels the model knows only a bias of zero."""
    spark = documents.sparkSession
    with scratch(spark, "toxicity") as place:
        rows = place.keep(training_rows(documents, labels, sample_rows).select("doc_id", "toxic", "text"), "rows")
        # bounded by the sample: of its features, those that LEAST_ROWS rows hold
        coordinates = shared_features(rows)
        sent = spark.sparkContext.broadcast(coordinates)
        shard = F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))
        shards = [place.keep(_coded(rows.filter(shard == at), sent), f"shard-{at}") for at in range(SHARDS)]
        sent.destroy()  # the shards are written, and the driver would keep it
        z, n = np.zeros(len(coordinates) + 1), np.zeros(len(coordinates) + 1)
        for _ in range(ROUNDS):
            state = spark.sparkContext.broadcast((z, n))
            step_z, step_n = _round(shards, state)
            state.destroy()
            z, n = z + step_z, n + step_n
    weights = weights_of(z[:-1], n[:-1])
    kept = weights != 0
    start = weights_of(z[-1:], n[-1:], regular=False)
    return Model(coordinates[kept], weights[kept].astype(np.float32), float(start[0]))


def shared_features(rows: DataFrame) -> np.ndarray:
    """The features that ``LEAST_ROWS`` rows hold, ascending, from the rows' texts.

    A task looks through its own rows first and sends each range of their features as one sorted array.
    """
    ranges = np.arange(1 << (BITS - LOW_BITS), dtype=np.uint64)

    def found_in(features_of_rows: np.ndarray) -> pa.RecordBatch:
        values, holders = np.unique(features_of_rows, return_counts=True)
        borders = np.append(np.searchsorted(values, ranges << np.uint64(LOW_BITS)), len(values)).tolist()
        low, several = values.astype(np.uint32), np.minimum(holders, LEAST_ROWS).astype(np.uint8)
        arrays = [
            pa.array(ranges.astype(np.int32)),
            *(pa.array([own[a:b].tobytes() for a, b in zip(borders, borders[1:])], pa.binary()) for own in (low, several)),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["part", "low", "holders"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [features(text) for batch in slices(batches) for text in batch.column(0).to_pylist()]
        if held:
            yield found_in(np.concatenate(held))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        low = np.concatenate([np.frombuffer(own, np.uint32) for own in pdf["low"]])
        holders = np.concatenate([np.frombuffer(own, np.uint8) for own in pdf["holders"]])
        values, place = np.unique(low, return_inverse=True)
        shared = values[np.bincount(place, holders, len(values)) >= LEAST_ROWS]
        return pd.DataFrame({"part": pdf["part"][:1], "low": [shared.tobytes()]})

    counted = rows.select("text").mapInArrow(count, "part int, low binary, holders binary").groupBy("part").applyInPandas(add, "part int, low binary")
    parts = sorted((row["part"], row["low"]) for row in counted.collect())
    own = [np.frombuffer(low, np.uint32) | np.uint64(part << LOW_BITS) for part, low in parts]
    return np.concatenate(own) if own else np.empty(0, np.uint64)


def _coded(rows: DataFrame, coordinates: Broadcast) -> DataFrame:
    """doc_id, toxic and the places of each text's features among the coordinates."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [places_in(coordinates.value, features(text)).astype(np.int32).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(own, pa.binary())], ["doc_id", "toxic", "places"])

    return rows.select("doc_id", "toxic", "text").mapInArrow(code, "doc_id long, toxic int, places binary")


def _round(shards: list[DataFrame], state: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Each shard trains from the state given, in a task of its own; returns the mean of their steps, a number for each coordinate and the bias."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            order = np.argsort(mixed(whole["doc_id"].to_numpy().astype(np.uint64)), kind="stable")
            places = whole["places"].to_pylist()
            z, n = (own.copy() for own in state.value)
            ftrl([np.frombuffer(places[at], np.int32) for at in order], whole["toxic"].to_numpy()[order], z, n, EPOCHS)
            steps = [[(own - before).astype(np.float32).tobytes()] for own, before in zip((z, n), state.value)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()) for own in steps], ["z", "n"])

    trained = [rows.coalesce(1).mapInArrow(train, "z binary, n binary") for rows in shards]
    steps = reduce(DataFrame.unionByName, trained).collect()  # one row a shard
    nothing = [np.zeros(len(state.value[0]))]
    return tuple(sum([np.frombuffer(row[name], np.float32).astype(float) for row in steps] or nothing) / SHARDS for name in ("z", "n"))


def scorer(documents: DataFrame, model: Model):
    """A column function: the probability that a text is toxic; a null text is an empty one."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = sent.value
        for batch in texts:
            sums = np.array([model.score(text or "") for text in batch], np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -35, 35))))

    return score


def score_documents(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each whole text.

    Null and empty texts get the bias alone. Repeated rows stay, further columns are left out. A label given twice
    counts once, as toxic if any says so; labels other than 0 and 1 and those without an id are not used.
    """
    score = scorer(documents, fit(documents, labels, sample_rows))
    scored = documents.select(F.col("doc_id").cast("long"), score(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that score below one half, all columns."""
    score = scorer(documents, fit(documents, labels, sample_rows))
    return documents.filter(score(F.col("text")) < 0.5)
