"""A corpus cleaned and packed in stages; each reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowgauge.llm import chaining, packing, simhash, toxicity
from flowgauge.llm.common import cut, scratch, table
from flowgauge.llm.queries import WORD_VOCABULARY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a model of the labels of this corpus."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.one_per_component(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; every document stays."""
    return chaining.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and where they stand in the training sequences."""
    # the executors still hold what the stages before needed, so less room is left for words
    return packing.pack_documents(docs, WORD_VOCABULARY, remember=200_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

# Neither a trained model nor chained alignments can be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark, "pipeline") as place:
        for name, stage in STAGES:
            docs = place.keep(stage(spark, docs, sf_dir), name)
        return cut(docs)
