"""Readers for cases, dimensions, state and stored results."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.schema import (
    AGGREGATE_SCHEMA,
    CASE_SCHEMA,
    CASE_TABLE,
    CATALOG_SCHEMA,
    RESULTS_SCHEMA,
    TRANSFER_SCHEMA,
)
from flowgauge.session import file_system

HEADER_THREADS = 32
DATABASE_PREFIXES = ("postgresql://", "postgres://")


def read_cases_csv(spark: SparkSession, path: str, schema: T.StructType = CASE_SCHEMA) -> DataFrame:
    """Headed CSV with ISO-8601 times, with or without fraction; empty text is null."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def csv_files(spark: SparkSession, *paths: str) -> list[str]:
    """The files at these paths, folders searched through; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path")
    return [row["path"] for row in found.collect()]


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in the first line of a file; none for an empty file."""
    system, place = file_system(spark, path)
    jvm = spark._jvm.java.io
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    codec, opened = factory.getCodec(place), system.open(place)
    lines = jvm.BufferedReader(jvm.InputStreamReader(opened if codec is None else codec.createInputStream(opened), "UTF-8"))
    try:
        line = lines.readLine()
    finally:
        lines.close()
    return tuple(next(csv.reader([line.removeprefix("\ufeff")]))) if line else ()


def read_raw_csv(spark: SparkSession, *paths: str, schema: T.StructType = TRANSFER_SCHEMA) -> DataFrame:
    """Any subset of the columns of ``schema``, in any order and in each file its own; absent columns become null.

    The first lines are looked at by a few threads of the driver; files with the same header are read together by name,
    and the reads are united. Names that the schema lacks are left out. Quotes in text are doubled; a line is a row, so that
    large files are read in parts.
    """
    files = csv_files(spark, *paths)
    layouts: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for file, header in zip(files, pool.map(lambda file: header_of(spark, file), files)):
            if header:
                layouts.setdefault(header, []).append(file)
    parts = []
    for header, own in sorted(layouts.items()):
        if len(set(header)) < len(header):
            raise ValueError(f"a column is named twice in the header of {own[0]}")
        rows = (
            spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in header]))
            .option("header", True)
            .option("nullValue", "")
            .option("emptyValue", "")
            .option("escape", '"')
            .option("enforceSchema", False)
            .csv(own)
        )
        parts.append(
            rows.select(
                *[
                    (F.col(f"`{field.name}`") if field.name in header else F.lit(None)).cast(field.dataType).alias(field.name)
                    for field in schema
                ]
            )
        )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_cases_json(spark: SparkSession, path: str, schema: T.StructType = CASE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def jdbc_options(address: str) -> dict[str, str]:
    """Options of the JDBC source for a ``postgresql://user:password@host:port/name`` address."""
    parts = urlsplit(address)
    if parts.scheme not in ("postgresql", "postgres") or not parts.hostname:
        raise ValueError("expected postgresql://[user[:password]@]host[:port]/database")
    query = f"?{parts.query}" if parts.query else ""
    options = {
        "url": f"jdbc:postgresql://{parts.hostname}:{parts.port or 5432}{parts.path}{query}",
        "driver": "org.postgresql.Driver",
    }
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def read_cases_table(
    spark: SparkSession,
    address: str,
    table: str = CASE_TABLE,
    *,
    column: str | None = None,
    lower: datetime | int | None = None,
    upper: datetime | int | None = None,
    partitions: int = 64,
    fetch_size: int = 10000,
) -> DataFrame:
    """A database table; with a ``column`` and its bounds the read runs in parallel ranges.

    The bounds only shape the ranges; rows outside them are read too. Filters and column
    selection on the result reach the database.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(address), dbtable=table, fetchsize=fetch_size)
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs both bounds")
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=partitions
        )
    return reader.load()


def load_cases(spark: SparkSession, place: str, *, single_task: bool = False, **database_options) -> DataFrame:
    """Cases from a database address, a CSV or JSON file, or a Parquet table.

    A database is read in ranges of a ``column``; one connection for all rows must be asked for by ``single_task``.
    """
    if place.startswith(DATABASE_PREFIXES):
        if database_options.get("column") is None and not single_task:
            raise ValueError("name a partition column and its bounds, or ask for a read in a single task")
        return read_cases_table(spark, place, **database_options)
    if place.endswith(".json"):
        return read_cases_json(spark, place)
    if place.endswith(".csv"):
        return read_raw_csv(spark, place)
    return spark.read.parquet(place)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The procedure catalog: procedure, service line and eight log-normal parameters."""
    return spark.read.schema(CATALOG_SCHEMA).option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The one-row document of a finished analysis."""
    return spark.read.schema(RESULTS_SCHEMA).option("multiLine", True).json(path)


def read_aggregates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AGGREGATE_SCHEMA).option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)


def stored_insights(results: DataFrame) -> DataFrame:
    """The findings of a results document, one row each."""
    return results.select(F.inline("insights"))
