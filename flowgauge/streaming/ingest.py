"""The incremental load as a stream over arriving files."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowgauge.sources.readers import read_raw_csv
from flowgauge.sources.writers import insert_ignore

SEEN_AT = "seen_at"
# Fixed value: what Spark tells of a file that it does not parse.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
STORE = "spark.sql.streaming.stateStore"
# The state lies on the executors' disks and takes so much memory of each, whatever arrives; the default store holds all rows in memory.
STATE_ON_DISK = {
    f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STORE}.rocksdb.maxMemoryUsageMB": "256",
    f"{STORE}.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    file_format: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Rows of the files that arrive. CSV columns must stand as in the schema, or the read fails: see ``csv_arrivals``."""
    reader = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"')
        reader = reader.option("enforceSchema", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def csv_arrivals(spark: SparkSession, folder: str, *, pattern: str = "*.csv", files_per_batch: int = 1000) -> DataFrame:
    """The places of CSV files that arrive, for ``rows_by_header`` as the transformation of a batch; contents are not read here."""
    reader = spark.readStream.schema(FILE_SCHEMA).format("binaryFile").option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", pattern).load(folder).select("path")


def rows_by_header(batch: DataFrame) -> DataFrame:
    """The rows of a batch of CSV files, each file's columns by the names in its own header.

    A batch names as many files as it was limited to.
    """
    return read_raw_csv(batch.sparkSession, *[row["path"] for row in batch.select("path").collect()])


def without_redeliveries(stream: DataFrame, within: str = "1 hour") -> DataFrame:
    """Rows that repeat, column by column, one seen at most ``within`` before are dropped.

    The rows seen are kept in the state store until the time is over, so the state is bounded by what arrives in that time.
    Time is that of arrival: no row is too late for it, however old its own times are. A copy that comes later, or with
    other values, goes through; the target's keys decide on it.
    """
    timed = stream.withColumn(SEEN_AT, F.current_timestamp()).withWatermark(SEEN_AT, within)
    return timed.dropDuplicatesWithinWatermark(stream.columns).drop(SEEN_AT)


@contextlib.contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """For queries that start within the block. One that goes on from a checkpoint keeps the store it was begun with."""
    before = {name: spark.conf.get(name, None) for name in STATE_ON_DISK}
    for name, value in STATE_ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ingest_available(
    stream: DataFrame,
    target_path: str,
    checkpoint_path: str,
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    key: str = "event_id",
) -> StreamingQuery:
    """Load everything that has arrived since the last run, then stop; returns the ended query.

    The checkpoint takes the place of the watermark table. A batch that is replayed
    after a failure adds nothing, and late rows are kept, because each batch is matched
    against the stored keys in the buckets of its own and not against a bounded window of them.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        insert_ignore(transform(batch), target_path, key)  # which reads it once, as each reading runs the batch again

    with _state_on_disk(stream.sparkSession):
        query = (
            stream.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return query
