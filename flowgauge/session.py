"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def local_session(name: str = "flowgauge", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster, use the session it provides."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        # small row groups, so that all local cores share an intermediate table of a few MB
        .config("spark.hadoop.parquet.block.size", str(4 << 20))
        .getOrCreate()
    )


@functools.cache
def _own_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="flowgauge-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder(spark.sparkContext.applicationId)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


_passing: set[str] = set()


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of this application's own, which the file system deletes when the driver ends, also after a failure."""
    root = f"{shared_folder(spark)}/flowgauge/{spark.sparkContext.applicationId}"
    if root not in _passing:
        system, place = file_system(spark, root)
        system.mkdirs(place)
        system.deleteOnExit(place)
        _passing.add(root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


def compact(df: DataFrame) -> DataFrameWriter:
    """A writer of tables that are read again here: closer packed than by the default, as they are most of what is written."""
    return df.write.option("compression", "zstd")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a re-run, and
    it gives the planner the true size: a small result is then broadcast because it
    measures below ``spark.sql.autoBroadcastJoinThreshold``, a large one is shuffled.
    """
    path = new_folder(df.sparkSession, label)
    compact(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settled(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``settle`` for as long as the block lasts; the folder is removed at its end, also after a failure."""
    path = new_folder(df.sparkSession, label)
    try:
        compact(df).parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(df.sparkSession, path)
