"""Incremental load: watermark, new rows, insert-ignore, new watermark."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flowgauge.operators.derive import transfer_form
from flowgauge.operators.ingest import EPOCH, is_wall_clock, merge_watermarks, position_column, position_of, rows_after
from flowgauge.schema import DEFAULT_SOURCE_ID, WATERMARK_SCHEMA
from flowgauge.sources.keyed import read_table, replace_loads
from flowgauge.sources.writers import insert_counted


class Load(NamedTuple):
    inserted: int
    watermark: datetime | None  # to show; the position itself is never taken from a Python clock
    rejected: int = 0  # rows without a key, newly set aside


def load_increment(
    source: DataFrame,
    target_path: str,
    state_path: str,
    source_id: str = DEFAULT_SOURCE_ID,
    *,
    strict: bool = False,
    run_at: datetime | None = None,
) -> Load:
    """Bring the source's new rows into the target table.

    The state has one row per source and is replaced as a whole. Rows are committed first and the state second: a run that
    breaks off, at whatever step, is simply repeated, and the rows already stored are not stored twice. The watermark
    advances to the latest creation time seen, even when every row was known. One writer per target; a second one fails.

    The source is read once, behind the watermark. Rows without a key go to ``rejected_path`` of the target.
    Times without a zone are stored in the state as if their clock were UTC's.
    """
    spark = source.sparkSession
    state = read_table(spark, state_path, WATERMARK_SCHEMA)
    position = position_of(state, source_id)
    pulled, seen = rows_after(transfer_form(source), position, strict=strict), Observation()
    inserted, rejected = insert_counted(pulled.observe(seen, position_column(pulled).alias("newest")), target_path)
    newest = seen.get["newest"]
    reached = max((place for place in (position, newest) if place is not None), default=None)
    if reached is None:
        return Load(inserted, None, rejected)
    run = spark.range(1).select(
        F.lit(source_id).alias("source_id"),
        F.timestamp_micros(F.lit(reached).cast("long")).alias("last_created_at"),
        (F.current_timestamp() if run_at is None else F.lit(run_at)).alias("last_run_at"),
        F.lit(inserted).cast("long").alias("rows_transferred"),
    )
    # a handful of rows, held apart from the files that are about to be replaced
    replace_loads(merge_watermarks(state, run), state_path, "source_id")
    return Load(inserted, _shown(reached, pulled), rejected)


def _shown(position: int, rows: DataFrame) -> datetime:
    """A position as the moment that the source would show: on its own clock, or on this process's."""
    if is_wall_clock(rows, "created_at"):
        return EPOCH + timedelta(microseconds=position)
    return (EPOCH.replace(tzinfo=timezone.utc) + timedelta(microseconds=position)).astimezone().replace(tzinfo=None)
