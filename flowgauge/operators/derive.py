"""Columns derived from a case's own milestones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions.columns import clamp, day_of_week, hour_of_day, late_start, minutes_between
from flowgauge.schema import COMPLETED, DURATIONS, MILESTONES, PHASES, TOTAL, TRANSFER_SCHEMA
from flowgauge.fixed_values import DURATION_BOUNDS


def as_timestamps(df: DataFrame, columns: Sequence[str] = MILESTONES, lenient: bool = False) -> DataFrame:
    """Parse the milestone columns that are not timestamps yet.

    Unreadable text fails the job; with ``lenient`` it becomes null instead.
    """
    parse = F.try_to_timestamp if lenient else F.to_timestamp
    ready = (T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {
            name: parse(F.col(name).cast("string"))
            for name in columns
            if name in df.columns and not isinstance(df.schema[name].dataType, ready)
        }
    )


def elapsed_minutes(df: DataFrame, start: str, end: str) -> Column:
    """Minutes between two columns of ``df``, by the kind of timestamps they hold."""
    zoned = all(isinstance(df.schema[name].dataType, T.TimestampType) for name in (start, end))
    return minutes_between(start, end, zoned)


def with_durations(df: DataFrame) -> DataFrame:
    """Add the four phase durations and the total, in minutes, unless they are there."""
    df = as_timestamps(df, (*MILESTONES, "scheduled_start_time"))
    if DURATIONS[0] in df.columns:
        return df
    return df.withColumns(
        {phase.column: elapsed_minutes(df, phase.start, phase.end) for phase in (*PHASES, TOTAL)}
    )


def completed_only(df: DataFrame, statuses: Sequence[str] = (COMPLETED,)) -> DataFrame:
    return df.filter(F.col("case_status").isin(*statuses))


def with_late_start(df: DataFrame, grace_minutes: int = 15) -> DataFrame:
    ready = as_timestamps(df, ("op_start_time", "scheduled_start_time"))
    return ready.withColumn("late_start", late_start(grace_minutes=grace_minutes))


def with_checkin_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"checkin_hour": hour_of_day("checkin_time"), "checkin_dow": day_of_week("checkin_time")}
    )


def clip_durations(
    df: DataFrame,
    columns: Sequence[str] = DURATIONS,
    low: float = DURATION_BOUNDS[0],
    high: float = DURATION_BOUNDS[1],
) -> DataFrame:
    return df.withColumns({name: clamp(F.col(name), low, high) for name in columns})


def transfer_form(df: DataFrame) -> DataFrame:
    """The stored columns in their fixed order, without the derived ones.

    A source that lacks some of them gets nulls there.
    """
    return df.select(
        *[
            F.col(field.name) if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name)
            for field in TRANSFER_SCHEMA
        ]
    )
