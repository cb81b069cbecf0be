"""Joins of cases with the facility and procedure dimensions.

Dimensions are expected as stored tables (or settled), so that their measured size
decides whether they are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import local_time
from flowgauge.operators.derive import completed_only
from flowgauge.schema import COMPLETED, MILESTONES


def with_catalog(df: DataFrame, catalog: DataFrame, columns: Sequence[str] = ("service_line",)) -> DataFrame:
    return df.join(catalog.select("procedure_type", *columns), "procedure_type", "left")


def with_facility(
    df: DataFrame, facilities: DataFrame, columns: Sequence[str] = ("facility_name", "timezone")
) -> DataFrame:
    return df.join(facilities.select("facility_id", *columns), "facility_id", "left")


def on_local_clock(df: DataFrame, columns: Sequence[str] = MILESTONES, timezone: str = "timezone") -> DataFrame:
    """Milestones in the facility's own time zone; UTC where none is stored."""
    zone = F.coalesce(F.col(timezone), F.lit("UTC"))
    return df.withColumns({name: local_time(F.col(name), zone) for name in columns})


def procedures_of(catalog: DataFrame, service_line: str) -> DataFrame:
    return catalog.filter(F.col("service_line") == service_line)


def service_lines(catalog: DataFrame) -> DataFrame:
    return catalog.select("service_line").distinct().orderBy("service_line")


def service_line_rollup(
    df: DataFrame, catalog: DataFrame, statuses: Sequence[str] = (COMPLETED,)
) -> DataFrame:
    """Cases and mean total duration per facility and service line.

    Cases are summed per procedure before the join, so the join sees one row per
    facility and procedure.
    """
    per_procedure = (
        completed_only(df, statuses)
        .groupBy("facility_id", "procedure_type")
        .agg(
            F.count(F.lit(1)).alias("cases"),
            F.count("dur_total").alias("timed"),
            F.sum("dur_total").alias("minutes"),
        )
    )
    minutes, timed = F.sum("minutes"), F.sum("timed")
    return (
        with_catalog(per_procedure, catalog)
        .groupBy("facility_id", "service_line")
        .agg(
            F.sum("cases").alias("cases"),
            F.when(timed > 0, minutes / timed).alias("avg_total_minutes"),
        )
    )
