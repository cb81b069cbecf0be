"""Top groups and the spread between facilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import ratio, variation_pct
from flowgauge.schema import KEYS


def top_groups(groups: DataFrame, by: str, k: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``k`` groups with the largest ``by``; nulls last, equal values in key order."""
    return groups.orderBy(F.desc_nulls_last(by), *[F.asc(key) for key in keys]).limit(k)


def most_variable(groups: DataFrame, k: int = 5) -> DataFrame:
    """The groups whose total duration deviates most, with the coefficient of variation."""
    top = top_groups(groups, "dur_total_std", k)
    cv = variation_pct(F.col("dur_total_std"), F.col("dur_total_mean"))
    return top.withColumn("coefficient_of_variation", cv)


def most_late(groups: DataFrame, k: int = 5, above: float = 0.2) -> DataFrame:
    """The groups that start late most often, among those above a rate of ``above``."""
    return top_groups(groups.filter(F.col("late_start_rate") > above), "late_start_rate", k)


def facility_gaps(groups: DataFrame, value: str = "dur_total_mean") -> DataFrame:
    """Per procedure seen at two or more facilities, its fastest and slowest facility.

    Of equal means the first facility in order wins on both sides.
    """
    known = F.col(value).isNotNull()
    pair = F.struct(F.col("facility_id").alias("facility"), F.col(value).alias("mean"))
    fast_first = F.when(known, F.struct(F.col(value), F.col("facility_id")))
    slow_first = F.when(known, F.struct(-F.col(value), F.col("facility_id")))
    ends = (
        groups.groupBy("procedure_type")
        .agg(
            F.count(F.lit(1)).alias("n_facilities"),
            F.min("facility_id").alias("first_facility"),
            F.min_by(pair, fast_first).alias("fast"),
            F.min_by(pair, slow_first).alias("slow"),
        )
        .filter(F.col("n_facilities") >= 2)
    )
    gap = F.col("slow.mean") - F.col("fast.mean")
    return ends.select(
        "procedure_type",
        "n_facilities",
        "first_facility",
        F.col("fast.facility").alias("fastest_facility"),
        F.col("fast.mean").alias("fastest_mean"),
        F.col("slow.facility").alias("slowest_facility"),
        F.col("slow.mean").alias("slowest_mean"),
        gap.alias("gap_minutes"),
        (ratio(gap, F.col("fast.mean")) * 100).alias("gap_pct"),
    )


def wide_gaps(groups: DataFrame, min_minutes: float = 20, min_pct: float = 30) -> DataFrame:
    """The gaps above both limits; a fastest mean of zero has no percentage and drops out."""
    gaps = facility_gaps(groups)
    return gaps.filter((F.col("gap_minutes") > min_minutes) & (F.col("gap_pct") > min_pct))
