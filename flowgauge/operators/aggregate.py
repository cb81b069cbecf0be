"""Group statistics of phase durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import late_start, ratio
from flowgauge.functions.stats import exact_percentiles
from flowgauge.operators.derive import as_timestamps, completed_only
from flowgauge.schema import CANCELED, COMPLETED, DURATIONS, KEYS, PHASES, STATISTICS

PERCENTILES = {"median": 0.5, "p90": 0.9}


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all known; the others belong to no group."""
    return df.na.drop(subset=list(keys)) if keys else df


def aggregates(
    df: DataFrame,
    *,
    keys: Sequence[str] = KEYS,
    columns: Sequence[str] = DURATIONS,
    statuses: Sequence[str] = (COMPLETED,),
    statistics: Sequence[str] = STATISTICS,
    percentiles: str = "exact",
) -> DataFrame:
    """Mean, median, p90 and deviation of each duration, case volume and late-start rate.

    Means, deviations, volume and rate come from one aggregation. Percentiles are exact
    by default; ``percentiles="approx"`` keeps them in that same single aggregation.
    """
    if percentiles not in ("exact", "approx"):
        raise ValueError("percentiles must be 'exact' or 'approx'")
    keys = list(keys)
    cases = with_keys(completed_only(df, statuses), keys)
    fractions = {name: PERCENTILES[name] for name in statistics if name in PERCENTILES}

    measures = []
    for column in columns:
        value = F.nanvl(F.col(column).cast("double"), F.lit(None))
        if "mean" in statistics:
            measures.append(F.avg(value).alias(f"{column}_mean"))
        if "std" in statistics:
            measures.append(F.stddev_samp(value).alias(f"{column}_std"))
        if percentiles == "approx":
            measures += [
                F.percentile_approx(value, fraction, 10000).alias(f"{column}_{name}")
                for name, fraction in fractions.items()
            ]
    measures.append(F.count("event_id").alias("case_volume"))
    if "scheduled_start_time" in cases.columns:
        cases = as_timestamps(cases, ("op_start_time", "scheduled_start_time"))
        measures.append(F.avg(late_start().cast("double")).alias("late_start_rate"))
    groups = cases.groupBy(*keys).agg(*measures)

    if fractions and percentiles == "exact":
        ranks = exact_percentiles(cases, keys, columns, fractions)
        if keys:
            groups = groups.join(ranks, keys, "left")
        else:  # one row each
            whole = groups.withColumn("ranks", ranks.select(F.struct(*ranks.columns)).scalar())
            groups = whole.select(*groups.columns, "ranks.*")
    ordered = [f"{column}_{name}" for column in columns for name in STATISTICS if name in statistics]
    rest = [name for name in ("case_volume", "late_start_rate") if name in groups.columns]
    return groups.select(*keys, *ordered, *rest)


def late_start_rates(
    df: DataFrame, keys: Sequence[str] = KEYS, statuses: Sequence[str] = (COMPLETED,)
) -> DataFrame:
    cases = with_keys(completed_only(df, statuses), keys)
    return cases.groupBy(*keys).agg(F.avg(late_start().cast("double")).alias("late_start_rate"))


def join_late_rates(groups: DataFrame, rates: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Attach late-start rates that were computed apart; both sides hold one row per group."""
    return groups.join(rates, list(keys), "left")


def phase_means(groups: DataFrame, by: str = "facility_id") -> DataFrame:
    """Per facility, the unweighted mean over its procedures of each phase's mean."""
    means = groups.groupBy(by).agg(
        *[F.avg(f"{phase.column}_mean").alias(phase.column) for phase in PHASES]
    )
    total = sum((F.col(phase.column) for phase in PHASES[1:]), F.col(PHASES[0].column))
    return means.withColumn("journey", total)


def phase_breakdown(groups: DataFrame, by: str = "facility_id") -> DataFrame:
    """The same means in long form: one row per facility and phase."""
    means = phase_means(groups, by)
    stacked = means.unpivot([by], [phase.column for phase in PHASES], "phase_column", "mean_of_means")
    labels = F.create_map(*[F.lit(text) for phase in PHASES for text in (phase.column, phase.label)])
    return stacked.select(by, labels[F.col("phase_column")].alias("phase"), "mean_of_means")


def longest_phase(groups: DataFrame, by: str = "facility_id") -> DataFrame:
    """Per facility, the phase with the largest mean, its minutes and share of the journey.

    Of equal phases the earliest wins. A facility without a positive journey is left out.
    """
    means = phase_means(groups, by).filter(F.col("journey") > 0)
    longest = F.greatest(*[F.col(phase.column) for phase in PHASES])
    name = F.coalesce(*[F.when(F.col(phase.column) == longest, F.lit(phase.label)) for phase in PHASES])
    return means.select(
        by,
        name.alias("phase"),
        longest.alias("phase_minutes"),
        "journey",
        (longest / F.col("journey") * 100).alias("phase_pct"),
    )


def facility_overview(df: DataFrame, statuses: Sequence[str] = (COMPLETED,)) -> DataFrame:
    """Mean and p90 of the total duration and the number of cases of each facility."""
    cases = with_keys(completed_only(df, statuses), ["facility_id"])
    value = F.nanvl(F.col("dur_total").cast("double"), F.lit(None))
    sizes = cases.groupBy("facility_id").agg(
        F.avg(value).alias("avg_total_minutes"), F.count(F.lit(1)).alias("total_cases")
    )
    ranks = exact_percentiles(cases, ["facility_id"], ["dur_total"], {"p90": 0.9})
    return sizes.join(ranks, "facility_id", "left").withColumnRenamed("dur_total_p90", "p90_total_minutes")


def cancellation_rate(df: DataFrame) -> DataFrame:
    """One row ``total, count, rate`` over all cases, whatever their status; none without cases."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.col("case_status") == CANCELED, F.lit(False))).alias("count"),
    ).filter(F.col("total") > 0)
    return counts.withColumn("rate", ratio(F.col("count"), F.col("total")))


def duration_threshold(
    df: DataFrame,
    column: str = "dur_postop_to_discharge",
    fraction: float = 0.9,
    statuses: Sequence[str] = (COMPLETED,),
) -> DataFrame:
    """One row ``threshold``: a percentile over all completed cases."""
    found = exact_percentiles(completed_only(df, statuses), [], [column], {"threshold": fraction})
    return found.withColumnRenamed(f"{column}_threshold", "threshold")


def with_extended_recovery(df: DataFrame, statuses: Sequence[str] = (COMPLETED,)) -> DataFrame:
    """Completed cases with ``extended_recovery`` = 1 above the p90 of their recovery time.

    ``df`` is read more than once: settle it first when it is costly to derive.
    """
    threshold = duration_threshold(df, statuses=statuses).scalar()
    above = F.coalesce(F.col("dur_postop_to_discharge") > threshold, F.lit(False))
    return completed_only(df, statuses).withColumn("extended_recovery", above.cast("int"))


def class_balance(df: DataFrame, label: str = "extended_recovery") -> DataFrame:
    """One row ``negatives, positives, positive_weight`` with weight = negatives / max(positives, 1)."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    )
    weight = F.col("negatives").cast("double") / F.greatest(F.col("positives"), F.lit(1))
    return counts.withColumn("positive_weight", weight)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The known values of a column, in order."""
    return df.select(column).na.drop().distinct().orderBy(column)
