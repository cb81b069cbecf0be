"""Groups, facilities and all cases summarised from one count of bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import late_start, ratio
from flowgauge.functions.stats import ONE_SECOND, Level, bin_counts, moments, percentiles_at
from flowgauge.operators.aggregate import PERCENTILES
from flowgauge.operators.derive import as_timestamps
from flowgauge.schema import CANCELED, COMPLETED, DURATIONS, KEYS, STATISTICS, TOTAL
from flowgauge.session import settle

SITE = ("facility_id",)
# Numbers that are counted like durations: a bin of zeros and one of ones.
LATE, DONE, KNOWN, CANCELLED = "is_late", "is_done", "is_known", "is_canceled"


class Summaries(NamedTuple):
    """What ``aggregates``, ``facility_overview`` and ``cancellation_rate`` return."""

    groups: DataFrame
    overview: DataFrame
    cancellation: DataFrame


def _measured(cases: DataFrame, columns: Sequence[str], statuses: Sequence[str]) -> tuple[DataFrame, list[str]]:
    done = F.coalesce(F.col("case_status").isin(*statuses), F.lit(False))
    flags: dict[str, Column] = {
        DONE: F.when(done, 1.0),
        KNOWN: F.when(done & F.col("event_id").isNotNull(), 1.0),
        CANCELLED: F.coalesce(F.col("case_status") == CANCELED, F.lit(False)).cast("double"),
    }
    if "scheduled_start_time" in cases.columns:
        cases = as_timestamps(cases, ("op_start_time", "scheduled_start_time"))
        flags[LATE] = F.when(done, late_start().cast("double"))
    durations = {name: F.when(done, F.col(name)) for name in columns}
    numbers = {**durations, **flags}
    return cases.select(*KEYS, *[value.alias(name) for name, value in numbers.items()]), list(numbers)


def _wide(found: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, str]], name: str = "metric") -> DataFrame:
    """One row per group: each column is a value of the row of one metric."""
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == metric, F.col(value))).alias(into) for into, (metric, value) in values.items()]
    )


def summaries(
    cases: DataFrame,
    *,
    columns: Sequence[str] = DURATIONS,
    statistics: Sequence[str] = STATISTICS,
    group_percentiles: Mapping[str, Mapping[str, float]] | None = None,
    statuses: Sequence[str] = (COMPLETED,),
    bin_width: float = ONE_SECOND,
) -> Summaries:
    """All three summaries by two scans of the cases: one counts bins per group, one looks at the values in the bins wanted.

    Facilities and the whole are added up from the groups' bins, and so are their percentiles. ``group_percentiles`` may ask
    for fewer than all of ``statistics`` of all ``columns``, by column; what is not asked for is left out.
    """
    measured, names = _measured(cases, columns, statuses)
    bins = settle(bin_counts(measured, KEYS, names, bin_width), "bins")
    fractions = {name: PERCENTILES[name] for name in statistics if name in PERCENTILES}
    wanted = {name: fractions for name in columns} if group_percentiles is None else group_percentiles
    wanted = {name: own for name, own in wanted.items() if own}
    levels = [Level(SITE, {TOTAL.column: {"p90": PERCENTILES["p90"]}})]
    if wanted:
        levels.append(Level(KEYS, wanted))
    found = percentiles_at(measured, bins, KEYS, levels, bin_width)

    group_values = {f"{name}_{kind}": (name, kind) for name in columns for kind in ("mean", "std") if kind in statistics}
    group_values |= {"case_volume": (KNOWN, "n"), "done": (DONE, "n")}
    if LATE in names:
        group_values["late_start_rate"] = (LATE, "mean")
    groups = _wide(moments(bins, KEYS), KEYS, group_values).filter("done > 0").drop("done")
    groups = groups.withColumn("case_volume", F.coalesce("case_volume", F.lit(0)))
    if wanted:
        named = found[1].withColumn("column", F.concat_ws("_", "metric", "name"))
        ranks = {f"{name}_{kind}": (f"{name}_{kind}", "percentile") for name, own in wanted.items() for kind in own}
        groups = groups.join(_wide(named, KEYS, ranks, "column"), list(KEYS), "left")
    order = [f"{name}_{kind}" for name in columns for kind in STATISTICS]
    rest = ["case_volume", "late_start_rate"]
    groups = groups.select(*KEYS, *[name for name in [*order, *rest] if name in groups.columns])

    site_values = {"avg_total_minutes": (TOTAL.column, "mean"), "total_cases": (DONE, "n")}
    sizes = _wide(moments(bins, SITE), SITE, site_values).filter("total_cases > 0")
    p90 = found[0].select(*SITE, F.col("percentile").alias("p90_total_minutes"))
    overview = sizes.join(p90, list(SITE), "left")

    every = moments(bins.filter(F.col("metric") == CANCELLED), ())
    counted = every.select(F.col("n").alias("total"), F.round(F.col("n") * F.col("mean")).cast("long").alias("count"))
    return Summaries(groups, overview, counted.withColumn("rate", ratio(F.col("count"), F.col("total"))))
