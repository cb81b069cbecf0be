"""Summary tables for a report, from insights, group statistics and model results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.fixed_values import INSIGHT_TABS
from flowgauge.functions.columns import chart_label, feature_title
from flowgauge.functions.text import nearest, percent, whole_percent
from flowgauge.operators.aggregate import phase_breakdown
from flowgauge.operators.ranking import top_groups
from flowgauge.schema import SEVERITY_ORDER


MOST_COLUMNS = 200


def kpi_row(overview: DataFrame, rate_row: DataFrame) -> DataFrame:
    """One row: completed cases, facilities, weighted mean duration, cancellations.

    Both inputs are summaries: one row per facility, and one row for all cases.
    """
    cases = F.coalesce(F.sum("total_cases"), F.lit(0))
    minutes = F.coalesce(F.sum(F.col("avg_total_minutes") * F.col("total_cases")), F.lit(0.0))
    rates = rate_row.agg(
        F.struct(
            F.max("total").alias("all_cases"),
            F.coalesce(F.max("count"), F.lit(0)).alias("canceled"),
            F.max("rate").alias("cancel_rate"),
        )
    ).scalar()
    return (
        overview.agg(
            cases.alias("completed"),
            F.count(F.lit(1)).alias("facilities"),
            (minutes / F.greatest(cases, F.lit(1))).alias("avg_total_minutes"),
        )
        .withColumn("rates", rates)
        .select("completed", "facilities", "avg_total_minutes", "rates.*")
    )


def model_cards(results: DataFrame) -> DataFrame:
    """One row with the quality figures of both models; null where a model is missing."""
    return results.select(
        F.col("discharge_predictor.r2_score").alias("r2_score"),
        F.col("discharge_predictor.mae_minutes").alias("mae_minutes"),
        F.col("extended_recovery_classifier.auc_score").alias("auc_score"),
        F.col("extended_recovery_classifier.p90_threshold_minutes").alias("p90_threshold_minutes"),
    )


def summaries_of(insights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facility overview and cancellation row as far as stored findings tell them."""
    overview = insights.filter(F.col("type") == "facility_summary").select(
        F.col("facility").alias("facility_id"), "avg_total_minutes", "p90_total_minutes", "total_cases"
    )
    rate_row = insights.filter(F.col("type") == "cancellation_rate").select("total", "count", "rate")
    return overview, rate_row


def facility_chart(overview: DataFrame) -> DataFrame:
    """Case volume and mean duration per facility."""
    return overview.select(
        "facility_id", "total_cases", nearest(F.col("avg_total_minutes"), 1).alias("avg_total_minutes")
    )


def phase_chart(groups: DataFrame) -> DataFrame:
    long = phase_breakdown(groups)
    return long.withColumn("mean_of_means", nearest(F.col("mean_of_means"), 1))


def phase_matrix(groups: DataFrame, facilities: Sequence[str] | None = None) -> DataFrame:
    """One row per phase, one column per facility of the given ones.

    Without a list the facilities are read from the groups, and more than ``MOST_COLUMNS`` of them are refused.
    """
    if facilities is None:
        seen = groups.select("facility_id").distinct().orderBy("facility_id").limit(MOST_COLUMNS + 1).collect()
        facilities = [row["facility_id"] for row in seen]
        if len(facilities) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} facilities: name those wanted, or use phase_chart with a row for each")
    return phase_chart(groups).groupBy("phase").pivot("facility_id", list(facilities)).agg(F.first("mean_of_means"))


def top_procedures_chart(groups: DataFrame, k: int = 10) -> DataFrame:
    """Mean and p90 of the ``k`` largest groups."""
    return top_groups(groups, "case_volume", k).select(
        chart_label("procedure_type", "facility_id").alias("label"),
        "case_volume",
        nearest(F.col("dur_total_mean"), 1).alias("mean_minutes"),
        nearest(F.col("dur_total_p90"), 1).alias("p90_minutes"),
    )


def top_procedures_table(groups: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest groups; an unknown late-start rate reads as a dash."""
    late = whole_percent(F.col("late_start_rate"))
    return top_groups(groups, "case_volume", k).select(
        "facility_id",
        "procedure_type",
        "case_volume",
        *[
            nearest(F.col(f"dur_total_{name}"), 1).alias(f"{name}_minutes")
            for name in ("mean", "median", "p90", "std")
        ],
        F.when(F.col("late_start_rate").isNotNull(), late).otherwise("—").alias("late_starts"),
    )


def status_distribution(kpi: DataFrame) -> DataFrame:
    """Cases completed, canceled and everything else, from the KPI row."""
    rest = F.coalesce(F.col("all_cases") - F.col("completed") - F.col("canceled"), F.lit(0))
    named = kpi.select(
        F.col("completed").alias("Completed"),
        F.col("canceled").alias("Cancelled"),
        F.greatest(rest, F.lit(0)).alias("Other"),
    )
    return named.unpivot([], ["Completed", "Cancelled", "Other"], "status", "cases")


def importance_ranking(importances: DataFrame) -> DataFrame:
    """Features by weight, from a column ``feature_importance`` (map of name to fraction)."""
    return (
        importances.select(F.explode("feature_importance").alias("feature", "weight"))
        .select(
            feature_title(F.col("feature")).alias("feature"),
            percent(F.col("weight")).alias("importance_pct"),
            "weight",
        )
        .orderBy(F.desc("weight"))
        .drop("weight")
    )


def insight_counts(insights: DataFrame) -> DataFrame:
    """Number of findings in all, per type in tab order, and per severity.

    The total and the severities are always listed, a type only when it occurs.
    """
    entries = [("tab", key, label) for key, label in INSIGHT_TABS]
    entries += [("severity", name, name) for name in SEVERITY_ORDER]
    listed = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(kind).alias("kind"),
                F.lit(key).alias("key"),
                F.lit(label).alias("label"),
            )
            for position, (kind, key, label) in enumerate(entries)
        ]
    )
    known = [key for _, key, _ in entries if key != "all"]
    # one row, one map of counts: the findings are already few
    per_name = (
        insights.select(F.explode(F.array(F.lit("all"), "type", "severity")).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = per_name.agg(
        *[F.coalesce(F.max(F.when(F.col("key") == key, F.col("n"))), F.lit(0)).alias(key) for key in ("all", *known)]
    )
    tally = F.create_map(*[part for key in ("all", *known) for part in (F.lit(key), F.col(key))])
    return (
        counts.select(tally.alias("tally"), F.inline(listed))
        .select("position", "kind", "key", "label", F.col("tally")[F.col("key")].alias("n"))
        .filter((F.col("n") > 0) | (F.col("key") == "all") | (F.col("kind") == "severity"))
        .orderBy("position")
    )


def finding_totals(insights: DataFrame) -> DataFrame:
    """Findings per type and severity with subtotals; a null marks a subtotal."""
    return insights.cube("type", "severity").agg(F.count(F.lit(1)).alias("n"))
