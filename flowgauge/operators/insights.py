"""Findings with severity and text, ranked for a reader.

Every family returns the common insight columns plus the sort columns ``family`` and
``place``, ``first_key``, ``second_key``, which ``in_order`` uses and drops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge import texts
from flowgauge.functions.columns import graded, severity_rank
from flowgauge.functions.stats import numbered
from flowgauge.functions.text import fill, grouped, lookup, nearest, tenth_percent, whole, whole_percent
from flowgauge.operators.aggregate import cancellation_rate, facility_overview, longest_phase
from flowgauge.operators.levels import Summaries
from flowgauge.operators.ranking import most_late, most_variable, wide_gaps
from flowgauge.schema import INSIGHT_SCHEMA

SORT_COLUMNS = ("family", "place", "first_key", "second_key")


def _finding(
    df: DataFrame,
    kind: str,
    family: int,
    severity: Column,
    fields: dict[str, Column],
    text: dict[str, Column],
    place: Column | None = None,
    first_key: Column | None = None,
    second_key: Column | None = None,
) -> DataFrame:
    values = {"type": F.lit(kind), "severity": severity, **fields, **text}
    common = [
        values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in INSIGHT_SCHEMA
    ]
    nothing = F.lit(None).cast("string")
    return df.select(
        *common,
        F.lit(family).alias("family"),
        (F.lit(None) if place is None else place).cast("double").alias("place"),
        (nothing if first_key is None else first_key).alias("first_key"),
        (nothing if second_key is None else second_key).alias("second_key"),
    )


def high_variance(groups: DataFrame) -> DataFrame:
    facility, procedure = F.col("facility_id"), F.col("procedure_type")
    std, cv = F.col("dur_total_std"), F.col("coefficient_of_variation")
    wording = texts.HIGH_VARIANCE
    return _finding(
        most_variable(groups),
        "high_variance",
        1,
        graded(cv, high=50),
        {
            "facility": facility,
            "procedure": procedure,
            "total_duration_std": nearest(std, 1),
            "coefficient_of_variation": nearest(cv, 1),
        },
        {
            "title": fill(wording["title"], procedure=procedure),
            "message": fill(
                wording["message"],
                facility=facility,
                procedure=procedure,
                std=whole(std),
                cv=whole(cv),
                mean=whole(F.col("dur_total_mean")),
                p90=whole(F.col("dur_total_p90")),
            ),
            "impact": F.lit(wording["impact"]),
            "action": F.lit(wording["action"]),
        },
        place=-std,
        first_key=facility,
        second_key=procedure,
    )


def late_starts(groups: DataFrame) -> DataFrame:
    facility, procedure, rate = F.col("facility_id"), F.col("procedure_type"), F.col("late_start_rate")
    wording = texts.LATE_STARTS
    return _finding(
        most_late(groups),
        "late_starts",
        2,
        graded(rate, high=0.5),
        {"facility": facility, "procedure": procedure, "late_start_rate": nearest(rate, 3)},
        {
            "title": fill(wording["title"], procedure=procedure),
            "message": fill(
                wording["message"], facility=facility, procedure=procedure, rate=whole_percent(rate)
            ),
            "impact": F.lit(wording["impact"]),
            "action": F.lit(wording["action"]),
        },
        place=-rate,
        first_key=facility,
        second_key=procedure,
    )


def bottlenecks(groups: DataFrame, above_pct: float = 35) -> DataFrame:
    facility, phase = F.col("facility_id"), F.col("phase")
    worst, pct = F.col("phase_minutes"), F.col("phase_pct")
    wording = texts.BOTTLENECK
    return _finding(
        longest_phase(groups).filter(pct > above_pct),
        "bottleneck",
        3,
        graded(pct, high=45),
        {
            "facility": facility,
            "phase": phase,
            "phase_minutes": nearest(worst, 1),
            "phase_pct": nearest(pct, 1),
        },
        {
            "title": fill(wording["title"], phase=phase),
            "message": fill(
                wording["message"],
                facility=facility,
                phase=phase,
                pct=whole(pct),
                worst=whole(worst),
                total=whole(F.col("journey")),
            ),
            "impact": fill(wording["impact"], facility=facility, saving=whole(worst * 0.125)),
            "action": lookup(
                phase, texts.PHASE_ACTIONS, fill(wording["action"], phase_lower=F.lower(phase))
            ),
        },
        first_key=facility,
    )


def cross_facility(groups: DataFrame) -> DataFrame:
    procedure = F.col("procedure_type")
    fast, slow = F.col("fastest_facility"), F.col("slowest_facility")
    gap, gap_pct = F.col("gap_minutes"), F.col("gap_pct")
    wording = texts.CROSS_FACILITY
    return _finding(
        wide_gaps(groups),
        "cross_facility",
        4,
        F.lit("medium"),
        {
            "facility": slow,
            "procedure": procedure,
            "gap_minutes": nearest(gap, 1),
            "gap_pct": nearest(gap_pct, 1),
            "reference_facility": fast,
        },
        {
            "title": fill(wording["title"], procedure=procedure),
            "message": fill(
                wording["message"],
                procedure=procedure,
                slow=slow,
                slow_mean=whole(F.col("slowest_mean")),
                gap=whole(gap),
                gap_pct=whole(gap_pct),
                fast=fast,
                fast_mean=whole(F.col("fastest_mean")),
            ),
            "impact": fill(wording["impact"], slow=slow, fast=fast, gap=whole(gap)),
            "action": fill(wording["action"], slow=slow, fast=fast, procedure=procedure),
        },
        first_key=F.col("first_facility"),
        second_key=procedure,
    )


def facility_summaries(overview: DataFrame) -> DataFrame:
    facility, cases = F.col("facility_id"), F.col("total_cases")
    mean, p90 = F.col("avg_total_minutes"), F.col("p90_total_minutes")
    wording = texts.FACILITY_SUMMARY
    return _finding(
        overview,
        "facility_summary",
        5,
        F.lit("info"),
        {
            "facility": facility,
            "avg_total_minutes": nearest(mean, 1),
            "p90_total_minutes": nearest(p90, 1),
            "total_cases": cases,
        },
        {
            "title": fill(wording["title"], facility=facility),
            "message": fill(
                wording["message"],
                facility=facility,
                cases=grouped(cases),
                mean=whole(mean),
                p90=whole(p90),
            ),
            "impact": F.lit(wording["impact"]),
            "action": F.lit(wording["action"]),
        },
        first_key=facility,
    )


def cancellations(rate_row: DataFrame) -> DataFrame:
    rate, count, total = F.col("rate"), F.col("count"), F.col("total")
    raised = rate > 0.02
    wording = texts.CANCELLATION
    return _finding(
        rate_row,
        "cancellation_rate",
        6,
        graded(rate, high=0.05, medium=0.02),
        {"rate": nearest(rate, 4), "count": count, "total": total},
        {
            "title": F.lit(wording["title"]),
            "message": fill(
                wording["message"], total=grouped(total), count=grouped(count), rate=tenth_percent(rate)
            ),
            "impact": F.when(raised, wording["impact_raised"]).otherwise(wording["impact_normal"]),
            "action": F.when(raised, wording["action_raised"]).otherwise(wording["action_normal"]),
        },
    )


def _order() -> list[Column]:
    return [
        severity_rank(F.col("severity")),
        F.col("family"),
        F.asc_nulls_last("place"),
        F.asc_nulls_last("first_key"),
        F.asc_nulls_last("second_key"),
    ]


def in_order(findings: DataFrame) -> DataFrame:
    """By severity, then family, then each family's own order."""
    return findings.orderBy(*_order())


def positioned(findings: DataFrame) -> DataFrame:
    """The findings with their place in that order as ``position``, from 1, in place of the sort columns."""
    return numbered(findings, _order(), "position").drop(*SORT_COLUMNS)


def findings_of(found: Summaries) -> DataFrame:
    """All six families with their sort columns, not yet sorted. Four of them read the groups, so settle these first."""
    families = [
        high_variance(found.groups),
        late_starts(found.groups),
        bottlenecks(found.groups),
        cross_facility(found.groups),
        facility_summaries(found.overview),
        cancellations(found.cancellation),
    ]
    return reduce(DataFrame.unionByName, families)


def ranked_findings(cases: DataFrame, groups: DataFrame) -> DataFrame:
    """The same from cases with durations, which are read more than once, and the ``aggregates`` of their groups."""
    return findings_of(Summaries(groups, facility_overview(cases), cancellation_rate(cases)))


def all_insights(cases: DataFrame, groups: DataFrame) -> DataFrame:
    return in_order(ranked_findings(cases, groups)).drop(*SORT_COLUMNS)
