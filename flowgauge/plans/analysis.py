"""The whole analysis: cases in, aggregates, model results, insights and tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgauge.operators import report
from flowgauge.operators.derive import with_durations
from flowgauge.operators.insights import findings_of, positioned
from flowgauge.operators.levels import summaries
from flowgauge.operators.models import (
    prepare_features,
    train_discharge_predictor,
    train_recovery_classifier,
)
from flowgauge.schema import DURATIONS, KEYS
from flowgauge.session import settle
from flowgauge.sources.readers import load_cases, read_aggregates, read_results, stored_insights
from flowgauge.sources.writers import results_document, write_aggregates, write_results


SUMMARY_COLUMNS = ("event_id", *KEYS, "case_status", "scheduled_start_time", "op_start_time", *DURATIONS)
MODEL_COLUMNS = ("checkin_time", "anesthesia_type", "asa_class")


def analyse(
    cases: DataFrame, *, with_models: bool = True, trees: int = 100, timestamp: str | None = None
) -> dict[str, DataFrame]:
    """Frames ``aggregates``, ``insights`` and the one-row ``results``.

    Of the timed cases what the branches read is written once to the shared folder; the summaries scan it twice.
    """
    columns = SUMMARY_COLUMNS + (MODEL_COLUMNS if with_models else ())
    derived = with_durations(cases)
    timed = settle(derived.select(*[name for name in columns if name in derived.columns]), "timed-cases")
    found = summaries(timed)
    groups = settle(found.groups, "aggregates")
    findings = settle(findings_of(found._replace(groups=groups)), "findings")
    predictor = classifier = None
    if with_models:
        prepared, features = prepare_features(timed)
        predictor = train_discharge_predictor(prepared, features, trees=trees)
        classifier = train_recovery_classifier(prepared, features, trees=trees)
    return {
        "cases": timed,
        "aggregates": groups,
        "insights": positioned(findings),
        "results": results_document(findings, predictor, classifier, timestamp),
    }


def run_analysis(
    spark: SparkSession, place: str, output: str, *, reading: dict | None = None, **options
) -> dict[str, DataFrame]:
    """Load, analyse and write ``aggregates.csv`` and ``analytics_results.json`` (folders).

    ``reading`` has the options of ``load_cases`` for a database.
    """
    frames = analyse(load_cases(spark, place, **(reading or {})), **options)
    write_aggregates(frames["aggregates"], f"{output}/aggregates.csv")
    write_results(frames["results"], f"{output}/analytics_results.json")
    return frames


def report_tables(groups: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    """Every table of the report, from the stored outputs of an analysis."""
    insights = stored_insights(results)
    overview, rate_row = report.summaries_of(insights)
    kpi = report.kpi_row(overview, rate_row)
    return {
        "kpi": kpi,
        "models": report.model_cards(results),
        "facilities": report.facility_chart(overview),
        "phases": report.phase_chart(groups),
        "top_procedures_chart": report.top_procedures_chart(groups),
        "status": report.status_distribution(kpi),
        "importance": report.importance_ranking(results.select("discharge_predictor.feature_importance")),
        "insight_counts": report.insight_counts(insights),
        "top_procedures": report.top_procedures_table(groups),
    }


def write_report(spark: SparkSession, output: str) -> None:
    """Read an analysis back from ``output`` and write its report tables beside it."""
    groups = read_aggregates(spark, f"{output}/aggregates.csv")
    results = read_results(spark, f"{output}/analytics_results.json")
    for name, frame in report_tables(groups, results).items():
        frame.write.mode("overwrite").json(f"{output}/report/{name}")
