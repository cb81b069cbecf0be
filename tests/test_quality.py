from datetime import datetime

from cases import case, frame, plan, timed
from pyspark.sql import functions as F

from flowgauge.operators import quality
from flowgauge.schema import DURATIONS


def violations(df):
    return {row["event_id"]: set(row["violations"]) for row in quality.with_violations(df).collect()}


def test_each_rule(spark):
    rows = [
        case("good"),
        case("asa0", asa=0),
        case("asa7", asa=7),
        case("asa_none", asa=None),
        case("status", status="lost"),
        case("facility", facility=None),
        case("reversed", phases=(10, -5, 30, 40)),
        case("reversed_canceled", phases=(10, -5, 30, 40), status="canceled"),
    ]
    df = timed(spark, rows).withColumn(
        "dur_total", F.when(F.col("event_id") == "good", F.col("dur_total")).otherwise(F.col("dur_total"))
    )
    assert violations(df) == {
        "good": set(),
        "asa0": {"asa_class_out_of_range"},
        "asa7": {"asa_class_out_of_range"},
        "asa_none": set(),
        "status": {"unknown_case_status"},
        "facility": {"missing_facility_id"},
        "reversed": {"milestones_out_of_order", "duration_not_positive"},
        "reversed_canceled": set(),
    }


def test_additivity_tolerates_rounding_only(spark):
    df = timed(spark, [case("near"), case("far")])
    shifted = df.withColumn(
        "dur_total", F.col("dur_total") + F.when(F.col("event_id") == "far", 0.01).otherwise(0.0001)
    )
    assert violations(shifted) == {"near": set(), "far": {"durations_do_not_add_up"}}


def test_split_keeps_every_row(spark):
    df = timed(spark, [case("a"), case("b", asa=9), case("c", status="lost")])
    valid, quarantined = quality.split_by_quality(df)
    assert [row["event_id"] for row in valid.collect()] == ["a"]
    assert valid.columns == df.columns
    assert {row["event_id"] for row in quarantined.collect()} == {"b", "c"}


def test_counts_list_every_rule(spark):
    counts = {r["rule"]: r["violations"] for r in quality.violation_counts(timed(spark, [case("a", asa=9)])).collect()}
    assert counts.pop("asa_class_out_of_range") == 1
    assert len(counts) == 12 and set(counts.values()) == {0}


def test_duplicates_orphans_and_weekdays(spark):
    df = frame(spark, [case("a"), case("a"), case("b", facility="Z"), case("c", facility=None, start=datetime(2025, 1, 11, 9))])
    assert [tuple(r) for r in quality.duplicate_keys(df).collect()] == [("a", 2)]
    dimension = spark.createDataFrame([("A",)], "facility_id string")
    assert [tuple(r) for r in quality.orphan_keys(df, dimension, "facility_id").collect()] == [("Z", 1)]
    assert quality.on_weekdays(df).count() == 3


def test_one_job_writes_both_halves(spark, tmp_path):
    df = timed(spark, [case("good"), case("bad", asa=7), case("worse", asa=7, status="lost")])
    path = str(tmp_path / "checked")
    quality.write_by_quality(df, path)
    good = quality.read_by_quality(spark, path, quality.VALID, df.schema)
    bad = quality.read_by_quality(spark, path, quality.QUARANTINED, df.schema)
    assert good.columns == df.columns and [row["event_id"] for row in good.collect()] == ["good"]
    assert {row["event_id"]: len(row["violations"]) for row in bad.collect()} == {"bad": 1, "worse": 2}
    valid, held_back = quality.split_by_quality(df)
    assert "checked" not in plan(valid) and valid.count() == 1 and held_back.count() == 2


def test_weights_that_do_not_add_up(spark):
    rows = [("a", 0.5), ("a", 0.5), ("b", 0.5), ("b", 0.4), ("c", None)]
    off = quality.weights_off(spark.createDataFrame(rows, "line string, weight double"), ["line"]).collect()
    assert {row["line"] for row in off} == {"b", "c"}


def test_a_filter_on_violations_does_not_repeat_the_columns(spark):
    """Pushed below them, it held the subtraction of each duration once for each use in a rule."""
    moments = timed(spark, [case("a"), case("b", asa=9)])
    valid, quarantined = quality.split_by_quality(moments)
    for half in (valid, quarantined):
        plan_text = half.select("event_id")._jdf.queryExecution().optimizedPlan().toString()
        assert plan_text.count("timestampdiff") + plan_text.count("unix_micros") <= 4 * len(DURATIONS)
    assert [row["event_id"] for row in quarantined.collect()] == ["b"]
