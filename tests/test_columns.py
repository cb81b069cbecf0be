from datetime import datetime

import pytest
from cases import case, frame
from pyspark.sql import functions as F

from flowgauge.functions import columns as C
from flowgauge.functions.text import fill, grouped, lookup, nearest, percent, tenth_percent, whole, whole_percent
from flowgauge.operators.derive import as_timestamps, clip_durations, transfer_form, with_durations, with_late_start
from flowgauge.schema import CASE_SCHEMA, DURATIONS, TRANSFER_COLUMNS


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_durations_keep_fractions_and_add_up(spark):
    row = with_durations(frame(spark, [case("a", phases=(0.5, 1.25, 10, 20.000001))])).first()
    assert row["dur_checkin_to_preop"] == 0.5
    assert row["dur_preop_to_op"] == 1.25
    assert row["dur_total"] == pytest.approx(31.750001, abs=1e-6)


def test_existing_durations_are_kept(spark):
    df = frame(spark, [case("a")]).withColumn("dur_checkin_to_preop", F.lit(99.0))
    assert with_durations(df).first()["dur_checkin_to_preop"] == 99.0
    assert "dur_total" not in with_durations(df).columns


def test_durations_ignore_a_change_of_the_clock(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            "SELECT timestamp'2025-03-09T06:30:00Z' AS a, timestamp'2025-03-09T07:30:00Z' AS b"
        )
        assert df.select(C.minutes_between("a", "b", zoned=True).alias("m")).first()["m"] == 60.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_text_milestones_with_and_without_fraction(spark):
    df = spark.createDataFrame(
        [("2025-01-06T07:00:00+00:00", "2025-01-06T07:10:30.500000+00:00")],
        "checkin_time string, preop_start_time string",
    )
    parsed = as_timestamps(df)
    assert parsed.select(C.minutes_between("checkin_time", "preop_start_time", True).alias("m")).first()["m"] == (
        pytest.approx(10.508333, abs=1e-6)
    )


def test_unreadable_milestone_fails_or_becomes_null(spark):
    df = spark.createDataFrame([("soon",)], "checkin_time string")
    assert as_timestamps(df, lenient=True).first()["checkin_time"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        as_timestamps(df).collect()


@pytest.mark.parametrize(("late_by", "flag"), [(15, 0), (15.1, 1), (-5, 0)])
def test_late_start_is_strict(spark, late_by, flag):
    assert with_late_start(frame(spark, [case("a", late_by=late_by)])).first()["late_start"] == flag


def test_unscheduled_is_not_late(spark):
    assert with_late_start(frame(spark, [case("a", scheduled=False)])).first()["late_start"] == 0


def test_monday_is_zero(spark):
    days = [datetime(2025, 1, 6 + offset) for offset in range(7)]
    df = spark.createDataFrame([(day,) for day in days], "t timestamp")
    assert [row[0] for row in df.select(C.day_of_week("t")).collect()] == list(range(7))
    assert df.filter(C.is_weekday("t")).count() == 5


def test_variation_is_zero_without_a_positive_mean(spark):
    assert value(spark, C.variation_pct(F.lit(5.0), F.lit(0.0))) == 0.0
    assert value(spark, C.variation_pct(F.lit(5.0), F.lit(10.0))) == 50.0


def test_severity_limits_are_exclusive(spark):
    def grade(number, **limits):
        return value(spark, C.graded(F.lit(number).cast("double"), **limits))

    assert [grade(50, high=50), grade(50.1, high=50)] == ["medium", "high"]
    assert [grade(x, high=0.05, medium=0.02) for x in (0.02, 0.021, 0.05, 0.051)] == [
        "info",
        "medium",
        "medium",
        "high",
    ]
    assert value(spark, C.graded(F.lit(None).cast("double"), high=50)) == "medium"


def test_clamp(spark):
    df = spark.createDataFrame([(1.0,), (50.0,), (900.0,), (None,)], "dur_total double")
    clipped = [row[0] for row in clip_durations(df, ["dur_total"]).collect()]
    assert clipped == [3.0, 50.0, 600.0, None]


def test_feature_title_percent_and_time(spark):
    titles = [value(spark, C.feature_title(F.lit(name))) for name in ("facility_id_enc", "dur_op_to_postop")]
    assert titles == ["Facility Id", "Op To Postop"]
    assert value(spark, percent(F.lit(0.12345))) == 12.3
    assert value(spark, C.display_time(F.lit(datetime(2025, 1, 6, 7, 5, 9)))) == "2025-01-06 07:05:09"
    assert value(spark, C.chart_label(F.lit("P"), F.lit("A"))) == "P (A)"


def test_numbers_round_half_to_even(spark):
    assert [value(spark, whole(F.lit(x))) for x in (2.5, 3.5, 2.51)] == ["2", "4", "3"]
    assert value(spark, whole(F.lit(None).cast("double"))) == "nan"
    assert value(spark, whole_percent(F.lit(0.125))) == "12%"
    assert value(spark, tenth_percent(F.lit(0.02441))) == "2.4%"
    assert value(spark, grouped(F.lit(12977))) == "12,977"


@pytest.mark.parametrize("number", [2.25, 2.35, 2.45, 209.05, 209.15, 1234567.85, -0.25, 0.05, 12.5])
def test_rounding_is_that_of_the_binary_value(spark, number):
    assert value(spark, nearest(F.lit(number), 1)) == round(number, 1)
    assert value(spark, whole(F.lit(number))) == f"{number:.0f}"


def test_fill_and_lookup(spark):
    assert value(spark, fill("{a} of {b}.", a=F.lit("x"), b=F.lit("y"))) == "x of y."
    table = {"one": "1"}
    assert value(spark, lookup(F.lit("one"), table, F.lit("?"))) == "1"
    assert value(spark, lookup(F.lit("two"), table, F.lit("?"))) == "?"


def test_fold_depends_on_the_id_alone(spark):
    ids = spark.range(5000).select(F.concat(F.lit("e"), "id").alias("event_id"))
    first = ids.withColumn("t", C.in_test_fold())
    second = ids.repartition(7).withColumn("t", C.in_test_fold())
    assert first.exceptAll(second).count() == 0
    assert 0.17 < first.filter("t").count() / 5000 < 0.23


def test_transfer_form_has_no_derived_columns(spark):
    assert len(CASE_SCHEMA) == 13
    assert len(TRANSFER_COLUMNS) == 14
    moved = transfer_form(with_durations(frame(spark, [case("a")])))
    assert tuple(moved.columns) == TRANSFER_COLUMNS
    assert not set(DURATIONS) & set(moved.columns)
    assert transfer_form(moved.drop("created_at")).first()["created_at"] is None
