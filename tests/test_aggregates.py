import numpy as np
import pytest
from cases import by_key, case, timed
from pyspark.sql import functions as F

from flowgauge.operators import aggregate, ranking
from flowgauge.schema import AGGREGATE_SCHEMA, KEYS


def test_statistics_match_numpy(spark):
    minutes = [float(n * n % 37 + 5) for n in range(25)]
    rows = [case(f"e{n}", phases=(m, 20, 30, 40), late_by=20 if n % 5 == 0 else 0) for n, m in enumerate(minutes)]
    groups = aggregate.aggregates(timed(spark, rows))
    assert groups.columns == AGGREGATE_SCHEMA.names
    row = groups.first()
    assert row["dur_checkin_to_preop_mean"] == pytest.approx(np.mean(minutes))
    assert row["dur_checkin_to_preop_median"] == pytest.approx(np.median(minutes))
    assert row["dur_checkin_to_preop_p90"] == pytest.approx(np.percentile(minutes, 90))
    assert row["dur_checkin_to_preop_std"] == pytest.approx(np.std(minutes, ddof=1))
    assert (row["case_volume"], row["late_start_rate"]) == (25, 0.2)


def test_single_case_has_no_deviation(spark):
    row = aggregate.aggregates(timed(spark, [case("a")])).first()
    assert row["dur_total_std"] is None
    assert row["dur_total_mean"] == row["dur_total_p90"] == 100.0


def test_only_completed_cases_with_known_keys_count(spark):
    rows = [case("a"), case("b", status="delayed"), case("c", facility=None), case("d", status="canceled")]
    df = timed(spark, rows)
    assert aggregate.aggregates(df).select("case_volume").collect() == [(1,)]
    both = aggregate.aggregates(df, statuses=("completed", "delayed"))
    assert both.first()["case_volume"] == 2


def test_volume_counts_ids_and_overview_counts_rows(spark):
    df = timed(spark, [case("a"), case(None), case("c")])
    assert aggregate.aggregates(df, statistics=("mean",)).first()["case_volume"] == 2
    assert aggregate.facility_overview(df).first()["total_cases"] == 3


def test_unscheduled_cases_lower_the_late_rate(spark):
    df = timed(spark, [case("a", late_by=16), case("b", scheduled=False)])
    assert aggregate.aggregates(df, statistics=("mean",)).first()["late_start_rate"] == 0.5


def test_no_rate_without_a_schedule_column(spark):
    groups = aggregate.aggregates(timed(spark, [case("a")]).drop("scheduled_start_time"), statistics=("mean",))
    assert "late_start_rate" not in groups.columns


def test_no_completed_case_gives_no_group(spark):
    df = timed(spark, [case("a", status="canceled")])
    assert aggregate.aggregates(df).count() == 0
    assert aggregate.facility_overview(df).count() == 0
    assert aggregate.cancellation_rate(df).first()["rate"] == 1.0
    assert aggregate.cancellation_rate(df.limit(0)).count() == 0


def test_approximate_percentiles_are_actual_values_nearby(spark):
    rows = [case(f"e{n}", phases=(n + 1, 20, 30, 40)) for n in range(101)]
    row = aggregate.aggregates(timed(spark, rows), percentiles="approx").first()
    assert row["dur_checkin_to_preop_median"] == pytest.approx(51, abs=1)
    assert row["dur_checkin_to_preop_p90"] == pytest.approx(91, abs=1)
    with pytest.raises(ValueError):
        aggregate.aggregates(timed(spark, rows), percentiles="guess")


def test_joined_rates_equal_the_fused_ones(spark):
    df = timed(spark, [case(f"e{n}", procedure="PQ"[n % 2], late_by=n * 3) for n in range(12)])
    fused = aggregate.aggregates(df, statistics=("mean",))
    joined = aggregate.join_late_rates(fused.drop("late_start_rate"), aggregate.late_start_rates(df))
    assert by_key(joined, *KEYS) == by_key(fused, *KEYS)


def test_phase_means_are_not_weighted_by_volume(spark):
    rows = [case(f"e{n}", procedure="big", phases=(10, 10, 10, 10)) for n in range(9)]
    rows.append(case("x", procedure="small", phases=(30, 10, 10, 10)))
    groups = aggregate.aggregates(timed(spark, rows), statistics=("mean",))
    assert aggregate.phase_means(groups).first()["dur_checkin_to_preop"] == 20.0
    longest = aggregate.longest_phase(groups).first()
    assert (longest["phase"], longest["phase_minutes"], longest["phase_pct"]) == ("Check-in to Pre-op", 20.0, 40.0)
    long = by_key(aggregate.phase_breakdown(groups), "phase")
    assert long[("OR to PACU",)]["mean_of_means"] == 10.0


def test_equal_phases_pick_the_earliest(spark):
    groups = aggregate.aggregates(timed(spark, [case("a", phases=(10, 25, 25, 25))]), statistics=("mean",))
    assert aggregate.longest_phase(groups).first()["phase"] == "Pre-op to OR"


def test_no_journey_no_longest_phase(spark):
    groups = aggregate.aggregates(timed(spark, [case("a", phases=(0, 0, 0, 0))]), statistics=("mean", "std"))
    assert aggregate.longest_phase(groups).count() == 0
    assert ranking.most_variable(groups).first()["coefficient_of_variation"] == 0.0


def test_top_groups_ties_and_nulls(spark):
    groups = spark.createDataFrame(
        [("B", "P", 5.0), ("A", "Q", 5.0), ("A", "P", None), ("C", "P", 9.0), ("A", "R", 5.0)],
        "facility_id string, procedure_type string, dur_total_std double",
    )
    top = [tuple(row)[:2] for row in ranking.top_groups(groups, "dur_total_std", 5).collect()]
    assert top == [("C", "P"), ("A", "Q"), ("A", "R"), ("B", "P"), ("A", "P")]


def gap_groups(spark, rows):
    return spark.createDataFrame(rows, "facility_id string, procedure_type string, dur_total_mean double")


def test_gap_ties_take_the_first_facility(spark):
    groups = gap_groups(spark, [("C", "P", 90.0), ("B", "P", 90.0), ("D", "P", 50.0), ("A", "P", 50.0)])
    row = ranking.facility_gaps(groups).first()
    assert (row["fastest_facility"], row["slowest_facility"]) == ("A", "B")
    assert (row["gap_minutes"], row["gap_pct"], row["first_facility"]) == (40.0, 80.0, "A")


def test_gap_needs_two_facilities_and_both_limits(spark):
    assert ranking.facility_gaps(gap_groups(spark, [("A", "P", 50.0)])).count() == 0
    limits = [
        ("A", "twenty", 50.0), ("B", "twenty", 70.0),
        ("A", "thirty", 100.0), ("B", "thirty", 130.0),
        ("A", "wide", 100.0), ("B", "wide", 131.0),
        ("A", "zero", 0.0), ("B", "zero", 80.0),
    ]
    wide = ranking.wide_gaps(gap_groups(spark, limits))
    assert [row["procedure_type"] for row in wide.collect()] == ["wide"]


def test_late_limit_is_exclusive(spark):
    groups = spark.createDataFrame(
        [("A", "P", 0.2), ("A", "Q", 0.21)], "facility_id string, procedure_type string, late_start_rate double"
    )
    assert [row["procedure_type"] for row in ranking.most_late(groups).collect()] == ["Q"]


def test_extended_recovery_is_above_the_overall_p90(spark):
    rows = [case(f"e{n}", phases=(1, 1, 1, n + 1)) for n in range(11)] + [case("x", phases=(1, 1, 1, 500), status="delayed")]
    df = timed(spark, rows)
    assert aggregate.duration_threshold(df).first()["threshold"] == 10.0
    labelled = aggregate.with_extended_recovery(df)
    assert labelled.count() == 11
    assert [row["event_id"] for row in labelled.filter("extended_recovery = 1").collect()] == ["e10"]


def test_class_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "extended_recovery int")
    assert aggregate.class_balance(df).first()["positive_weight"] == 3.0
    assert aggregate.class_balance(df.filter(F.col("extended_recovery") == 0)).first()["positive_weight"] == 3.0


def test_distinct_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string")
    assert [row["k"] for row in aggregate.distinct_values(df, "k").collect()] == ["a", "b"]


def test_without_keys_there_is_one_row(spark):
    rows = [case(f"e{n}", phases=(10, 20, 30, n)) for n in range(5)]
    whole = aggregate.aggregates(timed(spark, rows), keys=(), columns=("dur_postop_to_discharge",)).collect()
    assert len(whole) == 1
    assert (whole[0]["case_volume"], whole[0]["dur_postop_to_discharge_median"]) == (5, 2.0)
