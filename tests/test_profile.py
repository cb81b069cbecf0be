import math
from datetime import datetime

import pytest
from cases import by_key, case, frame, timed

from flowgauge.operators import enrich, profile
from flowgauge.schema import CATALOG_SCHEMA
from flowgauge.sources import dimensions


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [("P", "GI", 2.0, 0.1) + (3.0, 0.2) * 3, ("Q", "ENT", 2.0, 0.1) + (3.0, 0.2) * 3, ("R", "GI") + (1.0, 0.1) * 4]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def test_lognormal_fit_and_drift(spark, catalog):
    df = timed(spark, [case(f"e{n}", phases=(m, 20, 30, 0)) for n, m in enumerate((5, 10, 20))])
    fit = profile.lognormal_fit(df)
    first = by_key(fit, "procedure_type", "phase")["P", "checkin_to_preop"]
    logs = [math.log(m) for m in (5, 10, 20)]
    mean = sum(logs) / 3
    assert first["mu"] == pytest.approx(mean)
    assert first["sigma"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in logs) / 2))
    none = by_key(fit, "phase")["postop_to_discharge",]
    assert (none["cases"], none["mu"]) == (0, None)
    drift = by_key(profile.lognormal_drift(fit, profile.catalog_phases(catalog)), "phase")
    assert drift["checkin_to_preop",]["mu_drift"] == pytest.approx(mean - 2.0)


def test_hourly_profile_with_expected_weights(spark):
    df = frame(spark, [case("a"), case("b"), case("c", start=datetime(2025, 1, 6, 8))])
    hours = by_key(profile.hourly_profile(df), "hour")
    assert hours[7,]["share"] == pytest.approx(2 / 3) and len(hours) == 2
    both = by_key(profile.hourly_profile(df, expected=dimensions.hour_weights(spark)), "hour")
    assert len(both) == 24
    assert (both[9,]["n"], both[9,]["expected_share"]) == (0, pytest.approx(4 / 30.2))


def test_daily_volume_shows_missing_weekdays_only(spark):
    starts = [datetime(2025, 1, day, 9) for day in (9, 9, 10, 14)]
    rows = [case(f"a{n}", start=start) for n, start in enumerate(starts)] + [case("b", facility="B", start=starts[0])]
    bands = spark.createDataFrame([("A", 1, 1), ("B", 1, 5)], "facility_id string, volume_min int, volume_max int")
    days = by_key(profile.daily_volume(frame(spark, rows), bands), "facility_id", "day")
    found = {(site, day.day): (row["cases"], row["band"]) for (site, day), row in days.items()}
    assert found == {
        ("A", 9): (2, "above"), ("A", 10): (1, "within"), ("A", 13): (0, "below"), ("A", 14): (1, "within"),
        ("B", 9): (1, "within"), ("B", 10): (0, "below"), ("B", 13): (0, "below"), ("B", 14): (0, "below"),
    }


def test_silent_facility_is_in_the_calendar(spark):
    bands = spark.createDataFrame([("A", 1, 1), ("S", 1, 5)], "facility_id string, volume_min int, volume_max int")
    days = by_key(profile.daily_volume(frame(spark, [case("a")]), bands), "facility_id")
    assert (days["S",]["cases"], days["S",]["band"]) == (0, "below")


def test_unknown_statuses_count(spark):
    mix = profile.status_mix(frame(spark, [case("a"), case("b", status="lost"), case("c", status=None), case("d")])).first()
    assert (mix["cases"], mix["other"], mix["completed_share"], mix["other_share"]) == (4, 2, 0.5, 0.5)


def test_status_and_asa_mix(spark):
    df = frame(spark, [case("a"), case("b", status="delayed", asa=3), case("c"), case("d", asa=None)])
    mix = profile.status_mix(df).first()
    assert (mix["cases"], mix["completed"], mix["delayed_share"], mix["canceled"]) == (4, 3, 0.25, 0)
    asa = by_key(profile.asa_mix(df, dimensions.asa_weights(spark)), "asa_class")
    assert asa[3,]["share"] == pytest.approx(1 / 3)
    assert (asa[6,]["n"], asa[6,]["expected_share"]) == (0, pytest.approx(0.01))


def test_case_mix_keeps_unseen_lines(spark, catalog):
    df = frame(spark, [case("a"), case("b"), case("c", procedure="R")])
    sites = spark.createDataFrame([("A",)], "facility_id string")
    bias = spark.createDataFrame([("A", "GI", 2.0)], "facility_id string, service_line string, weight double")
    mix = by_key(profile.case_mix(df, catalog, profile.expected_case_mix(sites, catalog, bias)), "service_line")
    assert (mix["GI",]["cases"], mix["GI",]["share"], mix["GI",]["expected_share"]) == (3, 1.0, 0.8)
    assert (mix["ENT",]["cases"], mix["ENT",]["share"], mix["ENT",]["expected_share"]) == (0, 0.0, pytest.approx(0.2))


def test_anesthesia_mix_against_weights(spark, catalog):
    df = frame(spark, [case("a"), case("b", anesthesia="General"), case("c", procedure="Q", anesthesia="Local")])
    mix = by_key(
        profile.anesthesia_mix(df, catalog, dimensions.anesthesia_weights(spark)), "service_line", "anesthesia_type"
    )
    assert (mix["GI", "MAC"]["share"], mix["GI", "MAC"]["expected_share"]) == (0.5, pytest.approx(0.6))
    assert mix["ENT", "General"]["cases"] == 0


def test_schedule_deviation(spark):
    df = frame(spark, [case("a", late_by=10), case("b", late_by=-10), case("c", late_by=30), case("d", scheduled=False)])
    row = profile.schedule_deviation(df).first()
    assert (row["cases"], row["deviation_mean"], row["deviation_median"], row["deviation_p90"]) == (3, 10, 10, 26)
    assert row["deviation_std"] == pytest.approx(20)


def test_enrichment_and_rollup(spark, catalog):
    df = timed(spark, [case("a"), case("b", procedure="R", phases=(10, 20, 30, 140)), case("c", procedure="?")])
    rollup = by_key(enrich.service_line_rollup(df, catalog), "service_line")
    assert (rollup["GI",]["cases"], rollup["GI",]["avg_total_minutes"]) == (2, 150.0)
    assert rollup[None,]["cases"] == 1
    assert [r["procedure_type"] for r in enrich.procedures_of(catalog, "ENT").collect()] == ["Q"]
    assert [r["service_line"] for r in enrich.service_lines(catalog).collect()] == ["ENT", "GI"]


def test_local_clock(spark):
    sites = spark.createDataFrame(
        [("A", "Site", "America/New_York")], "facility_id string, facility_name string, timezone string"
    )
    df = frame(spark, [case("a"), case("b", facility="B")])
    local = by_key(enrich.on_local_clock(enrich.with_facility(df, sites)), "event_id")
    assert local["a",]["checkin_time"].hour == 2
    assert local["b",]["checkin_time"].hour == 7
