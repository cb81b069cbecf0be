"""The shape of physical plans, which decides how the queries scale."""

from datetime import datetime

import pytest
from cases import plan

from flowgauge.operators import aggregate, enrich, ingest, quality, ranking
from flowgauge.operators.derive import with_durations, with_late_start
from flowgauge.session import settle
from flowgauge.sources import case_view as view

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Case events as a stored table."""
    path = str(tmp_path_factory.mktemp("stored") / "cases")
    view.case_events(spark, FOLDER, created_at=True).write.parquet(path)
    return spark.read.parquet(path)


def test_aggregation_combines_before_the_only_shuffle(stored):
    text = plan(aggregate.aggregates(with_durations(stored), statistics=("mean", "std")))
    assert text.count("\nExchange") + text.count(") Exchange") >= 1
    body = text.split("\n\n")[0]
    assert body.count("Exchange") == 1
    assert body.count("HashAggregate") == 2


def test_only_needed_columns_are_read(stored):
    text = plan(aggregate.late_start_rates(stored))
    assert "ReadSchema: struct<facility_id:string,procedure_type:string,scheduled_start_time" in text
    assert "discharge_time" not in text
    assert "PushedFilters: [IsNotNull(case_status), EqualTo(case_status,completed)" in text


def test_top_k_does_not_sort_everything(stored):
    groups = aggregate.aggregates(with_durations(stored), columns=("dur_total",), statistics=("mean", "std"))
    for top in (ranking.most_variable(groups), ranking.most_late(groups)):
        assert "TakeOrderedAndProject" in plan(top)


def test_exact_percentiles_hold_no_group_in_memory(stored):
    text = plan(aggregate.facility_overview(with_durations(stored)))
    assert "percentile(" not in text
    assert "ObjectHashAggregate" not in text
    assert "BroadcastHashJoin" in text


def test_percentiles_filter_in_the_scan_or_count_before_the_shuffle(spark, stored):
    def steps():
        overview = aggregate.facility_overview(with_durations(stored))
        return plan(overview).split("\n\n")[0].splitlines()

    def position(lines, text):
        return next(i for i, line in enumerate(lines) if text in line)

    lines = steps()
    semi = position(lines, "LeftSemi")
    assert "BroadcastHashJoin" in lines[semi]
    scan = position(lines[semi:], "Scan parquet")
    assert not any("HashAggregate" in line for line in lines[semi : semi + scan])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = steps()
        assert sum("HashAggregate" in line for line in lines[position(lines, "LeftSemi") :]) >= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_copies_are_dropped_before_the_shuffle(stored):
    body = plan(ingest.first_write_wins(stored)).split("\n\n")[0]
    assert body.count("WindowGroupLimit") == 2
    lines = body.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in lines[exchange:])


def test_watermark_reaches_the_scan(stored):
    text = plan(ingest.rows_after(stored, datetime(1998, 1, 1), up_to=datetime(1999, 1, 1)))
    assert "GreaterThanOrEqual(created_at,1998-01-01T00:00" in text
    assert "LessThanOrEqual(created_at,1999-01-01T00:00" in text


def test_small_batch_leaves_the_stored_table_unshuffled(stored):
    batch = stored.filter("event_id LIKE '1-%'")
    body = plan(ingest.not_stored(settle(batch, "batch"), stored)).split("\n\n")[0]
    assert "BroadcastHashJoin LeftSemi" in body


def test_dimensions_are_broadcast_by_their_size(spark, stored):
    text = plan(enrich.with_facility(stored, view.facilities(spark, FOLDER)))
    assert "BroadcastHashJoin" in text
    catalog = view.catalog(spark, FOLDER)
    rollup = plan(enrich.service_line_rollup(with_durations(stored), catalog)).split("\n\n")[0]
    lines = rollup.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate" in line for line in lines[join:])


def test_orphans_are_counted_before_a_shuffled_join(spark, stored):
    facilities = view.facilities(spark, FOLDER)
    assert "BroadcastHashJoin LeftAnti" in plan(quality.orphan_keys(stored, facilities, "facility_id"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        body = plan(quality.orphan_keys(stored, facilities, "facility_id")).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = body.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("HashAggregate" in line for line in lines[join:])


def test_rules_take_one_pass(stored):
    body = plan(quality.violation_counts(with_durations(stored))).split("\n\n")[0]
    assert body.count("Scan parquet") == 1


def test_late_start_stays_in_generated_code(stored):
    assert "(codegen" in plan(with_late_start(stored)) or "[codegen id" in plan(with_late_start(stored))
