"""Summaries of all levels from one count of bins, against the operators that scan for each."""

import random
from datetime import timedelta

import pytest
from cases import MONDAY, case, frame
from pyspark.sql import functions as F

from flowgauge.functions import stats
from flowgauge.operators import aggregate, levels
from flowgauge.operators.derive import with_durations
from flowgauge.schema import DURATIONS


def some_cases(count=400):
    random_ = random.Random(7)
    rows = []
    for n in range(count):
        phases = tuple(random_.choice([0.5, 7, 20.25, 33, 90, 2000]) + random_.random() for _ in range(4))
        rows.append(
            case(
                f"e{n}" if n % 17 else None,
                facility=random_.choice(["A", "B", None]),
                procedure=random_.choice(["P", "Q", None]),
                phases=phases,
                late_by=random_.choice([0, 15, 16, 40]),
                status=random_.choice(["completed", "completed", "canceled", "delayed", None]),
                start=MONDAY + timedelta(minutes=n),
                scheduled=n % 5 > 0,
            )
        )
    return rows + [case("alone", facility="C", procedure="P"), case("gone", facility="D", status="canceled")]


def rows_of(df, *keys):
    return {tuple(row[key] for key in keys): row.asDict() for row in df.collect()}


def assert_same(mine, theirs):
    assert mine.keys() == theirs.keys()
    for key, row in theirs.items():
        assert mine[key].keys() == row.keys()
        for name, value in row.items():
            assert mine[key][name] == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (key, name)


@pytest.fixture(scope="module")
def timed(spark):
    return with_durations(frame(spark, some_cases())).persist()


def test_summaries_equal_separate_scans(timed):
    found = levels.summaries(timed)
    assert_same(rows_of(found.groups, "facility_id", "procedure_type"), rows_of(aggregate.aggregates(timed), "facility_id", "procedure_type"))
    assert found.groups.columns == aggregate.aggregates(timed).columns
    assert_same(rows_of(found.overview, "facility_id"), rows_of(aggregate.facility_overview(timed), "facility_id"))
    assert_same(rows_of(found.cancellation), rows_of(aggregate.cancellation_rate(timed)))


def test_no_cases_have_no_summaries(timed):
    for frame_ in levels.summaries(timed.limit(0)):
        assert frame_.count() == 0


def test_summaries_scan_the_cases_twice(spark, timed, tmp_path):
    """Counted by the file scans of all jobs that building and reading the summaries run."""
    path = str(tmp_path / "cases")
    timed.coalesce(1).write.parquet(path)
    scans = []
    settle = stats.settle

    def counted(df, label):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count(str(tmp_path)))
        return settle(df, label)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stats, "settle", counted)
        patch.setattr(levels, "settle", counted)
        found = levels.summaries(spark.read.parquet(path))
        scans += [df._jdf.queryExecution().executedPlan().toString().count(str(tmp_path)) for df in found]
    assert sum(scans) == 2


@pytest.mark.parametrize("width", [1 / 60, 5.0, 400.0])
def test_estimates_stay_within_their_bound(timed, width):
    done = timed.filter("case_status = 'completed' and facility_id is not null")
    fractions = {"low": 0.0, "median": 0.5, "p90": 0.9, "high": 1.0}
    bins = stats.bin_counts(done, ["facility_id"], DURATIONS, width)
    estimates = rows_of(stats.estimated_percentiles(stats.rolled_up(bins, ["facility_id"]), ["facility_id"], fractions, width), "facility_id", "metric", "name")
    exact = rows_of(stats.exact_percentiles(done, ["facility_id"], DURATIONS, fractions), "facility_id")
    assert len(estimates) == len(exact) * len(DURATIONS) * len(fractions)
    for (facility, metric, name), row in estimates.items():
        assert abs(row["estimate"] - exact[facility,][f"{metric}_{name}"]) <= row["bound"] <= max(width, 2000 * 2 ** (1 / 4096))


def test_wide_and_negative_bins_have_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1e6, -3.0, -0.001, 0.0, 0.02, 1439.999, 1440.0, 1e6)], "v double")
    low, high = stats._edges(stats.ONE_SECOND)
    edges = df.withColumn("bin", stats._bin(F.col("v"), stats.ONE_SECOND)).select("v", low.alias("low"), high.alias("high"))
    for row in edges.collect():
        assert row["low"] - 1e-3 <= row["v"] <= row["high"] + 1e-3


def test_rows_are_numbered_in_order(spark):
    values = [(random.Random(n).randint(0, 300), n) for n in range(1000)] + [(None, -1)]
    df = spark.createDataFrame(values, "a int, b int").repartition(7)
    found = stats.numbered(df, [F.asc_nulls_last("a"), F.desc("b")], "place", 5).collect()
    ordered = sorted(values, key=lambda row: (row[0] is None, row[0] or 0, -row[1]))
    assert [(row["a"], row["b"]) for row in sorted(found, key=lambda row: row["place"])] == ordered
    assert sorted(row["place"] for row in found) == list(range(1, 1002))
