import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowgauge.functions.stats import (
    area_under_roc,
    exact_percentiles,
    regression_metrics,
    running_total,
    with_share,
)

FRACTIONS = {"median": 0.5, "p90": 0.9, "low": 0.0, "high": 1.0}


def check_against_numpy(spark, groups):
    rows = [(key, number) for key, numbers in groups.items() for number in numbers]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {row["k"]: row for row in exact_percentiles(df, ["k"], ["v"], FRACTIONS).collect()}
    assert set(found) == {key for key, numbers in groups.items() if numbers}
    for key, numbers in groups.items():
        if numbers:
            for name, fraction in FRACTIONS.items():
                expected = np.percentile(numbers, fraction * 100)
                assert found[key][f"v_{name}"] == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_percentiles_of_uneven_groups(spark):
    rng = random.Random(7)
    check_against_numpy(
        spark,
        {
            "hot": [rng.lognormvariate(3, 0.5) for _ in range(5000)],
            "ties": [12.0] * 400 + [12.000001] * 100,
            "one": [5.0],
            "two": [1.0, 2.0],
            "negative": [rng.gauss(0, 30) for _ in range(300)],
            "huge": [rng.uniform(0, 1e9) for _ in range(300)],
        },
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(
        st.floats(-1e7, 1e7, allow_nan=False).map(lambda x: round(x, 6)), min_size=1, max_size=40
    )
)
def test_percentiles_of_any_numbers(spark, numbers):
    check_against_numpy(spark, {"k": numbers})


def test_percentiles_skip_unknown_values(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", float("nan"), None), ("a", 3.0, None), ("b", None, 2.0)],
        "k string, v double, w double",
    )
    found = {row["k"]: row for row in exact_percentiles(df, ["k"], ["v", "w"], {"m": 0.5}).collect()}
    assert (found["a"]["v_m"], found["a"]["w_m"]) == (2.0, None)
    assert (found["b"]["v_m"], found["b"]["w_m"]) == (None, 2.0)


def test_percentile_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(float(n),) for n in range(11)], "v double")
    assert exact_percentiles(df, [], ["v"], {"p90": 0.9}).first()["v_p90"] == 9.0
    assert exact_percentiles(df.filter("v < 0"), [], ["v"], {"p90": 0.9}).first()["v_p90"] is None


def test_running_total_over_ranges(spark):
    rng = random.Random(3)
    numbers = rng.sample(range(100000), 700)
    amounts = {number: rng.randint(0, 9) for number in numbers}
    df = spark.createDataFrame(list(amounts.items()), "o long, a long")
    found = {row["o"]: row["t"] for row in running_total(df, "o", "a", "t", partitions=5).collect()}
    expected, total = {}, 0
    for number in sorted(numbers):
        expected[number] = total
        total += amounts[number]
    assert found == expected


def test_auc_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 12))) for _ in range(200)]
    positives = [score for label, score in rows if label]
    negatives = [score for label, score in rows if not label]
    won = sum((p > n) + (p == n) / 2 for p in positives for n in negatives)
    df = spark.createDataFrame(rows, "y int, s double")
    result = area_under_roc(df, "y", "s").first()
    assert result["auc"] == pytest.approx(won / len(positives) / len(negatives))
    assert (result["positives"], result["negatives"]) == (len(positives), len(negatives))


@pytest.mark.parametrize("rows", [[(1, 0.3), (1, 0.9)], [(0, 0.3)], []])
def test_auc_of_one_class_is_zero(spark, rows):
    assert area_under_roc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"] == 0.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 5.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert row["mae"] == pytest.approx(2 / 3)
    assert row["r2"] == pytest.approx(1 - 2 / 14)
    flat = regression_metrics(df.filter("y = 1"), "y", "p").first()
    assert flat["r2"] is None


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 5)], "g string, k string, n long")
    shares = {(r["g"], r["k"]): r["share"] for r in with_share(df, by=["g"]).collect()}
    assert shares == {("a", "x"): 0.25, ("a", "y"): 0.75, ("b", "x"): 1.0}
