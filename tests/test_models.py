import random
from datetime import timedelta

import pytest
from cases import MONDAY, case, timed
from pyspark.sql import functions as F

from flowgauge.operators import models, report
from flowgauge.schema import CLASSIFIER_SCHEMA, REGRESSOR_SCHEMA


def many(count, seed=1):
    rng = random.Random(seed)
    return [
        case(
            f"e{n}",
            facility=rng.choice("CAB"),
            procedure=rng.choice("PQ"),
            phases=(rng.randint(5, 20), rng.randint(5, 20), rng.randint(20, 60), rng.randint(20, 90)),
            start=MONDAY + timedelta(hours=n % 9, days=n % 5),
            asa=1 + n % 4,
            anesthesia=rng.choice(["MAC", "Local", None]),
        )
        for n in range(count)
    ]


@pytest.fixture(scope="module")
def prepared(spark):
    frame, features = models.prepare_features(timed(spark, many(400)))
    return frame.cache(), features


def test_codes_follow_sorted_order_with_unknown(spark):
    rows = [case("a", facility="B"), case("b", facility="A", anesthesia=None), case("c", facility="C", anesthesia="zinc")]
    encoded = {r["event_id"]: r for r in models.label_encode(timed(spark, rows)).collect()}
    assert [encoded[k]["facility_id_enc"] for k in "abc"] == [1, 0, 2]
    # MAC, unknown, zinc
    assert [encoded[k]["anesthesia_type_enc"] for k in "abc"] == [0, 1, 2]


def test_features(spark, prepared):
    frame, features = prepared
    assert features == list(models.FEATURES)
    assert len(models.without_recovery(features)) == 8
    assert "dur_op_to_postop" not in models.without_recovery(features)
    less = timed(spark, many(5)).drop("asa_class", "anesthesia_type")
    assert models.prepare_features(less)[1] == [
        f for f in models.FEATURES if f not in ("asa_class", "anesthesia_type_enc")
    ]


@pytest.mark.parametrize(("count", "enough"), [(99, False), (100, True)])
def test_a_hundred_rows_are_needed(spark, count, enough):
    frame, features = models.prepare_features(timed(spark, many(count)))
    assert models.has_rows(frame) is enough
    result = models.train_discharge_predictor(frame, features, trees=2, depth=2)
    assert (result is not None) is enough
    if not enough:
        assert models.train_recovery_classifier(frame, features) is None
        assert models.model_search(frame, features) is None


def test_rows_with_unknown_features_are_left_out(spark):
    rows = timed(spark, many(120)).withColumn("asa_class", F.when(F.rand(1) < 0.5, F.col("asa_class")))
    frame, features = models.prepare_features(rows)
    assert models.train_discharge_predictor(frame, features, trees=1) is None


def test_discharge_predictor(prepared):
    result = models.train_discharge_predictor(*prepared, trees=15, depth=4)
    assert result.schema == REGRESSOR_SCHEMA
    row = result.first()
    assert row["n_train"] + row["n_test"] == 400
    assert 0 < row["mae_minutes"] < 30
    assert row["r2_score"] > 0.1
    assert sum(row["feature_importance"].values()) == pytest.approx(1)
    assert set(row["feature_importance"]) == set(models.FEATURES)
    ranking = [r["importance_pct"] for r in report.importance_ranking(result).collect()]
    assert ranking == sorted(ranking, reverse=True) and len(ranking) == 9


def test_recovery_classifier(prepared):
    row = models.train_recovery_classifier(*prepared, trees=5).first()
    assert row["features_used"] == models.without_recovery(models.FEATURES)
    assert 0 <= row["auc_score"] <= 1
    assert 70 < row["p90_threshold_minutes"] < 91


def test_one_class_in_the_test_fold_gives_zero(spark):
    rows = timed(spark, many(300)).withColumn("dur_postop_to_discharge", F.lit(30.0))
    frame, features = models.prepare_features(rows)
    result = models.train_recovery_classifier(frame, features, trees=2)
    assert result.schema == CLASSIFIER_SCHEMA
    assert result.first()["auc_score"] == 0.0


def test_more_categories_than_the_default_bins(spark):
    rows = [case(f"e{n}", procedure=f"P{n % 90:02}", phases=(5, 5, n % 90, 30)) for n in range(400)]
    frame, features = models.prepare_features(timed(spark, rows))
    assert models.train_discharge_predictor(frame, features, trees=2, depth=2).count() == 1


def test_search_ranks_every_setting(prepared):
    grid = [
        {"max_depth": 1, "n_estimators": 1, "learning_rate": 0.1},
        {"max_depth": 4, "n_estimators": 8, "learning_rate": 0.1, "subsample": 0.7, "colsample": 0.6},
    ]
    rows = models.model_search(*prepared, grid=grid).collect()
    assert {(r["setting"], r["trees"]) for r in rows} == {(1, 1), (2, 8)}
    assert rows[0]["mae_minutes"] <= rows[1]["mae_minutes"]


def test_a_million_values_are_encoded_without_a_list(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.lpad((F.col("id") * 7919 % 1_000_000).cast("string"), 6, "0")).alias("facility_id"), "id")
    encoded = models.label_encode(df, ["facility_id"])
    right = F.col("facility_id_enc") == (F.col("id") * 7919 % 1_000_000)
    assert encoded.filter(right).count() == 1_000_000
    with pytest.raises(ValueError, match="facility_id_enc has 1000000 values"):
        models._bins(encoded, ["facility_id_enc"])


def test_codes_of_no_rows_and_of_no_columns(spark):
    none = timed(spark, many(3)).limit(0)
    assert models.label_encode(none).count() == 0
    assert models.label_encode(none.select("event_id")).columns == ["event_id"]


def test_the_search_ranks_settings_by_their_errors(spark, prepared):
    grid = [{"n_estimators": 1, "max_depth": 1, "learning_rate": 0.1}, {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3}]
    one, two = (models.model_search(*prepared, grid, at_once).collect() for at_once in (1, 2))
    assert one == two and sorted(row["setting"] for row in one) == [1, 2]
    assert [row["mae_minutes"] for row in one] == sorted(row["mae_minutes"] for row in one)


def test_rows_of_a_training_take_no_memory_from_the_trees(spark):
    with models._kept(spark.range(10)) as held:
        assert held.count() == 10 and held.storageLevel.useDisk and not held.storageLevel.useMemory
    assert not held.storageLevel.useDisk


def test_importances_of_the_trained_model_are_ranked(spark, prepared):
    fitted = models.train_discharge_predictor(*prepared, trees=5, depth=3)
    weights = fitted.first()["feature_importance"]
    ranked = report.importance_ranking(fitted.select("feature_importance")).collect()
    assert [row["importance_pct"] for row in ranked] == sorted((round(100 * w, 1) for w in weights.values()), reverse=True)
    assert len(ranked) == len(models.FEATURES) and abs(sum(weights.values()) - 1) < 1e-6
