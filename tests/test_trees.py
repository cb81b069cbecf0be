"""The trees beside MLlib's, and what tasks do without their files."""

import random
import shutil

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from flowgauge.operators import models, trees

FEATURES, ARITY = ["kind", "a", "b", "same"], {"kind": 12}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    made = [(rng.randrange(12), float(rng.randrange(30)), rng.gauss(0, 1), 1.0) for _ in range(1500)]
    df = spark.createDataFrame(made, "kind int, a double, b double, same double")
    label = F.col("a") * 2 + F.col("b") * F.col("kind") + F.when(F.col("kind").isin(3, 7), 20).otherwise(0)
    return df.withColumn("label", label).repartition(3, "a").cache()


def assembled(rows):
    kind = F.col("kind").cast("double").alias("kind", metadata={"ml_attr": {"type": "nominal", "name": "kind", "num_vals": 12}})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.withColumns({"kind": F.col("kind")}).select(kind, "a", "b", "same", "label"))


def scores(model, rows):
    return [row[1] for row in model.score(rows, "score").collect()]


@pytest.mark.parametrize(("rate", "share", "depth"), [(1.0, 1.0, 3), (0.8, 1.0, 3), (1.0, 0.7, 2)])
def test_numbers_are_predicted_as_by_mllib(rows, rate, share, depth):
    theirs = GBTRegressor(
        maxDepth=depth, maxIter=4, stepSize=0.1, subsamplingRate=rate, featureSubsetStrategy="all" if share == 1 else str(share), maxBins=64, seed=42
    ).fit(assembled(rows))
    with trees.training(rows, 1500, FEATURES, ARITY, 64, 42) as held:
        ours = held.boost(trees=4, depth=depth, shrinkage=0.1, rate=rate, share=share, seed=42)
    assert scores(ours, rows) == pytest.approx([row[0] for row in theirs.transform(assembled(rows)).select("prediction").collect()], abs=1e-9)
    assert ours.importances() == pytest.approx(theirs.featureImportances.toArray().tolist(), abs=1e-9)


def test_risks_are_predicted_as_by_mllib(rows):
    rows = rows.withColumn("label", (F.col("label") > 50).cast("double"))
    weighted = assembled(rows).withColumn("weight", F.when(F.col("label") == 1, 6.5).otherwise(1.0))
    theirs = GBTClassifier(maxDepth=3, maxIter=4, stepSize=0.1, maxBins=64, weightCol="weight", seed=42).fit(weighted).transform(weighted)
    with trees.training(rows, 1500, FEATURES, ARITY, 64, 42, trees.Loss(True, 6.5)) as held:
        ours = held.boost(trees=4, depth=3, shrinkage=0.1, seed=42)
    assert scores(ours, rows) == pytest.approx([row[0] for row in theirs.select(vector_to_array("probability")[1]).collect()], abs=1e-9)


def test_a_task_that_lacks_its_files_makes_them_anew(rows, monkeypatch):
    def model(held):
        return held.boost(trees=3, depth=8, shrinkage=0.3, rate=0.7, share=0.7, seed=7)

    monkeypatch.setattr(trees, "BLOCK_ROWS", 500)
    with trees.training(rows, 1500, FEATURES, ARITY, 64, 7) as held:
        assert held.parts == 3
        whole, name, passes, each = scores(model(held), rows), held.name, [], held._pass

        def after_a_loss(*given):
            passes.append(given)
            if len(passes) in (2, 12, 20):
                held.placed.foreachPartition(lambda _: shutil.rmtree(trees._home(name), ignore_errors=True))
            return each(*given)

        monkeypatch.setattr(held, "_pass", after_a_loss)
        assert scores(model(held), rows) == pytest.approx(whole) and len(passes) > 20


def test_draws_go_on_from_block_to_block(spark):
    drawn = trees.bagged(3000, 0, 0.8, 99)
    assert (trees.bagged(1000, 1700, 0.8, 99) == drawn[1700:2700]).all()
    generator = spark._jvm.org.apache.spark.util.random.XORShiftRandom(99)
    assert [generator.nextDouble() < 0.8 for _ in range(500)] == drawn[:500].tolist()


def test_ends_of_deep_trees_are_found_in_stages():
    bins = trees.Bins((np.arange(255) + 0.5, np.empty(0)), (0, 0))
    splits = {node: trees.Split(0, np.arange(256) < (2 * (node - (1 << level)) + 1) << 7 - level, 1.0, (1.0, 1.0)) for level in range(8) for node in range(1 << level, 2 << level)}
    finder, values = trees._Finder(splits, bins), np.arange(256)[::-1].astype(float)
    codes = bins.codes([values, values])
    assert [finder.ends[place] - 256 for place in finder(codes, 256)] == values.tolist()


def test_features_without_a_choice_make_one_end(rows):
    with trees.training(rows, 1500, ["same"], {}, 64, 1) as held:
        model = held.boost(trees=2, depth=3, shrinkage=0.1, seed=1)
    mean = rows.agg(F.avg("label")).first()[0]
    assert set(np.round(scores(model, rows), 6)) == {round(mean, 6)} and model.importances() == [0.0]
    with pytest.raises(ValueError, match="no rows"), trees.training(rows.limit(0), 0, FEATURES, ARITY, 64, 1):
        pass


def test_trainings_hold_codes_and_not_points(spark, monkeypatch):
    """MLlib's own copies of the rows were objects of about 100 bytes, which executors had no memory for."""
    monkeypatch.setattr(models, "GBTRegressor", None, raising=False)
    monkeypatch.setattr(models, "GBTClassifier", None, raising=False)
    rows = spark.range(300).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 7).alias("asa_class"), (F.col("id") % 7 * 3.0).alias("dur_total"))
    assert models.train_discharge_predictor(rows, ["asa_class"], trees=2, depth=2).count() == 1
    rows = rows.withColumns({"case_status": F.lit("completed"), "dur_postop_to_discharge": F.col("dur_total")})
    assert models.train_recovery_classifier(rows, ["asa_class"], trees=2, depth=2).count() == 1
    assert len(models.model_search(rows, ["asa_class"], [{"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1}]).collect()) == 1


@pytest.mark.parametrize("count", [14_000, 40_000])
def test_splits_are_looked_for_in_the_rows_that_mllib_draws(spark, count):
    rng = np.random.default_rng(5)
    made = zip(rng.integers(0, 12, count).tolist(), np.round(rng.exponential(9, count)).tolist(), rng.normal(size=count).tolist(), strict=True)
    rows = spark.createDataFrame(list(made), "kind int, a double, b double").withColumn("same", F.lit(1.0))
    rows = rows.withColumn("label", F.col("a") * 2 + F.col("b") * F.col("kind")).repartition(3, "b").cache()
    theirs = GBTRegressor(maxDepth=3, maxIter=2, maxBins=64, seed=42).fit(assembled(rows)).transform(assembled(rows))
    with trees.training(rows, count, FEATURES, ARITY, 64, 42) as held:
        ours = held.boost(trees=2, depth=3, shrinkage=0.1, seed=42)
    assert scores(ours, rows) == pytest.approx([row[0] for row in theirs.select("prediction").collect()], abs=1e-9)
