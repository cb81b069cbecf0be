"""Toxic wordings that few training rows hold."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
from test_texts import frame, made_up

from flowgauge.llm import toxicity


def test_a_word_of_four_training_rows_is_learnt_though_no_shard_holds_them_all(spark):
    shard = F.pmod(F.xxhash64("id"), F.lit(toxicity.SHARDS))
    trained = spark.range(300).filter(~toxicity.held_out(F.col("id"))).select("id", shard.alias("shard")).collect()
    bad = [row.id for own in range(2) for row in [row for row in trained if row.shard == own][:2]]
    assert len(bad) == 4
    texts = [made_up(at, 40) + (" rarebadword" if at in bad else "") for at in range(300)]
    labels = spark.createDataFrame([(at, 1, int(at in bad)) for at in range(300)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(spark, texts), labels)
    assert dict(zip(model.features.tolist(), model.weights))[int(toxicity.features("rarebadword")[0])] > 0


def plain_ftrl(rows, labels, epochs):
    """The published recurrence, a coordinate at a time, over dictionaries."""
    z, n, weights = {}, {}, {}

    def weight(feature):
        l1 = 0.0 if feature == "bias" else toxicity.L1
        own = z.get(feature, 0.0)
        if abs(own) <= l1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(feature, 0.0))) / toxicity.ALPHA + toxicity.L2
        return -(own - math.copysign(l1, own)) / rate

    for _ in range(epochs):
        for row, label in zip(rows, labels):
            active = [*row, "bias"]
            now = {feature: weight(feature) for feature in active}
            slope = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(now.values()))))) - label
            for feature in active:
                before = n.get(feature, 0.0)
                sigma = (math.sqrt(before + slope * slope) - math.sqrt(before)) / toxicity.ALPHA
                z[feature] = z.get(feature, 0.0) + slope - sigma * now[feature]
                n[feature] = before + slope * slope
    return {feature: weight(feature) for feature in z}


def test_training_equals_a_plain_ftrl():
    random_ = random.Random(3)
    rows = [sorted(random_.sample(range(60), random_.randint(0, 12))) for _ in range(200)]
    labels = [int(any(feature < 4 for feature in row)) for row in rows]
    z, n = np.zeros(61), np.zeros(61)
    toxicity.ftrl([np.array(row, np.int32) for row in rows], np.array(labels), z, n, 4)
    expected = plain_ftrl(rows, labels, 4)
    mine = toxicity.weights_of(z[:-1], n[:-1])
    assert np.allclose(mine, [expected.get(feature, 0.0) for feature in range(60)], atol=1e-9)
    assert np.isclose(toxicity.weights_of(z[-1:], n[-1:], regular=False)[0], expected["bias"])
    assert 0 < np.count_nonzero(mine) < 60


def test_features_of_two_rows_are_counted_over_all_tasks(spark):
    texts = ["one two", "two three", "three", None, "", "four four", "two"]
    rows = [(at, text or "") for at, text in enumerate(texts)]
    for parts in (1, 4):
        frame_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        known = {int(toxicity.features(word)[0]) for word in ("two", "three")}
        assert set(toxicity.shared_features(frame_).tolist()) == known
    assert len(toxicity.shared_features(frame_.limit(0))) == 0
