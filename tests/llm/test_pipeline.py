"""The corpus pipeline, stage by stage and as a whole, on the smallest tables."""

import corpus_pipeline
from flowgauge.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema.simpleString() == docs.schema.simpleString()
        after.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "length").collect())
    )
