"""Every query over empty tables, and over tables of nulls, repeats, long texts and columns that clash with its own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowgauge.llm.queries import QUERIES

ALL = dict(QUERIES, pipeline=corpus_pipeline.run)
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, toxic int",
    "embeddings": "vec_id long, embedding array<float>",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
}
CLASHING = (
    "fp fingerprint component_id root node a b block variant hash salt start source_id chain spans owner starts side "
    "stretch score predicted held_out toxic features shard bin used final members piece at member lengths vector size copy "
    "query_id rank host path fetched best rule verdict candidates edited n_tokens ids stream ordinal kind row next "
    "pass item agree visits visitor major parts holders value values high low text_hash n_shingles links pair n"
).split()
LONG = " ".join(f"word{at % 977}" for at in range(60_000))
ROWS = {
    "documents": [
        (None, None, None, None, None),
        (None, "a text of a row without an id", None, None, None),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n ", "en", "s", 3),
        (4, "One short text.", "en", "s", 15),
        (4, "One short text.", "en", "s", 15),
        (5, "one short text.", "en", None, None),
        (6, LONG, "en", "s", len(LONG)),
        (7, "\u00e9\U0001f600 \u4e2d\u6587 \ufffd", None, "s", 6),
    ],
    "labels": [(None, None), (None, 1), (1, 1), (4, None), (5, 7), (6, 0), (6, 0), (7, 1), (99, 1)],
    "embeddings": [
        (None, None),
        (None, [1.0, 2.0]),
        (0, None),
        (50, [1.0, None]),
        (100, [float("nan"), 1.0]),
        (150, [1.0, 2.0]),
        (200, [1.0, 2.0]),
        (201, [1.0, 2.0]),
        (201, [1.0, 2.0]),
        (250, []),
        (300, [1.0]),
    ],
    "benchmark": [(None, None), (None, "text"), (1, ""), (2, "One, SHORT one!"), (2, "One, SHORT one!"), (3, "absent"), (4, "\u4e2d\u6587")],
    "pages": [
        (None, None, None),
        (1, None, ""),
        (2, "no address", "<p>"),
        (2, "no address", "<p>"),
        (3, "http://A.example.com/en/x?y#z", "<html><article><p>" + "text " * 50_000 + "</article>"),
        (4, "://", "<<<>>> & &amp; <script>"),
    ],
}


def write(spark, folder, rows, clashing=()):
    for name, schema in SCHEMAS.items():
        frame = spark.createDataFrame(rows.get(name, []), schema)
        for column in clashing:
            if column not in frame.columns:
                frame = frame.withColumn(column, F.lit("clash"))
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), {})


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"), ROWS, CLASHING)


@pytest.mark.parametrize("name", ALL)
def test_empty_tables_have_empty_results(spark, empty, name):
    assert ALL[name](spark, empty).collect() == []


# rows of the result; what each stands for is in the operators' docstrings
EXPECTED = {
    "op1_toxicity": 10,
    "op2_simhash": 10,
    "op3_token_counts": 10,
    "op4_trie_bpe": 10,
    "op5_chaining": 0,
    "op6_minhash": 10,
    "op8_cover_tree": 4,
    "op9_url_rules": 6,
    "op10_line_blocks": 6,
    "op11_token_links": 10,
    "op12_block_max": 4 + 3 + 3 + 1,
    "op13_minhash_join": 10,
}


@pytest.mark.parametrize("name", ALL)
def test_odd_tables(spark, odd, name):
    rows = ALL[name](spark, odd).collect()
    if name in EXPECTED:
        assert len(rows) == EXPECTED[name]
    if name == "op1_toxicity":
        assert all(0 <= row["score"] <= 1 for row in rows)
    if name == "op2_simhash":
        blank = [row for row in rows if row["fingerprint"] == "0" * 16]
        assert len(blank) == 4 and {row["component_id"] for row in blank} == {1}
    if name == "op8_cover_tree":
        found = sorted((row["query_id"], row["rank"], row["vec_id"]) for row in rows)
        assert found == [(150, 1, 200), (150, 2, 201), (200, 1, 150), (200, 2, 201)]
    if name == "op12_block_max":
        found = sorted((row["item_id"] or 0, row["rank"], row["doc_id"] or 0) for row in rows)
        assert found[:4] == [(0, 1, 4), (0, 2, 4), (0, 3, 5), (0, 4, 0)] and found[-1] == (4, 1, 7)
        assert found[4:-1] == [(2, rank, doc_id) for rank, doc_id in ((1, 4), (2, 4), (3, 5)) for _ in range(2)]
    if name == "op13_minhash_join":
        blank = [row for row in rows if row["n_shingles"] == 0]
        assert sorted((row["doc_id"] or 0, row["component_id"] or 0) for row in blank) == [(0, 0), (1, 1), (2, 2), (3, 3)]
        assert [row["component_id"] for row in rows if row["doc_id"] in (4, 5)] == [4, 4, 4]
        assert all(row["kept"] == (row["doc_id"] is not None and row["doc_id"] == row["component_id"]) for row in rows)
    if name in ("op7_packing", "pipeline"):
        assert len({(row["sequence_id"], row["offset"]) for row in rows}) == len(rows)
        assert all(0 < row["length"] and row["offset"] + row["length"] <= 4096 for row in rows)


def test_stages_keep_columns_that_clash(spark, odd):
    documents = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, documents, odd)
        assert kept.columns == documents.columns, name
        assert {row["fp"] for row in kept.collect()} <= {"clash"}, name
