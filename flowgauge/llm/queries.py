"""The registered queries over documents, pages and embeddings, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowgauge.llm import (
    chaining,
    cover_tree,
    lexical,
    line_blocks,
    minhash,
    minhash_join,
    packing,
    simhash,
    token_links,
    token_scan,
    toxicity,
    trie_bpe,
    url_rules,
)
from flowgauge.llm.common import cut, scratch, table

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_OF_DOCUMENT = 50256

RULES = (
    url_rules.Rule("allow", "com/"),
    url_rules.Rule("block", "example.com/en/"),
    url_rules.Rule("allow", "www.example.com/en/"),
    url_rules.Rule("block", "net/es/"),
    url_rules.Rule("block", "net/fr/"),
)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as flat streams of 16-bit ids, then counted from the streams alone."""
    with scratch(spark, "token-scan") as place:
        documents = table(spark, sf_dir, "documents")
        blocks = place.keep(token_scan.token_blocks(documents, BYTE_VOCABULARY, END_OF_DOCUMENT), "streams")
        summaries = token_scan.block_summaries(blocks.filter("kind = 0"), END_OF_DOCUMENT)
        counts = token_scan.stitched(place.keep(summaries, "summaries"))
        labelled = token_scan.labels_of(blocks).join(counts, ["stream", "ordinal"], "full")
        return cut(labelled.select("doc_id", "stream", "ordinal", "n_tokens"))


def op4_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encode_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op5_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extract_pages(table(spark, sf_dir, "pages"))


def op11_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


def op12_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_toxicity,
        op2_simhash,
        op3_token_counts,
        op4_trie_bpe,
        op5_chaining,
        op6_minhash,
        op7_packing,
        op8_cover_tree,
        op9_url_rules,
        op10_line_blocks,
        op11_token_links,
        op12_block_max,
        op13_minhash_join,
    )
}

_RULE_ROWS = ", ".join(
    f"('{rule.host}', '{rule.path}', '{rule.pattern}', '{rule.verdict}')" for rule in RULES
)

_LOWERED = f"translate(text, '{url_rules.UPPER}', '{url_rules.LOWER}')"

ORACLE_SQL: dict[str, str] = {
    "op8_cover_tree": """
        WITH usable AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS vector
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.vector, d.vector)::BIGINT AS score
            FROM usable q JOIN usable d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_url_rules": f"""
        WITH rules(host, path, rule, verdict) AS (VALUES {_RULE_ROWS}),
        rest AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), numbered AS (
            SELECT row_number() OVER () AS row, coalesce(page_id, NULL) AS page_id, coalesce(host, '') AS host, coalesce(path, '') AS path
            FROM parts
        ), fitting AS (
            SELECT n.row, r.rule, r.verdict,
                   row_number() OVER (PARTITION BY n.row ORDER BY length(r.rule) DESC, r.verdict DESC, r.rule DESC) AS place
            FROM numbered n JOIN rules r
              ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
        )
        SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM numbered n LEFT JOIN fitting f ON f.row = n.row AND f.place = 1
    """,
    "op12_block_max": f"""
        WITH words AS (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all({_LOWERED},
                                      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
            FROM documents
        ), docs AS (
            SELECT row, doc_id, len(terms) AS n, terms FROM words WHERE len(terms) > 0
        ), corpus AS (
            SELECT count(*)::BIGINT AS N, sum(n)::BIGINT AS L FROM docs
        ), postings AS (
            SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(N) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM postings, corpus GROUP BY term
        ), items AS (
            SELECT row_number() OVER () AS item, item_id,
                   list_distinct(regexp_extract_all({_LOWERED},
                                                    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS terms
            FROM benchmark
        ), scored AS (
            SELECT i.item, i.item_id, d.doc_id, p.row,
                   sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * d.n * c.N) // c.L))))::BIGINT AS score
            FROM (SELECT item, item_id, unnest(terms) AS term FROM items) i
            JOIN postings p USING (term) JOIN weights w USING (term) JOIN docs d ON d.row = p.row, corpus c
            GROUP BY ALL
        ), ranked AS (
            SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_minhash_join": f"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), shingled AS (
            SELECT row, doc_id,
                   CASE WHEN w IS NULL OR len(w) = 0 THEN []
                        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)])
                   END AS s
            FROM words
        ), classes AS (
            SELECT list_sort(s) AS s, min(row) AS node, len(any_value(s)) AS n FROM shingled WHERE len(s) > 0 GROUP BY list_sort(s)
        ), grams AS (
            SELECT node, n, unnest(s) AS g FROM classes
        ), pairs AS (
            SELECT x.node AS a, y.node AS b
            FROM grams x JOIN grams y ON x.g = y.g AND x.node < y.node AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
            GROUP BY x.node, y.node
            HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
        ), linked AS (
            SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
        ), reach(node, root) AS (
            SELECT node, node FROM classes
            UNION
            SELECT linked.b, reach.root FROM reach JOIN linked ON linked.a = reach.node
        ), rooted AS (
            SELECT node, min(root) AS root FROM reach GROUP BY node
        ), members AS (
            SELECT x.row, x.doc_id, len(x.s)::BIGINT AS n_shingles, coalesce(r.root, -x.row) AS root
            FROM shingled x LEFT JOIN classes c ON len(x.s) > 0 AND c.s = list_sort(x.s) LEFT JOIN rooted r ON r.node = c.node
        ), named AS (
            SELECT doc_id, n_shingles, min(doc_id) OVER (PARTITION BY root) AS component_id FROM members
        )
        SELECT doc_id, n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM named
    """,
}
