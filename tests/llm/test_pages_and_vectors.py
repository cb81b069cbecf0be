"""Operators over pages and embeddings, held against brute force on small fixtures."""

import math
import random

import numpy as np
import pytest

from flowgauge.llm import cover_tree, line_blocks, queries, url_rules

# --- exact top-k ---------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vector int, size string")


def slow_top_k(rows, k=5, every=50):
    usable = {
        vec_id: [math.floor(256 * x) for x in map(np.float32, embedding)]
        for vec_id, embedding, *_ in rows
        if vec_id is not None and embedding is not None and all(x is not None and math.isfinite(x) for x in embedding)
    }
    found = []
    for query, mine in usable.items():
        if query % every == 0:
            scored = [
                (-sum(int(a) * int(b) for a, b in zip(mine, own)), vec_id)
                for vec_id, own in usable.items()
                if vec_id != query and len(own) == len(mine)
            ]
            found += [(query, at + 1, vec_id, -score) for at, (score, vec_id) in enumerate(sorted(scored)[:k])]
    return sorted(found)


def test_top_k_equals_brute_force(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("BLOCK_ROWS", 64), ("QUERY_BYTES", 256)):
        monkeypatch.setattr(cover_tree, name, value)
    random_ = random.Random(4)
    rows = [(at, [random_.gauss(0, 1) for _ in range(6)], 0, 0, "") for at in range(400)]
    rows += [(at, [0.5] * 6, 0, 0, "") for at in range(400, 520)]  # a vector that many share, queries too
    rows += [(600, None, 0, 0, ""), (601, [1.0, None] * 3, 0, 0, ""), (650, [math.nan] * 6, 0, 0, ""), (651, [math.inf] * 6, 0, 0, "")]
    rows += [(700, [1.0, 2.0], 0, 0, ""), (701, [1.0, -2.0], 0, 0, ""), (None, [1.0] * 6, 0, 0, ""), rows[0]]
    found = cover_tree.top_k(vectors(spark, rows)).collect()
    assert sorted(tuple(row) for row in found) == slow_top_k(rows)


def test_top_k_of_none_and_of_few(spark):
    assert cover_tree.top_k(vectors(spark, [])).count() == 0
    rows = [(0, [1.0], 0, 0, ""), (1, [2.0], 0, 0, "")]
    assert [tuple(row) for row in cover_tree.top_k(vectors(spark, rows)).collect()] == [(0, 1, 1, 131072)]


def test_every_point_is_within_the_radii_above_it():
    points = np.random.default_rng(1).normal(size=(900, 4))

    def walk(node):
        assert np.sqrt(((points[node.rows] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([child.rows for child in node.children])) == sorted(node.rows)
        for child in node.children:
            walk(child)

    walk(cover_tree.build(points))


# --- URL rules -----------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host int, path int, rule int, verdict int, best int")


def slow_verdict(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    stop = min([rest.index(mark) for mark in "/?#" if mark in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    path = rest[stop:]
    path = path[: min([path.index(mark) for mark in "?#" if mark in path] or [len(path)])]
    fitting = [
        (len(rule.pattern), rule.verdict == "block", rule.pattern, rule.verdict)
        for rule in rules
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    best = max(fitting) if fitting else (0, False, None, "allow")
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme.com/en/", "http://", "http://example.com", "http://example.com/", "http://EXAMPLE.com/en/1?x=/fr/#y",
    "https://www.example.com/en/", "https://a.www.example.com/en/2", "http://notexample.com/en/1", "http://x.net/es", "http://x.net/es/",
    "http://x.net/fr/a/b", "http://com/x", "http://xcom/x", "http://a.com:80/en/", "http://a.net?es/", "http://a.net#/es/",
    "x://y://z.com/en/", "http://a\nb.com/q", "http://É.com/ñ", "http://example.com/enx/", "http://net/es/" + "p/" * 2000,
]


def test_urls_are_judged_like_by_hand(spark):
    rows = [(at, url, "", 0, 0, 0, 0, 0) for at, url in enumerate([*URLS, URLS[7]])] + [(None, URLS[8], "", 0, 0, 0, 0, 0)]
    odd = (url_rules.Rule("block", "example.com/en"), url_rules.Rule("allow", "EXAMPLE.com/en"), url_rules.Rule("block", "a+b.net/x.y/"))
    for rules in (queries.RULES, (*queries.RULES, *odd)):
        judged = url_rules.judge_urls(pages(spark, rows), rules).collect()
        assert len(judged) == len(rows)
        for row in judged:
            host, path, rule, verdict = slow_verdict(row.url, rules)
            assert (row.host, row.path, row.verdict) == (host, path, verdict)
            assert (row.rule or "").lower() == (rule or "").lower()
    assert url_rules.judge_urls(pages(spark, []), queries.RULES).count() == 0


def test_rules_hang_under_their_rarest_token(spark):
    rule = url_rules.Rule("block", "example.com/en/")
    assert url_rules.rule_index([rule], {"h:com": 9, "h:example": 3, "p:en": 5}) == {"h:example": [rule]}
    rows = [(0, "http://a.com/en/", "", 0, 0, 0, 0, 0), (1, "http://example.com/fr/", "", 0, 0, 0, 0, 0)]
    judged = url_rules.judge_urls(pages(spark, rows), [rule]).orderBy("page_id").collect()
    assert [row.candidates for row in judged] == [0, 1]


# --- main text -----------------------------------------------------------------

LONG = "This paragraph is long enough to be a surge of text on its own account, as articles have it, not menus."
CASES = [
    (None, ""),
    ("", ""),
    ("<html><body><nav><a>Menu</a></nav><footer>Foot</footer></body></html>", ""),
    ("<head><title>T</title></head><article><h1>Head &amp; more</h1><p><b>One<br><p>Two\n  three.</p><p>x</article><footer>f</footer>", "Head & more One Two three. x"),
    (f"<div class='menu'><p>{LONG}</p></div><div><h1>Title</h1><p>{LONG}</p><p>End.</p></div><div id=comments><p>{LONG}</p></div>", f"Title {LONG} End."),
    (f"<body><p>{LONG}<script>var a='</p><p>no';</script></p><!-- <p>no</p> --><aside>{LONG}</aside></body>", LONG),
    (f"<article><header><p>by</p></header><p>{LONG}</p><form>{LONG}</form><p>after the form</p></article><p>{LONG}</p>", f"by {LONG} after the form"),
    ("<article><p>a&nbsp;b &lt;c&gt; &#233; &am &amp</p></article>", "a b <c> é &am &"),
    ("<article><p>" + "long " * 30000 + "</p></article>", ("long " * 30000).strip()),
    ("<article><p>never closed <b>bold", "never closed bold"),
    ("just words", ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert line_blocks.main_text(page) == text


def test_surge_and_dive():
    lengths = np.array([0, 10, 0, 0, 0, 60, 90, 0, 0, 5, 0, 0, 0, 100])
    assert line_blocks.text_spans(lengths, 86) == [(5, 10), (13, 14)]


def test_pages_of_a_frame(spark):
    rows = [(at, "u", page, 0, 0, 0, 0, 0) for at, (page, _) in enumerate(CASES)] + [(0, "u", CASES[3][0], 0, 0, 0, 0, 0)]
    found = line_blocks.extract_pages(pages(spark, rows)).collect()
    assert sorted((row.page_id, row.text, row.n_chars) for row in found) == sorted(
        [(at, text, len(text)) for at, (_, text) in enumerate(CASES)] + [(0, CASES[3][1], len(CASES[3][1]))]
    )
    assert line_blocks.extract_pages(pages(spark, [])).count() == 0
