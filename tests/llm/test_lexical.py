"""Ranked search against a plain scorer."""

import math
import random
import re

import numpy as np
import pytest

from flowgauge.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text or "")


def brute_force(documents, items, best):
    """item number, rank, doc_id and score; the documents are (doc_id, text)."""
    counts = [(doc_id, terms) for doc_id, text in documents if (terms := TERM.findall(lowered(text)))]
    n_all, l_all = len(counts), sum(len(terms) for _, terms in counts)
    rows = []
    for at, text in enumerate(items):
        scored = []
        for doc_id, terms in counts:
            score = 0
            for term in set(TERM.findall(lowered(text))):
                holders = sum(term in own for _, own in counts)
                if tf := terms.count(term):
                    weight = math.floor(1000 * math.log((2 * n_all + 2) / (2 * holders + 1)))
                    long = 10 + 90 * len(terms) * n_all // l_all
                    score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * long))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [(at, rank, None if unnamed else doc_id, -score) for rank, (score, unnamed, doc_id) in enumerate(sorted(scored)[:best], 1)]
    return rows


def corpus(seed, documents=160, words=40):
    random_ = random.Random(seed)
    vocabulary = ["".join(random_.choice("abcdeé1") for _ in range(random_.randint(1, 4))) for _ in range(120)]
    weights = [1 / (at + 1) for at in range(120)]

    def text(size):
        return "".join(word.upper() + ", " if random_.random() < 0.2 else word + " " for word in random_.choices(vocabulary, weights, k=size))

    rows = [(at, text(random_.choice([0, 1, words, 3 * words]))) for at in range(documents)]
    rows += [(None, text(words)), (7, text(words)), (8, None), *((200 + at, rows[3][1]) for at in range(12))]
    return rows, [text(6) for _ in range(25)] + ["", "zzz", rows[3][1]]


def test_varints_come_back():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**31, 2**62], np.int64)
    octets, sizes = lexical.varints(values)
    assert sizes.tolist()[:7] == [1, 1, 1, 2, 2, 2, 3] and lexical.from_varints(octets).tolist() == values.tolist()


@pytest.mark.parametrize("block, seed", [(1, 1), (2, 2), (5, 3), (128, 4)])
def test_shards_equal_a_plain_scorer(monkeypatch, block, seed):
    """Blocks of few postings, several shards one after the other, and the floor that each leaves to the next."""
    monkeypatch.setattr(lexical, "BLOCK", block)
    documents, items = corpus(seed)
    vocabulary = {}
    coded = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in lexical.terms_of(i)}), np.int64) for i in items]
    shards = []
    for start in range(0, len(documents), 50):
        writer = lexical.ShardWriter(vocabulary)
        part = documents[start : start + 50]
        writer.add([doc_id for doc_id, _ in part], [text for _, text in part])
        shards.append(writer.shard().to_pylist()[0])
    held = np.zeros(len(vocabulary), np.int64)
    for row in shards:
        held[np.frombuffer(row["terms"], np.int32)] += np.frombuffer(row["counts"], np.int32)
    n_docs, n_terms = sum(row["n_docs"] for row in shards), sum(row["n_terms"] for row in shards)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)
    statistics = lexical.Statistics(n_docs, n_terms, weights)
    unpacked = []
    plain = lexical.Shard.unpack
    monkeypatch.setattr(lexical.Shard, "unpack", lambda self, blocks: unpacked.append(len(blocks)) or plain(self, blocks))
    for best in (1, 10):
        found = []
        for at, terms in enumerate(coded):
            heap, floor = [], 0
            for row in shards:
                shard = lexical.Shard(row, statistics)
                docs, scores = shard.search(terms, floor, best)
                own = zip((-scores).tolist(), (shard.named[docs] == 0).tolist(), shard.ids[docs].tolist())
                heap = sorted([*heap, *own])[:best]
                floor = -heap[-1][0] if len(heap) == best else 0
            found += [(at, rank, None if un else doc_id, -score) for rank, (score, un, doc_id) in enumerate(heap, 1)]
        assert found == brute_force(documents, items, best)
    every = sum(len(np.frombuffer(row["last"], np.int32)) for row in shards) * 2 * len(items)
    assert sum(unpacked) < every  # some blocks stay packed


@pytest.mark.parametrize("query_bytes", [1 << 20, 60])
def test_ranking_equals_a_plain_scorer(spark, query_bytes):
    """In one pass and in several."""
    documents, items = corpus(5)
    found = lexical.rank_documents(
        spark.createDataFrame(documents, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(at + 1000, text) for at, text in enumerate(items)], "item_id long, text string"),
        query_bytes=query_bytes,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted((row.item_id - 1000, row["rank"], row.doc_id, row.score) for row in found.collect())
    assert rows == brute_force(documents, items, 10)
