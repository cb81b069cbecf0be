"""Repeated passages that breaks, composition and changed words must not hide."""

import random

import numpy as np
from test_texts import frame, made_up

from flowgauge.llm import chaining


def best_score(x, y, weight):
    """The recurrence of the chains over all pairs of matches."""
    order = sorted(range(len(x)), key=lambda at: (x[at], y[at]))
    scores = []
    for own, at in enumerate(order):
        gains = [0.0]
        for before, other in enumerate(order[:own]):
            dx, dy = int(x[at] - x[other]), int(y[at] - y[other])
            if 0 < dx <= chaining.LONGEST_GAP and 0 < dy <= chaining.LONGEST_GAP:
                gains.append(scores[before] - chaining.GAP_COST * (dx + dy))
        scores.append(weight + max(gains))
    return max(scores)


def test_chains_equal_brute_force_where_texts_break():
    random_ = random.Random(5)
    for _ in range(60):
        x = np.array([random_.randrange(3000) for _ in range(80)])
        y = x + np.array([random_.choice([0, 0, 700, -900, random_.randrange(3000)]) for _ in range(80)])
        chains = chaining.chain(x, y, 48.0)
        steps = [(np.diff(x[places]), np.diff(y[places])) for places in chains]
        for dx, dy in steps:
            assert ((dx > 0) & (dx <= chaining.LONGEST_GAP) & (dy > 0) & (dy <= chaining.LONGEST_GAP)).all()
        scores = [48.0 * (len(dx) + 1) - chaining.GAP_COST * (dx.sum() + dy.sum()) for dx, dy in steps]
        assert abs(max(scores) - best_score(x, y, 48.0)) < 1e-6


def test_a_copy_goes_on_behind_a_long_insertion(spark):
    first, second, third = made_up(1, 400), made_up(2, 200), made_up(3, 200)
    texts = [f"{first} {second} {third}", f"{first} {made_up(4, 300)} {second} {made_up(5, 300)} {third}"]
    rows = chaining.repeated_passages(frame(spark, texts)).collect()
    assert {texts[1][row.start : row.end] for row in rows} == {first, second, third}


def test_a_passage_composed_of_earlier_ones_meets_a_document_that_holds_it(spark):
    parts = [made_up(at, 30) for at in (10, 11, 12)]
    whole = " ".join(parts)
    least = " ".join(whole.split()[20:70])
    texts = [f"{made_up(20 + at, 60)} {part} {made_up(30 + at, 60)}" for at, part in enumerate(parts)]
    texts += [f"{made_up(40, 60)} {whole} {made_up(41, 60)}", f"{made_up(42, 60)} {whole} {made_up(43, 60)}"]
    texts += [f"{made_up(44, 60)} {least} {made_up(45, 60)}"]
    rows = chaining.repeated_passages(frame(spark, texts)).collect()
    assert {(row.doc_id, row.source_id, texts[row.doc_id][row.start : row.end]) for row in rows} == {(4, 3, whole), (5, 3, least)}


def test_thinned_matches_keep_every_diagonal():
    x = np.concatenate([np.arange(0, 1000, 5), np.arange(2000, 2300, 5), [5000]])
    y = np.concatenate([np.arange(0, 1000, 5), np.arange(2700, 3000, 5), [9]])
    kept = set(zip(*(side.tolist() for side in chaining.thinned(x, y))))
    assert kept < set(zip(x.tolist(), y.tolist())) and len(kept) < 20
    assert {(0, 0), (995, 995), (2000, 2700), (2295, 2995), (5000, 9)} <= kept


def test_passages_of_a_pair_cover_the_same_text_in_fewer_rows():
    random_ = random.Random(6)
    for _ in range(100):
        spans = [(start, start + random_.randint(1, 60)) for start in random_.sample(range(600), 25)]
        rows = [(1, start, end, 0) for start, end in spans]
        kept = chaining.covering(rows)
        covered, all_covered = ({at for _, start, end, _ in own for at in range(start, end)} for own in (kept, rows))
        assert covered == all_covered and set(kept) <= set(rows)
    assert len(chaining.covering([(1, at, at + 50, 0) for at in range(100)])) == 3


def test_passages_with_one_word_in_five_changed_are_found(spark):
    texts = []
    for at in range(40):
        words = made_up(100 + at, 50).split()
        changed = [f"{word}zz" if place % 5 == 2 else word for place, word in enumerate(words)]
        texts += [f"{made_up(200 + at, 40)} {' '.join(own)} {made_up(300 + at + 50 * side, 40)}" for side, own in enumerate((words, changed))]
    rows = chaining.repeated_passages(frame(spark, texts)).collect()
    # in 40 words of 50, ten short seeds are whole; by thinning one passage in some hundreds has none
    assert len({row.doc_id for row in rows}) >= 38 and all(row.doc_id == row.source_id + 1 for row in rows)
    assert all(row.n_words >= 50 and row.likeness >= 0.8 for row in rows)


def mutated(text, share, seed):
    """The text with ``share`` of its words replaced, evenly spaced from a random one on."""
    words = text.split()
    random_ = random.Random(seed)
    for place in random_.sample(range(1, len(words) - 1), round(share * len(words))):
        words[place] = made_up(seed * 1000 + place, 1)
    return " ".join(words)


def test_passages_are_found_where_their_short_seeds_stand_in_earlier_documents(spark):
    for share in (0.1, 0.15):
        singles, pairs = [], []
        for at in range(20):
            passage = made_up(500 + at, 80)
            words = passage.split()
            singles += [f"{made_up(5000 + 100 * at + low, 30)} {' '.join(words[low : low + 9])}" for low in range(0, 80, 5)]
            pairs.append([f"{made_up(600 + at, 40)} {passage}", f"{made_up(700 + at, 40)} {mutated(passage, share, 800 + at)}"])
        texts = singles + [first for first, _ in pairs] + [second for _, second in pairs]
        rows = chaining.repeated_passages(frame(spark, texts)).collect()
        wanted = {(len(singles) + 20 + at, len(singles) + at) for at in range(20)}
        assert len(wanted & {(row.doc_id, row.source_id) for row in rows}) >= 18


def test_matches_equal_brute_force_over_batches(spark):
    random_ = random.Random(8)
    seeds = sorted({(random_.randrange(40), 0, random_.randrange(30), random_.randrange(5)) for _ in range(800)})
    given = spark.createDataFrame(seeds, "hash long, salt int, doc_id long, start int")
    wanted = set()
    for key, salt, doc, start in seeds:
        same = [row for row in seeds if row[0] == key and row[2] < doc]
        if same:
            last = max(same)
            sources = {same[0][2:]} | ({last[2:]} if last[2] != same[0][2] else set())
            wanted |= {(key, doc, start, *source) for source in sources}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            found = [tuple(row) for row in chaining._matches(given).collect()]
            assert set(found) == wanted and len(found) == len(wanted)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_salts_change_no_match(spark):
    """Salts are ranges of doc_id, here of ten documents each; a third of the hashes have some."""
    random_ = random.Random(9)
    seeds = sorted({(random_.randrange(30), random_.randrange(60), random_.randrange(4)) for _ in range(900)})
    schema = "hash long, salt int, doc_id long, start int"
    plain = spark.createDataFrame([(key, 0, doc, start) for key, doc, start in seeds], schema)
    salted = spark.createDataFrame([(key, doc // 10 + 1 if key % 3 == 0 else 0, doc, start) for key, doc, start in seeds], schema)
    wanted, found = (sorted(tuple(row) for row in chaining._matches(given).collect()) for given in (plain, salted))
    assert found == wanted and len(set(found)) == len(found) > 1000


def test_the_sample_of_common_seeds_decides_on_no_source(spark, monkeypatch):
    """A passage that many hold stands changed in the document before its last holder: that one is the second source."""
    common = made_up(920, 80)
    changed = " ".join(f"{word}q" if at % 10 == 4 else word for at, word in enumerate(common.split()))
    texts = [f"{made_up(930 + at, 30)} {common if at % 8 == 0 else changed}" for at in range(90)]
    given = frame(spark, texts)
    rows = []
    for least in (1_000_000, 2):
        monkeypatch.setattr(chaining, "COMMON", least)
        rows.append(sorted(tuple(row) for row in chaining.repeated_passages(given).collect()))
    assert rows[0] == rows[1] and rows[0]


def test_seeds_come_back_from_their_bytes():
    random_ = np.random.default_rng(3)
    for count in (1, 2, 1000):
        hashes = random_.integers(0, 1 << chaining.HASH_BITS, count)
        salts = random_.integers(0, 65, count).astype(np.int32)
        ids = random_.integers(-(1 << 62), 1 << 62, count)
        starts = random_.integers(0, 1 << 31, count).astype(np.int32)
        rows = chaining.unpacked(chaining.packed(hashes, salts, ids, starts))
        order = np.argsort(hashes, kind="stable")
        assert all((own == given[order]).all() for own, given in zip(rows, (hashes, salts, ids, starts)))


def test_nothing_is_cut_against_a_text_that_goes_itself(spark):
    first = made_up(900, 100)
    second = " ".join(f"{word}q" if at % 6 == 1 else word for at, word in enumerate(first.split()))
    third = " ".join(f"{word}r" if at % 6 == 4 else word for at, word in enumerate(second.split()))
    texts = [first, second, third, third]
    kept = {row.doc_id: row.text for row in chaining.without_repeats(frame(spark, texts)).collect()}
    assert kept[0] == first and kept[1] != second and kept[2] == third and kept[3] == ""


def test_a_second_source_inside_a_fuzzy_passage_is_reported(spark):
    passage = made_up(910, 200)
    inner = " ".join(passage.split()[60:130])
    copy = " ".join(f"{word}q" if at % 10 == 4 else word for at, word in enumerate(passage.split()))
    part = " ".join(copy.split()[60:130])
    rows = chaining.repeated_passages(frame(spark, [f"{made_up(911, 60)} {passage}", f"{made_up(912, 60)} {part}", copy])).collect()
    assert inner != part and {(row.doc_id, row.source_id) for row in rows} == {(1, 0), (2, 0), (2, 1)}


def test_smallest_hashes_of_windows_equal_brute_force():
    random_ = np.random.default_rng(4)
    for window in (2, 7, 27):
        for count in (1, 2, 6, 7, 8, 27, 28, 90):
            hashes = random_.integers(0, 40, count).astype(np.uint64)
            windows = [range(at, min(count, at + window)) for at in range(max(1, count - window + 1))]
            wanted = {at for own in windows for at in own if hashes[at] == min(hashes[other] for other in own)}
            assert set(chaining.smallest_in_windows(hashes, window).tolist()) == wanted


def test_a_pair_goes_on_as_one_row_however_often_its_text_repeats_itself(spark):
    """One word many times over makes a chain at nearly every place; the texts go on once for all of them."""
    texts = [f"{made_up(950 + at, 60)} {' '.join(['again'] * (200 + 100 * at))} {made_up(960 + at, 60)}" for at in range(2)]
    given = frame(spark, texts).select("doc_id", "text")
    nothing = np.empty(0, np.int64)
    rows = chaining._chains(chaining._matches(chaining._seeds(given, nothing, nothing, 4)), 4).collect()
    assert len(rows) == 1 and len(rows[0].sizes) > 100
    assert sum(rows[0].lengths) < 2 * len(texts[1]) and sum(rows[0].source_lengths) < 2 * len(texts[0]) + 2 * chaining.MARGIN


def test_pairs_aligned_together_equal_each_alone():
    pairs, chains = [], []
    for at in range(12):
        passage = made_up(970 + at, 70 + 20 * at)
        own, other = (f"{made_up(1000 + 2 * at + side, 30 * at)} {passage if side else mutated(passage, 0.05, 990 + at)}".strip() for side in range(2))
        places = [len(text) - len(text.split(" ", 30 * at)[-1]) for text in (own, other)]
        first, other_first = (max(0, place - chaining.MARGIN) for place in places)
        pairs.append((([first], [own[first : places[0] + chaining.MARGIN]]), ([other_first], [other[other_first : places[1] + chaining.MARGIN]])))
        chains.append(([1], places[:1], places[1:]))
    together = chaining.align(*(chaining.Words(list(side)) for side in zip(*pairs)), chains)
    alone = [chaining.align(chaining.Words([own]), chaining.Words([other]), [chain])[0] for (own, other), chain in zip(pairs, chains)]
    assert together == alone and all(found and found[0][4] >= 50 for found in together)
