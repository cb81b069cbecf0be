"""Near copies by signature coordinates against all pairs of full sets."""

import random
import re

import numpy as np

from flowgauge.llm import minhash_join


def brute_force(rows):
    """doc_id, n_shingles and component_id of (doc_id, text), by all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda found: found[0].lower(), text or ""))
        runs = [tuple(words[at : at + 4]) for at in range(max(1, len(words) - 3))] if words else []
        sets.append(set(runs))
    root = list(range(len(rows)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(at)] = min(least.get(find(at), doc_id), doc_id)
    return sorted(((d, len(sets[at]), least.get(find(at))) for at, (d, _) in enumerate(rows)), key=str)


def near(random_, words, changes):
    words = list(words)
    for at in random_.sample(range(len(words)), changes):
        words[at] = f"changed{random_.randint(0, 10**9)}"
    return " ".join(words)


def compared(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minhash_join.near_copies(frame).collect()
    assert all(row.kept == (row.doc_id is not None and row.doc_id == row.component_id) for row in found)
    assert sorted(((row.doc_id, row.n_shingles, row.component_id) for row in found), key=str) == brute_force(rows)


def test_components_equal_all_pairs(spark):
    random_ = random.Random(3)
    words = [f"w{at}" for at in range(3000)]
    texts = [None, "", " \t\n", "one", "ONE", "one two three", "one two\x0bthree", "one two three four", "a\xa0b c", "a\xa0b c d e"]
    for _ in range(25):  # chains: each a near copy of the one before
        text = random_.sample(words, random_.choice([30, 80, 200]))
        for changes in random_.choices([0, 1, 2, 3, 5], k=4):
            texts.append(near(random_, text, min(changes, len(text) // 20)))
            text = texts[-1].split(" ")
    passage = random_.sample(words, 60)
    texts += [" ".join(passage + random_.sample(words, random_.choice([5, 60, 120]))) for _ in range(40)]  # a passage in many
    texts += [texts[20].upper(), texts[20]]
    rows = [(at * 3 % 1009, text) for at, text in enumerate(texts)]
    compared(spark, [*rows, (None, texts[20]), (None, "of its own, without an id"), rows[30]])


def test_groups_beyond_a_chunk_stay_whole(spark):
    """More near copies than a comparison holds, of which some link to few others."""
    random_ = random.Random(4)
    base = [f"w{at}" for at in range(100)]
    rows = [(at, near(random_, base, random_.choice([1, 2, 3]))) for at in range(2500)]
    found = {row.doc_id: row.component_id for row in minhash_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [set(minhash_join.shingle_set(text).tolist()) for _, text in rows]
    for at, own in enumerate(sets):
        if found[at] != 0:  # then no link to the large component may have been lost
            both = [len(own & other) for other in sets]
            assert not any(100 * b >= 80 * (len(own) + len(o) - b) and found[k] != found[at] for k, (b, o) in enumerate(zip(both, sets)))


def test_lists_are_chunked_and_parts_meet_across(spark):
    """What two chunks part is compared again, in every chunk."""
    own = minhash_join.shingle_set(" ".join(f"w{at}" for at in range(53)))
    signs = minhash_join.signatures([own])[0].astype(np.uint32).tobytes()
    schema = "value long, holders long, node long, n_shingles long, signs binary, bitmap binary, posted long"
    posted = spark.createDataFrame([(5, 4096, node, 50, signs, minhash_join.bitmap(own), 7) for node in range(40)], schema)
    stars = minhash_join.stars(posted).collect()
    assert 0 < len(stars) < 40  # a star in each of the four chunks
    roots = spark.createDataFrame([(node, 0 if node < 38 else node) for node in range(40)], "node long, root long")
    met = {tuple(sorted((row.a, row.b))) for row in minhash_join.across(posted, roots, False).collect()}
    assert met == {(a, b) for b in (38, 39) for a in range(b)}


def test_bitmaps_rule_out_no_link():
    """The bound holds for every pair, and leaves few of those that are no links."""
    random_ = random.Random(9)
    base = [f"w{at}" for at in range(200)]
    texts = [near(random_, base, random_.randint(0, 40)) for _ in range(150)]
    texts += [" ".join(random_.choices("ab", k=n)) for n in range(1, 40)]
    sets = [minhash_join.shingle_set(text) for text in texts]
    members = minhash_join.Members.__new__(minhash_join.Members)
    members.nodes, members.sizes = np.arange(len(sets)), np.array([len(own) for own in sets])
    members.signs = np.zeros((len(sets), 32), np.uint32)  # all coordinates agree
    members.bitmaps = np.stack([np.frombuffer(minhash_join.bitmap(own), np.uint64) for own in sets])
    every = np.arange(len(sets))
    x, y, _ = members.may_link(every, members, every)
    kept = set(zip(x.tolist(), y.tolist()))
    links = set()
    for a, one in enumerate(sets):
        for b, other in enumerate(sets):
            both = len(np.intersect1d(one, other))
            if 100 * both >= 80 * (len(one) + len(other) - both):
                links.add((a, b))
    assert links <= kept and len(kept) < 1.3 * len(links)
