"""Operators over documents, held against brute force on small fixtures."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from flowgauge.llm import chaining, graph, minhash, packing, simhash, token_scan, toxicity, trie_bpe

BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))
# "fp", "bucket" and the like are names that the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, bucket string, start string"
ODD = [
    None,
    "",
    "  \n\t ",
    "one",
    "It's I'LL 's <|endoftext|> a\x1cb\x85c d<|startoftext|>",
    "Ünïcode ΑΣ 日本 😀 " * 3,
    "x" * 3000 + " " + "-" * 500,
    "word " * 9000,
    "same text again, and again",
    "same text again, and again",
]


def frame(spark, texts, first=0):
    rows = [(first + at, text, "en", "s", len(text or ""), "a", "b", "c") for at, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Nulls, empty, odd and long texts, a row without an id and a repeated row."""
    return frame(spark, ODD).unionByName(
        spark.createDataFrame([(None, "no id", None, None, None, None, None, None), (3, "one", *[None] * 6)], SCHEMA)
    )


def made_up(seed, words=120):
    random_ = random.Random(seed)
    return " ".join("".join(random_.choice("abcdefghij") for _ in range(random_.randint(3, 8))) for _ in range(words))


def test_every_character_is_parted_as_the_library_does():
    """Letters and digits of newer or older Unicode tables, before and after contractions."""
    library = Tokenizer.from_file(BYTES)
    own = trie_bpe.Encoder(trie_bpe.read_vocabulary(BYTES))
    characters = [chr(at) for at in [*range(0x80, 0xD800), *range(0xE000, 0x20000), *range(0x20000, 0x110000, 997)]]
    for start in range(0, len(characters), 20_000):
        texts = [f"{c}'s x{c}y{c}'re 1{c}2 {c}'LL" for c in characters[start : start + 20_000]]
        wanted = [np.array(found.ids, "<u4").tobytes() for found in library.encode_batch(texts, add_special_tokens=False)]
        assert own.encode_texts(texts) == wanted


def test_bpe_equals_the_tokenizer_and_decodes(spark):
    library = Tokenizer.from_file(BYTES)
    rows = trie_bpe.encode_documents(odd(spark), BYTES, with_ids=True).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        text = "no id" if row.doc_id is None else ODD[row.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.ids == np.array(ids, "<u4").tobytes() and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(row.ids).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert trie_bpe.encode_documents(frame(spark, []), BYTES).count() == 0


def test_bpe_on_random_strings():
    random_, library = random.Random(7), Tokenizer.from_file(BYTES)
    parts = ["a", "e", "th", " ", "\n", "  ", "'s", "é", "ß", "12", "!", "##", "́", "日", "😀", "ing", "The"]
    texts = ["".join(random_.choice(parts) for _ in range(random_.randint(0, 40))) for _ in range(3000)]
    mine = trie_bpe.Encoder(trie_bpe.read_vocabulary(BYTES)).encode_texts(texts)
    theirs = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in mine] == [encoding.ids for encoding in theirs]


def test_packing_is_whole_and_tight(spark):
    texts = [*ODD, *(made_up(seed, 40 * (seed % 9 + 1)) for seed in range(40))]
    library, capacity = Tokenizer.from_file(WORDS), 512
    rows = packing.pack_documents(frame(spark, texts).repartition(20), WORDS, capacity).collect()
    whole = []
    for doc_id, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        whole += packing.pieces_of(doc_id, ids.tobytes(), capacity)
        pieces = sorted((row for row in rows if row.doc_id == doc_id), key=lambda row: row.piece)
        assert [row.start for row in pieces] == list(range(0, len(ids), capacity))
        for row in pieces:
            own = ids[row.start : row.start + capacity]
            assert (row.length, row.ids_crc32) == (len(own), zlib.crc32(own.tobytes()))
    by_sequence = {}
    for row in sorted(rows, key=lambda row: row.offset):
        assert by_sequence.get(row.sequence_id, 0) == row.offset
        by_sequence[row.sequence_id] = row.offset + row.length
    at_once = len(packing.best_fit(whole, capacity))  # what one task that saw all pieces would need
    assert max(by_sequence.values()) <= capacity and len(by_sequence) <= at_once + 2
    assert packing.pack_documents(frame(spark, []), WORDS).count() == 0
    assert packing.pack_documents(odd(spark), WORDS).filter("doc_id is null or doc_id = 3").count() == 3


@pytest.mark.parametrize("order", ["by length", "by source", "mixed"])
@pytest.mark.parametrize("lengths", [{31: 400, 21: 400}, {31: 400, 26: 60}, {40: 300, 35: 300, 5: 500, 11: 40}])
def test_packing_is_tight_on_any_storage_order(spark, order, lengths):
    """Several tasks and rounds, against best fit of all pieces at once."""
    capacity, kinds = 60, ["a"] * sum(lengths.values())
    sizes = [size for size, count in lengths.items() for _ in range(count)]
    if order == "by source":
        sizes = sorted(sizes, reverse=True)
    if order == "mixed":
        random.Random(1).shuffle(sizes)
    texts = [" ".join(own for own in kinds[: size - 1]) for size in sizes]  # each word is a token, and the end
    rows = packing.pack_documents(frame(spark, texts).coalesce(16), WORDS, capacity, task_pieces=100).collect()
    assert sorted(row.length for row in rows) == sorted(sizes)
    used = {}
    for row in sorted(rows, key=lambda row: row.offset):
        assert used.get(row.sequence_id, 0) == row.offset
        used[row.sequence_id] = row.offset + row.length
    at_once = len(packing.best_fit([packing.Item(size, [0]) for size in sizes], capacity))
    # a task's share of the mix differs by chance, by more than at the usual size of tasks
    assert max(used.values()) <= capacity and len(used) <= 1.06 * at_once + 2


def test_best_fit_takes_the_fullest_bin():
    items = [packing.Item(used, [used]) for used in (6, 5, 4, 3, 2)]
    assert sorted(sorted(item.members) for item in packing.best_fit(items, 10)) == [[2, 3, 5], [4, 6]]


@pytest.mark.parametrize("width", [2, 4])
def test_token_scan_stitches_blocks(spark, width, monkeypatch):
    monkeypatch.setattr(token_scan, "RUN", 3)
    random_, end = random.Random(width), 9
    streams = {0: [3, 0, 0, 17, 1, 40, 2], 1: [], 2: [0], 3: [100], 4: [random_.randint(0, 9) for _ in range(60)]}
    rows, wanted = [], []
    for stream, counts in streams.items():
        tokens = [token for count in counts for token in [*[5] * count, end]] + [5] * (stream == 2) * 7
        data = np.array(tokens, token_scan.DTYPES[width]).tobytes()
        wanted += [(stream, at, count) for at, count in enumerate(counts)] + [(2, 1, 7)] * (stream == 2)
        rows += [(stream, at // (4 * width), data[at : at + 4 * width]) for at in range(0, len(data), 4 * width)]
    blocks = spark.createDataFrame(rows, "stream long, block long, data binary")
    counted = token_scan.stitched(token_scan.block_summaries(blocks, end, width))
    assert sorted(tuple(row) for row in counted.collect()) == sorted(wanted)
    assert token_scan.stitched(token_scan.block_summaries(blocks.limit(0), end, width)).count() == 0


def test_flat_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 2, 9, 3, 9, 4], "<u2").tobytes())
    blocks = token_scan.read_flat_files(spark, str(tmp_path), block_bytes=4)
    counted = token_scan.stitched(token_scan.block_summaries(blocks, 9))
    assert [row.n_tokens for row in counted.orderBy("ordinal").collect()] == [2, 1, 1]


def test_token_streams_of_documents(spark):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    blocks = token_scan.token_blocks(odd(spark), BYTES, 50256)
    counts = token_scan.stitched(token_scan.block_summaries(blocks.filter("kind = 0"), 50256))
    rows = token_scan.labels_of(blocks).join(counts, ["stream", "ordinal"], "full").collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        text = "no id" if row.doc_id is None else ODD[row.doc_id] or ""
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_token_streams_keep_every_id_at_any_block_size(spark):
    """Negative ids are ids; ordinals do not depend on the size of a block."""
    rows = [(-1, "a b"), (None, "c"), (-(2**62), ""), (0, "d e f"), (2**62, "g")] + [(at, f"h {at}") for at in range(1, 30)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(BYTES)
    wanted = [(at, doc_id, len(library.encode(text).ids)) for at, (doc_id, text) in enumerate(rows)]
    for block_bytes in (16, 64, 1 << 20):
        blocks = token_scan.token_blocks(documents, BYTES, 50256, block_bytes=block_bytes)
        counts = token_scan.stitched(token_scan.block_summaries(blocks.filter("kind = 0"), 50256))
        found = token_scan.labels_of(blocks, block_bytes).join(counts, ["stream", "ordinal"], "full").orderBy("ordinal").collect()
        assert [(row.ordinal, row.doc_id, row.n_tokens) for row in found] == wanted
    with pytest.raises(ValueError, match="multiples"):
        token_scan.token_blocks(documents, BYTES, 50256, block_bytes=24)


def slow_fingerprint(text):
    words = [part for part in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() if part]
    runs = [b" ".join(words[at : at + 3]) for at in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(links):
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_simhash_components(spark):
    texts = [*ODD, *(made_up(seed) for seed in range(6)), *(made_up(1) + f" tail{at}" for at in range(25))]
    rows = simhash.near_duplicates(frame(spark, texts)).collect()
    prints = {at: slow_fingerprint(text) for at, text in enumerate(texts)}
    links = [(a, b) for a in prints for b in prints if a <= b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = slow_components(links)
    assert {row.doc_id: (row.fingerprint, row.component_id) for row in rows} == {
        at: (f"{prints[at]:016x}", root[at]) for at in prints
    }
    kept = simhash.one_per_component(frame(spark, texts))
    assert kept.columns == frame(spark, []).columns
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(root.values()))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    ids = [row.doc_id for row in simhash.one_per_component(odd(spark)).collect()]
    assert ids.count(3) == 1 and ids.count(None) == 1


def test_balls_meet_at_every_distance(spark):
    random_ = random.Random(5)
    points = [random_.getrandbits(63) for _ in range(60)]
    for point in points[:40]:
        near = point
        for bit in random_.sample(range(63), random_.randint(1, 4)):
            near ^= 1 << bit
        points.append(near)
    points = sorted(set(points))
    links = simhash.near_links(spark.createDataFrame([(point,) for point in points], "fp long")).collect()
    assert all((row.a ^ row.b).bit_count() <= 3 for row in links)
    wanted = [(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= 3]
    assert slow_components([(row.a, row.b) for row in links]) == slow_components(wanted)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(at, at + 1) for at in range(40)] + [(100, 100 + at) for at in range(1, 30)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {row.node: row.root for row in found} == slow_components(links)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_fingerprints(spark):
    texts = [*ODD, *(made_up(seed, 400) for seed in range(8))]
    rows = {row.doc_id: row for row in minhash.fingerprint_documents(frame(spark, texts)).collect()}
    whole = [text or "" for text in texts]

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()

    for at, text in enumerate(whole):
        following = whole[(at + 1) % len(whole)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[at]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mine, other = shingles(text), shingles(edited)
        exact = len(mine & other) / len(mine | other) if mine | other else 1.0
        assert abs(row.near_edited - exact) < 0.15
    assert rows[8].fingerprint == rows[9].fingerprint and rows[8].near_next == 1
    assert rows[1].fingerprint == rows[2].fingerprint and rows[0].near_next == 1 and rows[2].near_next == 0
    assert minhash.fingerprint_documents(frame(spark, [])).count() == 0
    assert minhash.fingerprint_documents(odd(spark)).count() == len(ODD) + 2
    assert minhash.fingerprint_documents(frame(spark, ["only one"])).collect()[0].near_next == 1


def test_repeated_passages(spark):
    passage, boiler = made_up(900, 70), made_up(901, 12)
    words = passage.split()
    fuzzy = " ".join([*words[:30], "changed", *words[31:]])
    texts = [f"{made_up(at, 60)} {own} {made_up(at + 50, 60)} {boiler}" for at, own in enumerate([passage, passage, fuzzy, "", ""])]
    texts += [None, "", made_up(77, 30) * 3, "short"]
    rows = chaining.repeated_passages(frame(spark, texts, first=10)).collect()
    assert {(row.doc_id, row.source_id) for row in rows} == {(11, 10), (12, 10)}
    for row in rows:
        mine, other = texts[row.doc_id - 10][row.start : row.end], texts[row.source_id - 10][row.source_start : row.source_end]
        assert mine == (passage if row.doc_id == 11 else fuzzy) and other == passage
    assert min(row.likeness for row in rows) > 0.9
    cleaned = chaining.without_repeats(frame(spark, texts, first=10))
    assert cleaned.columns == frame(spark, []).columns
    left = {row.doc_id: (row.text, row.n_chars) for row in cleaned.collect()}
    assert len(left) == len(texts) and left[10][0] == texts[0] and left[13][0] == texts[3] and left[15][0] is None
    assert passage not in left[11][0] and left[11][1] == len(left[11][0])
    assert chaining.repeated_passages(frame(spark, [])).count() == 0
    assert chaining.without_repeats(odd(spark)).count() == len(ODD) + 2


def test_common_seeds_are_dealt_out_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(chaining, "COMMON", 2)
    passage = made_up(903, 80)
    rows = chaining.repeated_passages(frame(spark, [f"{made_up(at, 20)} {passage}" for at in range(150)])).collect()
    assert {row.doc_id for row in rows} == set(range(1, 150)) and all(row.source_id < row.doc_id for row in rows)


def test_chain_prefers_the_ordered_matches():
    x = np.array([0, 50, 100, 150, 120])
    y = np.array([1000, 1050, 1100, 1150, 10])
    best = chaining.chain(x, y, 48.0)
    assert [places.tolist() for places in best] == [[0, 1, 2, 3]]


def toxic_corpus(spark, rows=240):
    bad = ["vileword", "nastyword", "awfulword"]
    texts = [made_up(at, 40) + (f" {bad[at % 3]} {made_up(at + 999, 5)} {bad[(at + 1) % 3]}" if at % 4 == 0 else "") for at in range(rows)]
    labels = spark.createDataFrame([(at, 1, int(at % 4 == 0)) for at in range(rows)], "doc_id long, quality int, toxic int")
    return texts, labels


def test_toxicity_on_held_out_rows(spark):
    texts, labels = toxic_corpus(spark)
    odd_labels = spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 0, 7), (9999, 0, 1)], labels.schema)
    rows = toxicity.score_documents(frame(spark, texts), labels.unionByName(odd_labels)).collect()
    held = [row for row in rows if row.held_out]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert np.mean([row.predicted == (row.doc_id % 4 == 0) for row in held]) > 0.95
    scored = toxicity.score_documents(odd(spark), labels).collect()
    assert len(scored) == len(ODD) + 2 and all(0 <= row.score <= 1 for row in scored)
    nothing = toxicity.score_documents(frame(spark, ["a"]), labels.limit(0)).collect()
    assert nothing[0].score == 0.5
    assert toxicity.score_documents(frame(spark, []), labels).count() == 0


def test_ftrl_leaves_noise_at_zero():
    random_ = np.random.default_rng(3)
    labels = random_.integers(0, 2, 400)
    rows = [np.append(random_.integers(1, 40, 3), 0) if label else random_.integers(1, 40, 3) for label in labels]
    z, n = np.zeros(41), np.zeros(41)
    toxicity.ftrl([np.unique(row) for row in rows], labels, z, n, 3)
    weights = toxicity.weights_of(z, n)
    assert weights[0] > 2 and np.count_nonzero(np.abs(weights[1:40]) > weights[0] / 2) == 0
