"""Links between two tokenizers' tokens against a plain walk over the bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from test_texts import ODD, odd
from tokenizers import Tokenizer

from flowgauge.llm import token_links, trie_bpe

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
MORE = [
    "  two spaces, <s>no token</s> <unk> <0x41> \t tab",
    "a▁b keeps no mark",
    "▁",
    " ",
    "\n",
    "\x00zero",
    "ﬁ ½ Å é  wide　",
    "don't we'll I'VE ՘'s",
    "naïve 日本語 😀👩‍👩‍👧 \U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    letters = trie_bpe.byte_letters()
    spelled = {number: bytes(letters[x] for x in name) for name, number in first.get_vocab().items() if set(name) <= letters.keys()}
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def bytes_of(number):
        piece = second.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        return a, b, [spelled[x] for x in a], [bytes_of(x) for x in b]

    return encode


def brute_force(library, texts):
    """One dict per text, as the operator's rows."""
    found, counts = [], Counter()
    for text in texts:
        a, b, a_bytes, b_bytes = library(text or "")
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in own]).tolist() for own in (a_bytes, b_bytes))
        links = [(x, y) for x, i in zip(a, a_ends) for y, j in zip(b, b_ends) if i == j] if len(a) < 500 else None
        if links is None:
            at = dict(zip(b_ends, b))
            links = [(x, at[i]) for x, i in zip(a, a_ends) if i in at]
        groups, i, j = [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            own = [[], []]
            while i < len(a) and a_ends[i] <= end:
                own[0].append(str(a[i]))
                i += 1
            while j < len(b) and b_ends[j] <= end:
                own[1].append(str(b[j]))
                j += 1
            groups.append("|".join(",".join(part) for part in own))
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found.append((len(a), len(b), len(groups), links, digest))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for n_a, n_b, n_groups, links, digest in found
    ], counts


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_equals_a_walk_over_the_bytes(spark, library):
    random_ = random.Random(8)
    made = ["".join(random_.choices("ab cé'\n1.日<|s>▁", k=random_.randint(1, 60))) for _ in range(60)]
    rows = [(at, text, "x") for at, text in enumerate([*ODD, *MORE, *made])]
    frame = spark.createDataFrame([*rows, (None, "no id", "x"), rows[3]], "doc_id long, text string, links string").repartition(3)
    expected, _ = brute_force(library, [text for _, text, _ in [*rows, (None, "no id", ""), rows[3]]])
    found = token_links.align_documents(frame, A, B).collect()
    wanted = [(doc_id, *own) for (doc_id, _, _), own in zip([*rows, (None, "", ""), rows[3]], expected)]
    key = lambda row: (row[0] is None, row[0] or 0, *row[1:])
    assert sorted(((row.doc_id, *(row[name] for name in NAMES)) for row in found), key=key) == sorted(wanted, key=key)
    assert {row[3] for row in wanted} > {0} and wanted[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_odd_tables_have_a_row_per_document(spark):
    assert token_links.align_documents(odd(spark), A, B).count() == len(ODD) + 2
    assert token_links.align_documents(odd(spark).limit(0), A, B).collect() == []


def test_vocabularies_bound_the_pairs():
    """Of two linked tokens one is the end of the other."""
    aligner = token_links.Aligner(trie_bpe.read_vocabulary(A), token_links.read_model(B))
    spelled = [[bytes(side.spelling.joined(np.array([x]))) for x in range(len(side.spelling.sizes))] for side in aligner.sides]
    known = [Counter(token for token in own if token) for own in spelled]
    bound = sum(known[1][token[at:]] for token in spelled[0] for at in range(len(token)))
    bound += sum(known[0][token[at:]] for token in spelled[1] for at in range(1, len(token)))
    assert 0 < bound < 1_000_000


def test_tokens_without_bytes_link_with_all_that_end_there():
    """Not in the given vocabularies; several tokens of a side may then end at one byte."""

    class Side:
        def __init__(self, tokens, lists):
            self.spelling, self.lists = token_links.Spelling.of(tokens), pa.array(lists, pa.list_(pa.int32()))

        def encode(self, texts):
            return self.lists

    aligner = token_links.Aligner.__new__(token_links.Aligner)
    aligner.sides = (Side([b"", b" a", b"b"], [[1, 0, 2]]), Side([b"", b" ", b"a", b"b"], [[1, 2, 0, 3]]))
    aligner.width = 4
    aligner.written = [
        pa.array([f"{n}{mark}" for mark in (",", end) for n in range(len(side.spelling.sizes))], pa.large_string())
        for side, end in zip(aligner.sides, "|;")
    ]
    aligner.all_written = pa.concat_arrays(aligner.written)
    row = aligner.align(["ab"]).to_pylist()[0]
    assert row["groups_sha256"] == hashlib.sha256(b"1,0|1,2,0;2|3").hexdigest()
    assert sorted(np.frombuffer(row["links"], np.int64).tolist()) == sorted([1 * 4 + 2, 1 * 4 + 0, 0 * 4 + 2, 0 * 4 + 0, 2 * 4 + 3]) and row["n_groups"] == 2


def test_parts_of_a_text_have_the_ids_of_the_whole(library):
    """Also where a worker remembers few of them."""
    random_ = random.Random(12)
    texts = ["".join(random_.choices(["a", "the", "'s", " ", "  ", "\n", "\t", "é", "日", "▁", "1", ".", "<s>", "\x85", "　"], k=random_.randint(1, 40))) for _ in range(3000)]
    for limit in (10, 100_000):
        sides = token_links.ByteSide(trie_bpe.read_vocabulary(A), limit), token_links.PieceSide(token_links.read_model(B), limit)
        for start in range(0, len(texts), 500):
            part = texts[start : start + 500]
            a, b = (side.encode(part).to_pylist() for side in sides)
            for text, one, other in zip(part, a, b):
                assert (one, other) == library(text)[:2], repr(text)
