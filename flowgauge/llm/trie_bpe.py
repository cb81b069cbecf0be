"""BPE by a trie of distinct words.

The encoding of a word is fixed by the last token of each of its prefixes: what is left of that
token is a shorter prefix. So words are walked as a trie, depth first, with the last tokens of the path on a
stack. A prefix that many words share is worked out once. The last token of a new prefix is the one token that
ends there and whose border to the last token before it survives all merges.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from flowgauge.llm.common import WHITE_SPACE, remembered_by_worker, slices

# A word with the space before it, or white space up to the last character before a word.
CHUNK = re.compile(rf" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
# Fixed value: the vocabulary's own pattern, inside a chunk.
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+"
)
REMEMBERED = 800_000  # chunks or words that a worker remembers
ASCII = frozenset(map(chr, range(128)))
NEVER = 1 << 30
WORD_END = "</w>"
END_SHIFT = 0x100  # added to the last letter of a word where the vocabulary tells it apart


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file.

    Printable Latin-1 characters stand for themselves; the other bytes, in order, follow from 256.
    """
    printable = [byte for byte in range(256) if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174]
    rest = sorted(set(range(256)) - set(printable))
    return {chr(byte): byte for byte in printable} | {chr(256 + at): byte for at, byte in enumerate(rest)}


def ended(word: str) -> str:
    """A word whose last letter is marked as such."""
    return word[:-1] + chr(ord(word[-1]) + END_SHIFT)


class MergeTable:
    """The merges of a vocabulary file, over words spelled with one character per byte (Latin-1)."""

    def __init__(self, text: str):
        described = json.loads(text)
        model, letters = described["model"], byte_letters()
        vocab = model["vocab"]
        self.special = {item["content"]: item["id"] for item in described["added_tokens"]}
        marks_end = model["end_of_word_suffix"] == WORD_END
        self.spelled: dict[int, str] = {}
        for name, number in vocab.items():
            last = marks_end and name.endswith(WORD_END)
            stem = name.removesuffix(WORD_END) if last else name
            if stem and name not in self.special and set(stem) <= letters.keys():
                word = "".join(chr(letters[letter]) for letter in stem)
                self.spelled[number] = ended(word) if last else word
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.joined[pair] = rank
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = pair, rank
        # a token counts only if its own letters are encoded as it
        self.ids = {word: number for number, word in self.spelled.items() if len(word) == 1 and number not in self.parts}
        for number, pair in self.parts.items():
            if self.borders(*pair, self.rank[number]):
                self.ids[self.spelled[number]] = number
        self.size = {number: len(word) for word, number in self.ids.items()}
        self.fits: dict[int, bool] = {}

    def borders(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether two adjacent tokens stay apart in all merges of a rank below ``until``.

        The two are taken apart again, the one formed last first. At each step the pair at the
        border is one that met while the word was merged; it must not merge before one
        of the two was taken up by what it was taken from. Of equal ranks the leftmost merges first.
        """
        left_until = right_until = NEVER
        while True:
            rank = self.joined.get((left, right))
            if rank is not None and rank < until and rank < left_until and rank <= right_until:
                return False
            left_rank, right_rank = self.rank.get(left, -1), self.rank.get(right, -1)
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                left, left_until = self.parts[left][1], left_rank
            else:
                right, right_until = self.parts[right][0], right_rank

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct words, little-endian 32-bit; sorted, they are the paths of a trie, depth first."""
        encoded: dict[str, bytes] = {}
        if len(self.fits) > REMEMBERED // 2:
            self.fits.clear()
        ids, fits, size = self.ids.get, self.fits, self.size
        before, last = "", []
        for word in sorted(words):
            shared = 0
            for mine, other in zip(word, before):
                if mine != other:
                    break
                shared += 1
            del last[shared:]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                while True:  # most last tokens are short
                    token = ids(word[start:end])
                    if token is not None:
                        if not start:
                            break
                        key = last[start - 1] << 20 | token
                        fit = fits.get(key)
                        if fit is None:
                            fit = fits[key] = self.borders(last[start - 1], token)
                        if fit:
                            break
                    start -= 1
                last.append(token)
            numbers, at = [], len(word)
            while at:
                token = last[at - 1]
                numbers.append(token)
                at -= size[token]
            numbers.reverse()
            encoded[word], before = array("I", numbers).tobytes(), word
        return encoded


def remembered(known: dict[str, bytes], fresh: dict[str, bytes], needed: set[str], limit: int) -> dict[str, bytes]:
    """A dictionary that has all that is needed: ``known``, grown by ``fresh`` while that keeps within the limit."""
    if len(known) + len(fresh) <= limit:
        known.update(fresh)
        return known
    for word in needed - fresh.keys():
        fresh[word] = known[word]
    return fresh


class Parting:
    """Parts chunks into pieces as the library does, whose tables of letters and digits are not those of Python or ``regex``."""

    def __init__(self):
        self.library = ByteLevel(add_prefix_space=False)
        self.agrees: dict[str, bool] = {}  # characters beyond ASCII seen so far

    def learn(self, characters: set[str]) -> None:
        """Hold the class of new characters, found by what the library joins them with, against that of the tables here."""
        for new in characters - self.agrees.keys():
            joins = [len(self.library.pre_tokenize_str(before + new)) == 1 for before in "a1!"]
            own = [regex.match(kind, new) is not None for kind in (r"\p{L}", r"\p{N}", rf"[^{WHITE_SPACE}\p{{L}}\p{{N}}]")]
            self.agrees[new] = joins == own and new.isalpha() == own[0]

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a chunk whose characters are known."""
        if chunk.isascii() or all(map(self.agrees.__getitem__, filterfalse(str.isascii, chunk))):
            body = chunk[1:] if chunk[0] == " " else chunk
            # str.isalpha means all of \p{L}; most chunks are such a word
            return [chunk] if body.isalpha() else PIECES.findall(chunk)
        return [chunk[start:end] for _, (start, end) in self.library.pre_tokenize_str(chunk)]


class Encoder:
    """Whole texts by a byte-level vocabulary, with the worker's memory of chunks."""

    def __init__(self, text: str, limit: int = REMEMBERED):
        self.table, self.limit = MergeTable(text), limit
        self.known: dict[str, bytes] = {}
        self.parting = Parting()
        spelled = {number: word.encode("latin-1") for number, word in self.table.spelled.items()}
        spelled |= {number: content.encode() for content, number in self.table.special.items()}
        self.lengths = np.zeros(max(spelled) + 1, np.int64)
        self.lengths[list(spelled)] = list(map(len, spelled.values()))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.letters = np.frombuffer(b"".join(spelled[number] for number in sorted(spelled)), np.uint8)

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of all these chunks; new ones are remembered while there is room."""
        fresh = chunks - self.known.keys()
        pieces: dict[str, list[str]] = {}
        self.parting.learn(set().union(*filterfalse(str.isascii, fresh)) - ASCII)
        for chunk in fresh:
            own = self.parting.pieces(chunk)
            pieces[chunk] = [piece if piece.isascii() else piece.encode().decode("latin-1") for piece in own]
        words = self.table.encode_words({piece for own in pieces.values() for piece in own})
        ids = {
            chunk: words[own[0]] if len(own) == 1 else b"".join(map(words.__getitem__, own))
            for chunk, own in pieces.items()
        }
        return remembered(self.known, ids, chunks, self.limit)

    def encode_texts(self, texts: list[str], special: bool = True) -> list[bytes]:
        """Ids of whole texts, little-endian 32-bit; with ``special``, special tokens' strings have their own."""
        if special and any(content in text for content in self.table.special for text in texts):
            border = re.compile("(" + "|".join(map(re.escape, self.table.special)) + ")")
            parts = [border.split(text) for text in texts]
        else:
            parts = [[text] for text in texts]
        # of a text's parts, every second is a special token's string
        chunked = [[CHUNK.findall(part) if at % 2 == 0 else part for at, part in enumerate(own)] for own in parts]
        look = self.learn(set().union(*(part for own in chunked for part in own[::2]))).__getitem__
        numbers = self.table.special
        return [
            b"".join(
                b"".join(map(look, part)) if at % 2 == 0 else numbers[part].to_bytes(4, "little")
                for at, part in enumerate(own)
            )
            for own in chunked
        ]

    def decode_texts(self, encoded: list[bytes]) -> list[str]:
        """Texts of id sequences, by gathering the letters of all ids at once; bytes that are no UTF-8 become U+FFFD."""
        ids = np.frombuffer(b"".join(encoded), "<u4")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        letters = self.letters[np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)].tobytes()
        borders = np.cumsum([0] + [len(own) // 4 for own in encoded])
        cuts = np.concatenate([[0], ends])[borders].tolist()
        return [letters[start:end].decode("utf-8", errors="replace") for start, end in zip(cuts, cuts[1:])]


def encoder(text: str) -> Encoder:
    """One per Python worker and vocabulary, so that later tasks find words encoded already."""
    return remembered_by_worker(("bytes", text), lambda: Encoder(text))


def read_vocabulary(path: str) -> str:
    """The file's text; executors get it with the task and need no file of their own."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(documents: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text, with ``with_ids`` also the ids.

    Null and empty texts have no tokens. Rows are independent: repeated rows and null ids stay, further
    columns are left out.
    """
    text = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(text.value)
        for batch in slices(batches, texts=1):
            ids = words.encode_texts([value or "" for value in batch.column(1).to_pylist()])
            columns = [
                batch.column(0),
                pa.array([len(own) // 4 for own in ids], pa.int64()),
                pa.array([hashlib.sha256(own).hexdigest() for own in ids], pa.string()),
                pa.array([hashlib.sha256(own.encode()).hexdigest() for own in words.decode_texts(ids)], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, schema)
