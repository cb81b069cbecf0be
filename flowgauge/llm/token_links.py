"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

A batch of texts becomes two list columns of token ids. Each is flattened, its parent indices name the document, and a
segmented running sum of the tokens' byte lengths gives the byte at which each token ends. A hash join of the two sides on
(document, end) yields the links: tokens that end together. Common ends cut a document's tokens into groups.

How often two ids are linked is counted by ``Table.group_by`` within each task, and Spark adds up the tasks' counts. Of two
linked tokens one's bytes are the end of the other's, so the vocabularies bound the number of linked pairs, whatever the number
of documents: each token has no more ends than bytes. Only these counts travel to all tasks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowgauge.llm.common import cut, remembered_by_worker, scratch, slices
from flowgauge.llm.trie_bpe import CHUNK, byte_letters, read_vocabulary, remembered

SPACE_MARK = "▁"
PIECE_BYTES = 1 << 20  # of text in one Arrow table
REMEMBERED = 250_000  # parts of texts that a worker remembers ids of, for each side


@dataclass(frozen=True)
class Spelling:
    """The bytes of each id: one after the other, where each begins, and how many."""

    octets: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Spelling:
        sizes = np.array([len(token) for token in tokens], np.int64)
        return Spelling(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        return self.octets[np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)]


class Remembering:
    """Ids of texts put together from those of their parts, of which a worker remembers a number.

    ``PARTS`` must cut a text where no token reaches across.
    """

    PARTS: re.Pattern

    def __init__(self, limit: int):
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def ids_of(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of new parts, as 32-bit numbers."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Ids of a space and each text."""
        cut_up = [self.PARTS.findall(f" {text}") for text in texts]
        needed = set().union(*cut_up)
        fresh = self.ids_of(sorted(needed - self.known.keys()))
        self.known = remembered(self.known, fresh, needed, self.limit)
        look = self.known.__getitem__
        found = [b"".join(map(look, parts)) for parts in cut_up]
        offsets = np.cumsum([0] + [len(own) // 4 for own in found])
        ids = np.frombuffer(b"".join(found), np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))


def _split(ids: list[int], owners: list[int], parts: list[str]) -> dict[str, bytes]:
    """Ids that come one part after the other, by the number of the part of each."""
    octets = np.array(ids, np.int32).tobytes()
    ends = (4 * np.searchsorted(np.array(owners, np.int64), np.arange(len(parts) + 1))).tolist()
    return {part: octets[start:end] for part, start, end in zip(parts, ends, ends[1:])}


class ByteSide(Remembering):
    """Space and text by a byte-level vocabulary; strings of special tokens are plain text."""

    PARTS = CHUNK

    def __init__(self, vocabulary: str, limit: int = REMEMBERED):
        super().__init__(limit)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores already
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        letters = byte_letters()
        size = self.library.get_vocab_size(with_added_tokens=True)
        spelled = [b""] * size
        for name, number in self.library.get_vocab(with_added_tokens=False).items():
            if set(name) <= letters.keys():
                spelled[number] = bytes(map(letters.__getitem__, name))
        self.spelling = Spelling.of(spelled)

    def ids_of(self, parts: list[str]) -> dict[str, bytes]:
        whole = self.library.encode(parts, is_pretokenized=True, add_special_tokens=False)
        return _split(whole.ids, whole.word_ids, parts)


class PieceSide(Remembering):
    """Text by a vocabulary of pieces, which sets the space before it.

    A piece has space marks only at its beginning or no other letters, and no line ends, so none reaches from a word over a space
    or over a line end; the constructor makes sure.
    """

    PARTS = re.compile(rf"[ {SPACE_MARK}]+[^ {SPACE_MARK}\n]*|\n[^ {SPACE_MARK}\n]*")

    def __init__(self, model: bytes, limit: int = REMEMBERED):
        super().__init__(limit)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.mark = self.model.piece_to_id(SPACE_MARK)
        tokens = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            is_byte = self.model.is_byte(number)
            if not is_byte and (SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece):
                raise ValueError(f"piece {number} reaches over a space or a line end")
            tokens.append(bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace(SPACE_MARK, " ").encode())
        self.spelling = Spelling.of(tokens)

    def ids_of(self, parts: list[str]) -> dict[str, bytes]:
        # the library sets a space before what it is given: it is taken from a part that has one, or its token from the others
        given = [part if part[0] == "\n" else part[1:] for part in parts]
        found = self.model.encode(given, num_threads=1) if given else []
        mark = np.array([self.mark], np.int32).tobytes()
        octets = {part: np.array(ids, np.int32).tobytes() for part, ids in zip(parts, found)}
        octets |= {part: mark for part in (" ", SPACE_MARK) if part in octets}  # nothing was given
        octets |= {part: octets[part].removeprefix(mark) for part in parts if part[0] == "\n"}
        return octets


class Aligner:
    """Two sides and what a worker keeps for them."""

    def __init__(self, vocabulary: str, model: bytes):
        self.sides = (ByteSide(vocabulary), PieceSide(model))
        self.width = len(self.sides[1].spelling.sizes)
        # ids in decimal with what follows them: a comma within a group, a bar or a semicolon at its end
        self.written = [
            pa.array([f"{number}{mark}" for mark in (",", end) for number in range(len(side.spelling.sizes))], pa.large_string())
            for side, end in zip(self.sides, "|;")
        ]
        self.all_written = pa.concat_arrays(self.written)

    def tokens(self, texts: list[str]) -> tuple[list[pa.ListArray], np.ndarray]:
        """Both sides' ids of each text, and which texts either side spells out byte for byte; others have no ids."""
        expected = [f" {text}".encode() if text else b"" for text in texts]
        whole = np.array([len(own) > 0 for own in expected])
        encoded = []
        for side in self.sides:
            lists = side.encode(texts)
            ids, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            octets = side.spelling.joined(ids).tobytes()
            borders = np.concatenate([[0], np.cumsum(side.spelling.sizes[ids])])[offsets].tolist()
            whole &= np.array([octets[a:b] == own for a, b, own in zip(borders, borders[1:], expected)], bool)
            encoded.append(lists)
        empty = pa.scalar(None, pa.list_(pa.int32()))
        right = pa.array(whole)
        return [_without_nulls(pc.if_else(right, lists, empty)) for lists in encoded], whole

    def links(self, lists: list[pa.ListArray]) -> tuple[pa.Table, list[pa.Table]]:
        """Pairs of tokens that end together (document, a, b and the tokens' places), and each side's tokens with their ends."""
        sides = []
        for own, side in zip(lists, self.sides):
            ids = pc.list_flatten(own)
            documents = pc.list_parent_indices(own)
            running = pc.cumulative_sum(pc.take(pa.array(side.spelling.sizes), ids))
            firsts = own.offsets.to_numpy()[:-1]  # the running sum before each document's first token
            before = np.concatenate([[0], running.to_numpy()])[firsts]
            ends = pc.subtract(running, pc.take(pa.array(before), documents))
            places = pa.array(np.arange(len(ids), dtype=np.int64))
            sides.append(pa.table({"document": documents.cast(pa.int64()), "end": ends, "id": ids, "place": places}))
        a, b = sides
        joined = a.rename_columns(["document", "end", "a", "a_place"]).join(
            b.rename_columns(["document", "end", "b", "b_place"]), ["document", "end"], join_type="inner", use_threads=False
        )
        return joined, sides

    def align(self, texts: list[str]) -> pa.RecordBatch:
        """n_a, n_b, n_groups, n_links, groups_sha256 and the linked pairs (a * width + b) of each text."""
        lists, _ = self.tokens(texts)
        joined, sides = self.links(lists)
        count = len(texts)
        documents = joined["document"].to_numpy()
        order = np.argsort(documents, kind="stable")
        codes = (joined["a"].to_numpy().astype(np.int64) * self.width + joined["b"].to_numpy())[order]
        n_links = np.bincount(documents, minlength=count)
        last = [self._last_of_groups(side, joined[place].to_numpy()) for side, place in zip(sides, ("a_place", "b_place"))]
        n_groups = np.bincount(sides[0]["document"].to_numpy()[last[0]], minlength=count)
        sizes = [np.diff(own.offsets.to_numpy()) for own in lists]
        ends = np.concatenate([[0], 8 * np.cumsum(n_links)]).tolist()
        octets = codes.tobytes()
        pairs = pa.array([octets[start:end] for start, end in zip(ends, ends[1:])], pa.binary())
        arrays = [
            pa.array(sizes[0], pa.int64()),
            pa.array(sizes[1], pa.int64()),
            pa.array(n_groups, pa.int64()),
            pa.array(n_links, pa.int64()),
            pa.array(self._digests(sides, last, sizes[0] + sizes[1])),
            pairs,
        ]
        return pa.RecordBatch.from_arrays(arrays, ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    @staticmethod
    def _last_of_groups(side: pa.Table, linked: np.ndarray) -> np.ndarray:
        """Whether a token is a group's last: linked, and the last of those that end where it does."""
        last = np.zeros(side.num_rows, bool)
        last[linked] = True
        documents, ends = side["document"].to_numpy(), side["end"].to_numpy()
        if len(last):
            last[:-1] &= (np.diff(documents) != 0) | (np.diff(ends) != 0)
        return last

    def _digests(self, sides: list[pa.Table], last: list[np.ndarray], sizes: np.ndarray) -> list[str]:
        """Hashes of the groups written out, '' for a document without tokens; all are written by one take."""
        group = [np.cumsum(own) - own for own in last]  # the group of each token
        ends = [np.flatnonzero(own) for own in last]
        # a token stands behind all tokens of its side before it, and those of the other side that belong before it
        a_place = np.arange(len(last[0])) + np.concatenate([[0], ends[1] + 1])[group[0]]
        b_place = np.arange(len(last[1])) + (ends[0] + 1)[group[1]] if len(last[1]) else np.empty(0, np.int64)
        codes = np.empty(len(last[0]) + len(last[1]), np.int64)
        first = 0
        for side, own, place, written in zip(sides, last, (a_place, b_place), self.written):
            codes[place] = first + side["id"].to_numpy() + own * (len(written) // 2)
            first += len(written)
        text = pc.take(self.all_written, pa.array(codes))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset :]
        octets = memoryview(text.buffers()[2] or b"")
        borders = offsets[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        # without the semicolon behind a document's last group
        return [hashlib.sha256(octets[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(borders, borders[1:])]


def pairs_of(links: pa.BinaryArray) -> pa.ListArray:
    """The linked pairs of each row; the bytes are taken as they lie."""
    offsets = np.frombuffer(links.buffers()[1], np.int32)[links.offset : links.offset + len(links) + 1] // 8
    first = int(offsets[0])
    values = pa.Array.from_buffers(pa.int64(), int(offsets[-1]) - first, [None, links.buffers()[2]], offset=first)
    return pa.ListArray.from_arrays(pa.array(offsets - first), values)


def _without_nulls(lists: pa.ListArray) -> pa.ListArray:
    """The lists with empty ones for null ones, values and offsets beginning at zero."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pc.list_flatten(lists))


def read_model(path: str) -> bytes:
    """The file's bytes; executors get them with the task and need no file of their own."""
    with open(path, "rb") as file:
        return file.read()


ALIGNED_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def aligned(documents: DataFrame, vocabulary_path: str, model_path: str) -> DataFrame:
    """doc_id, numbers of tokens, groups and links, the groups' hash, and the linked pairs of each whole text.

    A pair is a number: the first id times the number of the second vocabulary's ids, plus the second id. A text's pairs
    are kept as the bytes of these numbers, of 64 bits each.
    """
    sent = documents.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary_path), read_model(model_path)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = sent.value
        key = ("aligner", hash(vocabulary), hash(model))
        aligner = remembered_by_worker(key, lambda: Aligner(vocabulary, model))
        for batch in slices(batches, texts=1, piece_bytes=PIECE_BYTES):
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                found = aligner.align([text or "" for text in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), *found.columns], ["doc_id", *found.schema.names])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, ALIGNED_SCHEMA)


def pair_counts(found: DataFrame, width: int) -> DataFrame:
    """pair, n and best: how many links hold each pair, and whether no pair of its second id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def added() -> pa.Table:
            return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            own = pa.table({"pair": pc.list_flatten(pairs_of(batch.column(0)))})
            counted = own.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            parts.append(counted.rename_columns(["pair", "n"]))
            if len(parts) == 16:
                parts = [added()]
        if parts:
            yield from added().to_batches()

    counted = found.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = counted.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("most"))
    return counted.join(most, F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(found: DataFrame, counts: pa.Table) -> DataFrame:
    """``found`` with n_best and count_sum in place of the links. ``counts`` is bounded by the vocabularies."""
    order = np.argsort(counts["pair"].to_numpy())
    sent = found.sparkSession.sparkContext.broadcast(
        tuple(counts[name].to_numpy(zero_copy_only=False)[order] for name in ("pair", "n", "best"))
    )
    kept = ALIGNED_SCHEMA.removesuffix(", links binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        for batch in slices(batches, 2048):
            links = pairs_of(batch.column("links"))
            documents = pc.list_parent_indices(links).to_numpy()
            at = np.searchsorted(pairs, pc.list_flatten(links).to_numpy())
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            borders = np.flatnonzero(np.diff(documents, prepend=-1))
            for own, values in zip(sums, (best.astype(np.int64)[at], n[at])):
                if len(borders):
                    own[documents[borders]] = np.add.reduceat(values, borders)
            plain = batch.select(batch.schema.names[:-1])
            yield pa.RecordBatch.from_arrays([*plain.columns, *map(pa.array, sums)], [*plain.schema.names, "n_best", "count_sum"])

    return found.mapInArrow(work, f"{kept}, n_best long, count_sum long")


def vocabulary_width(model_path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()


def align_documents(documents: DataFrame, vocabulary_path: str, model_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each whole text.

    A text that is null, empty, or that either tokenizer does not give back byte for byte has no tokens: zeros and ''. Rows
    are taken as they are: repeated rows count each time, null ids stay, further columns are left out.
    """
    spark: SparkSession = documents.sparkSession
    with scratch(spark, "token-links") as place:
        found = place.keep(aligned(documents, vocabulary_path, model_path), "aligned")
        counts = pair_counts(found, vocabulary_width(model_path)).toArrow()
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return cut(scored(found, counts).select(*columns))
