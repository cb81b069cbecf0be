"""Best-fit packing of token sequences, in rounds over a tree of partitions.

The pieces are dealt evenly, whatever order they are stored in, so that each task sees the whole mix of lengths. It packs its own
best-fit decreasing. Bins that are nearly full are final; the others are opened again, and their pieces are the items of the next
round, in which a task takes in those of several. Texts never travel.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowgauge.llm.common import WHITE_SPACE, batches_of, cut, remembered_by_worker, scratch, slices
from flowgauge.llm.trie_bpe import REMEMBERED, MergeTable, ended, read_vocabulary, remembered

CAPACITY = 4096
END_ID = 1
WORD = re.compile(rf"[^{WHITE_SPACE}]+")
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]?)")

SLACK = 16  # a bin with no more room than this is nearly full
TASK_PIECES = 200_000  # that a task packs; more are dealt to more tasks
TEXTS = 2000  # whole texts in an Arrow batch

PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED_DDL = f"{PIECE_DDL}, sequence_id long, offset long, final boolean"


class WordTokens:
    """Ids of words, remembered. The tokenizer drops white space, so a text's ids are those of its words.

    Plain words of Latin-1 letters, with a full stop or comma or none, need no more normalising than lower case;
    they go through the trie of the vocabulary's merges. All others go through the tokenizer itself.
    """

    def __init__(self, text: str, limit: int = REMEMBERED):
        self.tokenizer, self.table, self.limit = Tokenizer.from_str(text), MergeTable(text), limit
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, bytes] = {}

    def _by_tokenizer(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def learn(self, needed: set[str]) -> dict[str, bytes]:
        fresh = needed - self.known.keys()
        ids: dict[str, bytes] = {}
        plain: dict[str, tuple[str, ...]] = {}
        for word in fresh:
            if word.isalpha() and word.isascii():
                plain[word] = (ended(word.lower()),)
                continue
            found = PLAIN.fullmatch(word)
            if found is None:
                ids[word] = self._by_tokenizer(word)
                continue
            letters = ended(found[1].lower().encode().decode("latin-1"))
            plain[word] = (letters, ended(found[2])) if found[2] else (letters,)
        encoded = self.table.encode_words({piece for own in plain.values() for piece in own})
        for word, own in plain.items():
            ids[word] = encoded[own[0]] if len(own) == 1 else encoded[own[0]] + encoded[own[1]]
        return remembered(self.known, ids, needed, self.limit)

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        worded = [WORD.findall(text) for text in texts]
        look = self.learn(set().union(*worded)).__getitem__
        return [b"".join(map(look, words)) for words in worded]


def word_tokens(text: str, remember: int) -> WordTokens:
    return remembered_by_worker(("words", text), lambda: WordTokens(text, remember))


class Item(NamedTuple):
    used: int
    members: list


def pieces_of(doc_id: int | None, ids: bytes, capacity: int) -> Iterator[Item]:
    """A document's pieces: doc_id, piece, start, length and the ids' checksum of each as the member."""
    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
        own = ids[at : at + 4 * capacity]
        length = len(own) // 4
        yield Item(length, [(doc_id, piece, at // 4, length, zlib.crc32(own))])


def best_fit(items: Iterable[Item], capacity: int) -> list[Item]:
    """Best-fit decreasing: each item goes to the open bin with the least room that takes it."""
    bins: list[tuple[int, list[Item]]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin with room r is open
    for item in sorted(items, key=lambda item: -item.used):
        above = rooms >> item.used
        if above:
            room = item.used + (above & -above).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at][1].append(item)
            room -= item.used
        else:
            at, room = len(bins), capacity - item.used
            bins.append((at, [item]))
        if room:
            by_room.setdefault(room, []).append(at)
            rooms |= 1 << room
    return [Item(sum(i.used for i in own), [m for i in own for m in i.members]) for _, own in bins]


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    named = [column.split() for column in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(own, kinds[kind]) for own, (_, kind) in zip(columns, named)], [name for name, _ in named])


def _packed(batches: Iterator[pa.RecordBatch], level: int, capacity: int, last: bool) -> Iterator[pa.RecordBatch]:
    """All pieces of a task with their places; bins are numbered by round, task and place."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    lengths = whole["length"].to_pylist()
    bins = best_fit([Item(length, [at]) for at, length in enumerate(lengths)], capacity)
    base = (level << 58) + (TaskContext.get().partitionId() << 34)
    order, numbers, offsets, final = [], [], [], []
    for number, own in enumerate(bins, base):
        full, offset = last or own.used >= capacity - SLACK, 0
        for at in own.members:
            order.append(at)
            numbers.append(number)
            offsets.append(offset)
            final.append(full)
            offset += lengths[at]
    placed = whole.take(pa.array(order, pa.int64()))
    for name, values in (("sequence_id", pa.array(numbers, pa.int64())), ("offset", pa.array(offsets, pa.int64())), ("final", pa.array(final))):
        placed = placed.append_column(name, values)
    yield from placed.to_batches(max_chunksize=10_000)


def pack_documents(
    documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, remember: int = REMEMBERED, task_pieces: int = TASK_PIECES
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset they are packed at.

    A document is its ids and then ``END_ID``; only documents longer than the capacity are cut. A null text is
    an empty one and takes one place. Repeated rows and null ids are packed as documents of their own.
    A worker remembers the ids of ``remember`` words; fewer take more time and less memory, with the same result.

    A task packs about ``task_pieces``. Rounds go on until one task takes all that is left, or until a round finds room for
    less than an eighth of its pieces: another deal of what is left would have the same lengths in every task.
    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.
    """
    spark = documents.sparkSession
    text = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    end = END_ID.to_bytes(4, "little")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(text.value, remember)
        for batch in slices(batches, texts=1):
            ids = words.encode_texts([value or "" for value in batch.column(1).to_pylist()])
            found = (pieces_of(doc_id, own + end, capacity) for doc_id, own in zip(batch.column(0).to_pylist(), ids))
            yield _table([item.members[0] for own in found for item in own], PIECE_DDL)

    with scratch(spark, "packing") as place:
        narrow = documents.select(F.col("doc_id").cast("long"), "text")
        with batches_of(spark, TEXTS):
            left = place.keep(narrow.mapInArrow(tokenise, PIECE_DDL), "pieces")
        done, count, level = left.limit(0).selectExpr("*", "0L AS sequence_id", "0L AS offset"), left.count(), 0
        while count:
            tasks = -(-count // task_pieces)
            dealt = left.repartition(tasks)
            pack = functools.partial(_packed, level=level, capacity=capacity, last=tasks == 1)
            packed = place.keep(dealt.mapInArrow(pack, PLACED_DDL), f"round-{level}")
            rest = packed.filter("not final")
            before, count, level = count, rest.count(), level + 1
            if 8 * count > 7 * before:
                done, count = done.unionByName(rest.drop("final")), 0
            done = done.unionByName(packed.filter("final").drop("final"))
            left = rest.drop("final", "sequence_id", "offset")
        return cut(done)
