"""Ranked lexical search by Block-Max MaxScore over the shards of an inverted index.

An index shard holds some thousand documents: per term a list of (document, occurrences), cut into blocks of 128
postings that are packed as variable-length differences. Each block keeps its last document, its most occurrences and its
shortest document outside the packed bytes, which together bound what any of its postings can score.

A query's lists are ordered by their bounds. Lists whose bounds add up to less than the score to beat are not essential:
a document in those alone can't get in. The essential lists are unpacked whole and give the candidates. On each of the other
lists, the largest bound first, a candidate is first held against the bound of the one block that could hold it;
only blocks in which some candidate may still get in are unpacked. The shards' best are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import Scratch, batches_of, cut, scratch, slices

BEST = 10
BLOCK = 128  # postings
SHARD_DOCUMENTS, SHARD_POSTINGS = 8192, 2_000_000
QUERY_BYTES = 16 << 20  # of item texts in one pass over the documents; their terms are all that is sent out
FIRST_SHARDS = 2  # searched ahead, for a score to beat in all others
# Fixed values of the score: one part in a hundred of a document's weight is length-free, B of it goes by length.
B, SCALE, ONE, PER_LENGTH = 90, 1_000_000_000, 1000, 8

# Every byte that is no ASCII letter or digit and below 0x80 parts terms; A-Z are lower-cased.
TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)

SHARD_SCHEMA = (
    "n_docs long, n_terms long, ids binary, named binary, sizes binary, terms binary, counts binary, "
    "last binary, most binary, least binary, places binary, packed binary"
)
FOUND_SCHEMA = "item int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """All terms of a whole text in order, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split()


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from zero as bytes of seven bits, the lowest first, all but the last marked; and each one's length."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >> np.uint64(bits) != 0
    starts = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(starts, size)
    octets = (np.repeat(values, size) >> (7 * place).astype(np.uint64)) & np.uint64(127)
    octets |= np.where(place < np.repeat(size, size) - 1, np.uint64(128), np.uint64(0))
    return octets.astype(np.uint8), size


def from_varints(octets: np.ndarray) -> np.ndarray:
    ends = octets < 128
    starts = np.flatnonzero(np.concatenate([[True], ends[:-1]]))
    place = np.arange(len(octets)) - np.repeat(starts, np.diff(np.append(starts, len(octets))))
    return np.add.reduceat((octets & 127).astype(np.int64) << (7 * place), starts) if len(octets) else np.empty(0, np.int64)


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of these half-open ranges, one range after the other."""
    sizes = ends - starts
    total = np.cumsum(sizes)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)


class ShardWriter:
    """Collects documents until a shard is full."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary, self.width = vocabulary, max(1, len(vocabulary))
        self.clear()

    def clear(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.postings = 0

    def add(self, doc_ids: list[int | None], texts: list[str | None]) -> None:
        look, numbers, owners, lengths = self.vocabulary.get, [], [], []
        for doc_id, text in zip(doc_ids, texts):
            words = terms_of(text) if text else ()
            if not words:
                continue
            known = [number for number in map(look, words) if number is not None]
            numbers += known
            lengths.append(len(known))
            owners.append(len(self.ids))
            self.ids.append(doc_id)
            self.sizes.append(len(words))
        keys = np.repeat(np.array(owners, np.int64), lengths) * self.width + np.array(numbers, np.int64)
        distinct, counts = np.unique(keys, return_counts=True)
        self.keys.append(distinct)
        self.counts.append(counts)
        self.postings += len(distinct)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCUMENTS or self.postings >= SHARD_POSTINGS

    def shard(self) -> pa.RecordBatch:
        keys, occurrences = np.concatenate(self.keys), np.concatenate(self.counts)
        docs, terms = keys // self.width, keys % self.width
        order = np.argsort(terms, kind="stable")  # documents ascend already
        docs, terms, occurrences = docs[order], terms[order], occurrences[order]
        sizes = np.array(self.sizes, np.int64)
        own, starts, counts = np.unique(terms, return_index=True, return_counts=True)
        firsts = ranges_by(starts, counts, BLOCK)  # of blocks
        before = np.concatenate([[-1], docs[:-1]])
        before[starts] = -1
        octets, lengths = varints(np.stack([docs - before - 1, occurrences - 1], axis=1).ravel())
        ends = np.concatenate([[0], np.cumsum(lengths.reshape(-1, 2).sum(axis=1))])
        lasts = np.append(firsts[1:], len(docs)) - 1
        named = np.array([doc_id is not None for doc_id in self.ids], np.uint8)
        row = {
            "n_docs": len(self.ids),
            "n_terms": int(sizes.sum()),
            "ids": np.array([doc_id or 0 for doc_id in self.ids], np.int64),
            "named": named,
            "sizes": sizes,
            "terms": own.astype(np.int32),
            "counts": counts.astype(np.int32),
            "last": docs[lasts].astype(np.int32) if len(docs) else np.empty(0, np.int32),
            "most": (np.maximum.reduceat(occurrences, firsts) if len(docs) else occurrences).astype(np.int64),
            "least": np.minimum.reduceat(sizes[docs], firsts) if len(docs) else np.empty(0, np.int64),
            "places": ends[np.append(firsts, len(docs))].astype(np.int64),
            "packed": octets,
        }
        self.clear()
        return pa.RecordBatch.from_pylist(
            [{name: value.tobytes() if isinstance(value, np.ndarray) else value for name, value in row.items()}],
            pa.schema([(n, pa.int64() if n in ("n_docs", "n_terms") else pa.binary()) for n in row]),
        )


def ranges_by(starts: np.ndarray, counts: np.ndarray, step: int) -> np.ndarray:
    """The first of every ``step`` places in each run."""
    blocks = -(-counts // step)
    return np.repeat(starts, blocks) + step * ranges(np.zeros(len(blocks), np.int64), blocks)


@dataclass
class Statistics:
    """What a score takes from the whole corpus: documents with terms, all their terms, the weight of each query term."""

    documents: int
    terms: int
    weights: np.ndarray

    def impact(self, weights: np.ndarray, occurrences: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        long = 100 - B + (B * sizes * self.documents) // self.terms
        return weights * ((SCALE * occurrences) // (ONE * occurrences + PER_LENGTH * long))


class Shard:
    """One shard with the bounds of its blocks and lists."""

    def __init__(self, row: dict, statistics: Statistics):
        def array(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(row[name], kind)

        self.statistics = statistics
        self.ids, self.named, self.sizes = array("ids", np.int64), array("named", np.uint8), array("sizes", np.int64)
        self.terms, self.counts = array("terms", np.int32), array("counts", np.int32).astype(np.int64)
        self.last, self.places = array("last", np.int32).astype(np.int64), array("places", np.int64)
        self.packed = array("packed", np.uint8)
        blocks = -(-self.counts // BLOCK)
        self.block_at = np.concatenate([[0], np.cumsum(blocks)])  # of each list
        self.block_list = np.repeat(np.arange(len(self.terms)), blocks)
        weights = statistics.weights[self.terms][self.block_list]
        self.block_bounds = statistics.impact(weights, array("most", np.int64), array("least", np.int64))
        self.bounds = np.maximum.reduceat(self.block_bounds, self.block_at[:-1]) if len(self.terms) else np.empty(0, np.int64)

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of these blocks, and what each adds to a document's score."""
        lists = self.block_list[blocks]
        numbers = from_varints(self.packed[ranges(self.places[blocks], self.places[blocks + 1])]).reshape(-1, 2)
        left = self.counts[lists] - BLOCK * (blocks - self.block_at[lists])
        sizes = np.minimum(left, BLOCK)
        before = np.where(blocks > self.block_at[lists], self.last[blocks - 1], -1)
        steps = np.cumsum(numbers[:, 0] + 1)
        first = np.cumsum(sizes) - sizes
        base = np.concatenate([[0], steps])[first]
        docs = steps + np.repeat(before - base, sizes)
        weights = self.statistics.weights[self.terms[np.repeat(lists, sizes)]]
        return docs, self.statistics.impact(weights, numbers[:, 1] + 1, self.sizes[docs])

    def search(self, terms: np.ndarray, floor: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places) that may be among the ``best``, and their whole scores, none below ``floor`` or 1."""
        at = np.searchsorted(self.terms, terms)
        lists = at[self.terms[np.minimum(at, len(self.terms) - 1)] == terms] if len(self.terms) else at[:0]
        lists = lists[np.argsort(self.bounds[lists], kind="stable")]
        upto = np.cumsum(self.bounds[lists])  # bound of a document in these lists alone, up to each
        beat = max(floor, 1)
        essential = int(np.searchsorted(upto, beat))
        if essential == len(lists):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, added = self.unpack(ranges(self.block_at[lists[essential:]], self.block_at[lists[essential:] + 1]))
        scores = np.zeros(len(self.ids), np.int64)
        np.add.at(scores, docs, added)
        found = np.flatnonzero(scores)
        scores = scores[found]
        for at in range(essential - 1, -1, -1):
            rest = int(upto[at - 1]) if at else 0
            if len(scores) >= best:  # so many have this much already
                beat = max(beat, int(np.partition(scores, len(scores) - best)[len(scores) - best]))
            alive = scores + int(upto[at]) >= beat
            found, scores = found[alive], scores[alive]
            if not len(found):
                return found, scores
            first, end = self.block_at[lists[at]], self.block_at[lists[at] + 1]
            blocks = first + np.searchsorted(self.last[first:end], found)
            inside = blocks < end
            reach = np.where(inside, self.block_bounds[np.minimum(blocks, end - 1)], 0)
            alive = scores + reach + rest >= beat
            found, scores, blocks, inside = found[alive], scores[alive], blocks[alive], inside[alive]
            needed = np.unique(blocks[inside])
            if len(needed):
                docs, added = self.unpack(needed)
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[place] == found, added[place], 0)
        alive = scores >= beat
        return found[alive], scores[alive]


def index_documents(documents: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Shards of an index over ``doc_id`` and ``text``, of the terms of a vocabulary alone."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardWriter(vocabulary.value)
        for batch in slices(batches, texts=1):
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                shard.add(part.column(0).to_pylist(), part.column(1).to_pylist())
                if shard.full():
                    yield shard.shard()
        if shard.ids:
            yield shard.shard()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(write, SHARD_SCHEMA)


def statistics_of(shards: DataFrame, terms: int) -> Statistics:
    """Counts over all shards; at most one number for each term of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            for own, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[np.frombuffer(own, np.int32)] += np.frombuffer(counts, np.int32)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some])], ["term", "holders"])

    whole = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    documents, all_terms = whole[0] or 0, whole[1] or 0
    held = shards.select("terms", "counts").mapInArrow(count, "term int, holders long").groupBy("term").agg(F.sum("holders").alias("holders"))
    weights = np.zeros(terms, np.int64)
    for batch in held.toArrow().to_batches():
        for term, holders in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))
    return Statistics(documents, all_terms, weights)


def search_shards(shards: DataFrame, queries: Broadcast, best: int) -> DataFrame:
    """item, doc_id and score of the best of each task's shards.

    ``queries`` holds the statistics, the terms of each item and the score to beat that is known so far.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics, items, floors = queries.value
        heaps: list[list[tuple[int, bool, int]]] = [[] for _ in items]  # negative score, without an id, id
        floors = floors.copy()
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, statistics)
                for at, terms in enumerate(items):
                    docs, scores = shard.search(terms, int(floors[at]), best)
                    if not len(docs):
                        continue
                    own = zip((-scores).tolist(), (shard.named[docs] == 0).tolist(), shard.ids[docs].tolist())
                    heaps[at] = sorted([*heaps[at], *own])[:best]
                    if len(heaps[at]) == best:
                        floors[at] = max(int(floors[at]), -heaps[at][-1][0])
        rows = [(at, None if unnamed else doc_id, -score) for at, heap in enumerate(heaps) for score, unnamed, doc_id in heap]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc_id", "score"])

    return shards.mapInArrow(search, FOUND_SCHEMA)


def merged(found: DataFrame, best: int) -> DataFrame:
    """The best of each item, with ranks; equal scores go by doc_id, those without one last."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def _pass(documents: DataFrame, texts: list[str], place: Scratch, label: str, best: int) -> DataFrame:
    """The best documents of these texts, by their number."""
    spark = documents.sparkSession
    vocabulary: dict[bytes, int] = {}
    items = []
    for text in texts:
        own = {vocabulary.setdefault(term, len(vocabulary)) for term in terms_of(text)}
        items.append(np.array(sorted(own), np.int64))
    sent = spark.sparkContext.broadcast(vocabulary)
    shards = place.keep(index_documents(documents, sent), f"shards-{label}")
    with batches_of(spark, 4):
        statistics = statistics_of(shards, len(vocabulary))
        items = [own[statistics.weights[own] > 0] for own in items]
        floors = np.zeros(len(items), np.int64)
        ahead = search_shards(shards.limit(FIRST_SHARDS), spark.sparkContext.broadcast((statistics, items, floors)), best)
        for row in merged(ahead, best).filter(F.col("rank") == best).toLocalIterator():
            floors[row["item"]] = row["score"]
        found = search_shards(shards, spark.sparkContext.broadcast((statistics, items, floors)), best)
        return place.keep(merged(found, best), f"found-{label}")


def rank_documents(documents: DataFrame, items: DataFrame, best: int = BEST, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of each item.

    Items go in passes of about ``query_bytes`` of text, whose terms are sent to the tasks: one pass for 16 MB of items, and
    the documents are read once in each. Each pass indexes all documents and searches all shards.

    Null and empty texts have no terms: such items get no rows, such documents count nowhere. Rows are taken as they are: an
    item given twice is ranked twice, a document given twice takes two ranks, and documents without an id come after
    equal scores with one. Further columns are left out.
    """
    spark = documents.sparkSession
    narrow = items.select("item_id", "text").filter("text is not null")
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = size // query_bytes + 1
    narrow = narrow.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    with scratch(spark, "lexical") as place:
        parts = []
        for at in range(passes):
            own = narrow.filter(F.col("pass") == at).select("item_id", "text").toArrow()  # one pass's texts
            found = _pass(documents, own["text"].to_pylist(), place, str(at), best)
            names = spark.createDataFrame(
                pa.table({"item": pa.array(range(own.num_rows), pa.int32()), "item_id": own["item_id"]})
            )
            parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return cut(every)
