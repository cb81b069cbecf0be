"""Passages that repeat across documents, found by chaining shared seeds.

Seeds are runs of four words, thinned to the smaller hash of every two in a row, as passages with one word in five
changed hold no longer ones, and longer runs, thinned so far that every run of fifty words holds one of each length: these
tell a verbatim passage from its parts. Each occurrence of a seed is matched with the seed's first occurrence and with
the document before its own that holds it (two stars, not all pairs): where a passage's short seeds stand in documents before its
source, the second leads to the source. The matches of two documents are chained in order, with a cost for gaps, by dynamic
programming over a Fenwick tree. The stretches of text around a chain are aligned word by word along it, and the
parts that agree in four words of five over fifty words or more are the repeated passages.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import Scratch, batches_of, cut, give_back, mixed, scratch, shingle_hashes, slices, unused_name, word_hashes

SEED_WORDS = 4
SEEDS = {SEED_WORDS: 2, 24: 27, 44: 7}  # words of a run: runs in a row of which the smallest hash is a seed
HASH_BITS = 56  # of a seed
LEAST_WORDS = 50
LIKENESS = 0.8
WEIGHT = 48.0  # of a match in the score of a chain
STEP = 100  # characters in which a run of one diagonal keeps a match
GAP_COST = 0.1  # per character skipped in either text
LONGEST_GAP = 400  # characters between two seeds of a chain
APART = 25  # characters between seeds that do not belong to one short phrase
MARGIN = 800  # characters of text aligned beyond the ends of a chain
SAMPLE_ROWS = 4000  # documents, in expectation, in which common seeds are looked for
COMMON = 20  # of these, a seed in so many has its occurrences dealt over SALTS tasks
SALTS = 64
PACKED_BYTES = 4 << 20  # of text whose seeds are packed at once
PART_BYTES = 8 << 20  # of text, in expectation, whose seeds a part holds at most
MATCH_ROWS = 100_000  # matches that go on at once
ALIGNED_CHARS = 1 << 20  # around chains that are aligned at once
TEXTS = 1000  # in an Arrow batch

# What str.split() takes for white space.
BLANK = np.zeros(0x3002, bool)
BLANK[[*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


def blanks(text: str) -> np.ndarray:
    """Which code points are white space to ``text.split()``."""
    return BLANK[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 0x3001)]


def word_starts(text: str) -> np.ndarray:
    """Code points at which the words of ``text.split()`` begin."""
    blank = blanks(text)
    return np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))


def smallest_in_windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the hashes that are the smallest of a window of so many in a row; of fewer hashes, the smallest."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min())
    least, wide = hashes, 1  # smallest of ``wide`` hashes from each place on
    while wide < window:
        step = min(wide, window - wide)
        least, wide = np.minimum(least[:-step], least[step:]), wide + step
    none = np.zeros(window - 1, least.dtype)
    most, wide = np.concatenate([none, least, none]), 1  # the largest of these over the windows that hold a place
    while wide < window:
        step = min(wide, window - wide)
        most, wide = np.maximum(most[:-step], most[step:]), wide + step
    return np.flatnonzero(most == hashes)


def seeds_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places (of the middle word) of a text's seeds of all lengths; the last bit of a hash tells long runs."""
    words = word_hashes().of(text.lower().split())
    if len(words) < SEED_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    starts = word_starts(text).astype(np.int32)
    short = shingle_hashes(words, SEED_WORDS)
    found, places = [], []
    for size, window in SEEDS.items():
        if len(words) < size:
            break
        hashes = short
        if size > SEED_WORDS:  # a long run is a run of short ones end to end
            count = len(words) - size + 1
            hashes = np.full(count, size, np.uint64)
            for at in range(0, size, SEED_WORDS):
                hashes = (hashes ^ short[at : at + count]) * np.uint64(0x9FB21C651E98DF25)
                hashes ^= hashes >> np.uint64(31)
            hashes = mixed(hashes)
        chosen = smallest_in_windows(hashes, window)
        kept = hashes[chosen] >> np.uint64(65 - HASH_BITS) << np.uint64(1)
        found.append(kept | np.uint64(size > SEED_WORDS))
        places.append(starts[chosen + size // 2])  # the text beyond the ends of a chain then holds the run
    return np.concatenate(found).view(np.int64), np.concatenate(places)


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns whose first one ascends as bytes: planes of the steps of the first and of the values of the others."""
    planes = b"".join(
        own.view(np.uint8).reshape(len(own), -1).T.tobytes() for own in (np.diff(columns[0], prepend=0), *map(np.ascontiguousarray, columns[1:]))
    )
    return struct.pack("<q", len(columns[0])) + zstandard.compress(planes, 1)


def unpack(data: bytes, kinds: list[type]) -> list[np.ndarray]:
    """Columns of ``pack``, of these kinds."""
    (count,) = struct.unpack_from("<q", data)
    planes = np.frombuffer(zstandard.decompress(data[8:]), np.uint8).reshape(-1, count)
    columns, low = [], 0
    for kind in kinds:
        high = low + np.dtype(kind).itemsize
        columns.append(np.ascontiguousarray(planes[low:high].T).view(kind).ravel())
        low = high
    return [np.cumsum(columns[0], dtype=kinds[0]), *columns[1:]]


def packed(hashes: np.ndarray, salts: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> bytes:
    """Seeds in ascending order of their hashes as bytes."""
    order = np.argsort(hashes, kind="stable")
    least = int(ids.min())
    return struct.pack("<q", least) + pack([hashes[order], (ids[order] - least).astype(np.int64), starts[order], salts[order].astype(np.int8)])


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, salts, ids and starts of ``packed`` seeds."""
    (least,) = struct.unpack_from("<q", data)
    hashes, ids, starts, salts = unpack(data[8:], [np.int64, np.int64, np.int32, np.int8])
    return hashes, salts.astype(np.int32), ids + least, starts


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers in ``part`` and the places of each."""
    order = np.argsort(part, kind="stable")
    numbers, lows = np.unique(part[order], return_index=True)
    for number, low, high in zip(numbers.tolist(), lows, [*lows[1:], len(order)]):
        yield number, order[low:high]


def part_rows(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    numbers, data = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])


def of_parts(batches: Iterator[pa.RecordBatch], read: Callable) -> Iterator[list[np.ndarray]]:
    """All columns of one part after the other, from rows of parts and packed columns that are sorted by part."""
    held, current = [], None
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if held and number != current:
                yield [np.concatenate(columns) for columns in zip(*held)]
                held = []
            current = number
            held.append(read(data.as_py()))
    if held:
        yield [np.concatenate(columns) for columns in zip(*held)]


def _seeds(texts: DataFrame, common: np.ndarray, borders: np.ndarray, parts: int) -> DataFrame:
    """part and packed seeds; a hash lies in one of ``parts`` parts, a common one in several by the salt of its document.

    Salts count the ranges of doc_id between ``borders`` from 1, so the documents of one salt come before those of the next.
    """
    sent = texts.sparkSession.sparkContext.broadcast((common, borders))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined(batches):
            found = [seeds_of(text) for text in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(), [len(hashes) for hashes, _ in found])
            hashes = np.concatenate([hashes for hashes, _ in found])
            starts = np.concatenate([starts for _, starts in found])
            common, borders = sent.value
            salts = np.where(np.isin(hashes, common), np.searchsorted(borders, ids, side="right") + 1, 0).astype(np.int32)
            part = (mixed(hashes.view(np.uint64) + salts.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
            rows = [(number, packed(hashes[at], salts[at], ids[at], starts[at])) for number, at in by_part(part)]
            if rows:
                yield part_rows(rows)
        give_back()

    return texts.mapInArrow(find, "part int, data binary")


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together, so that as many seeds are packed at once as PACKED_BYTES of text hold."""
    waiting, size = [], 0
    for batch in slices(batches, texts=1, piece_bytes=PACKED_BYTES):
        waiting.append(batch)
        size += batch.nbytes
        if size >= PACKED_BYTES:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def joined_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together, so that each but the last has so many rows or more."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if size:
        yield pa.concat_batches(waiting)


def _common_seeds(texts: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that many documents of a bounded sample hold, and borders of SALTS ranges of doc_id that hold like shares of it.

    The sample decides only how the occurrences of these hashes are dealt out, not what they are matched with.
    """
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    nothing = np.empty(0, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _, ids, _ in of_parts(batches, unpacked):
            order = np.lexsort((ids, hashes))
            hashes, ids = hashes[order], ids[order]
            fresh = np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(ids) != 0)])
            found, counts = np.unique(hashes[fresh], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found[counts >= COMMON])], ["hash"])

    seeds = _seeds(sample, nothing, nothing, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    common = np.sort(seeds.repartition("part").sortWithinPartitions("part").mapInArrow(count, "hash long").toArrow()["hash"].to_numpy())
    ids = np.sort(sample.select("doc_id").distinct().toArrow()["doc_id"].to_numpy())
    return common, np.unique(ids[np.arange(1, SALTS) * len(ids) // SALTS]) if len(ids) else nothing


def _in_parts(seeds: DataFrame) -> DataFrame:
    """Rows of hash, salt, doc_id and start as part and packed seeds."""
    parts = int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                hashes, salts, ids, starts = (batch.column(at).to_numpy() for at in range(4))
                part = mixed(hashes.view(np.uint64) + salts.astype(np.uint64)) % np.uint64(parts)
                yield part_rows([(number, packed(hashes[at], salts[at], ids[at], starts[at])) for number, at in by_part(part)])

    return seeds.select("hash", "salt", "doc_id", "start").mapInArrow(put, "part int, data binary")


def _within_salts(seeds: DataFrame) -> DataFrame:
    """Each occurrence of an unsalted seed with the first one of its hash, and with the last one of the document before.

    Each occurrence of a salted seed stands in one row, with the last one of the document before in its salt; ``source`` is null in
    the salt's first document.
    """

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, salts, ids, starts in of_parts(batches, unpacked):
            order = np.argsort(hashes, kind="stable")
            same = np.diff(hashes[order]) == 0
            order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (salts[order] > 0)]
            order = order[np.lexsort((starts[order], ids[order], salts[order], hashes[order]))]
            if not len(order):
                continue
            hashes, salts, ids, starts = (column[order] for column in (hashes, salts, ids, starts))
            rows = np.arange(len(ids))
            new = np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(salts) != 0)])
            first = np.maximum.accumulate(np.where(new, rows, 0))
            opens = np.maximum.accumulate(np.where(new | np.concatenate([[True], np.diff(ids) != 0]), rows, 0))
            before = np.where(opens > first, opens - 1, first)
            alone = salts == 0
            salted = np.flatnonzero(~alone)
            later = np.flatnonzero((ids[first] != ids) & alone)
            other = np.flatnonzero((ids[before] != ids) & (ids[before] != ids[first]) & alone)
            own = np.concatenate([salted, later, other])
            source = np.concatenate([before[salted], first[later], before[other]])
            for low in range(0, len(own), MATCH_ROWS):
                at, to = own[low : low + MATCH_ROWS], source[low : low + MATCH_ROWS]
                none = ids[to] == ids[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes[at]),
                        pa.array(salts[at]),
                        pa.array(ids[at]),
                        pa.array(starts[at]),
                        pa.array(ids[to], mask=none),
                        pa.array(starts[to], mask=none),
                    ],
                    ["hash", "salt", "doc_id", "start", "source_id", "source_start"],
                )
        give_back()

    if "part" not in seeds.columns:
        seeds = _in_parts(seeds)
    dealt = seeds.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(match, "hash long, salt int, doc_id long, start int, source_id long, source_start int")


def _matches(seeds: DataFrame, place: Scratch | None = None) -> DataFrame:
    """Each occurrence of a seed with the first one of its hash, and with the last one of the document before.

    Salted seeds are matched within their salts first. Each salt's first and last occurrence then tell the others the first
    one of the hash, and the salt's first document the last one of the salt before.
    """
    matched = _within_salts(seeds)
    if place is not None:
        matched = place.keep(matched, "matches")
    salted = matched.filter("salt > 0")
    occurrence = F.struct("doc_id", "start")
    ends = salted.groupBy("hash", "salt").agg(F.min(occurrence).alias("first"), F.max(occurrence).alias("last"))
    of_hash = Window.partitionBy("hash").orderBy("salt")  # a row for each salt
    ends = ends.select("hash", "salt", F.first("first").over(of_hash).alias("first"), F.lag("last").over(of_hash).alias("passed_on"))
    own = F.struct(F.col("source_id").alias("doc_id"), F.col("source_start").alias("start"))
    before = F.when(F.col("source_id").isNotNull(), own).otherwise(F.col("passed_on"))
    sources = F.array(
        F.when(F.col("first.doc_id") != F.col("doc_id"), F.col("first")),
        F.when(F.col("before.doc_id") != F.col("first.doc_id"), F.col("before")),
    )
    joined = salted.join(ends, ["hash", "salt"]).withColumn("before", before)
    found = joined.select("hash", "doc_id", "start", F.explode(F.array_compact(sources)).alias("source"))
    across = found.select("hash", "doc_id", "start", F.col("source.doc_id").alias("source_id"), F.col("source.start").alias("source_start"))
    return matched.filter("salt = 0").drop("salt").unionByName(across)


def chain(x: np.ndarray, y: np.ndarray, weight: float, least: int = 2) -> list[np.ndarray]:
    """Chains of ``least`` matches or more that ascend in both texts, best first, as places in ``x`` and ``y`` sorted by x.

    A chain's score is the weight of its matches less the cost of the gaps between them. As the cost is linear, the best
    match to go on from is a maximum over a range of ``y``, kept in a Fenwick tree. Matches that lie more than
    ``LONGEST_GAP`` behind in ``x`` are taken out of the tree, and the range begins so far behind in ``y``.
    """
    order = np.lexsort((y, x))
    xs, ys = x[order].tolist(), y[order].tolist()
    size = len(ys)
    by_y = np.argsort(y[order], kind="stable")
    levels = y[order][by_y].tolist()
    rank = np.empty(size, np.int64)
    rank[by_y] = np.arange(1, size + 1)
    places = rank.tolist()  # each match has a leaf of its own
    none = (-np.inf, -1)
    leaves: list[tuple[float, int]] = [none] * (size + 1)
    tree = leaves.copy()
    scores, before = [], []
    entered = left = 0
    for own_x, own_y in zip(xs, ys):
        while xs[entered] < own_x:  # matches of one x do not follow each other
            value = (scores[entered] + GAP_COST * (xs[entered] + ys[entered]), entered)
            node = places[entered]
            leaves[node] = value
            while node <= size:
                if value > tree[node]:
                    tree[node] = value
                node += node & -node
            entered += 1
        while xs[left] < own_x - LONGEST_GAP:
            node = places[left]
            value, leaves[node] = leaves[node], none
            while node <= size and tree[node] == value:
                most, step = leaves[node], 1
                while step < node & -node:
                    most = max(most, tree[node - step])
                    step *= 2
                tree[node] = most
                node += node & -node
            left += 1
        best, node, low = none, bisect_left(levels, own_y), bisect_left(levels, own_y - LONGEST_GAP)
        while node > low:
            below = node - (node & -node)
            if below >= low:
                best, node = max(best, tree[node]), below
            else:
                best, node = max(best, leaves[node]), node - 1
        gained = best[0] - GAP_COST * (own_x + own_y)
        scores.append(weight + max(0.0, gained))
        before.append(best[1] if gained > 0 else -1)
    used, chains = [False] * len(xs), []
    for end in np.argsort(-np.array(scores), kind="stable").tolist():
        path, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            path.append(at)
            at = before[at]
        if len(path) >= least:
            chains.append(order[path[::-1]])
    return chains


def thinned(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matches without those inside a run of one diagonal: its ends stay, and one in every STEP characters.

    Between two matches of one diagonal the texts are compared in step, whatever matches lie between them.
    """
    x, y = x.astype(np.int64), y.astype(np.int64)
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    fresh = np.concatenate([[True], (np.diff(x) != 0) | (np.diff(y) != 0)])
    x, y = x[fresh], y[fresh]
    parted = (np.diff(x - y) != 0) | (np.diff(x) > STEP)
    ends = np.concatenate([[True], parted]) | np.concatenate([parted, [True]])
    kept = ends | np.concatenate([[True], np.diff(x // STEP) != 0])
    return x[kept], y[kept]


def promising(chains: list[np.ndarray], x: np.ndarray, long_x: np.ndarray) -> list[np.ndarray]:
    """The chains that hold a long seed, or seeds apart from each other.

    Four words that two texts share stand alone nearly always; a passage of fifty words has more of them, or a long run.
    """
    long = np.isin(x, long_x)
    return [places for places in chains if x[places[-1]] - x[places[0]] >= APART or long[places].any()]


def stretch(starts: np.ndarray) -> tuple[int, int]:
    """The text around a chain."""
    return max(0, int(starts[0]) - MARGIN), int(starts[-1]) + MARGIN


def _pieces(chains: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Beginnings and lengths of the stretches around chains, those that overlap or touch as one."""
    firsts: list[int] = []
    stops: list[int] = []
    for first, stop in sorted(map(stretch, chains)):
        if stops and first <= stops[-1]:
            stops[-1] = max(stops[-1], stop)
        else:
            firsts.append(first)
            stops.append(stop)
    return firsts, [stop - first for first, stop in zip(firsts, stops)]


PAIR_KINDS = [np.int64, np.int64, np.int32, np.int32, np.int8]


def _chains(matches: DataFrame, parts: int) -> DataFrame:
    """A row for each pair of documents with chains: ``sizes`` of the chains, the starts of their seeds and the pieces of text around them."""
    names = ["sizes", "starts", "source_starts", "firsts", "lengths", "source_firsts", "source_lengths"]
    schema = "doc_id long, source_id long, " + ", ".join(f"{name} array<int>" for name in names)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in joined_rows(batches, MATCH_ROWS):
            ids, sources, starts, source_starts, hashes = (batch.column(at).to_numpy() for at in range(5))
            columns = [ids, sources, starts, source_starts, (hashes & 1).astype(np.int8)]
            part = mixed(mixed(ids.view(np.uint64)) + sources.view(np.uint64)) % np.uint64(parts)
            rows = []
            for number, at in by_part(part):
                at = at[np.argsort(ids[at], kind="stable")]
                rows.append((number, pack([column[at] for column in columns])))
            yield part_rows(rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in of_parts(batches, lambda data: unpack(data, PAIR_KINDS)):
            order = np.lexsort(columns[3::-1])
            ids, sources, starts, source_starts, long = (column[order] for column in columns)
            borders = np.concatenate([[0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(sources) != 0)) + 1])
            ends = np.append(borders[1:], len(ids))
            spread = starts[ends - 1] - starts[borders]
            wanted = np.flatnonzero((spread >= APART) | (np.maximum.reduceat(long, borders) > 0))
            rows: list[tuple] = []
            size = 0
            for low, high in zip(borders[wanted].tolist(), ends[wanted].tolist()):
                x, y = thinned(starts[low:high], source_starts[low:high])
                kept = promising(chain(x, y, WEIGHT, least=1), x, starts[low:high][long[low:high] > 0])
                if not kept:
                    continue
                own, other = ([side[places] for places in kept] for side in (x, y))
                sizes = [len(places) for places in kept]
                rows.append((ids[low], sources[low], sizes, np.concatenate(own), np.concatenate(other), *_pieces(own), *_pieces(other)))
                size += sum(sizes)
                if size >= MATCH_ROWS:
                    yield pair_rows(rows)
                    rows, size = [], 0
            if rows:
                yield pair_rows(rows)
        give_back()

    def pair_rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 2 + [pa.list_(pa.int32())] * len(names)
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "source_id", *names])

    sent = matches.select("doc_id", "source_id", "start", "source_start", "hash").mapInArrow(put, "part int, data binary")
    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(find, schema)


PLACE_BITS = 40  # of a place in a text; the bits above them number the text


class Words:
    """Words of pieces of texts: their hashes, starts and ends, counted from the beginning of each whole text."""

    def __init__(self, texts: list[tuple[list[int], list[str]]]):
        self.firsts = [(at << PLACE_BITS) + first for at, (firsts, _) in enumerate(texts) for first in firsts]
        self.pieces = [piece for _, pieces in texts for piece in pieces]
        starts, ends, hashes = [], [], []
        for first, text in zip(self.firsts, self.pieces):
            blank = np.concatenate([[True], blanks(text), [True]])
            starts.append(np.flatnonzero(blank[:-1] & ~blank[1:]) + first)
            ends.append(np.flatnonzero(~blank[:-1] & blank[1:]) + first)
            hashes += map(hash, text.lower().split())
        self.starts, self.ends, self.hashes = np.concatenate(starts), np.concatenate(ends), np.array(hashes, np.int64)

    def text(self, start: int, end: int) -> str:
        at = bisect_right(self.firsts, start) - 1
        return self.pieces[at][start - self.firsts[at] : end - self.firsts[at]]


class Stretches:
    """Words of stretches of a text behind each other, the words at their ends as far as they lie inside."""

    def __init__(self, words: Words, firsts: np.ndarray, stops: np.ndarray):
        self.low = np.searchsorted(words.ends, firsts, side="right")
        self.counts = np.maximum(0, np.searchsorted(words.starts, stops) - self.low)
        self.offsets = np.cumsum(self.counts) - self.counts
        at = ranges(self.low, self.counts)
        self.starts = np.maximum(words.starts[at], np.repeat(firsts, self.counts))
        self.ends = np.minimum(words.ends[at], np.repeat(stops, self.counts))
        self.hashes = words.hashes[at]
        for place in np.flatnonzero((self.starts > words.starts[at]) | (self.ends < words.ends[at])).tolist():
            self.hashes[place] = hash(words.text(int(self.starts[place]), int(self.ends[place])).lower())


def ranges(lows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each of ``lows`` on, behind each other."""
    return np.arange(int(counts.sum())) + np.repeat(lows - (np.cumsum(counts) - counts), counts)


def align(own: Words, other: Words, chains: list[tuple[list[int], list[int], list[int]]]) -> list[list[tuple]]:
    """For each pair of texts the passages along its chains: start, end, other start, other end, words and likeness.

    A pair's chains are given by their numbers of seeds and the starts of the seeds in both texts. Chains with ALIGNED_CHARS of
    text around them are compared at once, whatever pairs they are of.
    """
    pair = np.repeat(np.arange(len(chains)), [len(sizes) for sizes, _, _ in chains]) << PLACE_BITS  # of each chain
    sizes, starts, other_starts = (np.concatenate([np.array(values, np.int64) for values in side]) for side in zip(*chains))
    ends = np.cumsum(sizes)
    opens = ends - sizes
    firsts, stops = np.maximum(0, starts[opens] - MARGIN) + pair, starts[ends - 1] + MARGIN + pair
    other_firsts, other_stops = np.maximum(0, other_starts[opens] - MARGIN) + pair, other_starts[ends - 1] + MARGIN + pair
    group = np.cumsum(stops - firsts + other_stops - other_firsts) // ALIGNED_CHARS
    borders = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    found: list[list[tuple]] = [[] for _ in chains]
    for low, high in zip(borders, borders[1:]):
        sides = Stretches(own, firsts[low:high], stops[low:high]), Stretches(other, other_firsts[low:high], other_stops[low:high])
        chain_of = np.repeat(np.arange(high - low), sizes[low:high])
        inner = slice(opens[low], ends[high - 1])
        base = pair[low:high][chain_of]
        i = np.searchsorted(own.starts, starts[inner] + base) - sides[0].low[chain_of]
        j = np.searchsorted(other.starts, other_starts[inner] + base) - sides[1].low[chain_of]
        for span in compared(*sides, chain_of, i, j):
            at = span[0] >> PLACE_BITS
            found[at].append((*(place - (at << PLACE_BITS) for place in span[:4]), *span[4:]))
    return found


def compared(own: Stretches, other: Stretches, chain_of: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple]:
    """Passages along the chains through the words ``i`` and ``j`` of stretches.

    Between seeds words are compared in step; where a gap is longer in one text, from both of its ends, and what is left over is unlike.
    """
    inside = (i < own.counts[chain_of]) & (j < other.counts[chain_of])
    chain_of, i, j = chain_of[inside], i[inside], j[inside]
    if not len(i):
        return []
    changes = np.diff(chain_of) != 0
    opens, closes = np.concatenate([[True], changes]), np.concatenate([changes, [True]])

    def unlike(chains: np.ndarray, a: np.ndarray, b: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Places, of all words compared, of those that differ."""
        return np.flatnonzero(own.hashes[ranges(own.offsets[chains] + a, count)] != other.hashes[ranges(other.offsets[chains] + b, count)])

    lead = np.minimum(i, j)[opens]
    rest = np.minimum(own.counts[chain_of] - i, other.counts[chain_of] - j)[closes]
    at = np.flatnonzero(~closes)
    chains, a, b, next_a, next_b = chain_of[at], i[at], j[at], i[at + 1], j[at + 1]
    even = next_a - a == next_b - b
    steps = [
        (chain_of[opens], i[opens] - lead, j[opens] - lead, lead),
        (chain_of[closes], i[closes], j[closes], rest),
        (chains[even], a[even], b[even], (next_a - a)[even]),
    ]
    extra = np.zeros(len(own.hashes), np.int64)  # words of the other text left out just before
    chains, a, b, next_a, next_b = (side[~even] for side in (chains, a, b, next_a, next_b))
    count = np.maximum(0, np.minimum(next_a - a, next_b - b))
    begins, places = np.cumsum(count) - count, unlike(chains, a, b, count)
    ahead = np.minimum(np.append(places, len(own.hashes) + count.sum())[np.searchsorted(places, begins)] - begins, count)
    left = count - ahead
    stops, places = np.cumsum(left), unlike(chains, next_a - left, next_b - left, left)
    behind = np.minimum(stops - 1 - np.concatenate([[-1], places])[np.searchsorted(places, stops)], left)
    steps += [(chains, a, b, ahead), (chains, next_a - behind, next_b - behind, behind)]
    np.add.at(extra, own.offsets[chains] + next_a - behind, np.maximum(0, (next_b - b) - (next_a - a)))

    chains, a, b, count = map(np.concatenate, zip(*steps))
    words, others = ranges(own.offsets[chains] + a, count), ranges(other.offsets[chains] + b, count)
    like = own.hashes[words] == other.hashes[others]
    partner = np.full(len(own.hashes), -1, np.int64)  # the like word of the other text
    partner[words[like]] = others[like]
    cost = LIKENESS / (1 - LIKENESS)
    agrees, missing = partner >= 0, extra * cost
    gains = np.where(agrees, 1.0, -cost) - missing
    agreeing = np.concatenate([[0], np.cumsum(agrees)])
    lows, highs = own.offsets, own.offsets + own.counts
    found = []
    for at in np.flatnonzero(agreeing[highs] - agreeing[lows] >= LIKENESS * LEAST_WORDS).tolist():
        for a, b in passages(int(lows[at]), int(highs[at]), gains, missing, agrees, agreeing):
            met = partner[a:b][agrees[a:b]]
            whole = max(b - a, int(met[-1] - met[0]) + 1)
            ends = (int(own.starts[a]), int(own.ends[b - 1]), int(other.starts[met[0]]), int(other.ends[met[-1]]))
            found.append((*ends, b - a, len(met) / whole))
    return found


def passages(
    low: int, high: int, gains: np.ndarray, missing: np.ndarray, agrees: np.ndarray, agreeing: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Borders of the passages between two words; ``agreeing`` counts the like words before each.

    Where fewer words agree than the shortest passage needs, there is none.
    """

    def longest(low: int, high: int) -> tuple[int, int]:
        """The longest passage of the likeness wanted that begins and ends with like words."""
        sums = np.concatenate([[0.0], np.cumsum(gains[low:high])])
        begins = np.where(agrees[low:high], sums[:-1] - missing[low:high], np.inf)  # words left out before it do not count
        first = np.searchsorted(-np.minimum.accumulate(begins), -(sums[1:] + 1e-6))
        lengths = np.where(agrees[low:high], np.arange(1, high - low + 1) - first, 0)
        end = int(lengths.argmax())
        return low + int(first[end]), low + end + 1

    pending = [(low, high)]
    while pending:
        low, high = pending.pop()
        if high - low < LEAST_WORDS or agreeing[high] - agreeing[low] < LIKENESS * LEAST_WORDS:
            continue
        sums = np.concatenate([[0.0], np.cumsum(gains[low:high])])
        risen = sums - np.minimum.accumulate(sums)
        end = int(risen.argmax())
        if risen[end] <= 0:
            continue
        begin = int(np.flatnonzero(sums[: end + 1] == sums[: end + 1].min())[-1])
        a, b = low + begin, low + end
        if b - a < LEAST_WORDS:  # less like on the whole, but long enough
            a, b = longest(low, high)
        if b - a >= LEAST_WORDS:
            pending += [(low, a), (b, high)]
            yield a, b


def repeated_passages(documents: DataFrame) -> DataFrame:
    """doc_id, start, end, source_id, source_start, source_end, n_words and likeness of each repeated passage.

    ``source`` is an earlier document, by doc_id, that holds the passage; start and end count code points of the whole texts.
    The first document that holds a passage is a source only. A passage that lies in a verbatim one of its document is
    left out. Repeats within one document are no result. Rows without an id, null and
    empty texts take no part; rows that repeat an id count as one document. Further columns are left out.
    """
    spark = documents.sparkSession
    with scratch(spark, "chaining") as place:
        texts = documents.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null and text is not null")
        rows, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
        with batches_of(spark, TEXTS):
            seeds = _seeds(texts, *_common_seeds(texts, rows), parts)
            matches = _matches(seeds, place)
        chains = place.keep(_chains(matches, parts), "chains")
        with batches_of(spark, TEXTS):
            return cut(_aligned(chains, texts))


def covering(rows: list[tuple]) -> list[tuple]:
    """Of the passages of one pair, by their second and third value, as few as cover whatever all of them cover.

    Text that repeats itself, such as one word many times, agrees with its source at every place.
    """
    kept: list[tuple] = []
    end, best = -1, None
    for row in [*sorted(rows, key=lambda row: (row[1], -row[2])), None]:
        if best is not None and (row is None or row[1] > end):
            kept.append(best)
            end, best = best[2], None
        if row is not None and row[2] > max(end, best[2] if best else -1):
            best = row
    return kept


def outermost(rows: list[tuple]) -> list[tuple]:
    """The passages of one document without those that lie in a verbatim one; of equal verbatim ones that of the first source stays.

    What the source of a verbatim passage shares with a third document is its own result; a passage less alike implies nothing.
    Of sources that hold the same words for a passage the first stays.
    """
    by_source: dict[int, list[tuple]] = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    kept, end, seen = [], -1, set()
    every = (row for own in by_source.values() for row in covering(own))
    for row in sorted(every, key=lambda row: (row[1], -row[2], -row[7], row[3])):
        same = (row[1], row[2], row[8])
        if row[2] > end and same not in seen:
            seen.add(same)
            kept.append(row)
            if row[7] == 1:
                end = row[2]
    return kept


def _aligned(chains: DataFrame, texts: DataFrame) -> DataFrame:
    """Passages along the chains. Each text is read once and only the pieces that chains need go on."""
    none = F.lit(None).cast("array<int>")
    sides = [
        chains.select(
            "doc_id", "source_id", F.lit(0).alias("side"), F.col("doc_id").alias("owner"), "sizes", "starts", "source_starts",
            "firsts", "lengths",
        ),
        chains.select(
            "doc_id", "source_id", F.lit(1).alias("side"), F.col("source_id").alias("owner"), none.alias("sizes"), none.alias("starts"),
            none.alias("source_starts"), F.col("source_firsts").alias("firsts"), F.col("source_lengths").alias("lengths"),
        ),
    ]
    owned = texts.select(F.col("doc_id").alias("owner"), "text")
    pieces = F.transform(
        F.arrays_zip("firsts", "lengths"), lambda piece: F.col("text").substr(piece["firsts"] + 1, piece["lengths"])
    )
    stretches = sides[0].unionByName(sides[1]).join(owned, "owner").select(
        "doc_id", "source_id", "side", "sizes", "starts", "source_starts", "firsts", pieces.alias("pieces")
    )
    schema = (
        "doc_id long, start long, end long, source_id long, source_start long, source_end long, n_words long, likeness double"
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict | None = None
        owner, held = None, []
        for batch in slices(batches, rows=64):
            pairs, rows = [], []
            for row in batch.to_pylist():
                if row["side"] == 0:
                    waiting = row
                elif waiting is not None and (row["doc_id"], row["source_id"]) == (waiting["doc_id"], waiting["source_id"]):
                    pairs.append((waiting, row))
                    waiting = None
            if not pairs:
                continue
            own, other = (Words([(row["firsts"], row["pieces"]) for row in side]) for side in zip(*pairs))
            every = align(own, other, [(row["sizes"], row["starts"], row["source_starts"]) for row, _ in pairs])
            for at, ((row, _), found) in enumerate(zip(pairs, every)):
                doc_id, source_id, base = row["doc_id"], row["source_id"], at << PLACE_BITS
                if owner != doc_id:
                    rows += outermost(held)
                    owner, held = doc_id, []
                for _, a, b, _, c, d, n, like in covering([(doc_id, *span[:2], source_id, *span[2:]) for span in found]):
                    said = tuple(other.text(base + c, base + d).lower().split())
                    held.append((doc_id, a, b, source_id, c, d, n, like, hash(said)))
            if rows:
                yield filled(rows)
        if held:
            yield filled(outermost(held))
        give_back()

    def filled(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.float64()]
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        names = ["doc_id", "start", "end", "source_id", "source_start", "source_end", "n_words", "likeness"]
        return pa.RecordBatch.from_arrays(arrays, names)

    paired = stretches.repartition("doc_id").sortWithinPartitions("doc_id", "source_id", "side", "pieces")
    return paired.mapInArrow(meet, schema)


def parts_that_stay(link: dict, found: list | None) -> list[dict]:
    """Parts of a passage whose counterpart in the source is in no passage ``found`` there, by their share of its length.

    Parts of fewer words than a passage has are left out.
    """
    share = LEAST_WORDS / max(LEAST_WORDS, link["n_words"])
    low, high = link["source_start"], link["source_end"]
    scale = (link["end"] - link["start"]) / max(1, high - low)
    free, at = [], low
    for span in sorted(found if found is not None else [], key=lambda span: (span["start"], span["end"])):
        if span["start"] > at:
            free.append((at, min(span["start"], high)))
        at = max(at, span["end"])
    free.append((at, high))
    return [
        {"start": link["start"] + round((a - low) * scale), "end": link["start"] + round((b - low) * scale)}
        for a, b in free
        if b - a >= share * (high - low)
    ]


SPANS = T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType()))


@F.pandas_udf(SPANS)
def _parts_that_stay(links: pd.DataFrame, found: pd.Series) -> pd.Series:
    rows = zip(links.to_dict("records"), found)
    return pd.Series([parts_that_stay(link, own) for link, own in rows], dtype=object)


def without(text: str, spans: list) -> str:
    """A text without the whole words in the spans, which may overlap; what is left on either side is joined by a space."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda span: (span["start"], span["end"])):
        start, end = span["start"], span["end"]
        while start < end and 0 < start and not (text[start].isspace() or text[start - 1].isspace()):
            start += 1
        while start < end < len(text) and not (text[end].isspace() or text[end - 1].isspace()):
            end -= 1
        if start > at:
            parts.append(text[at:start].strip())
        at = max(at, end)
    return " ".join(part for part in [*parts, text[at:].strip()] if part)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if text is None else without(text, own) for text, own in zip(texts, spans)], dtype=object)


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with repeated passages cut out, as far as the text that they repeat stays in another document.

    A verbatim passage goes: whatever becomes of its source holds for it too. Of a passage less alike, the parts of fifty words or
    more go whose counterparts in the source are in no repeated passage of the source itself; so nothing is cut against a text that
    is cut against a third one. Every document stays, also one of which nothing is left, and rows without an id or a text
    stay as they are; ``n_chars`` is counted anew where something was cut.
    """
    owner, own, source = (unused_name(documents, name) for name in ("owner", "spans", "source"))
    links = repeated_passages(documents)
    found = links.groupBy(F.col("doc_id").alias(source)).agg(F.collect_set(F.struct("start", "end")).alias("found"))
    verbatim = F.col("likeness") == 1
    whole = links.filter(verbatim).select(F.col("doc_id").alias(owner), F.array(F.struct("start", "end")).alias("parts"))
    fuzzy = links.filter(~verbatim).join(found, F.col("source_id") == F.col(source), "left")
    link = F.struct("start", "end", "source_start", "source_end", "n_words")
    in_parts = fuzzy.select(F.col("doc_id").alias(owner), _parts_that_stay(link, F.col("found")).alias("parts"))
    spans = whole.unionByName(in_parts).select(owner, F.explode("parts").alias(own)).groupBy(owner).agg(F.collect_set(own).alias(own))
    joined = documents.join(spans, F.col("doc_id") == F.col(owner), "left")
    touched = F.col(own).isNotNull() & F.col("text").isNotNull()
    text = F.coalesce(_without(F.when(touched, F.col("text")), F.col(own)), F.col("text"))
    columns = {name: F.col(name) for name in documents.columns} | {"text": text}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.when(touched, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
    return joined.select(*(column.alias(name) for name, column in columns.items()))
