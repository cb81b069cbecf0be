"""Near copies by a join of MinHash signatures over an inverted list for each coordinate and value.

A document is its set of four-word shingles. Of 32 signature coordinates two sets of likeness 0.8 share 26 on average and at
least 14 but for about one pair in ten million. So documents meet only if 14 coordinates agree:

* Counting: a coordinate's value that a single class of equal sets has can't collide. A class with fewer than 14 shared values has no partner.
* Prefix: two classes that agree in 14 coordinates agree in one of the rarest (shared values - 13) of either, with all values in one
  order, the rarest first. Only those are posted; lists of values that many documents have are skipped, and are
  looked up in the signatures of the pairs that met elsewhere.
* Merging: a list is dealt in chunks. In a chunk each class is compared with the leaders found before it, a star for each group
  and not all pairs. What verified links connect needs no further comparison; the classes of a list that they leave in
  different components are then compared across all its chunks.
* Bounding: each set has a bitmap of its hashes. A bit of one set that another lacks stands for a shingle that it lacks, which
  bounds what the two can have in common. Pairs that cannot reach the likeness are not made.

Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import Scratch, WordHashes, cut, remembered_by_worker, scratch, shingle_hashes, slices
from flowgauge.llm.graph import components

SHINGLE_WORDS = 4
COORDINATES, LEAST_COMMON = 32, 14
LIKENESS = 80  # in a hundred
CHUNK = 1024  # classes of a list, in expectation, that one comparison holds
COMPARED = 256  # visitors compared with a chunk at a time

_seeds = np.random.default_rng(20).integers(0, 1 << 63, (2, COORDINATES), np.uint64)
FACTORS, TERMS = _seeds[0] * np.uint64(2) + np.uint64(1), _seeds[1]

BITMAP_BITS = 4096  # more shingles than that make the bound weaker, not wrong

PRINT_SCHEMA = (
    "doc_id long, text_hash long, n_shingles long, high long, low long, values array<long>, signs binary, bitmap binary"
)


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending; fewer words than four are one shingle, none are no shingle."""
    words = (text or "").encode().lower().split()
    hashes = remembered_by_worker("hashes of words in bytes", WordHashes)
    return np.unique(shingle_hashes(hashes.of(words), SHINGLE_WORDS))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least values of each set, none of them empty, under the coordinates' permutations; 32 bits of each."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(own) for own in sets[:-1]])
    least = np.empty((len(sets), COORDINATES), np.uint64)
    for at in range(COORDINATES):
        least[:, at] = np.minimum.reduceat(joined * FACTORS[at] + TERMS[at], starts)
    # a least value's high bits are mostly zero
    return least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)


def bitmap(own: np.ndarray) -> bytes:
    """A bit for each value of the hashes' high bits."""
    held = np.zeros(BITMAP_BITS, bool)
    held[(own >> np.uint64(64 - BITMAP_BITS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(held).tobytes()


def class_key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed numbers."""
    digest = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def prints(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, and class key and signature of each document with words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (np.arange(COORDINATES, dtype=np.int64) << 32)[None, :]
        for batch in slices(batches, texts=2):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(text) for text in part.column(2).to_pylist()]
                some = [at for at, own in enumerate(sets) if len(own)]
                keys: list[tuple[int, int] | tuple[None, None]] = [(None, None)] * len(sets)
                values: list[np.ndarray | None] = [None] * len(sets)
                signs: list[bytes | None] = [None] * len(sets)
                if some:
                    least = signatures([sets[at] for at in some])
                    for at, row, sign in zip(some, least.astype(np.int64) | named, least.astype(np.uint32)):
                        keys[at], values[at], signs[at] = class_key(sets[at]), row, sign.tobytes()
                arrays = [
                    part.column(0),
                    part.column(1),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([key[0] for key in keys], pa.int64()),
                    pa.array([key[1] for key in keys], pa.int64()),
                    pa.array(values, pa.list_(pa.int64())),
                    pa.array(signs, pa.binary()),
                    pa.array([bitmap(own) for own in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, PRINT_SCHEMA.replace(",", "").split()[::2])

    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(work, PRINT_SCHEMA)


def classes_of(printed: DataFrame) -> DataFrame:
    """One row per distinct set: a number of its own, where its first document is, its size and its signature."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "n_shingles", "values", "signs", "bitmap"))
    grouped = printed.filter("high is not null").groupBy("high", "low").agg(first.alias("first"))
    return grouped.select("high", "low", "first.*").drop("nameless").withColumn("node", F.monotonically_increasing_id())


def postings(classes: DataFrame) -> DataFrame:
    """value, holders, node, posted, n_shingles, signs and bitmap: each class under the rarest of the values it shares.

    A value's ``holders`` are all classes that have it, posted or not.
    """
    every = classes.select("node", F.explode("values").alias("value"))
    shared = every.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    held = every.join(shared, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("held"))
    # of a signature's values, those that are not shared come first in the order and take their part of the prefix
    rarest = held.filter(F.size("held") >= LEAST_COMMON).select(
        "node", F.slice("held", F.lit(1), F.size("held") - (LEAST_COMMON - 1)).alias("lists")
    )
    bits = F.transform("lists", lambda own: F.call_function("shiftleft", F.lit(1).cast("long"), (own["value"] / (1 << 32)).cast("int")))
    posted = F.aggregate(bits, F.lit(0).cast("long"), lambda mask, bit: mask.bitwiseOR(bit))
    prefix = rarest.select("node", posted.alias("posted"), F.inline("lists"))
    return prefix.join(classes.select("node", "n_shingles", "signs", "bitmap"), "node")


def _chunks() -> Column:
    return F.ceil(F.col("holders") / CHUNK)


def _own_chunk() -> Column:
    return F.pmod(F.xxhash64("node", "value"), _chunks())


class Members:
    """Classes of a list: their numbers, sizes, signatures and bitmaps, as rows of arrays."""

    def __init__(self, rows: pa.Table):
        self.nodes, self.sizes = rows["node"].to_numpy(), rows["n_shingles"].to_numpy()
        self.signs = self._rows(rows["signs"], np.uint32)
        self.bitmaps = self._rows(rows["bitmap"], np.uint64)
        self.posted = rows["posted"].to_numpy()

    @staticmethod
    def _rows(column: pa.ChunkedArray, kind: type) -> np.ndarray:
        values = column.to_pylist()
        return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)

    def agree(self, own: np.ndarray, others: Members, theirs: np.ndarray) -> np.ndarray:
        """How many coordinates agree, for all of these own rows and all of those others."""
        one, other = self.signs[own], others.signs[theirs]
        count = np.zeros((len(one), len(other)), np.uint8)
        for at in range(COORDINATES):
            count += one[:, at, None] == other[None, :, at]
        return count

    def may_link(self, own: np.ndarray, others: Members, theirs: np.ndarray, apart: np.ndarray | None = None) -> tuple:
        """Pairs (places in ``own`` and in ``theirs``, and agreeing coordinates) that nothing known here rules out."""
        count = self.agree(own, others, theirs)
        near = count >= LEAST_COMMON
        if apart is not None:
            near &= apart
        x, y = np.nonzero(near)
        agree = count[x, y]
        one, other = own[x], theirs[y]
        sizes, other_sizes = self.sizes[one], others.sizes[other]
        most = np.minimum(sizes, other_sizes)
        held = 100 * most >= LIKENESS * np.maximum(sizes, other_sizes)
        for start in range(0, len(x), 1 << 16):
            part = slice(start, start + (1 << 16))
            bits, other_bits = self.bitmaps[one[part]], others.bitmaps[other[part]]
            lacks = np.bitwise_count(bits & ~other_bits).sum(axis=1, dtype=np.int64)
            lacked = np.bitwise_count(other_bits & ~bits).sum(axis=1, dtype=np.int64)
            most[part] = np.minimum(sizes[part] - lacks, other_sizes[part] - lacked)
        held &= (100 + LIKENESS) * most >= LIKENESS * (sizes + other_sizes)
        return x[held], y[held], agree[held]

    def first_common(self, own: np.ndarray, others: Members, theirs: np.ndarray) -> np.ndarray:
        """The first coordinate under whose value both of each pair are posted: a pair belongs to that list alone."""
        bits = np.int64(1) << np.arange(COORDINATES)
        both = self.posted[own] & others.posted[theirs]
        same = (self.signs[own] == others.signs[theirs]) & (both[:, None] & bits != 0)
        return same.argmax(axis=1)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of one (value, chunk) at a time, in batches; rows come sorted."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        value, chunk = batch.column("value").to_numpy(), batch.column("chunk").to_numpy()
        borders = np.flatnonzero((np.diff(value) != 0) | (np.diff(chunk) != 0)) + 1
        for start, end in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
            own = (value[start], chunk[start])
            if held and own != before:
                yield held
                held = []
            held.append(batch.slice(start, end - start))
            before = own
    if held:
        yield held


PAIR_SCHEMA = "a long, b long, agree int"


def _pairs(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, agree = (np.concatenate(part) for part in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(agree.astype(np.int32))], ["a", "b", "agree"]
    )


def stars(posted: DataFrame) -> DataFrame:
    """a, b, agree: within each chunk of a list, each class and the leader that it may link to.

    Chunks differ from list to list, so that what a long list parts meets in another.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for group in _groups(batches):
            if sum(part.num_rows for part in group) < 2:
                continue
            members = Members(pa.Table.from_batches(group))
            left = np.arange(len(members.nodes))
            while len(left) > 1:
                leader, left = left[:1], left[1:]
                _, hit, agree = members.may_link(leader, members, left)
                if len(hit):
                    found.append((members.nodes[left[hit]], np.repeat(members.nodes[leader], len(hit)), agree))
                    left = np.delete(left, hit)
            if sum(len(part[0]) for part in found) > 50_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    dealt = posted.filter("holders > 1").withColumn("chunk", _own_chunk()).drop("holders")
    dealt = dealt.repartition("value", "chunk").sortWithinPartitions("value", "chunk", "node")
    return dealt.mapInArrow(meet, PAIR_SCHEMA)


def across(posted: DataFrame, roots: DataFrame, best_only: bool) -> DataFrame:
    """a, b, agree: pairs of a list that may link and lie in different components.

    Of a list, the component with the most classes stays in its chunks; all other classes visit every chunk. A list in one
    component is left out. With ``best_only`` a class names one partner per component and chunk, the one most like it.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            whole = pa.Table.from_batches(group)
            visits = whole.column("visits").to_numpy()
            own, guests = whole.slice(0, int((~visits).sum())), whole.filter(whole.column("visitor"))
            if not own.num_rows or not guests.num_rows:
                continue
            root, members = own["root"].to_numpy(), Members(own)
            every, coordinate = np.arange(len(root)), int(own["value"][0].as_py()) >> 32
            for start in range(0, guests.num_rows, COMPARED):
                guest = guests.slice(start, COMPARED)
                its_root, visiting = guest["root"].to_numpy(), Members(guest)
                apart = its_root[:, None] != root[None, :]
                x, y, agree = visiting.may_link(np.arange(len(its_root)), members, every, apart)
                mine = visiting.first_common(x, members, y) == coordinate
                x, y, agree = x[mine], y[mine], agree[mine]
                if best_only and len(x):
                    order = np.lexsort((-agree.astype(np.int64), root[y], x))
                    x, y, agree = x[order], y[order], agree[order]
                    first = np.concatenate([[True], (np.diff(x) != 0) | (np.diff(root[y]) != 0)])
                    x, y, agree = x[first], y[first], agree[first]
                yield _pairs([(visiting.nodes[x], members.nodes[y], agree)])

    rooted = posted.join(roots, "node")
    parts = rooted.groupBy("value", "root").agg(F.count(F.lit(1)).alias("size"))
    lists = parts.groupBy("value").agg(F.max_by("root", F.struct("size", "root")).alias("major"), F.count(F.lit(1)).alias("parts"))
    open_lists = lists.filter("parts > 1").drop("parts")
    rows = rooted.join(open_lists, "value").withColumn("visitor", F.col("root") != F.col("major"))
    stay = rows.withColumn("chunk", _own_chunk()).withColumn("visits", F.lit(False))
    visit = rows.filter("visitor").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _chunks() - 1)))
    visit = visit.filter(F.col("chunk") != _own_chunk()).withColumn("visits", F.lit(True))
    dealt = stay.unionByName(visit).drop("holders", "major")
    dealt = dealt.repartition("value", "chunk").sortWithinPartitions("value", "chunk", "visits", "node")
    return dealt.mapInArrow(meet, PAIR_SCHEMA)


def sets_of(documents: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and shingles of these classes, from the text of each one's first document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, texts=1):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [shingle_set(text) for text in part.column(1).to_pylist()]
                right = [class_key(own) == key for own, key in zip(sets, zip(part.column(2).to_pylist(), part.column(3).to_pylist()))]
                found = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([own.tobytes() for own in sets], pa.binary())], ["node", "shingles"]
                )
                yield found.filter(pa.array(right))

    wanted = classes.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "text_hash", "high", "low")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = wanted.withColumnRenamed("doc_id", "first_id").join(
        texts, (F.col("text_hash") == F.xxhash64("text")) & F.col("first_id").eqNullSafe(F.col("doc_id"))
    )
    found = rows.select("node", "text", "high", "low").mapInArrow(work, "node long, shingles binary")
    return found.dropDuplicates(["node"])  # of a repeated row


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs a, b those whose full sets are alike enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, texts=2):
            keep = []
            for one, other in zip(batch.column(2), batch.column(3)):
                one, other = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= LIKENESS * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = pairs.select("a", "b").join(sets.toDF("a", "one"), "a")
    second = first.join(sets.toDF("b", "other"), "b").select("a", "b", "one", "other")
    return second.mapInArrow(compare, "a long, b long")


def _roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return nodes.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def links_of(documents: DataFrame, classes: DataFrame, place: Scratch) -> DataFrame:
    """a, b: confirmed links that connect what is connected among the classes."""
    posted = place.keep(postings(classes), "postings")
    nodes = place.keep(posted.select("node").distinct(), "nodes")
    sets = place.keep(sets_of(documents, classes, nodes), "sets")
    # a class that met several leaders starts with the one most like it; what that leaves apart comes next
    nearest = place.keep(
        stars(posted).groupBy("a").agg(F.max_by(F.struct("b", "agree"), F.struct("agree", "b")).alias("best")).select("a", "best.b"),
        "met-first",
    )
    links = place.keep(confirmed(nearest, sets), "links-first")
    tested = nearest
    for label, best_only in (("best", True), ("rest", False)):
        roots = place.keep(_roots(nodes, links), f"roots-{label}")
        found = across(posted, roots, best_only).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        met = place.keep(found.join(done, ["a", "b"], "left_anti"), f"met-{label}")
        if met.isEmpty():
            break
        links = links.union(place.keep(confirmed(met, sets), f"links-{label}"))
        tested = tested.union(met)
    return links


def near_copies(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document.

    ``component_id`` is the smallest doc_id reachable over links, itself included. Null and empty texts and those
    without words have no shingles and link with nothing. Rows are documents of their own: repeated rows stay and link as equal texts
    do. A null doc_id counts in no minimum; a component of null ids alone has a null component_id, and
    ``kept`` is false for each null id. Further columns are left out.
    """
    spark = documents.sparkSession
    with scratch(spark, "minhash-join") as place:
        printed = place.keep(prints(documents), "prints")
        classes = place.keep(classes_of(printed), "classes")
        links = links_of(documents, classes, place)
        roots = place.keep(components(links), "roots")
        rooted = classes.join(roots, "node", "left").select("high", "low", "doc_id", F.coalesce("root", "node").alias("root"))
        least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = rooted.join(least, "root").select("high", "low", "component_id")
        some = printed.filter("high is not null").join(named, ["high", "low"]).select("doc_id", "n_shingles", "component_id")
        none = printed.filter("high is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        return cut(some.union(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
