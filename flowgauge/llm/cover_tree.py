"""Exact top-k by inner product with cover trees over queries and data.

A node of a cover tree is a point, a radius that covers all points below it, and children whose centres are spread
over it until every point is within half the radius of one, or there are as many as a node may have. No score between a query below one node and a point below another exceeds
``c . d + |c| r + |d| q + q r``, with the centres c and d and the radii q and r. A pair of nodes whose bound is under the
worst kth score of the queries below is skipped whole; other pairs are split, best bounds first.

Data are indexed in blocks, one tree per block, by the tasks that hold them. Queries go out in blocks of a bounded
number of bytes, one tree each, and meet every tree of the data. A bounded sample of the data gives each query a first kth
score, so that pruning starts at once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import Scratch, cut, scratch

LEAF, CHILDREN = 256, 8  # points of a leaf, and children of a node, at most
DEEPEST = 40
BLOCK_ROWS = 8192  # data rows per tree
QUERY_BYTES = 16 << 20  # queries sent out at once
SEED_ROWS = 2000  # data rows, in expectation, for the first kth scores
SCALE = 256


@dataclass
class Node:
    rows: np.ndarray  # places of the points below, in the tree's matrix
    centre: np.ndarray
    norm: float
    radius: float
    children: list[Node] = field(default_factory=list)


def build(points: np.ndarray, rows: np.ndarray | None = None, depth: int = 0) -> Node:
    """A cover tree over the rows of ``points``: children's centres are farther apart than half the radius.

    Below ``DEEPEST`` levels, which only far outliers one by one can cause, what is left is one leaf.
    """
    rows = np.arange(len(points)) if rows is None else rows
    centre = points[rows[0]]
    distances = np.sqrt(((points[rows] - centre) ** 2).sum(axis=1))
    node = Node(rows, centre, float(np.sqrt(centre @ centre)), float(distances.max()))
    if len(rows) <= LEAF or node.radius == 0 or depth == DEEPEST:
        return node
    reach, nearest, owner, seeds = node.radius / 2, distances, np.zeros(len(rows), np.int64), 1
    while nearest.max() > reach and seeds < CHILDREN:
        far = int(nearest.argmax())
        to_far = np.sqrt(((points[rows] - points[rows[far]]) ** 2).sum(axis=1))
        closer = to_far < nearest
        owner[closer], nearest = seeds, np.minimum(nearest, to_far)
        nearest[far] = 0.0
        owner[far] = seeds
        seeds += 1
    for seed in range(seeds):
        own = rows[owner == seed]
        if len(own) and len(own) < len(rows):
            node.children.append(build(points, own, depth + 1))
    return node


class Best:
    """The k best (score, vec_id) of each query: score descending, then vec_id ascending."""

    def __init__(self, count: int, k: int):
        self.k = k
        self.scores = np.full((count, k), -np.inf)
        self.ids = np.full((count, k), np.iinfo(np.int64).max)

    def kth(self, rows: np.ndarray) -> np.ndarray:
        return self.scores[rows, -1]

    def offer(self, rows: np.ndarray, own_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of data ``ids`` for the queries at ``rows``; a query's own row takes no part."""
        scores = np.where(ids[None, :] == own_ids[:, None], -np.inf, scores)
        for at in np.flatnonzero(scores.max(axis=1) >= self.kth(rows)):
            row = rows[at]
            able = np.flatnonzero((scores[at] >= self.scores[row, -1]) & (scores[at] > -np.inf))
            if len(able):
                all_scores = np.concatenate([self.scores[row], scores[at, able]])
                all_ids = np.concatenate([self.ids[row], ids[able]])
                order = np.lexsort((all_ids, -all_scores))[: self.k]
                self.scores[row], self.ids[row] = all_scores[order], all_ids[order]


def search(queries: np.ndarray, query_ids: np.ndarray, top: Node, data: np.ndarray, ids: np.ndarray, root: Node, best: Best, floor: np.ndarray) -> None:
    """Dual-tree search; ``floor`` is a kth score that each query is known to reach anyway."""

    def worst(node: Node) -> float:
        return float(np.maximum(best.kth(node.rows), floor[node.rows]).min())

    def bounds(q: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.array([node.centre for node in nodes])
        norms = np.array([node.norm for node in nodes])
        radii = np.array([node.radius for node in nodes])
        bound = centres @ q.centre + q.norm * radii + norms * q.radius + q.radius * radii
        return bound + 1e-9 * (np.abs(bound) + 1)  # radii are rounded

    def visit(q: Node, d: Node) -> None:
        if not q.children and not d.children:
            best.offer(q.rows, query_ids[q.rows], queries[q.rows] @ data[d.rows].T, ids[d.rows])
            return
        if d.children and (not q.children or d.radius >= q.radius):
            values = bounds(q, d.children)
            for at in np.argsort(-values):
                if values[at] < worst(q):
                    break
                visit(q, d.children[at])
        else:
            for child in q.children:
                if bounds(child, [d])[0] >= worst(child):
                    visit(child, d)

    if bounds(top, [root])[0] >= worst(top):
        visit(top, root)


def quantised(embedding: Column) -> Column:
    """floor(256 x) of each component, or null if a component or all is null or not finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine, F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE)))


def usable(embeddings: DataFrame, k: int) -> DataFrame:
    """vec_id, vector and its size. Of equal vectors the k + 1 smallest ids: no query can need another."""
    rows = embeddings.select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("vector"))
    kept = rows.filter("vector is not null and vec_id is not null").distinct()
    copies = Window.partitionBy("vector").orderBy("vec_id")
    ranked = kept.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    return ranked.select("vec_id", "vector", F.size("vector").alias("size"))


def _matrix(vectors: list) -> np.ndarray:
    return np.array(vectors, np.float64).reshape(len(vectors), -1)


def _index(data: DataFrame, place: Scratch) -> DataFrame:
    """One row per block of data of one size: ids, matrix and pickled tree."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def row(size: int) -> pa.RecordBatch:
            ids, vectors = held.pop(size)
            points = _matrix(vectors)
            arrays = [
                pa.array([size], pa.int64()),
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.array([points.tobytes()], pa.binary()),
                pa.array([pickle.dumps(build(points))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["size", "ids", "points", "tree"])

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, vectors = held.setdefault(len(vector), ([], []))
                ids.append(vec_id)
                vectors.append(vector)
                if len(ids) >= BLOCK_ROWS:
                    yield row(len(vector))
        for size in list(held):
            yield row(size)

    dealt = data.select("vec_id", "vector")
    return place.keep(dealt.mapInArrow(blocks, "size long, ids binary, points binary, tree binary"), "index")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows of each query, all if there are fewer.

    Queries are the rows whose vec_id is divisible by ``every``. Ties go to the smaller vec_id. Vectors that are null or hold
    a null or non-finite component, and rows without an id, take no part; vectors of another length than the
    query's neither. Repeated rows count once; further columns are left out. Scores are exact while they stay below 2**53.
    """
    spark = embeddings.sparkSession
    with scratch(spark, "cover-tree") as place:
        data = place.keep(usable(embeddings, k), "data")
        index = _index(data, place)
        # a query may be a copy that no query needs as a result, so queries come from all rows
        asked = embeddings.filter(F.col("vec_id") % every == 0)
        rows = asked.select(F.col("vec_id").cast("long").alias("query_id"), quantised(F.col("embedding")).alias("vector"))
        queries = place.keep(rows.filter("vector is not null").distinct().withColumn("size", F.size("vector")), "queries")
        found = None
        share = SEED_ROWS / max(1, data.count())
        for size, count in sorted((row["size"], row["count"]) for row in queries.groupBy("size").count().collect()):
            own = data.filter(F.col("size") == size)
            seeds = own.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20))).toArrow()
            parts = -(-count * max(1, size) * 8 // QUERY_BYTES)
            part_of = F.pmod(F.xxhash64("query_id"), F.lit(parts))
            for part in range(parts):
                block = queries.filter((F.col("size") == size) & (part_of == part)).toArrow()
                if block.num_rows:
                    scored = _against(index.filter(F.col("size") == size), block, seeds, k)
                    scored = place.keep(scored, f"scored-{size}-{part}")
                    found = scored if found is None else found.unionByName(scored)
        if found is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return cut(ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def _against(index: DataFrame, block: pa.Table, seeds: pa.Table, k: int) -> DataFrame:
    """Candidates for one block of queries, k per query and task at most."""
    ids, points = block["query_id"].to_numpy(), _matrix(block["vector"].to_pylist())
    floor = np.full(len(ids), -np.inf)
    if seeds.num_rows:
        first = Best(len(ids), k)
        seed_ids, seed_points = seeds["vec_id"].to_numpy(), _matrix(seeds["vector"].to_pylist())
        for start in range(0, len(ids), 256):
            rows = np.arange(start, min(start + 256, len(ids)))
            first.offer(rows, ids[rows], points[rows] @ seed_points.T, seed_ids)
        floor = first.scores[:, -1]
    sent = index.sparkSession.sparkContext.broadcast((ids, points, build(points), floor))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, top, known = sent.value
        best = Best(len(query_ids), k)
        for batch in batches:
            for at in range(batch.num_rows):
                _, own_ids, matrix, tree = (batch.column(column)[at].as_py() for column in range(4))
                own = np.frombuffer(own_ids, np.int64)
                data = np.frombuffer(matrix, np.float64).reshape(len(own), -1)
                search(queries, query_ids, top, data, own, pickle.loads(tree), best, known)
        rows, places = np.nonzero(best.scores > -np.inf)
        arrays = [
            pa.array(query_ids[rows]),
            pa.array(best.ids[rows, places]),
            pa.array(best.scores[rows, places].astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return index.mapInArrow(scan, "query_id long, vec_id long, score long")
