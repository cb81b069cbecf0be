"""Gradient-boosted trees by MLlib's rules, over rows packed as codes on the executors' disks.

The trees are those of MLlib's boosting: the same candidate splits, draws, gains and shrinkage. What differs is how rows are
held. A row is its label and, for each group of a few features, one number for the bins that its values fall into; blocks of rows
lie as arrays in the folders that Spark gives to the executor, with the residuals of the tree under way. A level of a tree is
one pass of array operations over them, which sends the sums of each node and bin to the driver, and no rows.

A block's arrays follow from its rows and the trees so far. Where a task finds none, since it runs on another executor than the
one before or that one was lost, they are made anew from the rows, which Spark holds by their lineage.
"""

from __future__ import annotations

import contextlib
import math
import os
import shutil
import struct
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import cache
from pathlib import Path
from typing import BinaryIO, NamedTuple

import numpy as np
from pyspark import SparkContext, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values ------------------------------------------------------------
BLOCK_ROWS = 1 << 18
GROUP_CODES = 2_048  # the codes of a group of features at most, if it has more than one: their sums stay in a core's cache
MOST_COLLECTED = 64  # sums of more tasks are added up by tasks first
SPLIT_ROWS = 10_000  # looked at for candidate splits, or the square of the bins
MOST_SPLIT_ROWS = 1_000_000  # which the driver holds as arrays
NOISE = 1e-15  # of a squared mean: smaller gains come from rounding
ROUNDING = 1e-12  # of a gain: of two splits that gain the same the first is taken, in whatever order rows were added up
STAGE_LEVELS = 6  # of a tree, whose ends are bits of a word
_MASK = (1 << 64) - 1
# -----------------------------------------------------------------------------


# --- random numbers as the JVM draws them ------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    """Scala's ``MurmurHash3.bytesHash`` of whole words."""
    h = seed
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _xorshift_state(seed: int) -> int:
    data = struct.pack(">Q", seed & _MASK)
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _xorshift(state: int) -> int:
    state ^= state << 21 & _MASK
    state ^= state >> 35
    return state ^ (state << 4 & _MASK)


def _next_double(state: int) -> tuple[int, float]:
    first = _xorshift(state)
    second = _xorshift(first)
    return second, (((first & (1 << 26) - 1) << 27) + (second & (1 << 27) - 1)) / (1 << 53)


class _JavaRandom:
    """``java.util.Random`` as far as it is used."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next_int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        value = self.state >> 16
        return value - (1 << 32) if value >> 31 else value

    def next_long(self) -> int:
        value = ((self._next_int() << 32) + self._next_int()) & _MASK
        return value - (1 << 64) if value >> 63 else value


def _chosen(among: int, wanted: int, seed: int) -> list[int]:
    """A reservoir sample of ``range(among)``."""
    reservoir, state = list(range(wanted)), _xorshift_state(seed)
    for item in range(wanted, among):
        state, drawn = _next_double(state)
        place = int(drawn * (item + 1))
        if place < wanted:
            reservoir[place] = item
    return reservoir


_STEP = np.array([_xorshift(1 << bit) for bit in range(64)], np.uint64)  # what a step makes of each bit: steps are linear


def _moved(states: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """States after the steps that make ``columns`` of the single bits."""
    bits = states[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)
    return np.bitwise_xor.reduce(bits * columns, axis=1)


def bagged(rows: int, first: int, rate: float, seed: int) -> np.ndarray:
    """Which of ``rows`` rows, ``first`` and following of a partition, are drawn at ``rate`` by a generator that starts before its first.

    A row takes two steps. They are made for many lanes at once, each of which has its own rows.
    """
    length = 64  # of a lane
    lanes = -(-rows // length)
    states, power, steps = np.array([_xorshift_state(seed)], np.uint64), _STEP, 2 * first
    while steps:
        if steps & 1:
            states = _moved(states, power)
        steps, power = steps >> 1, _moved(power, power)
    power = _STEP
    for _ in range((2 * length).bit_length() - 1):
        power = _moved(power, power)
    while len(states) < lanes:
        states, power = np.concatenate([states, _moved(states, power)]), _moved(power, power)
    states = states[:lanes].copy()
    kept = np.empty((length, lanes), bool)
    high = np.empty(lanes, np.uint64)
    for step in range(length):
        for drawn in (0, 1):
            states ^= states << np.uint64(21)
            states ^= states >> np.uint64(35)
            states ^= states << np.uint64(4)
            if not drawn:
                high = (states & np.uint64((1 << 26) - 1)) << np.uint64(27)
        kept[step] = (high + (states & np.uint64((1 << 27) - 1))).astype(np.float64) / (1 << 53) < rate
    return kept.T.ravel()[:rows]


# --- bins of features, and groups of them ------------------------------------


class Group(NamedTuple):
    """Features whose bins make one code: the bin of the feature at ``n`` is ``code // steps[n] % bins``."""

    features: tuple[int, ...]
    steps: tuple[int, ...]
    size: int


@cache
def _groups(sizes: tuple[int, ...]) -> tuple[Group, ...]:
    """Features that have a choice of splits, put together while their codes are few; one group of none if there are none."""
    parts: list[list[int]] = []
    for feature in sorted(range(len(sizes)), key=lambda n: -sizes[n]):
        if sizes[feature] > 1:
            fits = (part for part in parts if math.prod(sizes[n] for n in (*part, feature)) <= GROUP_CODES)
            part = next(fits, None)
            if part is None:
                parts.append(part := [])
            part.append(feature)
    found = []
    for part in parts or [[]]:
        steps = [math.prod(sizes[n] for n in part[at + 1 :]) for at in range(len(part))]
        found.append(Group(tuple(part), tuple(steps), math.prod(sizes[n] for n in part)))
    return tuple(found)


class Bins(NamedTuple):
    """``edges`` of continuous features (a value is in the first bin whose edge is not less) and ``arity`` of the categories, 0 for others."""

    edges: tuple[np.ndarray, ...]
    arity: tuple[int, ...]

    @property
    def sizes(self) -> tuple[int, ...]:
        return tuple(arity or len(edges) + 1 for edges, arity in zip(self.edges, self.arity, strict=True))

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))

    def groups(self) -> tuple[Group, ...]:
        return _groups(self.sizes)

    def codes(self, columns: Sequence[np.ndarray]) -> list[np.ndarray]:
        found = []
        for group in self.groups():
            code = np.zeros(len(columns[0]), np.int64)
            for feature, step in zip(group.features, group.steps, strict=True):
                values = columns[feature]
                own = values.astype(np.int64) if self.arity[feature] else np.searchsorted(self.edges[feature], values, side="left")
                code += own * step
            found.append(code.astype(_code_type(group)))
        return found


def _code_type(group: Group) -> type:
    return np.uint16 if group.size <= 1 << 16 else np.uint32


def _sampled(fraction: float, seed: int) -> Callable[[Iterable], Iterator]:
    """Rows drawn from a partition as ``RDD.sample`` draws them for MLlib."""

    def sample(batches):
        draws = _JavaRandom(seed)
        for _ in range(TaskContext.get().partitionId() + 1):
            own = draws.next_long()
        state, at, following = _xorshift_state(own), 0, 0
        gaps = math.log1p(-fraction)

        def gap():
            nonlocal state
            state, drawn = _next_double(state)
            return int(math.log(max(drawn, 5e-11)) / gaps)

        following = gap() if fraction <= 0.4 else 0
        for batch in batches:
            if fraction > 0.4:
                places = np.flatnonzero(bagged(batch.num_rows, at, fraction, own))
            else:
                places = []
                while following < at + batch.num_rows:
                    places.append(following - at)
                    following += 1 + gap()
            at += batch.num_rows
            yield batch.take(list(places)) if len(places) else batch.slice(0, 0)

    return sample


def _edges(values: np.ndarray, weights: np.ndarray, total: float, splits: int) -> np.ndarray:
    """Edges between values so that about as much weight lies between any two: all of them if there are no more than ``splits``.

    As in MLlib, what the ``total`` has beyond the other values is the weight of zero.
    """
    known, place = np.unique(values[values != 0], return_inverse=True)
    counts = np.bincount(place, weights=weights[values != 0], minlength=len(known))
    zeros = total - counts.sum()
    if zeros > np.finfo(float).eps * 100 * np.count_nonzero(values):
        at = np.searchsorted(known, 0.0)
        known, counts = np.insert(known, at, 0.0), np.insert(counts, at, zeros)
    if len(known) < 2 or splits < 1:
        return np.empty(0)
    between = (known[:-1] + known[1:]) / 2
    if len(between) <= splits:
        return between
    stride = total / (splits + 1)
    found, target, so_far = [], stride, counts[0]
    for index in range(1, len(known)):
        before, so_far = so_far, so_far + counts[index]
        if abs(before - target) < abs(so_far - target):
            found.append(between[index - 1])
            target += stride
    return np.array(found)


def find_bins(rows: DataFrame, features: Sequence[str], arity: Mapping[str, int], most: int, count: int, loss: Loss, seed: int) -> Bins:
    """Bins of the features of the ``count`` rows to learn from; a part of the rows decides on the edges, as in MLlib, and all are binned."""
    most = min(most, count)
    wanted = min(max(most * most, SPLIT_ROWS), MOST_SPLIT_ROWS)
    some = rows.select(*[F.col(name).cast("double").alias(f"f{n}") for n, name in enumerate(features)], "label")
    fraction, whole = wanted / count, float(count)
    if fraction < 1:
        drawn = _xorshift(_xorshift_state(seed)) & 0xFFFFFFFF
        some = some.mapInArrow(_sampled(fraction, drawn - (1 << 32) if drawn >> 31 else drawn), some.schema)
        if loss.logistic:
            whole = rows.agg(F.sum(F.when(F.col("label") > 0, loss.positive).otherwise(1.0))).first()[0]
    found = some.toArrow()
    weights = loss.weights(loss.target(found.column("label").to_numpy()))
    total = whole * fraction if fraction < 1 else weights.sum()
    sizes = tuple(arity.get(name, 0) if arity.get(name, 0) > 1 else 0 for name in features)
    columns = (found.column(f"f{n}").to_numpy() for n in range(len(features)))
    edges = tuple(np.empty(0) if size else _edges(column, weights, total, most - 1) for size, column in zip(sizes, columns, strict=True))
    return Bins(edges, sizes)


# --- losses ------------------------------------------------------------------


class Loss(NamedTuple):
    """Squared errors of numbers, or the logistic loss of labels 0 and 1, where 1 has the weight ``positive``."""

    logistic: bool = False
    positive: float = 1.0

    def target(self, label: np.ndarray) -> np.ndarray:
        return label * 2 - 1 if self.logistic else label

    def weights(self, target: np.ndarray) -> np.ndarray:
        return np.where(target > 0, self.positive, 1.0) if self.logistic else np.ones(len(target))

    def weighted(self, residual: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
        """The weights of rows, none if all are 1, and their weighted residuals; a residual has the sign of its target."""
        if not self.logistic:
            return None, residual
        weight = np.where(np.signbit(residual), 1.0, self.positive)
        return weight, residual * weight

    def residual(self, target: np.ndarray, prediction: np.ndarray) -> np.ndarray:
        """What the next tree learns: the loss's negative slope."""
        if self.logistic:
            with np.errstate(over="ignore"):
                return 4 * target / (1 + np.exp(2 * target * prediction))
        return 2 * (target - prediction)


# --- trees -------------------------------------------------------------------


class Split(NamedTuple):
    feature: int
    left: np.ndarray  # whether a bin goes left
    gain: float
    sides: tuple[float, float]  # the weight of the rows on the left and on the right


#: The splits of a tree under the numbers of their nodes: 1, and 2n and 2n + 1 below n.
Splits = dict[int, Split]


class Tree(NamedTuple):
    splits: Splits
    values: dict[int, float]  # of the ends


def _ends(splits: Splits, node: int, levels: int) -> list[int]:
    if not levels or node not in splits:
        return [node]
    return _ends(splits, 2 * node, levels - 1) + _ends(splits, 2 * node + 1, levels - 1)


class _Finder:
    """Finds the end of a tree that each row comes to.

    For each code of a group a word says which of up to 64 ends its values leave open; the words of all groups leave one.
    Deeper trees take several stages.
    """

    def __init__(self, splits: Splits, bins: Bins):
        self.groups, self.stages, roots = bins.groups(), [], [1]
        while True:
            ends = [_ends(splits, root, STAGE_LEVELS) for root in roots]
            tables: list[np.ndarray | None] = [None] * len(self.groups)
            for number, (root, own) in enumerate(zip(roots, ends, strict=True)):
                bit = {end: np.uint64(1 << at) for at, end in enumerate(own)}
                self._close(splits, root, bit, number, len(roots), tables, bins)
            self.ends = [end for own in ends for end in own]
            if all(table is None for table in tables):
                break
            # of a root without splits one end stays open anyway
            starts = np.cumsum([0, *map(len, ends)])[:-1].astype(np.int64)
            self.stages.append((starts, np.array([(1 << len(own)) - 1 for own in ends], np.uint64), tables))
            if not any(end in splits for end in self.ends):
                break
            roots = self.ends

    def _close(self, splits: Splits, node: int, bit: dict, number: int, roots: int, tables: list, bins: Bins) -> np.uint64:
        """Takes the ends below a node that its split rules out from the words; returns the word of all ends below it."""
        if node in bit:
            return bit[node]
        below = [self._close(splits, child, bit, number, roots, tables, bins) for child in (2 * node, 2 * node + 1)]
        split = splits[node]
        at = next(n for n, group in enumerate(self.groups) if split.feature in group.features)
        group = self.groups[at]
        if tables[at] is None:
            tables[at] = np.full((roots, group.size), _MASK, np.uint64)
        step = group.steps[group.features.index(split.feature)]
        left = split.left[np.arange(group.size) // step % len(split.left)]
        tables[at][number] &= np.where(left, ~below[1], ~below[0])
        return below[0] | below[1]

    def __call__(self, codes: Sequence[np.ndarray], rows: int) -> np.ndarray:
        """Places in ``ends``, in an array that the next use overwrites."""
        place, index = _ROOM("place", rows), _ROOM("index", rows)
        word, other, number = _ROOM("word", rows, np.uint64), _ROOM("other", rows, np.uint64), _ROOM("number", rows, np.float64)
        place[:] = 0
        for starts, whole, tables in self.stages:
            whole.take(place, out=word, mode="clip")
            for group, code, table in zip(self.groups, codes, tables, strict=True):
                if table is None:
                    continue
                if len(starts) > 1:
                    np.multiply(place, group.size, out=index)
                    np.add(index, code, out=index)
                else:
                    np.copyto(index, code)
                table.ravel().take(index, out=other, mode="clip")
                np.bitwise_and(word, other, out=word)
            # the one bit left is a power of two, whose exponent is its place
            np.copyto(number, word, casting="unsafe")
            np.right_shift(number.view(np.int64), 52, out=index)
            np.subtract(index, 1023, out=index)
            if len(starts) > 1:
                starts.take(place, out=other.view(np.int64), mode="clip")
                np.add(index, other.view(np.int64), out=index)
            np.copyto(place, index)
        return place


class Room:
    """Arrays that a worker uses again for each block: new ones would have their pages made each time."""

    def __init__(self):
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, rows: int, kind: type = np.int64) -> np.ndarray:
        size = rows * np.dtype(kind).itemsize
        if name not in self._held or len(self._held[name]) < size:
            self._held[name] = np.empty(size, np.uint8)
        return self._held[name][:size].view(kind)


_ROOM = Room()


class Model(NamedTuple):
    """Trees with their weights in the sum."""

    bins: Bins
    features: tuple[str, ...]
    trees: tuple[Tree, ...]
    weights: tuple[float, ...]
    logistic: bool

    def importances(self) -> list[float]:
        """Each feature's share of the gains, by the weight of the rows that gained."""
        totals = np.zeros(len(self.features))
        for tree in self.trees:
            for split in tree.splits.values():
                totals[split.feature] += split.gain * sum(split.sides)
        return (totals / totals.sum() if totals.sum() else totals).tolist()

    def score(self, rows: DataFrame, into: str) -> DataFrame:
        """``label`` and what the trees say of each row: a number, or the probability of 1."""
        bins, trees, weights, logistic = self.bins, self.trees, self.weights, self.logistic

        def scored(batches):
            import pyarrow as pa

            finders = [_Finder(tree.splits, bins) for tree in trees]
            values = [_values(tree, finder) * weight for tree, finder, weight in zip(trees, finders, weights, strict=True)]
            for batch in batches:
                columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(batch.num_columns)]
                codes, total = bins.codes(columns[1:]), np.zeros(batch.num_rows)
                for finder, own in zip(finders, values, strict=True):
                    total += own[finder(codes, batch.num_rows)]
                if logistic:
                    with np.errstate(over="ignore"):
                        total = 1 / (1 + np.exp(-2 * total))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(total)], ["label", into])

        chosen = rows.select("label", *[F.col(name).cast("double").alias(f"f{n}") for n, name in enumerate(self.features)])
        return chosen.mapInArrow(scored, f"label double, {into} double")


def _values(tree: Tree, finder: _Finder) -> np.ndarray:
    return np.array([tree.values[end] for end in finder.ends])


# --- blocks of rows on the executors -----------------------------------------


class Plan(NamedTuple):
    """What tasks need to know of a fit."""

    training: str
    fit: str
    bins: Bins
    loss: Loss
    rate: float  # of the rows that a tree draws
    shrinkage: float
    seed: int


class Block(NamedTuple):
    part: int  # the partition its rows come from
    first: int  # how many rows of that come before
    rows: int


def _packed(bins: Bins, loss: Loss) -> Callable[[Iterable], Iterator]:
    """Blocks of the rows of a partition, in their order."""

    def pack(batches):
        import pyarrow as pa

        part, first, waiting, held = TaskContext.get().partitionId(), 0, [], 0

        def block():
            nonlocal first, waiting, held
            rows = held
            label = np.concatenate([own[0] for own in waiting])
            codes = [np.concatenate(own) for own in zip(*(own[1] for own in waiting), strict=True)]
            body = b"".join([loss.target(label).astype(np.float64).tobytes(), *(code.tobytes() for code in codes)])
            made = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([rows], pa.int64()), pa.array([body], pa.binary())],
                ["part", "first", "rows", "body"],
            )
            first, waiting, held = first + rows, [], 0
            return made

        for batch in batches:
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(batch.num_columns)]
            at = 0
            while at < batch.num_rows:
                until = min(batch.num_rows, at + BLOCK_ROWS - held)
                waiting.append((columns[0][at:until], bins.codes([column[at:until] for column in columns[1:]])))
                held += until - at
                at = until
                if held == BLOCK_ROWS:
                    yield block()
        if held:
            yield block()

    return pack


def _home(training: str) -> str:
    """This executor's folder, among those that Spark deletes when the executor ends."""
    return f"{os.environ['SPARK_LOCAL_DIRS'].split(',')[0]}/flowgauge-trees-{training}"


def _path(plan: Plan, block: Block, kind: str, tree: int | None = None) -> str:
    return f"{_home(plan.training)}/{block.part}-{block.first}{'' if tree is None else f'-{plan.fit}-{tree}'}.{kind}"


def _put(path: str, data: bytes | np.ndarray) -> None:
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as file:
        file.write(data)
    os.replace(draft, path)  # of two tasks that write the same one comes after the other


def _drop(path: str) -> None:
    with contextlib.suppress(FileNotFoundError):
        os.remove(path)


def _stored(training: str) -> Callable[[Iterable], Iterator[list[tuple]]]:
    def store(rows):
        os.makedirs(_home(training), exist_ok=True)
        blocks = []
        for row in rows:
            block = Block(row["part"], row["first"], row["rows"])
            _put(f"{_home(training)}/{block.part}-{block.first}.rows", bytes(row["body"]))
            blocks.append(tuple(block))
        yield blocks

    return store


def _read(file: BinaryIO, into: np.ndarray) -> np.ndarray:
    file.readinto(memoryview(into).cast("B"))
    return into


def _read_codes(file: BinaryIO, bins: Bins, rows: int) -> list[np.ndarray]:
    return [_read(file, _ROOM(f"codes{at}", rows, _code_type(group))) for at, group in enumerate(bins.groups())]


def _begin(plan: Plan, block: Block, number: int, before: Sequence[Tree], finders: dict) -> None:
    """Writes what tree ``number`` learns from a block. ``before`` are the trees before it, or only the last of them."""
    with open(_path(plan, block, "rows"), "rb") as file:
        target, codes = _read(file, _ROOM("target", block.rows, np.float64)), _read_codes(file, plan.bins, block.rows)
    residual = target
    if number:
        prediction, first = _ROOM("sum", block.rows, np.float64), number - len(before)
        if first:
            with open(_path(plan, block, "sum", number - 1), "rb") as file:
                _read(file, prediction)
        else:
            prediction[:] = 0
        for tree, own in enumerate(before, first):
            if tree not in finders:
                finder = _Finder(own.splits, plan.bins)
                finders[tree] = finder, _values(own, finder) * (plan.shrinkage if tree else 1.0)
            finder, values = finders[tree]
            place = finder(codes, block.rows)
            np.add(prediction, values.take(place, out=_ROOM("other", block.rows, np.float64), mode="clip"), out=prediction)
        _put(_path(plan, block, "sum", number), prediction)
        residual = plan.loss.residual(target, prediction)
    if plan.rate < 1:
        drawn = bagged(block.rows, block.first, plan.rate, plan.seed + number + block.part + 1)
        residual = residual[drawn]
        _put(_path(plan, block, "codes", number), b"".join(code[drawn].tobytes() for code in codes))
    # last, as this file says that the others are there
    _put(_path(plan, block, "learnt", number), residual)
    for kind in ("sum", "codes", "learnt"):
        _drop(_path(plan, block, kind, number - 2))


def _add(tables: list[np.ndarray], plan: Plan, block: Block, number: int, finder: _Finder, nodes: Sequence[int]) -> None:
    """Adds the weights and the weighted residuals of a block to those of each node and code, in a table for each group."""
    with open(_path(plan, block, "learnt", number), "rb") as file:
        rows = os.fstat(file.fileno()).st_size // 8
        residual = _read(file, _ROOM("learnt", rows, np.float64))
    with open(_path(plan, block, "codes", number) if plan.rate < 1 else _path(plan, block, "rows"), "rb") as file:
        file.seek(0 if plan.rate < 1 else 8 * block.rows)
        codes = _read_codes(file, plan.bins, rows)
    weight, weighted = plan.loss.weighted(residual)
    active = np.full(len(finder.ends), len(nodes), np.int64)
    for at, node in enumerate(nodes):
        active[finder.ends.index(node)] = at
    dense = active.take(finder(codes, rows), out=_ROOM("number", rows), mode="clip")
    index = _ROOM("index", rows)
    for table, group, code in zip(tables, plan.bins.groups(), codes, strict=True):
        np.multiply(dense, group.size, out=index)
        np.add(index, code, out=index)
        for own, values in zip(table, (weight, weighted), strict=True):
            own += np.bincount(index, weights=values, minlength=(len(nodes) + 1) * group.size)[: own.size]


def _level(plan: Plan, number: int, before: Sequence[Tree], splits: Splits, nodes: Sequence[int], placed: Sequence[tuple]) -> np.ndarray:
    """The weight and the weighted residuals of each node's rows in each bin, for the blocks of a task and a level of tree ``number``.

    Fails if the executor lacks a file of a block.
    """
    finder, finders, bins = _Finder(splits, plan.bins), {}, plan.bins
    tables = [np.zeros((2, len(nodes) * group.size)) for group in bins.groups()]
    for own in placed:
        block = Block(*own)
        if not os.path.exists(_path(plan, block, "learnt", number)):
            _begin(plan, block, number, before, finders)
        _add(tables, plan, block, number, finder, nodes)
    sizes, starts = bins.sizes, bins.starts
    found = np.zeros((2, len(nodes), starts[-1]))
    # a feature without splits has the sums of the nodes
    found[:, :, [starts[feature] for feature, size in enumerate(sizes) if size == 1]] = tables[0].reshape(2, len(nodes), -1).sum(axis=2)[:, :, None]
    for table, group in zip(tables, bins.groups(), strict=True):
        table = table.reshape(2, len(nodes), *(sizes[feature] for feature in group.features))
        for at, feature in enumerate(group.features):
            others = tuple(n + 2 for n in range(len(group.features)) if n != at)
            found[:, :, starts[feature] : starts[feature + 1]] = table.sum(axis=others)
    return found


_shipped: set[str] = set()


def _ship(context: SparkContext) -> None:
    """Gives this package to the executors once, as tasks import their functions from it."""
    package = Path(__file__).parents[1]
    if context.applicationId in _shipped or not package.is_dir():  # in an archive it came with the application
        return
    _shipped.add(context.applicationId)
    place = f"{tempfile.mkdtemp(prefix='flowgauge-')}/{package.name}-package.zip"
    with zipfile.ZipFile(place, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(place)


class Training:
    """Rows to learn from, dealt evenly over tasks and stored beside the executors that run them."""

    def __init__(self, rows: DataFrame, features: Sequence[str], bins: Bins, loss: Loss, count: int):
        context = rows.sparkSession.sparkContext
        _ship(context)
        self.features, self.bins, self.loss, self.name = tuple(features), bins, loss, uuid.uuid4().hex
        chosen = rows.select("label", *[F.col(name).cast("double").alias(f"f{n}") for n, name in enumerate(features)])
        packed = chosen.mapInArrow(_packed(bins, loss), "part int, first long, rows long, body binary")
        self.parts = max(1, min(-(-count // BLOCK_ROWS), context.defaultParallelism))
        self.blocks = packed.repartition(self.parts).rdd
        # these small lists stay with the executors that stored the blocks, which draws the tasks of all passes there
        self.placed = self.blocks.mapPartitions(_stored(self.name)).persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        name = self.name
        self.placed.foreachPartition(lambda _: shutil.rmtree(_home(name), ignore_errors=True))
        self.placed.unpersist()

    def _pass(self, plan: Plan, number: int, trees: Sequence[Tree], splits: Splits, nodes: Sequence[int]) -> np.ndarray:
        last = trees[-1:]

        def near(index: int, lists: Iterable) -> Iterator:
            (blocks,) = lists
            try:
                yield _level(plan, number, last, splits, nodes, blocks), []
            except FileNotFoundError:
                yield 0, [index]

        def anew(lists: Iterable) -> Iterator:
            for blocks in lists:
                yield _level(plan, number, trees, splits, nodes, blocks)

        def joined(one: tuple, other: tuple) -> tuple:
            return one[0] + other[0], one[1] + other[1]

        found = self.placed.mapPartitionsWithIndex(near)
        total, lost = found.treeReduce(joined) if self.parts > MOST_COLLECTED else found.reduce(joined)
        if lost:
            again = self.blocks.mapPartitions(_stored(self.name)).mapPartitions(anew)
            total = total + sum(again.context.runJob(again, list, lost))
        return total

    def boost(self, *, trees: int, depth: int, shrinkage: float, rate: float = 1.0, share: float = 1.0, seed: int) -> Model:
        """``rate`` of the rows are drawn for each tree, and ``share`` of the features for each node."""
        plan = Plan(self.name, uuid.uuid4().hex, self.bins, self.loss, rate, shrinkage, seed)
        grown: list[Tree] = []
        for number in range(trees):
            grown.append(self._grow(plan, number, grown, depth, share))
        return Model(self.bins, self.features, tuple(grown), (1.0, *[shrinkage] * (trees - 1)), self.loss.logistic)

    def _grow(self, plan: Plan, number: int, before: Sequence[Tree], depth: int, share: float) -> Tree:
        draws, splits, values, nodes = _JavaRandom(plan.seed + number), {}, {}, [1]
        wanted = math.ceil(share * len(self.features))
        least = min(1.0, plan.loss.positive) / 2  # less weight is what rounding leaves of no row
        while nodes:
            # MLlib draws for the node that it met last first
            chosen = [_chosen(len(self.features), wanted, draws.next_long()) if share < 1 else range(len(self.features)) for _ in nodes]
            sums = self._pass(plan, number, before, splits, nodes)
            following = []
            for at, (node, split, sides) in enumerate(zip(nodes, *_best_splits(sums, self.bins, chosen, least), strict=True)):
                values.setdefault(node, sides[0])
                if split is not None:
                    splits[node] = split
                    del values[node]
                    values |= {2 * node: sides[1], 2 * node + 1: sides[2]}
                    # one row has no splits, and MLlib draws no features for it
                    following += [child for child, weight in zip((2 * node, 2 * node + 1), split.sides, strict=True) if weight > 3 * least]
            nodes = following[::-1] if nodes[0].bit_length() < depth else []
        return Tree(splits, values)


def _best_splits(sums: np.ndarray, bins: Bins, chosen: Sequence[Iterable[int]], least: float) -> tuple[list, list]:
    """Of each node the split that gains most among its chosen features, if any gains, and the means of the node and of its sides."""
    starts, sizes, nodes = bins.starts, bins.sizes, sums.shape[1]
    whole = sums[:, :, starts[0] : starts[1]].sum(axis=2)
    means = whole[1] / np.maximum(whole[0], least)
    best: list = [None] * nodes
    gains = NOISE * means * means
    allowed = np.zeros((len(sizes), nodes), bool)
    for node, features in enumerate(chosen):
        allowed[list(features), node] = True
    sides = [(mean, mean, mean) for mean in means.tolist()]
    for feature, size in enumerate(sizes):
        if size == 1:
            continue
        weight, total = (kind[:, starts[feature] : starts[feature + 1]] for kind in sums)
        order = None
        if bins.arity[feature]:  # categories in the order of their means
            order = np.argsort(np.where(weight > 0, total / np.where(weight > 0, weight, 1), np.inf), axis=1, kind="stable")
            weight, total = np.take_along_axis(weight, order, 1), np.take_along_axis(total, order, 1)
        weight, total = np.cumsum(weight, axis=1), np.cumsum(total, axis=1)
        left, left_sum = weight[:, :-1], total[:, :-1]
        right, right_sum = weight[:, -1:] - left, total[:, -1:] - left_sum
        valid = (left > least) & (right > least) & allowed[feature][:, None]
        left_mean, right_mean = left_sum / np.where(valid, left, 1), right_sum / np.where(valid, right, 1)
        gain = np.where(valid, left * right / weight[:, -1:].clip(least) ** 2 * (left_mean - right_mean) ** 2, -1)
        place = gain.argmax(axis=1)
        for node in np.flatnonzero(gain[np.arange(nodes), place] > gains * (1 + ROUNDING)).tolist():
            at = place[node]
            gains[node] = gain[node, at]
            goes_left = np.zeros(size, bool)
            goes_left[: at + 1] = True
            if order is not None:
                goes_left[order[node]] = goes_left.copy()
            best[node] = Split(feature, goes_left, float(gain[node, at]), (float(left[node, at]), float(right[node, at])))
            sides[node] = (sides[node][0], float(left_mean[node, at]), float(right_mean[node, at]))
    return best, sides


@contextlib.contextmanager
def training(
    rows: DataFrame, count: int, features: Sequence[str], arity: Mapping[str, int], most_bins: int, seed: int, loss: Loss = Loss()
) -> Iterator[Training]:
    """The ``count`` rows to learn from (``label`` and the features, none null), for as long as the block lasts."""
    if not count:
        raise ValueError("no rows to learn from")
    bins = find_bins(rows, features, arity, most_bins, count, loss, seed)
    held = Training(rows, features, bins, loss, count)
    try:
        yield held
    finally:
        held.release()
