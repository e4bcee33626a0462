"""One tree a round, grown from rows whose values were put into bins once.

A fit of Spark's tree learner looks for candidate splits, bins its rows and runs two stages for every level, each
time anew. Here rows are binned once for a whole run of rounds and kept as arrays, some thousand rows to an
element of an RDD. Tasks sum the histograms of a level's nodes over their rows, the histograms of a node meet in
one shuffle, and its best split comes back. Where one element holds all rows, a round is a single job.

Splits, ties, draws of rows and of columns, and the leaves are those of Spark's learner, down to the order of the
sums where one element holds the rows, so that trees can be compared with its own. Candidate splits are too, for
up to 10,000 rows; of more it takes a sample, here all rows count.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, lru_cache, partial, reduce

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from seasonflow.operators.trees import Inputs, Tree
from seasonflow.session import delete_path, scratch_path

#: Rows of an element, at most, and of a round that is one job.
CHUNK_ROWS = 200_000
#: Times the bins: what a task hands on of a column's values, where there are more rows than ``CHUNK_ROWS``.
POINTS = 8
#: Rounds between two written states.
STORED_EVERY = 25

_LEAST = 2.0**-52
_WORD, _LONG = (1 << 32) - 1, (1 << 64) - 1


# ------------------------------------------------------------------ the draws of Spark's learner


def _murmur(data: bytes, seed: int) -> int:
    """Hash of whole words by the rule of ``scala.util.hashing.MurmurHash3.bytesHash``."""
    turn = lambda x, r: ((x << r) | (x >> (32 - r))) & _WORD
    h = seed & _WORD
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & _WORD
        h = (turn(h ^ (turn(k, 15) * 0x1B873593 & _WORD), 13) * 5 + 0xE6546B64) & _WORD
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & _WORD
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & _WORD
    return h ^ (h >> 16)


def _start(seed: int) -> int:
    """The first state of ``XORShiftRandom(seed)``."""
    data = (seed & _LONG).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return (_murmur(data, low) << 32) | low


def _next(states: np.ndarray) -> np.ndarray:
    """Each state after one step."""
    states = states ^ (states << np.uint64(21))
    states = states ^ (states >> np.uint64(35))
    return states ^ (states << np.uint64(4))


@lru_cache
def _leap(steps: int) -> np.ndarray:
    """What each bit of a state adds to the state so many steps later: a step is linear."""
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(steps):
        bits = _next(bits)
    return bits


def uniforms(seed: int, count: int, steps: int = 512) -> np.ndarray:
    """The first doubles of ``XORShiftRandom(seed)``, from lanes that start ``steps`` apart."""
    lanes = math.ceil(2 * count / steps)
    states = np.empty(lanes, dtype=np.uint64)
    here, ahead = np.uint64(_start(seed)), _leap(steps)
    for i in range(lanes):
        states[i] = here
        here = np.bitwise_xor.reduce(ahead[(here >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1], initial=np.uint64(0))
    drawn = np.empty((lanes, steps), dtype=np.uint64)
    for i in range(steps):
        states = _next(states)
        drawn[:, i] = states
    pairs = drawn.reshape(-1)[: 2 * count].reshape(-1, 2)
    high, low = pairs[:, 0] & np.uint64((1 << 26) - 1), pairs[:, 1] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(float) * 2.0**-53


class Draws:
    """Which columns a node may split on: ``java.util.Random`` seeds one reservoir for each node."""

    def __init__(self, seed: int, columns: int, kept: int):
        self.state, self.columns, self.kept = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), columns, kept

    def _int(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        value = self.state >> 16
        return value - (1 << 32) if value >> 31 else value

    def of_a_node(self) -> list[int]:
        if self.kept == self.columns:
            return list(range(self.columns))
        state = _start((self._int() << 32) + self._int())
        kept = list(range(self.kept))
        for i in range(self.kept, self.columns):
            bits = []
            for size in (26, 27):
                state ^= (state << 21) & _LONG
                state ^= state >> 35
                state ^= (state << 4) & _LONG
                bits.append(state & ((1 << size) - 1))
            at = int(((bits[0] << 27) + bits[1]) * 2.0**-53 * (i + 1))
            if at < self.kept:
                kept[at] = i
        return kept


def columns_kept(share: str, columns: int) -> int:
    """Columns of a node by ``featureSubsetStrategy``, for one tree."""
    named = {"auto": columns, "all": columns, "sqrt": math.sqrt(columns), "log2": max(1.0, math.log2(columns)), "onethird": columns / 3}
    if share in named:
        return math.ceil(named[share])
    if share.isdigit() and int(share):
        return min(int(share), columns)
    if 0 < float(share) <= 1:
        return math.ceil(float(share) * columns)
    raise ValueError(f"featureSubsetStrategy {share}")


# ------------------------------------------------------------------ bins


def candidates(values: np.ndarray, counts: np.ndarray, splits: int) -> np.ndarray:
    """At most so many thresholds between distinct, ordered values: all of them, or those nearest to equal counts."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= splits:
        return middle
    so_far = np.cumsum(counts, dtype=float)
    stride = so_far[-1] / (splits + 1)
    found, target, at = [], stride, 0
    while True:
        # the first value that a step further from the target follows
        at = max(at, int(np.searchsorted(so_far, target)) - 1)
        while at < len(middle) and abs(so_far[at] - target) >= abs(so_far[at + 1] - target):
            at += 1
        if at >= len(middle):
            return np.array(found)
        found.append(middle[at])
        target, at = target + stride, at + 1


def thinned(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most so many ordered values that stand for all of them, each for about as many rows."""
    if len(values) <= most:
        return values, counts
    upto = np.cumsum(counts)
    last = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], most + 1)[1:]).clip(max=len(values) - 1))
    return values[last], np.diff(upto[last], prepend=0)


@dataclass(frozen=True)
class Bins:
    """Thresholds of every column; a nominal one has a bin for each value."""

    thresholds: tuple[np.ndarray, ...]
    categories: tuple[int, ...]  # 0: a number

    @classmethod
    def of(cls, rows: DataFrame, inputs: Inputs, count: int, bins: int) -> Bins:
        """From all rows of ``rows`` (the columns of :meth:`Inputs.numbers`, in order): each task hands on the
        distinct values of each column, or what stands for them, and those of a column meet in one task."""
        categories = tuple(len(inputs.values[c]) + 1 if c in inputs.values else 0 for c in inputs.columns)
        room = min(bins, count)
        if max(categories, default=0) > room:
            raise ValueError(f"{count} rows and {bins} bins are too few for {max(categories)} categories")
        most = POINTS * bins if count > CHUNK_ROWS else count

        def distinct(batches):
            import pyarrow as pa

            seen: list[list] = [[] for _ in categories]

            def merged(i):
                values, at = np.unique(np.concatenate([v for v, _ in seen[i]]), return_inverse=True)
                return thinned(values, np.bincount(at, np.concatenate([n for _, n in seen[i]])), most)

            for batch in batches:
                for i, c in enumerate(categories):
                    if batch.num_rows and not c:
                        seen[i].append(np.unique(_numbers(batch.column(i)), return_counts=True))
                        if len(seen[i]) > 32:
                            seen[i] = [merged(i)]
            held = [i for i, parts in enumerate(seen) if parts]
            both = [merged(i) for i in held]
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(held, "int32"), "v": pa.array([v for v, _ in both], pa.list_(pa.float64())), "n": pa.array([n for _, n in both], pa.list_(pa.float64()))}
            )

        def thresholds(group: pd.DataFrame) -> pd.DataFrame:
            values, at = np.unique(np.concatenate(group["v"].to_list()), return_inverse=True)
            found = candidates(values, np.bincount(at, np.concatenate(group["n"].to_list())), room - 1)
            return pd.DataFrame({"i": [int(group["i"].iloc[0])], "t": [found.tolist()]})

        met = rows.mapInArrow(distinct, "i int, v array<double>, n array<double>").groupBy("i").applyInPandas(thresholds, "i int, t array<double>")
        found = {r["i"]: np.array(r["t"], dtype=float) for r in met.collect()}  # as many numbers as there are bins
        return cls(tuple(found.get(i, np.empty(0)) for i in range(len(categories))), categories)

    @cached_property
    def sizes(self) -> list[int]:
        return [c or len(t) + 1 for c, t in zip(self.categories, self.thresholds)]

    def codes(self, matrix: np.ndarray) -> np.ndarray:
        """The bin of every number, a row for each column."""
        out = np.empty(matrix.shape[::-1], dtype=np.uint8 if max(self.sizes, default=0) <= 256 else np.uint16)
        for i, (t, c) in enumerate(zip(self.thresholds, self.categories)):
            out[i] = matrix[:, i] if c else np.searchsorted(t, matrix[:, i])
        return out


def _numbers(column) -> np.ndarray:
    found = column.to_numpy(zero_copy_only=False)
    if not np.isfinite(found.astype(float)).all():
        raise ValueError("a number that is not finite")
    return found


# ------------------------------------------------------------------ nodes and their splits


def impurity(n: float, s: float, q: float) -> float:
    """The variance of labels by their count, their sum and the sum of their squares."""
    return (q - (s * s) / n) / n if n else 0.0


@dataclass
class Node:
    """A node of a tree under growth: ``n``, ``s`` and ``q`` count and sum its labels and their squares."""

    columns: list[int] = field(default_factory=list)
    sums: tuple[float, float, float] | None = None  # of the root: as the first split shows them
    column: int = -1
    split: int = -1
    left_bins: list[int] = field(default_factory=list)
    gain: float = 0.0
    left: int = -1  # the right child comes after it


def best_splits(nodes: Sequence[Node], sums: Callable[[int], Sequence[np.ndarray]], bins: Bins, least: int) -> list[tuple]:
    """For each node ``gain, column, split, bins that go left, sums of the left and of the right, own sums``, from
    ``sums(column)``: counts, sums and sums of squares by node and bin."""
    sizes = bins.sizes
    width = len(sizes)
    gains, places = np.full((len(nodes), width), -np.inf), np.zeros((len(nodes), width), dtype=int)
    below: dict[int, tuple] = {}
    own = [node.sums for node in nodes]
    parent = np.array([impurity(*o) if o else 0.0 for o in own])[:, None]
    whole: list[tuple] = []
    # the root's impurity is that of the parts of the first split that is looked at
    used = list(dict.fromkeys(c for node in nodes for c in node.columns))
    for column in [c for c in used if sizes[c] > 1] or used[:1]:
        n, s, q = sums(column)
        order = None
        if bins.categories[column]:
            with np.errstate(divide="ignore", invalid="ignore"):
                centre = np.where(n == 0, np.finfo(float).max, s / n)
            order = np.argsort(centre, axis=1, kind="stable")
            n, s, q = (np.take_along_axis(x, order, axis=1) for x in (n, s, q))
        n, s, q = (np.cumsum(x, axis=1) for x in (n, s, q))
        if not whole:
            whole = list(zip(n[:, -1].tolist(), s[:, -1].tolist(), q[:, -1].tolist()))
        if sizes[column] < 2:
            continue
        left = [x[:, :-1] for x in (n, s, q)]
        right = [x[:, -1:] - x[:, :-1] for x in (n, s, q)]
        for k, known in enumerate(own):
            if known is None and column in nodes[k].columns:
                own[k] = tuple(float(a[k, 0] + b[k, 0]) for a, b in zip(left, right))
                parent[k] = impurity(*own[k])
        total = n[:, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            one, other = ((q - (s * s) / n) / n for n, s, q in (left, right))
            gain = parent - left[0] / total * one - right[0] / total * other
            gain[(left[0] < least) | (right[0] < least) | ~(gain >= 0)] = -np.inf
        at = gain.argmax(axis=1)
        rows = np.arange(len(nodes))
        gains[:, column], places[:, column] = gain[rows, at], at
        below[column] = (order, [x[rows, at] for x in left], [x[rows, at] for x in right])
    found = []
    for k, node in enumerate(nodes):
        mine = own[k] or whole[k]
        able = [c for c in node.columns if c in below]
        column = able[int(np.argmax(gains[k, able]))] if able else -1
        if column < 0 or gains[k, column] <= 0:
            found.append((0.0, -1, -1, [], None, None, mine))
            continue
        order, left, right = below[column]
        at = int(places[k, column])
        sent = list(range(at + 1)) if order is None else sorted(order[k, : at + 1].tolist())
        found.append((float(gains[k, column]), column, at, sent, tuple(float(x[k]) for x in left), tuple(float(x[k]) for x in right), mine))
    return found


class Router:
    """Where the rows of binned columns stand in a tree under growth."""

    def __init__(self, nodes: Sequence[Node], bins: Bins):
        size = max(bins.sizes, default=1)
        self.column = np.array([node.column for node in nodes])
        self.left = np.array([node.left for node in nodes])
        self.goes = np.zeros((len(nodes), size), dtype=bool)
        for i, node in enumerate(nodes):
            self.goes[i, node.left_bins] = True

    def step(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One level down, for rows that stand in a split node."""
        column = self.column[at]
        inner = np.flatnonzero(column >= 0)
        here = at[inner]
        out = at.copy()
        out[inner] = self.left[here] + ~self.goes[here, codes[column[inner], inner]]
        return out


@dataclass(frozen=True)
class Growth:
    """How a round's tree is grown."""

    bins: Bins
    seed: int
    depth: int
    least: int
    row_share: float
    kept: int
    first: bool  # the labels are the targets, else twice what is left of them

    def tree(self, weight: float, splits: Callable[[list[Node], list[int]], list[tuple]]) -> tuple[Tree, list[Node], np.ndarray]:
        """The tree, its nodes, and the leaf of each node; ``splits`` gives the best ones of the listed nodes."""
        draws = Draws(self.seed, len(self.bins.sizes), self.kept)
        nodes, wanted = [Node()], [0]
        for level in range(self.depth + 1):
            if not wanted:
                break
            for i in wanted:
                nodes[i].columns = draws.of_a_node()
            below = []
            for i, (gain, column, split, sent, left, right, own) in zip(wanted, splits(nodes, wanted)):
                node = nodes[i]
                node.sums = node.sums or own
                if column < 0 or level == self.depth:
                    continue
                node.gain, node.column, node.split, node.left_bins, node.left = gain, column, split, sent, len(nodes)
                for part in (left, right):
                    nodes.append(Node(sums=part))
                    if level + 1 < self.depth and abs(impurity(*part)) >= _LEAST:
                        below.append(len(nodes) - 1)
            wanted = below[::-1]
        return self._written(nodes, weight)

    def _written(self, nodes: list[Node], weight: float) -> tuple[Tree, list[Node], np.ndarray]:
        """Nodes from the root on, where two leaves of one value are one; leaves from left to right."""
        mean = [node.sums[1] / node.sums[0] if node.sums[0] else 0.0 for node in nodes]
        value: list[float | None] = [None] * len(nodes)  # of what is a leaf
        for i in reversed(range(len(nodes))):
            node = nodes[i]
            if node.column < 0:
                value[i] = mean[i]
            elif value[node.left] is not None and value[node.left] == value[node.left + 1]:
                value[i] = value[node.left]
        tree = Tree(weight, [], [], [], [], [], [], [])
        leaf, gain, leaves = np.zeros(len(nodes), dtype=np.int64), np.zeros(len(self.bins.sizes)), 0
        todo = [(0, None, False)]
        while todo:
            i, parent, inside = todo.pop()
            node = nodes[i]
            if inside:  # below a leaf
                leaf[i] = leaves - 1
                if node.column >= 0:
                    todo += [(node.left + 1, None, True), (node.left, None, True)]
                continue
            here = len(tree.feature)
            if parent:
                parent[1][parent[0]] = here
            split = value[i] is None
            nominal = split and self.bins.categories[node.column] > 0
            tree.feature.append(node.column if split else -1)
            tree.threshold.append(float(self.bins.thresholds[node.column][node.split]) if split and not nominal else 0.0)
            tree.left_categories.append(list(node.left_bins) if nominal else [])
            tree.value.append(0.0 if split else float(value[i]))
            tree.left_child.append(-1)
            tree.right_child.append(-1)
            if split:
                gain[node.column] += node.gain * node.sums[0]
                todo += [(node.left + 1, (here, tree.right_child), False), (node.left, (here, tree.left_child), False)]
            else:
                leaf[i] = leaves
                leaves += 1
                if node.column >= 0:
                    todo += [(node.left + 1, None, True), (node.left, None, True)]
        return replace(tree, gain=(gain / gain.sum() if gain.sum() else gain).tolist()), nodes, leaf


# ------------------------------------------------------------------ rows in tasks


@dataclass(frozen=True)
class Grown:
    """A round's tree before its step: the sums of what was left, by leaf and by whether a row only decides how many."""

    tree: Tree
    sums: dict[tuple[int, bool], tuple[int, float, float]]


@dataclass
class Learned:
    """The rows of a chunk that a round learns from: their places, bins, labels and squared labels."""

    rows: np.ndarray
    codes: np.ndarray
    label: np.ndarray
    square: np.ndarray

    def histograms(self, bins: Bins, at: np.ndarray, wanted: Sequence[int], nodes: int) -> Callable[[int], list[np.ndarray]]:
        """The sums of a column by wanted node and bin, as :func:`best_splits` asks for them; ``at`` has the node of
        every row of the chunk."""
        number = np.full(nodes, len(wanted))  # rows elsewhere are a group that is left out
        number[wanted] = np.arange(len(wanted))
        node = number[at[self.rows]]
        starts: dict[int, np.ndarray] = {}

        def of(column: int) -> list[np.ndarray]:
            size = bins.sizes[column]
            if size not in starts:
                starts[size] = node * size
            cell, cells = starts[size] + self.codes[column], (len(wanted) + 1) * size
            return [np.bincount(cell, w, cells).reshape(-1, size)[:-1] for w in (None, self.label, self.square)]

        return of


@dataclass
class Chunk:
    """Binned rows of a task and their prediction so far."""

    place: int
    codes: np.ndarray
    target: np.ndarray
    val: np.ndarray
    so_far: np.ndarray
    grown: Grown | None = None

    def learned(self, growth: Growth) -> Learned:
        rows = np.flatnonzero(~self.val)
        if growth.row_share < 1:
            rows = rows[uniforms(growth.seed + self.place + 1, len(rows)) < growth.row_share]
        label = self.target[rows] if growth.first else 2 * (self.target[rows] - self.so_far[rows])
        return Learned(rows, self.codes.take(rows, axis=1), label, label * label)

    def leaf_sums(self, leaf: np.ndarray) -> dict[tuple[int, bool], tuple[int, float, float]]:
        gap = self.target - self.so_far
        gap = np.where(np.isnan(gap), 0.0, gap)
        most = int(leaf.max(initial=0)) + 1
        out = {}
        for val in (False, True):
            mine = self.val == val
            n, s, q = (np.bincount(leaf[mine], w, most) for w in (None, gap[mine], gap[mine] * gap[mine]))
            out |= {(i, val): (int(n[i]), float(s[i]), float(q[i])) for i in np.flatnonzero(n).tolist()}
        return out

    def moved(self, tree: Tree, leaf: np.ndarray) -> Chunk:
        values = np.array([tree.value[i] for i in tree.leaves])
        return replace(self, so_far=self.so_far + tree.weight * values[leaf], grown=None)

    def standing(self, growth: Growth, nodes: Sequence[Node]) -> np.ndarray:
        """The node of each row, from the root on."""
        router, at = Router(nodes, growth.bins), np.zeros(len(self.target), dtype=np.int64)
        for _ in range(growth.depth):
            below = router.step(self.codes, at)
            if (below == at).all():
                break
            at = below
        return at


#: From the tree of a round and its leaves' sums to the tree with the values of its leaves.
Valued = Callable[[Grown], Tree]


def whole_round(growth: Growth, weight: float, valued: Valued, chunk: Chunk) -> Chunk:
    """A round where one chunk holds all rows."""
    learned = chunk.learned(growth)
    at = np.zeros(len(chunk.target), dtype=np.int64)

    def splits(nodes: list[Node], wanted: list[int]) -> list[tuple]:
        nonlocal at
        at = Router(nodes, growth.bins).step(chunk.codes, at)
        return best_splits([nodes[i] for i in wanted], learned.histograms(growth.bins, at, wanted, len(nodes)), growth.bins, growth.least)

    tree, nodes, leaf = growth.tree(weight, splits)
    at = Router(nodes, growth.bins).step(chunk.codes, at)
    grown = Grown(tree, chunk.leaf_sums(leaf[at]))
    return replace(chunk.moved(valued(grown), leaf[at]), grown=grown)


def _of_nodes(growth: Growth, nodes: list[Node], wanted: list[int], chunk: Chunk):
    """``node, (place, the sums of its columns beside each other)`` of a chunk."""
    sums = chunk.learned(growth).histograms(growth.bins, chunk.standing(growth, nodes), wanted, len(nodes))
    found = {c: np.stack(sums(c)) for c in {c for i in wanted for c in nodes[i].columns}}
    for k, i in enumerate(wanted):
        yield i, (chunk.place, np.concatenate([found[c][:, k] for c in nodes[i].columns], axis=1))


def _met(growth: Growth, nodes: list[Node], node: tuple) -> tuple:
    """The best split of a node whose sums have met, added up in the order of the chunks."""
    i, parts = node
    whole = reduce(np.add, [found for _, found in sorted(parts, key=lambda p: p[0])])
    upto = np.cumsum([growth.bins.sizes[c] for c in nodes[i].columns])
    columns = dict(zip(nodes[i].columns, np.split(whole, upto[:-1], axis=1)))
    return i, best_splits([nodes[i]], lambda c: [x[None] for x in columns[c]], growth.bins, growth.least)[0]


def _leaves_of(growth: Growth, nodes: list[Node], leaf: np.ndarray, chunk: Chunk):
    for at, sums in chunk.leaf_sums(leaf[chunk.standing(growth, nodes)]).items():
        yield at, (chunk.place, sums)


def _leaf_met(parts) -> tuple[int, float, float]:
    n, s, q = zip(*[sums for _, sums in sorted(parts)])
    return sum(n), sum(s), sum(q)


def _moved(growth: Growth, nodes: list[Node], leaf: np.ndarray, tree: Tree, chunk: Chunk) -> Chunk:
    return chunk.moved(tree, leaf[chunk.standing(growth, nodes)])


class BinnedRows:
    """Rows of a boosting run, held by the executors and written to the shared folder every few rounds, so a lost
    executor costs these rounds at most."""

    def __init__(self, dealt: DataFrame, inputs: Inputs, bins: Bins, parts: int, each: int):
        """``dealt`` has the columns of :meth:`Inputs.numbers` in order, then ``target, _val, so_far``, in
        ``parts`` partitions of which ``each`` make a chunk."""
        width = len(inputs.columns)

        def binned(batches):
            import pyarrow as pa

            columns = [[] for _ in range(width + 3)]
            for batch in batches:
                for i in range(width + 3):
                    columns[i].append(batch.column(i).to_numpy(zero_copy_only=False))
            rows = [np.concatenate(c) if c else np.empty(0) for c in columns]
            target, val, so_far = rows[width].astype(float), rows[width + 1].astype(bool), rows[width + 2].astype(float)
            if not np.isfinite(target[~val]).all():
                raise ValueError("a target that is missing or not finite")
            raw = np.column_stack([r.astype(float) for r in rows[:width]]) if width else np.empty((len(target), 0))
            place = TaskContext.get().partitionId()
            chunk = Chunk(place, bins.codes(inputs.matrix(raw)), target, val, so_far)
            yield pa.RecordBatch.from_pydict({"place": pa.array([place], "int32"), "chunk": [pickle.dumps(chunk)]})

        def joined(parts) -> Chunk:
            found = sorted((pickle.loads(p) for p in parts), key=lambda c: c.place)
            together = lambda name, axis=0: np.concatenate([getattr(c, name) for c in found], axis=axis)
            return Chunk(found[0].place // each, together("codes", 1), together("target"), together("val"), together("so_far"))

        chunks = dealt.mapInArrow(binned, "place int, chunk binary").rdd.map(lambda r: (r["place"] // each, bytes(r["chunk"])))
        self.bins, self.spark, self.path, self.rounds = bins, dealt.sparkSession, None, 0
        self.chunks = math.ceil(parts / each)
        self.now = self._stored(chunks.groupByKey(self.chunks).values().map(joined))
        self.before: list[RDD] = []

    def _stored(self, rows: RDD) -> RDD:
        path = scratch_path(self.spark, "rounds")
        rows.saveAsPickleFile(path)
        if self.path:
            delete_path(self.spark, self.path)
        self.path = path
        return self.spark.sparkContext.pickleFile(path, self.chunks).persist(StorageLevel.MEMORY_AND_DISK)

    def round(self, growth: Growth, weight: float, valued: Valued) -> Grown:
        """Grows a tree and takes its step on all rows."""
        if self.chunks == 1:
            after = self.now.map(partial(whole_round, growth, weight, valued)).persist(StorageLevel.MEMORY_AND_DISK)
            grown = after.map(lambda c: c.grown).collect()[0]
            self.before.append(self.now)
            self._free()
        else:
            grown, nodes, leaf = self._by_levels(growth, weight)
            after = self.now.map(partial(_moved, growth, nodes, leaf, valued(grown))).persist(StorageLevel.MEMORY_AND_DISK)
            self.before.append(self.now)
        self.now, self.rounds = after, self.rounds + 1
        if self.rounds % STORED_EVERY == 0:
            self.before.append(self.now)
            self.now = self._stored(self.now)
            self._free()
        return grown

    def _by_levels(self, growth: Growth, weight: float) -> tuple[Grown, list[Node], np.ndarray]:
        def splits(nodes: list[Node], wanted: list[int]) -> list[tuple]:
            met = self.now.flatMap(partial(_of_nodes, growth, nodes, wanted)).groupByKey(min(self.chunks, len(wanted)))
            found = met.map(partial(_met, growth, nodes)).collectAsMap()  # one split of each node
            self._free()  # the rows that came after are held by now
            return [found[i] for i in wanted]

        tree, nodes, leaf = growth.tree(weight, splits)
        sums = self.now.flatMap(partial(_leaves_of, growth, nodes, leaf)).groupByKey(1).mapValues(_leaf_met)
        return Grown(tree, sums.collectAsMap()), nodes, leaf  # two rows for each leaf

    def _free(self) -> None:
        for rows in self.before:
            rows.unpersist()
        self.before.clear()

    def close(self) -> None:
        self.before.append(self.now)
        self._free()
        delete_path(self.spark, self.path)


class TreeOfRounds(RandomForestRegressor):
    """Spark's tree learner by its parameters, for :class:`BinnedRows`: a fit is one round."""

    #: The tree's share in the sum, whether it stands for the level, and what gives its leaves their values.
    weight: float = 1.0
    first: bool = True
    valued: Valued = None

    def _fit(self, dataset: BinnedRows) -> Grown:
        kept = columns_kept(self.getFeatureSubsetStrategy(), len(dataset.bins.sizes))
        growth = Growth(dataset.bins, self.getSeed(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getSubsamplingRate(), kept, self.first)
        return dataset.round(growth, self.weight, self.valued)
