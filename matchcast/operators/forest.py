"""Forests grown level by level from histograms that all trees of all fits share.

Rows are binned and packed once (``binning``). While a node has many rows, its split comes from one aggregate over
(tree, node, feature, bin) for many trees of all fits at once; the rows follow the splits found so far from the root, so
nothing is written between levels. Nodes of at most ``gather`` rows are brought together, a node and tree
a group, and finished there; a fit whose rows are that few begins there, several trees a group. Draws depend on the row's
key, the tree and the node, so the trees are the same wherever a node is split. Who asks for importances alone
(``gains_only``) gets each group's gains by feature, not its nodes, which for a deep forest outweigh the table many times.

Rows that a fit does not learn from can ride along: they follow the splits and are scored without the forest being
sent anywhere. A shallower tree, one with a higher ``min_samples_split`` and a forest of fewer trees are parts of what is
grown anyway, so one growth scores them all (``Shape.parts``).

A forest of few nodes is a model on the driver, told to every executor. A larger one stays the written rows that its groups gave
(``Spread``): what it scores goes down the trees' tops and meets, group by group, what was grown below them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchcast.durable import durable
from matchcast.functions.hashing import POISSON_ONE
from matchcast.operators.binning import Blocks, Rows, Sample, binned, binned_blocks

# Tasks get this module's helpers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GATHER = 1 << 17
CHUNK = 1 << 17  # rows of a task that share a histogram
WAVE = 1 << 27  # rows times trees that are brought together at once: about 5 GB of shuffle
MOST_TREES = 50  # that one group grows
DEEPEST = 60  # levels; a node is named by the turns that lead to it, in one long
SPLITS_HELD = 1 << 20  # nodes of a level that the driver holds and tells to the rows: about 60 MB
HELD_NODES = 1 << 20  # of a forest that the driver holds and tells to every executor: about 30 MB
MET_ROWS = 1 << 20  # scored rows that meet a part of a tree in one group
EXACT = float(1 << 40)  # values of a spread forest are whole numbers of its parts, whose sums depend on no order
ROOT = 1


@dataclass(frozen=True)
class Shape:
    """One forest of a pool: its trees, the rows it learns from and those it scores."""

    trees: int = 100
    seed: int = 42
    depth: int | None = None
    leaf: int = 1
    split: int = 2
    per_split: int | None = None  # features looked at for a split, all if None
    columns: tuple[int, ...] | None = None  # features it may use, all if None
    sample: Sample = Sample()
    scored: int | None = None  # scores the rows with this mark
    bootstrap: bool = True
    parts: tuple[tuple[int | None, int, int], ...] = ()  # depth, split and trees of what is scored

    @property
    def deepest(self) -> int:
        return DEEPEST if self.depth is None else min(self.depth, DEEPEST)

    def learns(self, mark: np.ndarray) -> np.ndarray:
        return self.sample.learns(mark)

    def rides(self, mark: np.ndarray) -> np.ndarray:
        return np.zeros(len(mark), bool) if self.scored is None else mark == self.scored

    def limits(self) -> list[tuple[int, int, int]]:
        return [(DEEPEST if d is None else d, s, t) for d, s, t in self.parts]


def per_split(kind: str | None, width: int) -> int:
    """How many features a split looks at."""
    return max(1, int({"sqrt": math.sqrt(width), "log2": math.log2(width), None: width}[kind]))


# --- keyed draws -----------------------------------------------------------------------------


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every number (SplitMix64's last steps)."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tree_key(seed: int, tree: int) -> np.ndarray:
    return scrambled(scrambled(np.array([seed], np.int64).view(np.uint64)) ^ np.uint64(tree))


def child_keys(keys: np.ndarray) -> np.ndarray:
    """The keys of all left and right children, side by side."""
    return np.stack([scrambled(keys ^ np.uint64(1)), scrambled(keys ^ np.uint64(2))], axis=1).ravel()


def node_keys(root: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Keys of nodes that are named by their path: 1 is the root, 2n and 2n + 1 are the children of n."""
    found = np.empty(len(nodes), np.uint64)
    for i, node in enumerate(nodes.tolist()):
        key = root
        for turn in bin(node)[3:]:
            key = scrambled(key ^ np.uint64(1 + int(turn)))
        found[i] = key[0]
    return found


def drawn_columns(keys: np.ndarray, columns: np.ndarray, most: int) -> np.ndarray:
    """For each node the features its split looks at, ascending."""
    if most >= len(columns):
        return np.broadcast_to(columns, (len(keys), len(columns)))
    lots = scrambled(keys[:, None] ^ scrambled(columns.astype(np.uint64))[None, :])
    return np.sort(columns[np.argpartition(lots, most - 1, axis=1)[:, :most]], axis=1)


def row_weights(rows: Rows, shape: Shape, tree: int, mixed: np.ndarray | None = None) -> np.ndarray:
    """How often the tree counts each row it may learn from: its weight times its Poisson(1) draws.

    ``mixed`` has the scrambled keys, for who asks for many trees.
    """
    weight = shape.sample.weights(rows)
    if shape.bootstrap:
        lot = scrambled((scrambled(rows.key.view(np.uint64)) if mixed is None else mixed) ^ tree_key(shape.seed, tree))
        u = (lot >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        weight = weight * np.searchsorted(POISSON_ONE, u, side="left")
    return weight


# --- one group -------------------------------------------------------------------------------


class Sums:
    """Sums of rows by node or cell: how many, their weight and their weighted labels.

    Whole numbers stand side by side, three or two in a double that holds their sums exactly, so that one sum gives all.
    """

    def __init__(self, w: np.ndarray, wy: np.ndarray):
        self.rows, self.weight = len(w).bit_length(), int(min(w.sum(), 2.0**53)).bit_length()
        self.whole = self.rows + self.weight <= 53 and not ((w != np.floor(w)).any() or (wy != np.floor(wy)).any())
        if not self.whole:
            self.held = [w, wy]
        elif self.rows + 2 * self.weight <= 53:
            self.held = [1.0 + w * float(1 << self.rows) + wy * float(1 << (self.rows + self.weight))]
        else:
            self.held = [1.0 + w * float(1 << self.rows), wy]

    def keep(self, kept: np.ndarray) -> None:
        self.held = [x[kept] for x in self.held]

    def parted(self, sums: list[np.ndarray]):
        first = sums[0]
        return (
            first & ((1 << self.rows) - 1),
            ((first >> self.rows) & ((1 << self.weight) - 1)).astype(np.float64),
            (first >> (self.rows + self.weight) if len(sums) == 1 else sums[1]).astype(np.float64),
        )

    def packed(self, at: np.ndarray, m: int) -> list[np.ndarray]:
        return [np.bincount(at, x, m) for x in self.held]

    def by(self, at: np.ndarray, m: int):
        """Number, weight and weighted labels per place."""
        sums = self.packed(at, m)
        return self.parted([x.astype(np.int64) for x in sums]) if self.whole else (np.bincount(at, minlength=m), *sums)


def best_splits(flat, row, at, sums: Sums, looked, total_w, total_y, n, bins_most: int, leaf: int):
    """For every node the feature and bin that part it best, and the sum of squares that gains; no split gains -inf.

    ``flat`` has the bins, each row's from ``row`` on; ``at`` numbers each row's node, ``looked`` lists each node's
    features. Of equal gains the lowest feature and bin count.
    """
    nodes = len(looked)
    gain, feature, split = np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes, np.int64)
    first = at * bins_most
    for j in range(looked.shape[1]):
        cell = flat.take(row + looked[:, j].take(at)) + first
        if sums.whole and leaf > 0:
            value, best = _best_of_cells(sums.packed(cell, nodes * bins_most), sums, nodes, bins_most, total_w, total_y, n, leaf)
        else:
            nl, wl, yl = (x.reshape(nodes, bins_most).cumsum(axis=1)[:, :-1] for x in sums.by(cell, nodes * bins_most))
            nr = n[:, None] - nl
            wr, yr = total_w[:, None] - wl, total_y[:, None] - yl
            with np.errstate(divide="ignore", invalid="ignore"):
                found = np.where((nl >= leaf) & (nr >= leaf), yl * yl / wl + yr * yr / wr, -np.inf)
            best = found.argmax(axis=1)
            value = found[np.arange(nodes), best]
        better = value > gain
        gain[better], feature[better], split[better] = value[better], looked[better, j], best[better]
    return gain, feature, split


def _best_of_cells(cells: list[np.ndarray], sums: Sums, nodes: int, bins_most: int, total_w, total_y, n, leaf: int):
    """Per node the highest gain over the bins that have rows, and the first bin of it; between two of them gains are equal."""
    held = np.flatnonzero(cells[0])
    node = held // bins_most
    starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    up_to = [c.take(held).cumsum().astype(np.int64) for c in cells]
    for x in up_to:
        before = np.zeros(nodes, np.int64)
        before[1:] = x[starts[1:] - 1]
        x -= before.take(node)
    nl, wl, yl = sums.parted(up_to)
    nr, wr, yr = n.take(node) - nl, total_w.take(node) - wl, total_y.take(node) - yl
    with np.errstate(divide="ignore", invalid="ignore"):
        found = np.where((nl >= leaf) & (nr >= leaf), yl * yl / wl + yr * yr / wr, -np.inf)
    value = np.maximum.reduceat(found, starts)
    first = np.flatnonzero(found == value.take(node))[::-1]
    best = np.empty(nodes, np.int64)
    best[node.take(first)] = held.take(first)
    return value, best - np.arange(nodes) * bins_most


@dataclass
class Grown:
    """A tree, or what is below a node of it, as arrays; children stand side by side and a leaf's feature is -1."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    value: np.ndarray
    size: np.ndarray
    decrease: np.ndarray


def grow(rows: Rows, w: np.ndarray, shape: Shape, key: np.ndarray, bins_most: int, depth: int = 0, scores: np.ndarray | None = None) -> Grown:
    """Split rows until nothing is left to split. ``scores`` (part, riding row) takes what each part says of the riding rows.

    Below the root the scores hold what the node itself says already.
    """
    columns = np.arange(rows.values.shape[1]) if shape.columns is None else np.array(shape.columns)
    most = len(columns) if shape.per_split is None else shape.per_split
    inside = np.flatnonzero(w > 0)
    flat, width = rows.values.ravel(), rows.values.shape[1]
    sums = Sums(w[inside], w[inside] * rows.label[inside])
    row, at = inside * width, np.zeros(len(inside), np.int64)
    ride = np.flatnonzero(shape.rides(rows.mark))
    ride_row, ride_at = ride * width, np.zeros(len(ride), np.int64)
    riding = np.arange(len(ride))
    limits, told = shape.limits(), depth > 0
    keys, above, first = key, np.array([np.iinfo(np.int64).max]), 0
    levels: list[tuple] = []
    while True:
        m = len(keys)
        n, total_w, total_y = sums.by(at, m)
        value = total_y / np.where(total_w > 0, total_w, 1.0)
        if scores is not None and not told:
            for c, (deepest, split_least, _) in enumerate(limits):
                if depth <= deepest:
                    held = above[ride_at] >= split_least
                    scores[c, riding[held]] = value[ride_at[held]]
        told = False
        may = (total_y > 0) & (total_y < total_w) & (n >= max(shape.split, 2 * shape.leaf, 2)) & (depth < shape.deepest)
        feature, split, child, decrease = np.full(m, -1), np.zeros(m, np.int64), np.full(m, -1), np.zeros(m)
        open_ = np.flatnonzero(may)
        if len(open_):
            number = np.full(m, -1)
            number[open_] = np.arange(len(open_))
            if len(open_) < m:
                held = np.flatnonzero(number.take(at) >= 0)
                row, at = row[held], at[held]
                sums.keep(held)
            looked = drawn_columns(keys[open_], columns, most)
            gain, f, b = best_splits(
                flat, row, number.take(at), sums, looked, total_w[open_], total_y[open_], n[open_], bins_most, shape.leaf
            )
            good = np.isfinite(gain)
            parted = open_[good]
            feature[parted], split[parted] = f[good], b[good]
            child[parted] = first + m + 2 * np.arange(len(parted))
            decrease[parted] = gain[good] - total_y[parted] * total_y[parted] / total_w[parted]
        levels.append((feature, split, child, value, n, decrease))
        parted = np.flatnonzero(feature >= 0)
        if not len(parted):
            return Grown(*(np.concatenate(c) for c in zip(*levels)))

        def moved(row, at):
            stay = feature.take(at) >= 0
            if not stay.all():
                row, at = row[stay], at[stay]
            return stay, row, below.take(at) + (flat.take(row + feature.take(at)) > split.take(at))

        below = child - first - m
        stay, row, at = moved(row, at)
        if not stay.all():
            sums.keep(stay)
        stay, ride_row, ride_at = moved(ride_row, ride_at)
        riding = riding[stay]
        keys, above = child_keys(keys[parted]), np.repeat(n[parted], 2)
        first, depth = first + m, depth + 1


# Of a group: what each feature brought below the node, how many nodes there are, what scores with them, and the rest of them.
RESULT = (
    "fit int, tree int, node long, feature array<int>, decrease array<double>, nodes int, child binary, more binary,"
    " part int, keys array<long>, labels array<double>, scores array<double>"
)
RESULT_ARROW = pa.schema(
    [("fit", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.list_(pa.int32())), ("decrease", pa.list_(pa.float64())),
     ("nodes", pa.int32()), ("child", pa.binary()), ("more", pa.binary()),
     ("part", pa.int32()), ("keys", pa.list_(pa.int64())), ("labels", pa.list_(pa.float64())), ("scores", pa.list_(pa.float64()))]
)
SCORING = (("feature", np.int16), ("split", np.uint8), ("value", np.float64))
MORE = (("size", np.int32), ("decrease", np.float64))


def _squeezed(grown: Grown, kinds) -> bytes:
    held = b"".join(np.ascontiguousarray(getattr(grown, c), k).tobytes() for c, k in kinds)
    return pa.compress(held, codec="lz4", asbytes=True)


def _stretched(held: bytes, nodes: int, kinds) -> dict[str, np.ndarray]:
    whole, at, found = pa.decompress(held, nodes * sum(np.dtype(k).itemsize for _, k in kinds), codec="lz4"), 0, {}
    for c, k in kinds:
        found[c] = np.frombuffer(whole, k, nodes, at)
        at += nodes * np.dtype(k).itemsize
    return found


def _unsqueezed(nodes: int, child: bytes, more: bytes | None = None) -> Grown:
    """The nodes again; children stand in the order of the nodes they are of. Who scores needs no more than ``child``."""
    found = _stretched(child, nodes, SCORING)
    inner = found["feature"] >= 0
    places = np.full(nodes, -1, np.int32)
    places[inner] = 1 + 2 * np.arange(int(inner.sum()))
    rest = _stretched(more, nodes, MORE) if more is not None else dict.fromkeys(("size", "decrease"))
    return Grown(found["feature"], found["split"], places, found["value"], rest["size"], rest["decrease"])


def _tree_row(fit: int, tree: int, node: int, grown: Grown) -> dict:
    packed = {"nodes": len(grown.feature), "child": _squeezed(grown, SCORING), "more": _squeezed(grown, MORE)}
    return {**_gain_row(fit, tree, node, grown), **packed}


def _gain_row(fit: int, tree: int, node: int, grown: Grown) -> dict:
    """What each feature brought below the node, in place of the nodes."""
    inner = grown.feature >= 0
    brought = np.bincount(grown.feature[inner], grown.decrease[inner])
    feature = np.unique(grown.feature[inner])
    return {"fit": fit, "tree": tree, "node": node, "feature": feature.astype(np.int32), "decrease": brought[feature]}


def _score_rows(fit: int, rows: Rows, ride: np.ndarray, totals: np.ndarray) -> list[dict]:
    held = {"fit": fit, "keys": rows.key[ride], "labels": rows.label[ride]}
    return [{**held, "part": c, "scores": scores} for c, scores in enumerate(totals)]


PACKED = "rows int, mark binary, label binary, key binary, values binary, weights binary"
PACKED_NAMES = ["rows", "mark", "label", "key", "values", "weights"]


def _unpacked(table: pa.Table) -> Rows:
    return Rows.joined([Rows.of(r) for r in table.select(PACKED_NAMES).to_pylist()])


def _from_roots(blocks: Blocks, shapes: list[Shape], small: list[int], bins_most: int, keep_trees: bool, gains_only: bool) -> DataFrame:
    """Fits with few rows: their rows are brought together for some trees at a time, which are grown from the root."""
    spark = blocks.df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    total = sum(shapes[i].trees for i in small)
    each = min(MOST_TREES, max(1, math.ceil(total / (cores * 8))))
    units = [(i, t, min(t + each, shapes[i].trees)) for i in small for t in range(0, shapes[i].trees, each)]

    def deal(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows, by_fit = Rows.of(block), {}
                for number, (i, _, _) in enumerate(units):
                    if i not in by_fit:
                        used = shapes[i].learns(rows.mark) | shapes[i].rides(rows.mark)
                        by_fit = {i: [int(used.sum()), *rows.take(used).packed()]}
                    if by_fit[i][0]:
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, *by_fit[i])], schema=UNIT_ARROW)

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, first, last = units[key[0].as_py()]
        shape, rows, out = shapes[i], _unpacked(table), []
        ride, limits = np.flatnonzero(shape.rides(rows.mark)), shape.limits()
        totals = np.zeros((len(limits), len(ride)))
        for tree in range(first, last):
            scores = np.zeros_like(totals)
            grown = grow(rows, row_weights(rows, shape, tree), shape, tree_key(shape.seed, tree), bins_most, scores=scores if limits else None)
            totals += scores * np.array([[tree < trees] for _, _, trees in limits] or np.zeros((0, 1)))
            if keep_trees:
                out.append((_gain_row if gains_only else _tree_row)(i, tree, ROOT, grown))
        return pa.Table.from_pylist([*out, *_score_rows(i, rows, ride, totals)], RESULT_ARROW)

    dealt = blocks.df.mapInArrow(deal, f"unit int, {PACKED}").repartition(min(len(units), 4 * cores), "unit")
    return dealt.groupBy("unit").applyInArrow(finish, RESULT)


UNIT_ARROW = pa.schema([("unit", pa.int32()), ("rows", pa.int32()), *((c, pa.binary()) for c in PACKED_NAMES[1:])])


# --- shared levels ---------------------------------------------------------------------------


@dataclass
class _Node:
    """What the driver knows of a node that is split by the shared histograms."""

    n: int
    w: float
    y: float
    riding: int


@dataclass
class _Level:
    """The splits of one level of one tree, in the order of its nodes, as they are told to the rows."""

    nodes: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    codes: np.ndarray  # left and right: the child's name, negative if it is gathered, 0 if it stays whole
    values: np.ndarray
    sizes: np.ndarray
    start: float | None = None  # the root's value, at the first level


TOTALS = ["nt", "wt", "yt", "ridingt"]
CELLS = "tree int, node long, feature int, bin int, n long, w double, y double, riding long"


def _chunks(batches) -> Iterator[Rows]:
    """A task's blocks, joined to fewer and larger ones."""
    held, n = [], 0
    for batch in batches:
        for block in batch.to_pylist():
            held.append(Rows.of(block))
            n += block["rows"]
            if n >= CHUNK:
                yield Rows.joined(held)
                held, n = [], 0
    if held:
        yield Rows.joined(held)


def _numbered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct names, ascending, and the place of each name among them."""
    first, last = int(names.min()), int(names.max())
    if last - first >= CHUNK:
        return np.unique(names, return_inverse=True)
    there = np.bincount(names - first) > 0
    return np.flatnonzero(there) + first, (np.cumsum(there) - 1)[names - first]


def _cells(rows: Rows, at: np.ndarray, weight: np.ndarray, place: int, shape: Shape, tree: int, bins_most: int) -> pa.RecordBatch | None:
    """A chunk's share of the histograms of all nodes of a tree that its rows are in."""
    held = np.flatnonzero(at > 0)
    if not len(held):
        return None
    out: list[list[np.ndarray]] = []
    nodes, number = _numbered(at[held])
    sums = Sums(weight[held], weight[held] * rows.label[held])
    out_of_bag = weight[held] == 0
    riding = shape.rides(rows.mark)[held]
    columns = np.arange(rows.values.shape[1]) if shape.columns is None else np.array(shape.columns)
    most = len(columns) if shape.per_split is None else shape.per_split
    looked = drawn_columns(node_keys(tree_key(shape.seed, tree), nodes), columns, most)
    flat, row = rows.values.ravel(), held * rows.values.shape[1]
    for j in range(looked.shape[1]):
        cell = number * bins_most + flat.take(row + looked[:, j].take(number))
        size = len(nodes) * bins_most
        n, w, y = sums.by(cell, size)
        rides = np.zeros(size, np.int64)
        if riding.any():
            n, rides = n - np.bincount(cell[out_of_bag], minlength=size), np.bincount(cell[riding], minlength=size)
        found = np.flatnonzero(n + rides)
        node = found // bins_most
        out.append([np.full(len(found), place), nodes[node], looked[node, j], found % bins_most, *(x[found] for x in (n, w, y, rides))])
    kinds = (np.int32, np.int64, np.int32, np.int32, np.int64, np.float64, np.float64, np.int64)
    names = [c.split()[0] for c in CELLS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(zip(*out), kinds)], names)


def chosen_splits(cells: DataFrame, leaf: DataFrame) -> DataFrame:
    """The best split of each node from ``tree, node, feature, bin, n, w, y, riding``, with both sides' sums and the node's.

    ``leaf`` has the least rows of a side per ``tree``. Of equal gains the lowest feature and bin count; a node that cannot be
    split has no feature.
    """
    of_feature = Window.partitionBy("tree", "node", "feature")
    up_to = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.groupBy("tree", "node", "feature", "bin").agg(*(F.sum(c).alias(c) for c in ("n", "w", "y", "riding")))
    sides = sums.select(
        "tree", "node", "feature", "bin",
        *(F.sum(c).over(up_to).alias(f"{c}l") for c in ("n", "w", "y", "riding")),
        *(F.sum(c).over(of_feature).alias(f"{c}t") for c in ("n", "w", "y", "riding")),
    ).join(F.broadcast(leaf), "tree")
    wr, yr = F.col("wt") - F.col("wl"), F.col("yt") - F.col("yl")
    fits = (F.col("nl") >= F.col("leaf")) & (F.col("nt") - F.col("nl") >= F.col("leaf"))
    gain = F.when(fits, F.col("yl") * F.col("yl") / F.col("wl") + yr * yr / wr)
    ranked = F.struct(gain.alias("gain"), -F.col("feature"), -F.col("bin"))
    held = F.struct("feature", "bin", "nl", "wl", "yl", "ridingl", gain.alias("gain"))
    best = F.max_by(held, F.when(gain.isNotNull(), ranked)).alias("best")
    totals = [F.max(c).alias(c) for c in TOTALS]
    return sides.groupBy("tree", "node").agg(best, *totals).select("tree", "node", *TOTALS, "best.*")


def _by_levels(
    blocks: Blocks, trees: list[tuple[int, Shape, int]], bins_most: int, gather: int, keep_trees: bool, gains_only: bool
) -> tuple[DataFrame, list[dict]]:
    """Trees with many rows: levels by shared histograms, then what is left of each tree below its small nodes.

    Returns what the groups of small nodes gave, and the nodes above them.
    """
    spark = blocks.df.sparkSession
    parts = max((len(s.parts) for _, s, _ in trees), default=0)
    leaf = spark.createDataFrame([(k, s.leaf) for k, (_, s, _) in enumerate(trees)], "tree int, leaf int")

    levels: list[dict[int, _Level]] = []
    above: list[dict] = []
    going = list(range(len(trees)))
    while going:

        def histograms(batches, going=going):
            for rows in _chunks(batches):
                mixed = scrambled(rows.key.view(np.uint64))
                for place in going:
                    _, shape, tree = trees[place]
                    at, _, weight = _placed(rows, mixed, shape, tree, place, levels, 0)
                    found = _cells(rows, at, weight, place, shape, tree, bins_most)
                    if found is not None:
                        yield found

        chosen = chosen_splits(blocks.df.mapInArrow(histograms, CELLS), leaf).collect()
        if not chosen:
            break
        levels.append(_told(chosen, trees, len(levels), gather, above))
        going = [place for place, level in levels[-1].items() if (level.codes > 0).any()]

    def emit(batches):
        for rows in _chunks(batches):
            mixed = scrambled(rows.key.view(np.uint64))
            for place, (_, shape, tree) in enumerate(trees):
                at, scores, _ = _placed(rows, mixed, shape, tree, place, levels, parts)
                done = (at == 0) & shape.rides(rows.mark)
                held = np.flatnonzero((at < 0) | done)
                held = held[np.argsort(at[held], kind="stable")]
                if not len(held):
                    continue
                nodes = at[held]
                first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
                pieces = []
                for node, piece in zip((-nodes[first]).tolist(), np.split(held, first[1:])):
                    said = np.ascontiguousarray(scores[:, piece]).tobytes()
                    pieces.append((place, node, 0 if node else int(rows.key[0]), len(piece), *rows.take(piece).packed(), said))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), NODE_ARROW.types)], schema=NODE_ARROW)

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        place, node = key[0].as_py(), key[1].as_py()
        i, shape, tree = trees[place]
        pieces = table.to_pylist()
        rows = Rows.joined([Rows.of(p) for p in pieces])
        ride, limits = np.flatnonzero(shape.rides(rows.mark)), shape.limits()
        scores, out = np.zeros((0, len(ride))), []
        if limits:
            ranks = np.argsort(np.concatenate([np.frombuffer(p["key"], np.int64) for p in pieces]), kind="stable")
            said = np.concatenate([np.frombuffer(p["scores"], np.float64).reshape(parts, p["rows"]) for p in pieces], axis=1)[:, ranks]
            scores = said[: len(limits), ride].copy()
        if node:
            depth = int(node).bit_length() - 1
            root = node_keys(tree_key(shape.seed, tree), np.array([node]))
            grown = grow(rows, row_weights(rows, shape, tree), shape, root, bins_most, depth, scores if limits else None)
            if keep_trees:
                out.append((_gain_row if gains_only else _tree_row)(i, tree, node, grown))
        scores *= np.array([[tree < most] for _, _, most in limits] or np.zeros((0, 1)))
        return pa.Table.from_pylist([*out, *(_score_rows(i, rows, ride, scores) if len(ride) else [])], RESULT_ARROW)

    # Rows that are done in a large leaf need no meeting: each chunk's are a group of their own (node 0).
    groups = blocks.df.mapInArrow(emit, f"place int, node long, part long, {PACKED}, scores binary").repartition("place", "node", "part")
    return groups.groupBy("place", "node", "part").applyInArrow(finish, RESULT), above


NODE_ARROW = pa.schema(
    [("place", pa.int32()), ("node", pa.int64()), ("part", pa.int64()), ("rows", pa.int32()), *((c, pa.binary()) for c in PACKED_NAMES[1:]), ("scores", pa.binary())]
)


def _told(chosen: list, trees, depth: int, gather: int, above: list[dict]) -> dict[int, _Level]:
    """The level's splits by tree; the nodes they part, and those that stay whole, are put down in ``above``."""
    by_tree: dict[int, list] = {}
    for r in chosen:
        by_tree.setdefault(r["tree"], []).append(r)
    levels = {}
    for place, found in by_tree.items():
        fit, shape, tree = trees[place]
        kept, start = [], None
        for r in sorted(found, key=lambda r: r["node"]):
            if depth == 0:
                start = r["yt"] / r["wt"] if r["wt"] else 0.0
                above.append({"fit": fit, "tree": tree, "node": ROOT, "value": start, "size": r["nt"]})
            may = 0 < r["yt"] < r["wt"] and r["nt"] >= max(shape.split, 2 * shape.leaf, 2) and depth < shape.deepest
            if not may or r["gain"] is None:
                continue
            sides = [
                _Node(r["nl"], r["wl"], r["yl"], r["ridingl"]),
                _Node(r["nt"] - r["nl"], r["wt"] - r["wl"], r["yt"] - r["yl"], r["ridingt"] - r["ridingl"]),
            ]
            names = [2 * r["node"], 2 * r["node"] + 1]
            codes = [_code(name, s, shape, depth + 1, gather) for name, s in zip(names, sides)]
            above.append({
                "fit": fit, "tree": tree, "node": r["node"], "feature": r["feature"], "split": r["bin"],
                "decrease": r["gain"] - r["yt"] * r["yt"] / r["wt"],
            })
            above += [
                {"fit": fit, "tree": tree, "node": name, "value": s.y / s.w, "size": s.n} for name, s in zip(names, sides)
            ]
            kept.append((r["node"], r["feature"], r["bin"], codes, [s.y / s.w for s in sides], r["nt"]))
        columns = list(zip(*kept)) or [[], [], [], [], [], []]
        kinds = (np.int64, np.int64, np.int64, np.int64, float, np.int64)
        arrays = [np.array(c, k) for c, k in zip(columns, kinds)]
        arrays[3], arrays[4] = arrays[3].reshape(-1, 2), arrays[4].reshape(-1, 2)
        levels[place] = _Level(*arrays, start)
    return levels


def _code(name: int, side: _Node, shape: Shape, depth: int, gather: int) -> int:
    """What becomes of a child: it is split further here, gathered (negative), or a leaf (0)."""
    if not (0 < side.y < side.w and side.n >= max(shape.split, 2 * shape.leaf, 2) and depth < shape.deepest):
        return 0
    return name if side.n + side.riding > gather else -name


def _places(nodes: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Where each name stands among the ascending nodes, -1 where it does not."""
    first, width = int(nodes[0]), int(nodes[-1]) - int(nodes[0]) + 1
    if width <= CHUNK:
        table = np.full(width + 2, -1)
        table[nodes - first + 1] = np.arange(len(nodes))
        return table[np.clip(names - first, -1, width) + 1]
    place = np.minimum(np.searchsorted(nodes, names), len(nodes) - 1)
    return np.where(nodes[place] == names, place, -1)


def _placed(rows: Rows, mixed: np.ndarray, shape: Shape, tree: int, place: int, levels: list[dict[int, _Level]], parts: int):
    """The node in which each row is by the levels' splits (0: in none that goes on), its scores so far and its weight."""
    weight = row_weights(rows, shape, tree, mixed)
    at = np.where((weight > 0) | shape.rides(rows.mark), ROOT, 0)
    scores = np.zeros((parts, len(at)))
    for depth, told in enumerate(levels):
        if place in told:
            _move(rows, at, scores, shape, told[place], depth)
    return at, scores, weight


def _move(rows: Rows, at: np.ndarray, scores: np.ndarray, shape: Shape, level: _Level, depth: int) -> None:
    """Take the rows of one tree a level down; at the root the parts' scores begin with its value."""
    active = np.flatnonzero(at > 0)
    if level.start is not None:
        scores[:, active] = level.start
    if not len(active):
        return
    if not len(level.nodes):
        at[active] = 0
        return
    place = _places(level.nodes, at[active])
    found = place >= 0
    at[active[~found]] = 0
    active, place = active[found], place[found]
    value = rows.values.ravel().take(active * rows.values.shape[1] + level.feature[place])
    right = (value > level.split[place]).astype(np.int64)
    at[active] = level.codes.ravel().take(2 * place + right)
    for c, (deepest, split_least, _) in enumerate(shape.limits() if len(scores) else ()):
        if depth + 1 <= deepest:
            held = level.sizes[place] >= split_least
            scores[c, active[held]] = level.values[place[held], right[held]]


# --- a pool of fits --------------------------------------------------------------------------


@dataclass
class Pool:
    """What a pool of fits gave: rows of trees and of scores (``RESULT``), written once, and the nodes above them."""

    df: DataFrame
    shapes: list[Shape]
    above: list[dict] = field(default_factory=list)

    def scores(self) -> DataFrame:
        """``fit, part, key, y, p`` of all rows that rode along: the mean over the part's trees."""
        rows = self.df.where("keys IS NOT NULL").select("fit", "part", F.explode(F.arrays_zip("keys", "labels", "scores")).alias("r"))
        sums = rows.groupBy("fit", "part", F.col("r.keys").alias("key")).agg(F.max("r.labels").alias("y"), F.sum("r.scores").alias("total"))
        trees = [(i, c, t) for i, s in enumerate(self.shapes) for c, (_, _, t) in enumerate(s.parts)]
        told = self.df.sparkSession.createDataFrame(trees, "fit int, part int, trees int")
        p = (F.col("total") / F.col("trees")).alias("p")
        return sums.join(F.broadcast(told), ["fit", "part"]).select("fit", "part", "key", "y", p)

    def importances(self, width: int) -> list[list[float]]:
        """Per fit the mean over its trees of the share of the gain that each feature brought."""
        cells = self.df.where("feature IS NOT NULL").select("fit", "tree", F.explode(F.arrays_zip("feature", "decrease")).alias("c"))
        sums = cells.groupBy("fit", "tree", "c.feature").agg(F.sum("c.decrease").alias("decrease"))
        by_tree: dict[tuple[int, int], np.ndarray] = {}
        for r in [*(r.asDict() for r in sums.collect()), *(a for a in self.above if "feature" in a)]:
            by_tree.setdefault((r["fit"], r["tree"]), np.zeros(width))[r["feature"]] += max(r["decrease"], 0.0)
        means = [np.zeros(width) for _ in self.shapes]
        for (i, _), brought in sorted(by_tree.items()):
            means[i] += brought / (brought.sum() or 1.0)
        return [(m / (m.sum() or 1.0)).tolist() for m in means]

    def nodes(self, fit: int = 0) -> int:
        """How many nodes the fit's groups wrote."""
        return self.df.where(F.col("fit") == fit).agg(F.sum("nodes")).first()[0] or 0

    def _tops(self, fit: int) -> dict[int, dict[int, dict]]:
        tops: dict[int, dict[int, dict]] = {}
        for a in self.above:
            if a["fit"] == fit:
                tops.setdefault(a["tree"], {}).setdefault(a["node"], {}).update(a)
        return tops

    def trees(self, fit: int = 0) -> list[Grown]:
        """The trees of one fit, on the driver."""
        rows = self.df.where((F.col("fit") == fit) & F.col("child").isNotNull())
        parts: dict[int, dict[int, Grown]] = {}
        for r in rows.select("tree", "node", "nodes", "child", "more").collect():
            parts.setdefault(r["tree"], {})[r["node"]] = _unsqueezed(r["nodes"], bytes(r["child"]), bytes(r["more"]))
        tops = self._tops(fit)
        found = [_assembled(tops.get(t, {}), parts.get(t, {})) for t in range(self.shapes[fit].trees) if t in tops or t in parts]
        if len(found) < self.shapes[fit].trees:
            raise ValueError("there are no rows to learn from")
        return found

    def spread(self, fit: int = 0) -> Spread:
        """The trees of one fit, left where they are."""
        parts = self.df.where((F.col("fit") == fit) & F.col("child").isNotNull()).select("tree", "node", "nodes", "child")
        tops = self._tops(fit)
        below: dict[int, set[int]] = {}
        for r in parts.select("tree", "node").collect():
            below.setdefault(r["tree"], set()).add(r["node"])
        return Spread(parts, [_top(tops.get(t, {}), below.get(t, set())) for t in range(self.shapes[fit].trees)])


def _assembled(top: dict[int, dict], parts: dict[int, Grown]) -> Grown:
    """One tree from the nodes above and the parts that were grown below them."""
    if not top:
        return parts[ROOT]
    columns: list[list] = [[], [], [], [], [], []]
    waiting: list[tuple[int, int]] = [(ROOT, 0)]
    for c in columns:
        c.append(0)
    while waiting:
        node, place = waiting.pop()
        if node in parts:
            part, base = parts[node], len(columns[0]) - 1
            moved = np.where(part.child >= 0, part.child + base, -1)
            for c, values in zip(columns, (part.feature, part.split, moved, part.value, part.size, part.decrease)):
                c[place] = values[0]
                c.extend(values[1:].tolist())
            continue
        known, child = top[node], -1
        if "feature" in known:
            child = len(columns[0])
            for c in columns:
                c.extend([0, 0])
            waiting += [(2 * node, child), (2 * node + 1, child + 1)]
        row = (known.get("feature", -1), known.get("split", 0), child, known["value"], known["size"], known.get("decrease", 0.0))
        for c, v in zip(columns, row):
            c[place] = v
    return Grown(*(np.array(c) for c in columns))


def grow_pool(blocks: Blocks, shapes: list[Shape], gather: int = GATHER, keep_trees: bool = True, gains_only: bool = False) -> Pool:
    """Grow the forests of all fits at once; with ``gains_only`` for ``Pool.importances``, without their nodes."""
    sizes = blocks.sizes()
    marks = np.array(list(sizes), np.int32)
    counts = np.array(list(sizes.values()), np.int64)
    rows = [int(counts[s.learns(marks) | s.rides(marks)].sum()) if len(marks) else 0 for s in shapes]
    bins_most = max((len(e) for e in blocks.edges), default=0) + 1
    small = [i for i, n in enumerate(rows) if 0 < n <= gather]
    found, above = [], []
    if small:
        found.append(durable(_from_roots(blocks, shapes, small, bins_most, keep_trees, gains_only)))
    waiting = [(i, shapes[i], t) for i, n in enumerate(rows) if n > gather for t in range(shapes[i].trees)]
    while waiting:
        # A level has no more large nodes than the rows have room for, which bounds what the driver is told.
        most = max(1, min(128, SPLITS_HELD * gather // max(rows), WAVE // max(rows)))
        part, waiting = waiting[:most], waiting[most:]
        groups, nodes = _by_levels(blocks, part, bins_most, gather, keep_trees, gains_only)
        found.append(durable(groups))
        above += nodes
        del groups
        # Spark deletes shuffle files of what is no longer referred to when the driver collects its garbage.
        blocks.df.sparkSession._jvm.System.gc()
    if not found:
        raise ValueError("there are no rows to learn from")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return Pool(whole, shapes, above)


# --- a forest that stays where it was grown --------------------------------------------------


@dataclass
class Top:
    """A tree down to the nodes that groups went on from: ``node`` names what is below a leaf, 0 if nothing, ``share`` its rows' share."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    value: np.ndarray
    node: np.ndarray
    share: np.ndarray


TOP = (("feature", np.int64), ("split", np.int64), ("child", np.int64), ("value", np.float64), ("node", np.int64), ("share", np.float64))


def _top(known: dict[int, dict], below: set[int]) -> Top:
    if not known and not below:
        raise ValueError("there are no rows to learn from")
    known = known or {ROOT: {"value": 0.0, "size": 1}}
    rows, waiting = [None], [(ROOT, 0)]
    while waiting:
        name, place = waiting.pop()
        found, child = known[name], -1
        if "feature" in found:
            child = len(rows)
            rows += [None, None]
            waiting += [(2 * name, child), (2 * name + 1, child + 1)]
        share = found["size"] / max(known[ROOT]["size"], 1)
        rows[place] = (found.get("feature", -1), found.get("split", 0), child, found["value"], name if name in below else 0, share)
    return Top(*(np.array(c, k) for c, (_, k) in zip(zip(*rows), TOP)))


def _leaf(bins: np.ndarray, tree: Grown | Top) -> np.ndarray:
    """The leaf that each row of bins comes to."""
    node = np.zeros(len(bins), np.int64)
    going = np.arange(len(bins))
    while len(going):
        feature = tree.feature[node[going]]
        inner = feature >= 0
        going, feature = going[inner], feature[inner]
        at = node[going]
        node[going] = tree.child[at] + (bins[going, feature] > tree.split[at])
    return node


def _exact(values: np.ndarray) -> np.ndarray:
    return np.rint(values * EXACT) / EXACT


VISITS = "tree int, node long, slot long, ids binary, bins binary, said binary"
VISITS_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("slot", pa.int64()), ("ids", pa.binary()), ("bins", pa.binary()), ("said", pa.binary())])
TOTALS_ARROW = pa.schema([("_row", pa.int64()), ("total", pa.float64())])


@dataclass
class Spread:
    """A forest of any size: ``tree, node, nodes, child`` of what is below the tops, as written rows, and the tops."""

    parts: DataFrame
    tops: list[Top]

    def totals(self, rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
        """``_row, total``: the sum over the trees of what each says of ``_row, v``, some trees at a time."""
        n = rows.count()
        most = max(1, WAVE // max(n, 1))
        found = [durable(self._met(rows, edges, range(t, min(t + most, len(self.tops))), n)) for t in range(0, len(self.tops), most)]
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        return whole.groupBy("_row").agg(F.sum("total").alias("total"))

    def _met(self, rows: DataFrame, edges: list[np.ndarray], trees: range, n: int) -> DataFrame:
        tops = {t: [getattr(self.tops[t], c) for c, _ in TOP] for t in trees}
        slots = {(t, int(top[4][i])): 1 + int(n * top[5][i] / MET_ROWS) for t, top in tops.items() for i in np.flatnonzero(top[4])}
        context = rows.sparkSession.sparkContext
        told = context.broadcast((edges, tops, slots))

        def deal(batches):
            for ids, bins in _binned_chunks(batches, told.value[0]):
                mixed = int(scrambled(ids[:1].view(np.uint64))[0] >> np.uint64(1))
                for tree, arrays in told.value[1].items():
                    top = Top(*arrays)
                    leaf = _leaf(bins, top)
                    order = np.argsort(top.node[leaf], kind="stable")
                    nodes = top.node[leaf[order]]
                    starts = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
                    pieces = []
                    for node, held in zip(nodes[starts].tolist(), np.split(order, starts[1:])):
                        # Rows that a top alone decides meet nothing: a chunk's are a group of their own.
                        slot = mixed % told.value[2][tree, node] if node else mixed
                        said = None if node else _exact(top.value[leaf[held]]).tobytes()
                        pieces.append((tree, node, slot, ids[held].tobytes(), bins[held].tobytes(), said))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), VISITS_ARROW.types)], schema=VISITS_ARROW)

        def meet(visits: pa.Table, parts: pa.Table) -> pa.Table:
            ids, totals = [np.zeros(0, np.int64)], [np.zeros(0)]
            grown = [_unsqueezed(p["nodes"], p["child"]) for p in parts.to_pylist()]
            for held, bins, said in zip(*(visits.column(c).to_pylist() for c in ("ids", "bins", "said"))):
                ids.append(np.frombuffer(held, np.int64))
                if said is not None:
                    totals.append(np.frombuffer(said, np.float64))
                else:
                    totals.append(_exact(walk(np.frombuffer(bins, np.uint8).reshape(len(ids[-1]), -1), grown[0])))
            return pa.Table.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(totals))], schema=TOTALS_ARROW)

        named = rows.sparkSession.createDataFrame([(t, node, k) for (t, node), k in slots.items()], "tree int, node long, slots int")
        copies = self.parts.join(F.broadcast(named), ["tree", "node"]).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - F.lit(1).cast("long"))))
        by = ["tree", "node", "slot"]
        visits = rows.mapInArrow(deal, VISITS).groupBy(*by)
        met = visits.cogroup(copies.drop("slots").groupBy(*by)).applyInArrow(meet, "_row long, total double")
        return met.groupBy("_row").agg(F.sum("total").alias("total"))


def _binned_chunks(batches, edges: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and bins of a task's rows, many at a time."""
    ids, bins, n = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
        ids.append(batch.column("_row").to_numpy())
        bins.append(binned(values, edges))
        n += batch.num_rows
        if n >= CHUNK:
            yield np.concatenate(ids), np.concatenate(bins)
            ids, bins, n = [], [], 0
    if n:
        yield np.concatenate(ids), np.concatenate(bins)


# --- the model -------------------------------------------------------------------------------


def walk(bins: np.ndarray, tree: Grown) -> np.ndarray:
    """What a tree says of each row of bins."""
    return tree.value[_leaf(bins, tree)]


@dataclass
class ForestModel:
    """A forest that scores vectors: the mean of its trees' shares of class 1; a large one has no ``trees`` but is ``spread``."""

    edges: list[np.ndarray]
    trees: list[Grown]
    importances: list[float]
    spread: Spread | None = None

    def transform(self, df: DataFrame, features: str, probability: str, predicted: str) -> DataFrame:
        if self.spread is not None:
            rows = durable(df.withColumn("_row", F.monotonically_increasing_id()))
            totals = self.spread.totals(rows.select("_row", vector_to_array(F.col(features)).alias("v")), self.edges)
            share = totals.select("_row", (F.col("total") / len(self.spread.tops)).alias(probability))
            return _with_class(rows.join(share, "_row").drop("_row"), probability, predicted)
        # Arrays alone: a broadcast names its classes, and executors need not have the package.
        told = df.sparkSession.sparkContext.broadcast((self.edges, [[getattr(t, c) for c in SCORING_ARRAYS] for t in self.trees]))

        @F.pandas_udf("double")
        def share(vectors: pd.Series) -> pd.Series:
            edges, trees = told.value
            bins = binned(np.array(vectors.tolist(), float).reshape(len(vectors), len(edges)), edges)
            return pd.Series(sum((walk(bins, Grown(*t, None, None)) for t in trees), np.zeros(len(bins))) / len(trees))

        return _with_class(df.withColumn(probability, share(vector_to_array(F.col(features)))), probability, predicted)

    def save(self, path: str, spark: SparkSession) -> None:
        if self.spread is None:
            rows = [(i, *(getattr(t, c).tolist() for c in TREE_ARRAYS)) for i, t in enumerate(self.trees)]
            spark.createDataFrame(rows, STORED_TREES).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        else:
            rows = [(i, *(getattr(t, c).tolist() for c, _ in TOP)) for i, t in enumerate(self.spread.tops)]
            spark.createDataFrame(rows, STORED_TOPS).coalesce(1).write.mode("overwrite").parquet(f"{path}/tops")
            self.spread.parts.write.mode("overwrite").parquet(f"{path}/parts")
        kept = [(i, e.tolist(), v, self.spread is not None) for i, (e, v) in enumerate(zip(self.edges, self.importances))]
        spark.createDataFrame(kept, STORED_EDGES).coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        kept = spark.read.parquet(f"{path}/edges").orderBy("feature").collect()
        edges, importances = [np.array(r["edges"], float) for r in kept], [r["importance"] for r in kept]
        if kept and "spread" in kept[0] and kept[0]["spread"]:
            tops = spark.read.parquet(f"{path}/tops").orderBy("tree").collect()
            held = [Top(*(np.array(r[c], k) for c, k in TOP)) for r in tops]
            return cls(edges, [], importances, Spread(spark.read.parquet(f"{path}/parts"), held))
        trees = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()
        return cls(edges, [Grown(*(np.array(r[c]) for c in TREE_ARRAYS)) for r in trees], importances)


def _with_class(df: DataFrame, probability: str, predicted: str) -> DataFrame:
    """A share of class 1 as both classes' probabilities, and the class."""
    p = F.col(probability)
    return df.withColumns({probability: array_to_vector(F.array(1.0 - p, p)), predicted: (p > 0.5).cast("double")})


SCORING_ARRAYS = ("feature", "split", "child", "value")
TREE_ARRAYS = ("feature", "split", "child", "value", "size", "decrease")
STORED_TREES = "tree int, feature array<int>, split array<int>, child array<int>, value array<double>, size array<int>, decrease array<double>"
STORED_TOPS = "tree int, feature array<long>, split array<long>, child array<long>, value array<double>, node array<long>, share array<double>"
STORED_EDGES = "feature int, edges array<double>, importance double, spread boolean"


def shape_of(params: dict, width: int, **more) -> Shape:
    """The shape of a forest with the parameters of ``learners``."""
    return Shape(
        trees=params["n_estimators"], depth=params["max_depth"], leaf=params["min_samples_leaf"], split=params["min_samples_split"],
        per_split=per_split(params["max_features"], width), **more,
    )


def fit_forest(rows: DataFrame, features: list[str], label: str, params: dict, weight: str | None = None, seed: int = 42, gather: int = GATHER) -> ForestModel:
    """Fit one forest; ``rows`` may have the table's key, on which the draws then depend."""
    blocks = binned_blocks(rows, features, label, weights=[F.col(weight)] if weight else None)
    try:
        pool = grow_pool(blocks, [shape_of(params, len(features), seed=seed, sample=Sample(weight=0 if weight else None))], gather)
        importances = pool.importances(len(features))[0]
        if pool.nodes() > HELD_NODES:
            return ForestModel(blocks.edges, [], importances, pool.spread())
        return ForestModel(blocks.edges, pool.trees(), importances)
    finally:
        blocks.release()
