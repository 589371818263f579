"""Rows packed into blocks, as bins or as numbers, for learners that read them many times."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchcast.functions.hashing import POISSON_ONE, uniform_of
from matchcast.operators.order import values_at
from matchcast.schema import ROW_KEY

# Tasks get this module's helpers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
ACCURACY = 10000  # of the quantiles: a rank is off by at most one row in so many

BLOCK_SCHEMA = "block long, rows int, mark binary, label binary, key binary, values binary, weights binary"


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Up to ``bins - 1`` distinct values per feature that part its rows evenly, from one pass of mergeable sketches.

    A value's bin is the number of edges below it, so ``bin <= b`` says ``value <= edges[b]``.
    """
    if bins > 256:
        raise ValueError(f"a bin is one byte; {bins} are too many")
    shares = [i / bins for i in range(1, bins)]
    asked = [F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(features)]
    highest = [F.max(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]
    found = df.agg(*asked, *highest).first()
    edges = []
    for i in range(len(features)):
        values = np.unique(np.array(found[f"q{i}"] or [], float))
        edges.append(values[values < found[f"m{i}"]] if found[f"m{i}"] is not None else values)
    return edges


def exact_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """The same from exact quantiles, which takes several passes."""
    named = df.select(*(F.col(c).cast("double").alias(c) for c in features))
    found = values_at(named, features, lambda n: [-(-i * n // bins) - 1 for i in range(1, bins)])
    return [np.unique(np.array(found.get(c, []), float)) for c in features]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a matrix of values; a missing value is in the last bin."""
    out = np.empty(values.shape, np.uint8)
    for i, limits in enumerate(edges):
        out[:, i] = np.searchsorted(limits, values[:, i], side="left")
    return out


@dataclass(frozen=True)
class Sample:
    """The rows that a fit learns from, by their mark, and how often each counts: by a weight of the blocks, or drawn by its key.

    ``draw`` is the salt of a bootstrap sample, as ``sampling.bootstrap_weight`` has it; the blocks' key is then the row's residue.
    """

    before: int | None = None  # rows with a smaller mark
    but: int | None = None  # rows with another mark
    weight: int | None = None
    draw: int | None = None

    def learns(self, mark: np.ndarray) -> np.ndarray:
        if self.before is not None:
            return mark < self.before
        return np.ones(len(mark), bool) if self.but is None else mark != self.but

    def weights(self, rows: Rows) -> np.ndarray:
        weight = rows.weights[:, self.weight] if self.weight is not None else 1.0
        if self.draw is not None:
            weight = weight * np.searchsorted(POISSON_ONE, uniform_of(rows.key, self.draw), side="left")
        return np.where(self.learns(rows.mark), weight, 0.0)


@dataclass
class Blocks:
    """Rows of a table as blocks of bytes: a mark (such as the fold), the label, the key, the values and weights of each row."""

    df: DataFrame
    features: list[str]
    edges: list[np.ndarray] | None = None
    counts: dict[int, int] | None = None

    def sizes(self) -> dict[int, int]:
        """The number of rows per mark, counted once."""
        if self.counts is None:
            self.counts = self._counted()
        return self.counts

    def _counted(self) -> dict[int, int]:
        def run(batches):
            for batch in batches:
                found = [np.unique(np.frombuffer(m.as_py(), np.int32), return_counts=True) for m in batch.column("mark")]
                marks = np.concatenate([m for m, _ in found]) if found else np.zeros(0, np.int32)
                counts = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int32()), pa.array(counts, pa.int64())], ["mark", "n"])

        counted = self.df.select("mark").mapInArrow(run, "mark int, n long").groupBy("mark").agg(F.sum("n").alias("n"))
        return {r["mark"]: r["n"] for r in counted.collect()}

    def release(self) -> None:
        self.df.unpersist()


def row_key(df: DataFrame, features: list[str], label: str) -> Column:
    """What random draws depend on: the table's key, or else the row's values."""
    return F.xxhash64(ROW_KEY) if ROW_KEY in df.columns else F.xxhash64(label, *features)


def pack_blocks(
    df: DataFrame,
    features: list[str],
    label: str,
    mark: Column | None = None,
    weights: list[Column] | None = None,
    key: Column | None = None,
    convert: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """A block for each Arrow batch of rows; ``convert`` turns the matrix of values into what is kept of it."""
    held = weights or []
    rows = df.select(
        (F.lit(0) if mark is None else mark).cast("int").alias("mark"),
        F.col(label).cast("double").alias("label"),
        (row_key(df, features, label) if key is None else key).alias("key"),
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)),
        *(w.cast("double").alias(f"w{i}") for i, w in enumerate(held)),
    )
    width, kinds = len(features), len(held)

    def matrix(batch: pa.RecordBatch, name: str, n: int) -> np.ndarray:
        columns = [batch.column(f"{name}{i}").to_numpy(zero_copy_only=False) for i in range(n)]
        return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch, "x", width)
            mark, label, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mark", "label", "key"))
            whole = Rows(mark, label, key, values if convert is None else convert(values), matrix(batch, "w", kinds))
            first = [pa.array([int(key[0])], pa.int64()), pa.array([len(key)], pa.int32())]
            yield pa.RecordBatch.from_arrays([*first, *(pa.array([p], pa.binary()) for p in whole.packed())], BLOCK_NAMES)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def binned_blocks(
    df: DataFrame, features: list[str], label: str, mark: Column | None = None, weights: list[Column] | None = None,
    edges: list[np.ndarray] | None = None, **options,
) -> Blocks:
    """Bin the features once and pack the rows; the blocks are kept in memory or on disk."""
    edges = bin_edges(df, features) if edges is None else edges
    packed = pack_blocks(df, features, label, mark, weights, convert=lambda values: binned(values, edges), **options)
    return Blocks(packed.persist(), list(features), edges)


BLOCK_NAMES = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]


@dataclass
class Rows:
    """The rows of a block, unpacked; the values are bins (bytes) or numbers."""

    mark: np.ndarray
    label: np.ndarray
    key: np.ndarray
    values: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(block: dict, kind: type = np.uint8) -> Rows:
        n = block["rows"]
        return Rows(
            np.frombuffer(block["mark"], np.int32),
            np.frombuffer(block["label"], np.float64),
            np.frombuffer(block["key"], np.int64),
            np.frombuffer(block["values"], kind).reshape(n, -1),
            np.frombuffer(block["weights"], np.float64).reshape(n, -1),
        )

    def take(self, kept: np.ndarray) -> Rows:
        return Rows(self.mark[kept], self.label[kept], self.key[kept], self.values[kept], self.weights[kept])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        """All parts' rows in the order of their keys, so that sums do not depend on how the rows were dealt."""
        whole = Rows(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("mark", "label", "key", "values", "weights")))
        return whole.take(np.argsort(whole.key, kind="stable"))

    def packed(self) -> list[bytes]:
        kinds = (np.int32, np.float64, np.int64, self.values.dtype, np.float64)
        arrays = (self.mark, self.label, self.key, self.values, self.weights)
        return [np.ascontiguousarray(a, k).tobytes() for a, k in zip(arrays, kinds)]
