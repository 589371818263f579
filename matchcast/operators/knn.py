"""Exact k nearest neighbours as a pruned block join.

Training rows are grouped into shells: by nearest pivot, then by distance to it, and neighbouring shells
into blocks. Queries are packed by nearest pivot too, and a pack travels as a whole, once to each block it has to meet:
first to the blocks with the shells around its queries that hold k rows, which bounds how far a k-th neighbour can be; then
only to those other blocks that the triangle inequality does not put beyond that bound. In a block, products of matrices
(or sums of differences) rule out all but a few rows a query, whose distances are then worked out; a block hands back
only its k best rows. So neither all pairs nor a large group ever exist, and what is moved grows with packs times blocks,
not with queries times shells. Pivots grow with the square root of the training rows, so cells stay small.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchcast.durable import durable
from matchcast.functions.hashing import key_residue, mix
from matchcast.operators.impute import fit_standardiser

# Tasks get this module's helpers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_PIVOTS = 16
RINGS = 4
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 1 << 25  # of the vectors of a block
MET_ROWS = 1024  # of a block that are held against some queries at a time
HELD_BYTES = 1 << 26  # of training vectors that a model tells to every executor
ASKED_ROWS = 256  # whose distances are held at a time
METRICS = {"euclidean": 2, "manhattan": 1}


def _distances(a: np.ndarray, b: np.ndarray, power: int) -> np.ndarray:
    """Distance of every row of ``a`` to every row of ``b``, a few rows of ``a`` at a time."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        gap = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = (
            np.sqrt((gap * gap).sum(axis=2)) if power == 2 else np.abs(gap).sum(axis=2)
        )
    return out


def _smallest(d: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k smallest values in order; of equal ones the first."""
    if d.shape[1] <= k:
        return np.argsort(d, axis=1, kind="stable")
    # All that are no larger than the k-th value, in column order; ties beyond k then fall away.
    kth = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
    kept = np.where(d < kth, d, np.where(d == kth, kth, np.inf))
    width = int((d <= kth).sum(axis=1).max())
    columns = np.sort(np.argpartition(kept, width - 1, axis=1)[:, :width], axis=1)
    order = np.argsort(np.take_along_axis(d, columns, axis=1), axis=1, kind="stable")[:, :k]
    return np.take_along_axis(columns, order, axis=1)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=float).reshape(len(vectors), width)


def nearest(
    queries: DataFrame,
    train: DataFrame,
    k: int = 5,
    vector: str = "vector",
    key: str = "id",
    label: str = "label",
    metric: str = "euclidean",
    leave_self_out: bool = False,
    pivots: int | None = None,
    rings: int = RINGS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k training rows nearest to each query: ``key, neighbour, label, distance, place``.

    Equal distances are ordered by the training key. ``leave_self_out`` skips the training row
    whose key is the query's own.
    """
    power = METRICS[metric]
    points = train.select(
        F.col(key).alias("neighbour"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    asked = queries.select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("q"))
    kind = train.schema[key].dataType
    pivots = pivots or max(LEAST_PIVOTS, math.isqrt(points.count()))
    spots = points.orderBy(mix(key_residue(F.col("neighbour"), kind), 1), "neighbour").limit(pivots)
    centres = np.array([r["v"] for r in spots.select("v").collect()], dtype=float)
    if len(centres) == 0:
        return _ranked(
            asked.join(points.where(F.lit(False)), F.lit(False)).withColumn("distance", F.lit(0.0)), k, key
        )
    width = centres.shape[1]

    @F.pandas_udf("cell int, reach double")
    def locate(vectors: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(vectors, width), centres, power)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": d[np.arange(len(d)), cell]})

    placed = points.withColumn("at", locate("v")).select(
        "neighbour", "label", "v", "at.cell", "at.reach"
    )
    outer = placed.agg(F.max("reach")).first()[0]
    ring_width = outer / rings if outer else 1.0
    ring = F.least(F.floor(F.col("reach") / ring_width), F.lit(rings - 1)).cast("int")
    shelled = placed.withColumn("shell", F.col("cell") * rings + ring)
    shells = (
        shelled.groupBy("shell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("reach").alias("inner"),
            F.max("reach").alias("outer"),
        )
        .orderBy("shell")
        .collect()
    )
    most = max(1, min(block_rows, BLOCK_BYTES // (8 * width)))
    blocks = {s["shell"]: -(-s["n"] // most) for s in shells}
    layout = _Layout(centres, shells, rings, blocks, k + 1 if leave_self_out else k, power)
    first_of, times_of = layout.blocks(most)

    @F.pandas_udf("int")
    def block(at: pd.Series, lot: pd.Series) -> pd.Series:
        return pd.Series(first_of[at] + lot % times_of[at], dtype="int32")

    # Workers fill the cores as it is; products in them take one thread each.
    spark = queries.sparkSession
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")
    left = _packed(shelled.withColumn("block", block("shell", F.pmod(F.xxhash64("neighbour"), F.lit(1 << 30)))), kind, train.schema[label].dataType)
    schema = T.StructType(
        [
            T.StructField("pack", T.LongType()),
            T.StructField("at", T.IntegerType()),
            T.StructField("query", queries.schema[key].dataType),
            T.StructField("neighbour", kind),
            T.StructField("label", train.schema[label].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def best_of_block(asking: pa.Table, rows: pa.Table) -> pa.Table:
        if not asking.num_rows or not rows.num_rows:
            return arrow.empty_table()
        held = [r.as_py() for r in (rows.column(c)[0] for c in ("shells", "vectors"))]
        shell, t = np.frombuffer(held[0], np.int32), np.frombuffer(held[1], np.float64).reshape(-1, width)
        ids, labels = (rows.column(c).combine_chunks().flatten() for c in ("ids", "labels"))
        own = asking.column("ids").combine_chunks().flatten()
        q = np.frombuffer(asking.column("vectors")[0].as_py(), np.float64).reshape(-1, width)
        told = asking.column("bounds")[0].as_py()
        bounds = np.full(len(q), np.inf) if told is None else np.frombuffer(told, np.float64).copy()
        same = _same_keys(own, ids) if leave_self_out else None
        rank = np.empty(len(t), np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(t))
        near, place = layout.met(q, bounds, t, shell, rank, same, k)
        at, of = np.nonzero(np.isfinite(near))
        columns = [own.take(pa.array(at)), ids.take(pa.array(place[at, of])), labels.take(pa.array(place[at, of])), pa.array(near[at, of])]
        pack = pa.array(np.full(len(at), asking.column("pack")[0].as_py()))
        return pa.Table.from_arrays([pack, pa.array(at.astype(np.int32)), *(c.cast(t) for c, t in zip(columns, arrow.types[2:]))], schema=arrow)

    def meet(visits: DataFrame) -> DataFrame:
        """The best of each block for each query of the packs that visit it."""
        visits = durable(visits)
        rows = left.join(visits.select(F.col("block").alias("to"), F.col("pack").alias("by")), F.col("block") == F.col("to")).drop("block")
        return visits.groupBy("block", "pack").cogroup(rows.groupBy("to", "by")).applyInArrow(best_of_block, schema)

    # Enough packs that every core has several blocks to meet.
    cores = spark.sparkContext.defaultParallelism
    n = asked.count()
    each = max(1, min(most // 2, -(-n // (2 * cores))))
    packs = durable(_dealt(asked.withColumn("cell", locate("q").cell), -(-n // each), each))
    visit = F.lit(None).cast("binary").alias("bounds")
    told = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packs.schema) + ", bounds binary, block int"
    first = durable(meet(packs.select("*", visit).mapInArrow(layout.around_packs(most), told)))
    best = Window.partitionBy("pack", "at").orderBy("distance", "neighbour")
    kth = first.withColumn("place", F.row_number().over(best)).where(F.col("place") == k)
    kths = kth.groupBy("pack").agg(F.collect_list(F.struct("at", "distance")).alias("kths"))
    bounded = packs.join(kths, "pack", "left")
    second = meet(bounded.mapInArrow(layout.within_packs(most), told))
    return _ranked(first.unionByName(second), k, key)


def _packed(rows: DataFrame, kind: T.DataType, label: T.DataType) -> DataFrame:
    """A row for each block: its rows' shells and vectors as bytes, their keys and labels; the rows by shell, then by key."""
    schema = T.StructType(
        [
            T.StructField("block", T.IntegerType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("labels", T.ArrayType(label)),
            T.StructField("shells", T.BinaryType()), T.StructField("vectors", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[("shell", "ascending"), ("neighbour", "ascending")])).combine_chunks()
        n = [0, table.num_rows]
        lists = (pa.ListArray.from_arrays(n, table.column(c).combine_chunks()) for c in ("neighbour", "label"))
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        held = (table.column("shell").to_numpy().astype(np.int32).tobytes(), vectors.tobytes())
        columns = [pa.array([key[0].as_py()], pa.int32()), *lists, *(pa.array([h], pa.binary()) for h in held)]
        return pa.Table.from_arrays([c.cast(t) for c, t in zip(columns, arrow.types)], schema=arrow)

    return durable(rows.select("block", "shell", "neighbour", "label", "v").groupBy("block").applyInArrow(pack, schema))


def _dealt(asked: DataFrame, packs: int, most: int) -> DataFrame:
    """``pack, ids, vectors``: queries packed with those that have the same nearest pivot, at most so many a pack."""
    ranged = asked.repartitionByRange(max(1, packs), "cell", F.xxhash64("query")).sortWithinPartitions("cell")
    schema = T.StructType(
        [T.StructField("pack", T.LongType()), T.StructField("ids", T.ArrayType(asked.schema["query"].dataType)), T.StructField("vectors", T.BinaryType())]
    )
    arrow = to_arrow_schema(schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ids = pa.ListArray.from_arrays([0, table.num_rows], table.column("query").combine_chunks())
            columns = [pa.array([table.column("number")[0].as_py()]), ids.cast(arrow.types[1]), pa.array([vectors.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, most - n)
                held.append(some)
                n, batch = n + some.num_rows, batch.slice(some.num_rows)
                if n == most:
                    yield row(held)
                    held, n = [], 0
        if n:
            yield row(held)

    return ranged.select("query", "q", F.monotonically_increasing_id().alias("number")).mapInArrow(pack, schema)


def _same_keys(asked: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each query's key and each row's; those of equal keys are equal, and a missing key equals none."""
    codes = pc.index_in(asked, value_set=ids.unique()).fill_null(-1).to_numpy(zero_copy_only=False)
    own = pc.index_in(ids, value_set=ids.unique()).fill_null(-1).to_numpy(zero_copy_only=False)
    codes, own = codes.astype(np.int64), own.astype(np.int64)
    codes[np.flatnonzero(asked.is_null().to_numpy(zero_copy_only=False))] = -1
    own[np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))] = -2
    return codes, own


def _roughly(q: np.ndarray, t: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """The distance (its square for the Euclidean one) of every two rows, and for each row of ``q`` by how much it may be off."""
    if power == 2:
        sizes = (q * q).sum(axis=1), (t * t).sum(axis=1)
        d = q @ t.T
        d *= -2.0
        d += sizes[0][:, None]
        d += sizes[1][None, :]
    else:
        sizes = np.abs(q).sum(axis=1), np.abs(t).sum(axis=1)
        d, gap, columns = np.zeros((len(q), len(t))), np.empty((len(q), len(t))), np.ascontiguousarray(t.T)
        for j in range(q.shape[1]):
            np.subtract(q[:, j, None], columns[j][None, :], out=gap)
            np.abs(gap, out=gap)
            d += gap
    return d, 4e-16 * (q.shape[1] + 32) * (sizes[0] + sizes[1].max())


def _kept_best(near: np.ndarray, place: np.ndarray, at: np.ndarray, of: np.ndarray, far: np.ndarray, rank: np.ndarray) -> None:
    """Put what rows ``at`` found among the k best they have; of equal distances the lower ``rank`` is nearer."""
    k, touched = near.shape[1], np.unique(at)
    rows = np.concatenate([np.repeat(touched, k), at])
    d, i = np.concatenate([near[touched].ravel(), far]), np.concatenate([place[touched].ravel(), of])
    order = np.lexsort((np.where(i >= 0, rank[i], len(rank)), d, rows))
    rows, d, i = rows[order], d[order], i[order]
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    number = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    kept = number < k
    near[rows[kept], number[kept]], place[rows[kept], number[kept]] = d[kept], i[kept]


class _Layout:
    """Where the shells lie, and which blocks a query has to meet."""

    def __init__(self, centres, shells: list[Row], rings: int, blocks: dict[int, int], k: int, power: int):
        self.centres, self.power, self.k = centres, power, k
        self.names = np.array([s["shell"] for s in shells])
        self.cells, self.counts = self.names // rings, np.array([s["n"] for s in shells])
        self.inner = np.array([s["inner"] for s in shells])
        self.outer = np.array([s["outer"] for s in shells])
        self.times = np.array([blocks[s] for s in self.names])

    def _shells(self, batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """How near each shell's rows can be, and whether a query meets the shell first."""
        away = _distances(_matrix(batch["q"], self.centres.shape[1]), self.centres, self.power)[:, self.cells]
        nearest_possible = np.maximum(np.maximum(away - self.outer, self.inner - away), 0.0)
        order = np.argsort(nearest_possible, axis=1, kind="stable")
        covered = np.cumsum(self.counts[order], axis=1) >= self.k
        enough = np.where(covered.any(axis=1), covered.argmax(axis=1), len(self.names) - 1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(len(self.names))[None, :], axis=1)
        return nearest_possible, place <= enough[:, None]

    def _emit(self, batch: pd.DataFrame, wanted: np.ndarray) -> pd.DataFrame:
        rows, cols = np.nonzero(wanted)
        times = self.times[cols]
        rows, cols = np.repeat(rows, times), np.repeat(cols, times)
        first = np.concatenate([[0], np.cumsum(times)[:-1]]) if len(times) else times
        picked = batch.iloc[rows]
        return pd.DataFrame(
            {
                "query": picked["query"].to_numpy(),
                "q": picked["q"].to_numpy(),
                "shell": self.names[cols].astype("int32"),
                "block": (np.arange(len(rows)) - np.repeat(first, times)).astype("int32"),
            }
        )

    def blocks(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Per shell name its first block and its number of blocks: neighbouring shells share one of at most ``most`` rows."""
        first, times = (np.zeros(int(self.names.max()) + 1, np.int64) for _ in range(2))
        block, held = 0, 0
        for name, n, parts in zip(self.names, self.counts, self.times):
            if held and held + n > most:
                block, held = block + 1, 0
            first[name], times[name] = block, parts
            if parts > 1:
                block, held = block + int(parts), 0
            else:
                held += n
        return first, times

    def _blocks_met(self, q: np.ndarray, bounds: np.ndarray | None, most: int) -> set[int]:
        """The blocks around the queries or, with bounds, those beside them that may hold a neighbour."""
        first, times = self.blocks(most)
        around, within = np.zeros(len(self.names), bool), np.zeros(len(self.names), bool)
        step = max(1, 4_000_000 // max(1, len(self.names)))
        for i in range(0, len(q), step):
            near, seen = self._shells(pd.DataFrame({"q": list(q[i : i + step])}))
            around |= seen.any(axis=0)
            if bounds is not None:
                within |= (near <= self._slack(bounds[i : i + step])[:, None]).any(axis=0)

        def named(wanted: np.ndarray) -> set[int]:
            return {b for s in self.names[wanted] for b in range(int(first[s]), int(first[s] + times[s]))}

        return named(around) if bounds is None else named(within) - named(around)

    @staticmethod
    def _slack(bounds: np.ndarray) -> np.ndarray:
        # A little slack, so that rounding never rules out a true neighbour.
        return bounds * (1 + 1e-9) + 1e-12

    def around_packs(self, most: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    q = np.frombuffer(row.column("vectors")[0].as_py(), np.float64).reshape(-1, self.centres.shape[1])
                    for block in sorted(self._blocks_met(q, None, most)):
                        yield _visit(row, None, block)

        return run

    def within_packs(self, most: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    q = np.frombuffer(row.column("vectors")[0].as_py(), np.float64).reshape(-1, self.centres.shape[1])
                    bounds = np.full(len(q), np.inf)
                    for found in row.column("kths")[0].as_py() or ():
                        bounds[found["at"]] = found["distance"]
                    for block in sorted(self._blocks_met(q, bounds, most)):
                        yield _visit(row, bounds, block)

        return run

    def met(self, q: np.ndarray, bounds: np.ndarray, t: np.ndarray, shell: np.ndarray, rank: np.ndarray, same: tuple | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a block's rows ``t`` each query's k nearest: distances, infinite where there are none, and places; equal ones by ``rank``.

        Rows are met some shells at a time, the nearest first, by the queries that may have a neighbour there.
        """
        near, place = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
        known = np.searchsorted(self.names, shell)
        cells, number = np.unique(self.cells[known], return_inverse=True)
        away = _distances(q, self.centres[cells], self.power)
        groups = []
        for i in range(0, len(t), MET_ROWS):
            some, at = np.unique(known[i : i + MET_ROWS], return_index=True)
            least = np.full(len(q), np.inf)
            for s, j in zip(some, number[i : i + MET_ROWS][at]):
                gap = np.maximum(away[:, j] - self.outer[s], self.inner[s] - away[:, j])
                least = np.minimum(least, np.maximum(gap, 0.0))
            groups.append((float(least.mean()), i, least))
        for _, i, least in sorted(groups, key=lambda g: g[:2]):
            rows = t[i : i + MET_ROWS]
            wanted = np.flatnonzero(least <= self._slack(bounds))
            for j in range(0, len(wanted), ASKED_ROWS):
                self._some(wanted[j : j + ASKED_ROWS], q, bounds, i, rows, same, near, place, rank)
        return near, place

    def _some(self, some, q, bounds, first: int, rows, same, near, place, rank) -> None:
        k = near.shape[1]
        d, off = _roughly(q[some], rows, self.power)
        if same is not None:
            own, ids = same[0][some], same[1][first : first + len(rows)]
            order = np.argsort(ids, kind="stable")
            low, high = (np.searchsorted(ids[order], own, side=s) for s in ("left", "right"))
            for at in np.flatnonzero(high > low):
                d[at, order[low[at] : high[at]]] = np.inf
        limit = bounds[some]
        limit = (limit * limit if self.power == 2 else limit) * (1 + 1e-12) + off
        if d.shape[1] > k and np.isinf(limit).any():
            limit = np.minimum(limit, np.partition(d, k - 1, axis=1)[:, k - 1] + 2 * off)
        at, of = np.nonzero((d <= limit[:, None]) & (d < np.inf))
        if not len(at):
            return
        gap = q[some[at]] - rows[of]
        far = np.sqrt((gap * gap).sum(axis=1)) if self.power == 2 else np.abs(gap).sum(axis=1)
        _kept_best(near, place, some[at], of + first, far, rank)
        bounds[some] = np.minimum(bounds[some], near[some, k - 1])

    def _slices(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A few queries at a time, as each is held against every shell."""
        step = max(1, 4_000_000 // max(1, len(self.names)))
        for batch in batches:
            for i in range(0, len(batch), step):
                yield batch.iloc[i : i + step]

    def around(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in self._slices(batches):
            yield self._emit(batch, self._shells(batch)[1])

    def within(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in self._slices(batches):
            near, seen = self._shells(batch)
            bound = batch["bound"].to_numpy(dtype=float)
            bound = np.where(np.isnan(bound), np.inf, bound)
            yield self._emit(batch, ~seen & (near <= self._slack(bound)[:, None]))


def _visit(row: pa.RecordBatch, bounds: np.ndarray | None, block: int) -> pa.RecordBatch:
    """A pack on its way to a block."""
    added = [pa.array([None if bounds is None else bounds.tobytes()], pa.binary()), pa.array([block], pa.int32())]
    return pa.RecordBatch.from_arrays([*(row.column(c) for c in ("pack", "ids", "vectors")), *added], ["pack", "ids", "vectors", "bounds", "block"])


def _ranked(met: DataFrame, k: int, key: str) -> DataFrame:
    best = Window.partitionBy("query").orderBy("distance", "neighbour")
    return (
        met.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .select(F.col("query").alias(key), "neighbour", "label", "distance", "place")
    )


def vote(neighbours: DataFrame, key: str = "id", weights: str = "uniform") -> DataFrame:
    """Winning label per query and its share of the votes; a tie goes to the smaller label.

    With ``distance`` a vote counts one over its distance; neighbours at no distance, if there are
    any, are then the only ones that count.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError(f"weights are uniform or distance, not {weights!r}")
    per_query = Window.partitionBy(key)
    if weights == "uniform":
        weighed = neighbours.withColumn("weight", F.lit(1.0))
    else:
        touching = F.min("distance").over(per_query) == 0
        weight = F.when(touching, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
        weighed = neighbours.withColumn("weight", weight)
    tallied = weighed.groupBy(key, "label").agg(F.sum("weight").alias("weight"))
    return tallied.groupBy(key).agg(
        F.max_by("label", F.struct(F.col("weight"), -F.col("label"))).alias("prediction"),
        (F.max("weight") / F.sum("weight")).alias("share"),
    )


def knn_scores(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str = "label",
    key: str = "game_id",
    k: int = 5,
    weights: str = "uniform",
    metric: str = "euclidean",
) -> DataFrame:
    """Probability of class 1 for each test row from its neighbours in standardised features."""
    scaler = fit_standardiser(train, features)

    def vectors(df: DataFrame) -> DataFrame:
        return scaler.transform(df).select(key, label, F.array(*features).alias("vector"))

    near = nearest(vectors(test), vectors(train), k, "vector", key, label, metric)
    voted = vote(near, key, weights)
    p = F.when(F.col("prediction") == 1, F.col("share")).otherwise(1.0 - F.col("share"))
    return test.join(voted.select(key, p.alias("p")), key)


def _metric(params: dict) -> str:
    """Minkowski distances of power 1 and 2 have names of their own."""
    if params["metric"] != "minkowski":
        return params["metric"]
    return {1: "manhattan", 2: "euclidean"}[params["p"]]


@dataclass
class NeighbourModel:
    """The training rows as a model: ``transform`` adds the votes of the k nearest to each vector."""

    train: DataFrame
    k: int
    weights: str
    metric: str

    @classmethod
    def fit(cls, vectors: DataFrame, features: str, label: str, params: dict) -> NeighbourModel:
        """Keep the rows' vectors and labels, written once, so that they outlast the frame they come from."""
        rows = vectors.select(
            F.monotonically_increasing_id().alias("_query"),
            vector_to_array(F.col(features)).alias("vector"),
            F.col(label).cast("int").alias("label"),
        )
        return cls(durable(rows), params["n_neighbors"], params["weights"], _metric(params))

    def transform(self, df: DataFrame, features: str, probability: str, predicted: str) -> DataFrame:
        """Add the share of the votes for class 1, and the class.

        Training rows of at most 64 MB, which are counted first, are told to every executor, and no row of ``df`` is moved; in
        many dimensions nearly all of them have to be looked at anyway. Beyond that the rows meet block by block.
        """
        width = self.train.select(F.size("vector")).first()
        if width is not None and self.train.count() * width[0] * 8 <= HELD_BYTES:
            return self._beside(df, features, probability, predicted)
        rows = durable(df.withColumn("_query", F.monotonically_increasing_id()))
        asked = rows.select("_query", vector_to_array(F.col(features)).alias("vector"))
        near = nearest(asked, self.train, self.k, "vector", "_query", "label", self.metric)
        voted = vote(near, "_query", self.weights)
        p = F.when(F.col("prediction") == 1, F.col("share")).otherwise(1.0 - F.col("share"))
        found = voted.select(
            "_query",
            array_to_vector(F.array(1.0 - p, p)).alias(probability),
            F.col("prediction").cast("double").alias(predicted),
        )
        return rows.join(found, "_query").drop("_query")

    def _beside(self, df: DataFrame, features: str, probability: str, predicted: str) -> DataFrame:
        held = sorted(self.train.collect(), key=lambda r: r["_query"])
        points = np.array([r["vector"] for r in held], float)
        told = df.sparkSession.sparkContext.broadcast((points, np.array([r["label"] for r in held], float)))
        k, power, weights = self.k, METRICS[self.metric], self.weights

        @F.pandas_udf("double")
        def share(vectors: pd.Series) -> pd.Series:
            points, labels = told.value
            asked, found = _matrix(vectors, points.shape[1]), []
            for at in range(0, len(asked), ASKED_ROWS):
                d = _distances(asked[at : at + ASKED_ROWS], points, power)
                near = _smallest(d, k)
                far = np.take_along_axis(d, near, axis=1)
                w = np.ones(far.shape)
                if weights == "distance":
                    with np.errstate(divide="ignore"):
                        w = np.where(far[:, :1] == 0, (far == 0).astype(float), 1.0 / far)
                found.append((w * (labels[near] == 1)).sum(axis=1) / w.sum(axis=1))
            return pd.Series(np.concatenate([*found, np.zeros(0)]))

        scored = df.withColumn(predicted, share(vector_to_array(F.col(features))))
        p = F.col(predicted)
        return scored.withColumn(probability, array_to_vector(F.array(1.0 - p, p))).withColumn(predicted, (p > 0.5).cast("double"))

    def save(self, path: str) -> None:
        self.train.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, params: dict) -> NeighbourModel:
        return cls(spark.read.parquet(path), params["n_neighbors"], params["weights"], _metric(params))
