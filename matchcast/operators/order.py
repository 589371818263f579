"""Exact order statistics without sorting a whole table in one task.

``keys_at`` finds the sort keys at given positions of a total order, so that a split or a fold is
afterwards a plain comparison of each row's key with a few constants. ``values_at`` finds the values
of many columns at chosen ranks at once, for medians and quantiles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from matchcast.durable import durable


# --- keys at positions -----------------------------------------------------------------------


def keys_at(
    df: DataFrame,
    coarse: list[str],
    fine: list[str],
    choose: Callable[[DataFrame], list[int]],
) -> list[Row]:
    """The sort keys of the rows at chosen positions (from 0) in the order ``coarse + fine``.

    Rows are counted per coarse key first (a small, map-side combined aggregate). ``choose`` turns
    those counts (column ``_n``) into positions, and they settle in which coarse group each position
    falls. Only the rows of those groups are then sorted, by all key columns and spread over range
    partitions, so a coarse group may be as large as it likes. Nulls sort first, as in Spark's
    default ascending order.
    """
    order = coarse + fine
    counts = durable(df.groupBy(*coarse).agg(F.count(F.lit(1)).alias("_n")))
    positions = choose(counts)
    if not positions:
        return []
    wanted = sorted(set(positions))
    # One row per coarse key, so the unpartitioned window is over a small frame.
    running = Window.orderBy(*coarse).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = counts.withColumn("_end", F.sum("_n").over(running))
    hits = F.filter(
        F.array(*(F.lit(p).cast("long") for p in wanted)),
        lambda p: (p < F.col("_end")) & (p >= F.col("_end") - F.col("_n")),
    )
    groups = (
        ends.withColumn("_hits", hits)
        .where(F.size("_hits") > 0)
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .collect()
    )
    if sum(len(g["_hits"]) for g in groups) != len(wanted):
        raise ValueError("a position lies outside the table")

    within = reduce(
        lambda a, b: a | b,
        (
            reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(g[c])) for c in coarse))
            for g in groups
        ),
    )
    # Every position as a rank among the kept rows: groups are in order and kept whole.
    groups.sort(key=lambda g: g["_start"])
    ranks, kept = [], 0
    for g in groups:
        ranks += [kept + p - g["_start"] for p in sorted(g["_hits"])]
        kept += g["_n"]
    found = _rows_at(df.where(within).select(*order), order, ranks)
    by_position = dict(zip(wanted, found))
    return [by_position[p] for p in positions]


def _rows_at(keys: DataFrame, order: list[str], ranks: list[int]) -> list[Row]:
    """The rows at the given ranks, from range partitions fixed by a checkpoint."""
    ranged = durable(
        keys.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    )
    sizes = {r["_slice"]: r["n"] for r in ranged.groupBy("_slice").agg(F.count("*").alias("n")).collect()}
    targets, start = [], 0
    pending = sorted(set(ranks))
    for slice_id in sorted(sizes):
        end = start + sizes[slice_id]
        targets += [(slice_id, r - start + 1, r) for r in pending if start <= r < end]
        start = end
    inside = Window.partitionBy("_slice").orderBy(*order)
    hit = reduce(
        lambda a, b: a | b,
        ((F.col("_slice") == s) & (F.col("_row") == i) for s, i, _ in targets),
    )
    slices = sorted({s for s, _, _ in targets})
    rows = (
        ranged.where(F.col("_slice").isin(slices))
        .withColumn("_row", F.row_number().over(inside))
        .where(hit)
        .collect()
    )
    located = {(r["_slice"], r["_row"]): r for r in rows}
    by_rank = {r: located[(s, i)] for s, i, r in targets}
    return [by_rank[r] for r in ranks]


def at_or_after(df: DataFrame, order: list[str], key: Row) -> Column:
    """Whether a row's key is not before ``key``: a projection, no shuffle."""
    types = {f.name: f.dataType for f in df.schema}
    bound = F.struct(*(F.lit(key[c]).cast(types[c]).alias(c) for c in order))
    return F.struct(*(F.col(c) for c in order)) >= bound


# --- positions -------------------------------------------------------------------------------


def with_position(ordered: DataFrame, output: str) -> DataFrame:
    """Number the rows of an ordered table from 0 in their order.

    Rows are counted per range of the order, and a row's place in its range is added to the rows of
    the ranges before it; one number a range comes to the driver.
    """
    placed = durable(
        ordered.withColumns(
            {"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
        )
    )
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("at"))
    offsets, start = [], 0
    for r in sorted(sizes.collect(), key=lambda r: r["_slice"]):
        offsets.append((r["_slice"], start - r["at"]))
        start += r["n"]
    starts = ordered.sparkSession.createDataFrame(offsets, "_slice int, _start long")
    numbered = placed.join(F.broadcast(starts), "_slice").withColumn(output, F.col("_at") + F.col("_start"))
    return numbered.drop("_slice", "_at", "_start")


# --- values at ranks -------------------------------------------------------------------------


def values_at(
    df: DataFrame, columns: list[str], choose: Callable[[int], list[int]]
) -> dict[str, list[float]]:
    """The values of each column at chosen ranks (from 0) of its ascending order.

    ``choose`` turns a column's number of values, nulls aside, into ranks. Values must be free of
    NaN. The columns are stacked and counted per distinct value, combined before the shuffle; the
    counts are dealt to ranges of values. One sum per range tells in which of them a rank lies, and
    only those ranges are sorted. No column, nor a value that fills it, meets in one task.
    """
    counts = _stack(df, columns).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = durable(
        counts.repartitionByRange("name", "value").withColumn("_slice", F.spark_partition_id())
    )
    sums: dict[str, list[tuple[int, int]]] = {}
    for r in ranged.groupBy("name", "_slice").agg(F.sum("n").alias("n")).collect():
        sums.setdefault(r["name"], []).append((r["_slice"], r["n"]))
    targets, asked = [], {}
    for name, slices in sums.items():
        asked[name] = choose(sum(n for _, n in slices))
        start = 0
        for piece, n in sorted(slices):
            inside = sorted({r - start for r in asked[name] if start <= r < start + n})
            if inside:
                targets.append((name, piece, start, inside))
            start += n
    if not targets:
        return {}
    wanted = df.sparkSession.createDataFrame(
        targets, "name string, _slice int, _start long, ranks array<long>"
    )
    running = Window.partitionBy("name", "_slice").orderBy("value")
    ends = ranged.join(wanted, ["name", "_slice"]).withColumn("_end", F.sum("n").over(running))
    hits = F.filter("ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("n")))
    found = {
        (r["name"], r["rank"]): r["value"]
        for r in ends.select("name", "value", "_start", F.explode(hits).alias("hit"))
        .select("name", "value", (F.col("_start") + F.col("hit")).alias("rank"))
        .collect()
    }
    return {name: [found[name, r] for r in ranks] for name, ranks in asked.items()}


def exact_medians(df: DataFrame, columns: list[str]) -> dict:
    """Exact median of every column (mean of the two middle values for an even count).

    Values must be free of NaN; a column without values has none.
    """
    if not columns:
        return {}
    middle = values_at(df, columns, lambda n: [(n - 1) // 2, n // 2])
    return dict.fromkeys(columns) | {c: (low + high) / 2 for c, (low, high) in middle.items()}


def _stack(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column and row that has a value: ``name, value``."""
    cells = (
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns
    )
    stacked = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return stacked.where(F.col("value").isNotNull())
