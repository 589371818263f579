"""Temporal split, expanding folds, stratified folds and the keyed random split.

No split shuffles the table it labels: the keys at the cut positions are found first, then every
row is labelled by comparing its own key with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from matchcast.functions.hashing import SPAN, key_residue, mix, uniform
from matchcast.operators.order import at_or_after, keys_at
from matchcast.schema import GAME_ORDER, ROW_KEY

HASH_GROUPS = 4096


def _labelled(df: DataFrame, order: list[str], cuts: list[Row], name: str) -> DataFrame:
    """Number of cut keys at or before the row."""
    passed = [at_or_after(df, order, key).cast("int") for key in cuts]
    label = reduce(lambda a, b: a + b, passed, F.lit(0))
    return df.withColumn(name, label)


def _dated(df: DataFrame, date: str) -> DataFrame:
    """Games without a date come last."""
    return df.withColumn("_undated", F.col(date).isNull())


def _total(counts: DataFrame) -> int:
    return counts.agg(F.sum("_n")).first()[0] or 0


def _fold_starts(total: int, folds: int) -> list[int]:
    size = total // (folds + 1)
    if size == 0:
        raise ValueError(f"{total} rows are too few for {folds} folds")
    return [total - (folds - i) * size for i in range(folds)]


def temporal_split(
    df: DataFrame,
    test_size: float = 0.2,
    order: list[str] = GAME_ORDER,
    output: str = "is_test",
) -> DataFrame:
    """Mark the newest part of the games as test; the oldest ``int(n * (1 - test_size))`` train."""

    def cut(counts: DataFrame) -> list[int]:
        total = _total(counts)
        first_test = int(total * (1 - test_size))
        return [first_test] if first_test < total else []

    keyed = _dated(df, order[0])
    keys = keys_at(keyed, ["_undated", order[0]], order[1:], cut)
    return _labelled(keyed, ["_undated", *order], keys, output).withColumn(
        output, F.col(output) > 0
    ).drop("_undated")


def expanding_folds(
    df: DataFrame, folds: int = 5, order: list[str] = GAME_ORDER, output: str = "fold"
) -> DataFrame:
    """Number the validation blocks 0..folds-1 in time order; -1 marks rows that only train.

    Fold ``i`` is validated on its block and trained on every row with a smaller number.
    """
    keyed = _dated(df, order[0])
    keys = keys_at(
        keyed, ["_undated", order[0]], order[1:], lambda c: _fold_starts(_total(c), folds)
    )
    labelled = _labelled(keyed, ["_undated", *order], keys, output)
    return labelled.withColumn(output, F.col(output) - 1).drop("_undated")


def temporal_layout(
    df: DataFrame, test_size: float = 0.2, folds: int = 5, order: list[str] = GAME_ORDER
) -> DataFrame:
    """Both at once: ``is_test`` of the split, and ``fold`` of the training rows.

    Test rows have the fold number ``folds``. All cut positions are looked up together.
    """

    def cuts(counts: DataFrame) -> list[int]:
        total = _total(counts)
        first_test = int(total * (1 - test_size))
        starts = _fold_starts(first_test, folds)
        return starts + ([first_test] if first_test < total else [])

    keyed = _dated(df, order[0])
    keys = keys_at(keyed, ["_undated", order[0]], order[1:], cuts)
    labelled = _labelled(keyed, ["_undated", *order], keys, "fold")
    return labelled.withColumn("fold", F.col("fold") - 1).withColumn(
        "is_test", F.col("fold") == folds
    ).drop("_undated")


def stratified_folds(
    df: DataFrame,
    label: str,
    folds: int = 5,
    seed: int = 42,
    key: str = ROW_KEY,
    output: str = "fold",
) -> DataFrame:
    """Shuffled folds that each hold an equal share of every class, to within one row.

    Rows of a class are ordered by a hash of their key and that order is cut into equal runs.
    """
    hashed = mix(key_residue(F.col(key), df.schema[key].dataType), seed)
    width = SPAN // HASH_GROUPS + 1
    # The label and a hash range form the coarse key, so that few rows need sorting.
    keyed = df.withColumns(
        {"_class": F.col(label), "_hash": hashed, "_range": F.floor(hashed / width)}
    )
    owners: list = []

    def cuts(counts: DataFrame) -> list[int]:
        sizes = counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect()
        positions, start = [], 0
        for row in sorted(sizes, key=lambda r: (r["_class"] is not None, r["_class"])):
            # A class with fewer rows than folds has runs of no rows; they need no cut.
            inner = [i * row["n"] // folds for i in range(1, folds)]
            positions += [start + at for at in inner]
            owners.extend([row["_class"]] * len(inner))
            start += row["n"]
        return positions

    order = ["_class", "_range", "_hash", key]
    keys = keys_at(keyed, ["_class", "_range"], ["_hash", key], cuts)
    fold: Column = F.lit(0)
    for cls, bound in zip(owners, keys):
        mine = F.col("_class").eqNullSafe(F.lit(cls))
        fold = fold + (mine & at_or_after(keyed, order, bound)).cast("int")
    return keyed.withColumn(output, fold).drop("_class", "_hash", "_range")


def random_split(
    df: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    key: str = ROW_KEY,
    output: str = "is_test",
) -> DataFrame:
    """Mark a random share of the rows, decided by each row's key and the seed alone."""
    draw = uniform(key_residue(F.col(key), df.schema[key].dataType), seed)
    return df.withColumn(output, draw < test_size)
