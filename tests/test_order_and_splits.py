import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from matchcast.operators import splits
from matchcast.operators.order import exact_medians, values_at
from matchcast.schema import GAME_ORDER


def game_frame(spark, rows):
    return spark.createDataFrame(rows, "game_id long, game_date date, home_team string, away_team string")


def position_map(rows):
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or dt.date.min, r[2], r[3], r[0]))
    return {r[0]: i for i, r in enumerate(order)}


def skewed_rows(n=600, seed=1):
    """A third of the games on one date, a third of those of one team, some without a date."""
    rng = random.Random(seed)
    day = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        date = day + dt.timedelta(days=50 if hot else rng.randrange(100))
        team = "hot" if rng.random() < 0.4 else f"t{rng.randrange(9)}"
        rows.append((i, None if rng.random() < 0.02 else date, team, f"a{rng.randrange(9)}"))
    return rows


@pytest.mark.parametrize("n", [600, 7])
def test_temporal_split_on_a_hot_date(spark, n):
    rows = skewed_rows(n)
    where = position_map(rows)
    got = {r[0]: r[1] for r in splits.temporal_split(game_frame(spark, rows)).select("game_id", "is_test").collect()}
    cut = int(n * 0.8)
    assert got == {g: p >= cut for g, p in where.items()}


def test_temporal_split_when_every_game_is_on_one_date(spark):
    rows = [(i, dt.date(2024, 1, 1), "h", "a") for i in range(101)]
    got = splits.temporal_split(game_frame(spark, rows), 0.25).where("is_test").collect()
    assert sorted(r["game_id"] for r in got) == list(range(int(101 * 0.75), 101))


def test_expanding_folds(spark):
    rows = skewed_rows(103)
    where = position_map(rows)
    got = {r[0]: r[1] for r in splits.expanding_folds(game_frame(spark, rows)).select("game_id", "fold").collect()}
    size, first = 103 // 6, 103 - 5 * (103 // 6)
    assert got == {g: (p - first) // size if p >= first else -1 for g, p in where.items()}
    with pytest.raises(ValueError):
        splits.expanding_folds(game_frame(spark, rows[:4]))


def test_layout_agrees_with_split_and_folds(spark):
    rows = skewed_rows(400, 3)
    df = game_frame(spark, rows)
    where = position_map(rows)
    train, size = 320, 320 // 6
    for r in splits.temporal_layout(df).collect():
        p = where[r["game_id"]]
        assert r["is_test"] == (p >= train)
        expected = 5 if p >= train else max(-1, (p - (train - 5 * size)) // size)
        assert r["fold"] == expected


def test_splits_do_not_depend_on_partitioning(spark):
    df = game_frame(spark, skewed_rows(300, 4))
    one = splits.temporal_layout(df.coalesce(1)).select("game_id", "fold")
    many = splits.temporal_layout(df.repartition(13)).select("game_id", "fold")
    assert one.exceptAll(many).isEmpty()


def test_stratified_folds_are_balanced(spark):
    rows = [(i, "W" if i % 3 else "L") for i in range(500)] + [(1000 + i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "game_id long, outcome string")
    got = splits.stratified_folds(df, "outcome").groupBy("outcome", "fold").count().collect()
    for label in ("W", "L"):
        sizes = [r["count"] for r in got if r["outcome"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert sum(r["count"] for r in got) == 503


def test_random_split_share_and_seed(spark):
    df = spark.range(20000).withColumnRenamed("id", "game_id")
    a = splits.random_split(df, 0.2, 1)
    assert abs(a.where("is_test").count() / 20000 - 0.2) < 0.01
    assert a.exceptAll(splits.random_split(df.repartition(5), 0.2, 1)).isEmpty()


def test_split_plan_has_no_shuffle_of_its_own(spark, games):
    stored = games.select(*GAME_ORDER)
    plan = splits.temporal_layout(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_medians_and_ranks(spark):
    rng = random.Random(5)
    n = 4000
    rows = []
    for i in range(n):
        rows.append(
            (
                rng.random(),
                7.0 if rng.random() < 0.6 else rng.random() * 100,
                rng.choice([1.0, 2.0]),
                None if rng.random() < 0.5 else rng.gauss(0, 1e-9) + 5,
                None,
                float(i if i < n // 2 else i + 1000),
            )
        )
    columns = ["u", "ties", "two", "narrow", "none", "gap"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).persist()
    expected = {}
    for i, c in enumerate(columns):
        present = [r[i] for r in rows if r[i] is not None]
        expected[c] = statistics.median(present) if present else None
    assert exact_medians(df, columns) == expected
    spread = df.repartition(7)
    got = values_at(spread, columns, lambda k: [0, k // 3, k // 3, k - 1])
    for i, c in enumerate(columns):
        present = sorted(r[i] for r in rows if r[i] is not None)
        k = len(present)
        assert got.get(c) == ([present[0], present[k // 3], present[k // 3], present[-1]] if present else None)


def test_median_columns_may_be_absent(spark):
    assert exact_medians(spark.range(3), []) == {}
    empty = spark.createDataFrame([], "a double")
    assert exact_medians(empty, ["a"]) == {"a": None}
    assert F is not None
