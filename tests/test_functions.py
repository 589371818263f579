import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchcast.functions import encode, odds
from matchcast.functions.derive import derive_features, fatigue_index
from matchcast.functions.hashing import key_residue, normal, uniform, with_poisson


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_implied_probability(spark):
    got = values(
        spark, [(150.0,), (-110.0,), (0.0,), (None,)], "o double", odds.implied_probability(F.col("o"))
    )
    assert [round(v, 6) if v is not None else None for (v,) in got] == [0.4, 0.52381, 0.5, None]


def test_decimal_payout(spark):
    got = values(
        spark, [(150.0,), (-200.0,), (0.0,), (None,)], "o double", odds.decimal_payout(F.col("o"))
    )
    assert [v for (v,) in got] == [2.5, 1.5, None, None]


def test_rounded_pair_adds_up_on_ties(spark):
    home, away = odds.probability_pair(F.col("p"))
    rows = [(0.0005,), (0.0025,), (0.6345,), (0.5,), (0.1235,), (0.9995,)]
    for h, a in values(spark, rows, "p double", home, away):
        assert round(h + a, 9) == 1.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0.05, 0.95), min_size=20, max_size=60))
def test_offered_odds_lean_towards_the_bookmaker(spark, ps):
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    back = odds.implied_probability(odds.american_odds(F.col("p")))
    for p, q in df.select("p", back).collect():
        expected = min(max(p + 0.02, 0.05), 0.95)
        assert abs(q - expected) < 0.005


def test_target_encoding(spark):
    df = spark.createDataFrame([("W",), ("w",), ("L",), (None,), ("x",)], "outcome string")
    assert [r[0] for r in encode.encode_target(df).collect()] == [1, 1, 0, 0, 0]
    numbers = spark.createDataFrame([(1,), (None,)], "outcome int")
    assert encode.encode_target(numbers).collect() == numbers.collect()
    with pytest.raises(ValueError):
        encode.encode_target(df, "absent")


def test_win_loss_leaves_other_text_as_number(spark):
    got = values(spark, [("W",), ("L",), ("7",), ("draw",)], "v string", encode.encode_win_loss(F.col("v")))
    assert [v for (v,) in got] == [1, 0, 7, None]


def test_one_hot_drops_first_category(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0), (4, None)], "id int, level double")
    got = {r["id"]: (r["level_1.0"], r["level_2.0"]) for r in
           [x.asDict() for x in encode.one_hot(df, ["level"]).collect()]}
    assert got == {1: (0, 0), 2: (1, 0), 3: (0, 1), 4: (0, 0)}


def test_clean_turns_nan_and_infinity_into_null(spark):
    rows = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    got = values(spark, rows, "v double", encode.clean(F.col("v")))
    assert [v for (v,) in got] == [1.0, None, None, None, None]


def test_fatigue_stand_ins_and_rest_cap(spark):
    index = fatigue_index(F.col("r"), F.col("g"), F.col("m"), F.col("c"))
    rows = [(None, None, None, None), (10.0, 1.0, 0.0, 1.0), (0.0, 4.0, 99.0, 0.0)]
    got = [v for (v,) in values(spark, rows, "r double, g double, m double, c double", index)]
    expected = [
        1.5 + 2 + 0.5 * math.log1p(500),
        0.0 + 1 + 0.0 + 2.0,
        4.5 + 4 + 0.5 * math.log1p(99),
    ]
    assert got == pytest.approx(expected)


def test_derived_only_where_inputs_exist(spark):
    df = spark.createDataFrame(
        [(0.6, 0.5, 3, 5)],
        "home_team_win_pct double, away_team_win_pct double, home_team_rank int, away_team_rank int",
    )
    out = derive_features(df)
    assert set(out.columns) - set(df.columns) == {"win_pct_diff", "rank_diff"}
    row = out.first()
    assert row["rank_diff"] == 2.0 and round(row["win_pct_diff"], 9) == 0.1


def test_uniforms_and_normals_look_random(spark):
    ids = spark.range(20000)
    r = key_residue(F.col("id"))
    df = ids.select(
        uniform(r, 1).alias("a"), uniform(r, 2).alias("b"), normal(F.col("id"), 7).alias("z")
    )
    row = df.agg(
        F.avg("a"), F.var_pop("a"), F.corr("a", "b"), F.avg("z"), F.var_pop("z"), F.min("a"), F.max("a")
    ).first()
    assert abs(row[0] - 0.5) < 0.01 and abs(row[1] - 1 / 12) < 0.003 and abs(row[2]) < 0.03
    assert abs(row[3]) < 0.03 and abs(row[4] - 1) < 0.05
    assert 0 < row[5] and row[6] < 1
    lag = ids.select("id", uniform(r, 1).alias("a")).join(
        ids.select((F.col("id") + 1).alias("id"), uniform(r, 1).alias("next")), "id"
    )
    assert abs(lag.agg(F.corr("a", "next")).first()[0]) < 0.03


def test_keys_of_one_residue_are_drawn_apart(spark):
    keys = spark.createDataFrame([(5 + i * 2147483647,) for i in range(400)], "id long")
    u = uniform(key_residue(F.col("id")), 42)
    row = keys.select(u.alias("u")).agg(F.countDistinct("u"), F.avg("u"), F.var_pop("u")).first()
    assert row[0] == 400 and abs(row[1] - 0.5) < 0.06 and abs(row[2] - 1 / 12) < 0.02


def test_poisson_counts(spark):
    u = uniform(key_residue(F.col("id")), 3)
    row = with_poisson(spark.range(30000), u, "k").agg(F.avg("k"), F.var_pop("k")).first()
    assert abs(row[0] - 1) < 0.03 and abs(row[1] - 1) < 0.05
