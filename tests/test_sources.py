import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchcast import schema
from matchcast.sources import readers, writers

DAY = dt.date(2024, 3, 1)
COLUMNS = "home_team string, game_date date, p double"


def stored(spark, path):
    return {(r["home_team"], r["game_date"]): r for r in spark.read.parquet(path).collect()}


def test_upsert_inserts_updates_and_keeps_creation_time(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", DAY, 0.1), ("b", DAY, 0.2), ("c", dt.date(2024, 3, 2), 0.3)], COLUMNS)
    assert writers.upsert(first, path)
    before = stored(spark, path)
    assert len(before) == 3 and all(r["created_at"] is not None for r in before.values())
    assert writers.upsert(spark.createDataFrame([("b", DAY, 0.9), ("d", DAY, 0.4)], COLUMNS), path)
    after = stored(spark, path)
    assert {k: r["p"] for k, r in after.items()} == {
        ("a", DAY): 0.1, ("b", DAY): 0.9, ("c", dt.date(2024, 3, 2)): 0.3, ("d", DAY): 0.4
    }
    assert after["b", DAY]["created_at"] == before["b", DAY]["created_at"]
    assert after["d", DAY]["created_at"] > before["b", DAY]["created_at"]
    writers.upsert(spark.createDataFrame([("b", DAY, 0.9), ("d", DAY, 0.4)], COLUMNS), path)
    assert stored(spark, path) == after


def test_upsert_with_a_hot_key_and_many_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("home_team"),
        F.when(F.col("id") % 3 == 0, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), (F.col("id") % 50).cast("int"))).alias("game_date"),
        F.col("id").cast("double").alias("p"),
    )
    assert writers.upsert(rows, path, order=["p"])
    assert writers.upsert(rows.where("p < 1500").withColumn("p", -F.col("p")), path, order=["p"])
    got = spark.read.parquet(path)
    assert got.count() == 2001
    assert got.where("home_team = 'hot'").first()["p"] == 0.0
    assert got.where("home_team = '2999'").first()["p"] == 2999.0
    assert got.where("home_team = '4'").first()["p"] == -4.0


def test_upsert_by_month_rewrites_touched_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    april = dt.date(2024, 4, 2)
    writers.upsert(spark.createDataFrame([("a", DAY, 0.1), ("b", april, 0.2)], COLUMNS), path, grain="month")
    files = sorted((tmp_path / "t").glob("game_date_month=2024-03-01/*.parquet"))
    writers.upsert(spark.createDataFrame([("b", april, 0.5), ("c", april, 0.6)], COLUMNS), path, grain="month")
    got = stored(spark, path)
    assert {k: r["p"] for k, r in got.items()} == {("a", DAY): 0.1, ("b", april): 0.5, ("c", april): 0.6}
    assert files and files == sorted((tmp_path / "t").glob("game_date_month=2024-03-01/*.parquet"))
    with pytest.raises(ValueError):
        writers.upsert(spark.createDataFrame([("a", DAY, 0.1)], COLUMNS), path, grain="week")


def test_upsert_of_nothing_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], COLUMNS)
    assert not writers.upsert(none, path)
    assert writers.read_existing(spark, path) is None
    writers.upsert(spark.createDataFrame([("a", DAY, 0.1)], COLUMNS), path)
    assert not writers.upsert(none, path)
    assert len(stored(spark, path)) == 1
    with pytest.raises(ValueError):
        writers.upsert(none, path, keys=["home_team"])


def test_validated_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", DAY, 0.1)], COLUMNS)
    assert writers.write_validated(df, path, df.schema)
    assert writers.write_validated(df, path, df.schema, "append")
    assert spark.read.parquet(path).count() == 2
    assert writers.write_validated(df, path, df.schema, "replace")
    assert spark.read.parquet(path).count() == 1
    assert not writers.write_validated(df.drop("p"), path, df.schema)
    assert not writers.write_validated(df.where("false"), path, df.schema)
    with pytest.raises(ValueError):
        writers.write_validated(df, path, df.schema, "upsert")


def test_flags(spark):
    flags = spark.createDataFrame([(1, "season", 1), (2, "playoffs", 0)], "id int, flag string, is_enabled int")
    games = spark.range(4)
    assert readers.is_enabled(flags, "season") is True
    assert readers.is_enabled(flags, "playoffs") is False
    assert readers.is_enabled(flags, "absent") is False
    assert readers.gate_on_flag(games, flags, "season").count() == 4
    assert readers.gate_on_flag(games, flags, "x' or '1'='1").count() == 0


GAMES = "home_team string, game_date date, home_team_avg_pts_scored double"


def test_freshness_looks_at_the_first_game_only(spark):
    old = dt.date(2020, 1, 1)
    games = spark.createDataFrame([("a", old, None), ("b", DAY, 100.0), ("c", old, 101.0)], GAMES)
    assert readers.leading_date(games).first()[0] == DAY
    assert readers.gate_on_date(games, DAY).count() == 3
    assert readers.gate_on_date(games, old).count() == 0
    assert {r["stale"] for r in readers.mark_stale(games, old).collect()} == {True}
    assert {r["stale"] for r in readers.mark_stale(games, DAY).collect()} == {False}
    assert readers.gate_on_date(games.where("false"), DAY).isEmpty()


def test_scan_order_puts_missing_last(spark):
    games = spark.createDataFrame([("a", DAY, None), ("b", DAY, 100.0), ("c", DAY, 90.0)], GAMES)
    assert [r["home_team"] for r in readers.scan_games(games).collect()] == ["c", "b", "a"]
    plain = games.drop("home_team_avg_pts_scored")
    assert readers.scan_games(plain) is plain


def test_projection_rules(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert readers.drop_strict(df, ["a"]).columns == ["b", "c"]
    with pytest.raises(ValueError):
        readers.drop_strict(df, ["a", "absent"])
    assert readers.drop_present(df, ["a", "absent"]).columns == ["b", "c"]
    aligned = readers.align_columns(df, ["b", "new", "a"])
    assert aligned.columns == ["b", "new", "a"] and aligned.first()["new"] == 0.0


def test_csv_and_decimals(spark, tmp_path):
    path = str(tmp_path / "past.csv")
    with open(path, "w") as f:
        f.write(",".join(schema.PAST_GAMES.names) + "\n")
        f.write(",".join("" for _ in schema.PAST_GAMES.names) + ",\n")
    df = readers.read_csv(spark, path, schema.PAST_GAMES)
    assert df.schema == schema.PAST_GAMES and df.count() == 1
    money = spark.sql("SELECT CAST(1.5 AS DECIMAL(10, 2)) AS m, 1 AS n")
    assert readers.numeric_as_double(money).dtypes == [("m", "double"), ("n", "int")]


def test_contracts():
    assert len(schema.GAMES_V1) == 20 and len(schema.GAMES_V2) == 33
    assert len(schema.PREDICTIONS_V1) == 22 and len(schema.PREDICTIONS_V2) == 35
    assert len(schema.FEATURE_COLUMNS) == 27 and len(schema.METADATA_COLUMNS) == 14
    assert len(schema.DERIVED_COLUMNS) == 14
    assert set(schema.FEATURE_COLUMNS) < set(schema.GAMES_V2.names)
