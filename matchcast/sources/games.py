"""The game table built from the supplied order and customer tables.

Every order is a game: its customer plays at home and another customer, found by arithmetic on the
key, plays away. Nulls, zero odds and repeated team-and-date keys are built in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a table by its key over at least as many partitions as there are cores."""
    splits = max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df.repartition(splits, key)


def load_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(read(spark, sf_dir, "orders"), "o_orderkey")
    customer = read(spark, sf_dir, "customer")
    home = customer.select(
        F.col("c_custkey").alias("h_key"),
        F.col("c_name").alias("home_team"),
        F.col("c_nationkey").alias("h_nation"),
        F.col("c_acctbal").alias("h_balance"),
    )
    away = customer.select(
        F.col("c_custkey").alias("a_key"),
        F.col("c_name").alias("away_team"),
        F.col("c_nationkey").alias("a_nation"),
        F.col("c_acctbal").alias("a_balance"),
    )
    teams = customer.agg(F.count(F.lit(1))).scalar()
    joined = (
        orders.join(home, F.col("o_custkey") == F.col("h_key"))
        .withColumn("_away", (F.col("o_custkey") * 7 + 3) % teams)
        .join(away, F.col("_away") == F.col("a_key"))
    )
    key = F.col("o_orderkey")

    def number(value: Column) -> Column:
        return value.cast("double")

    def missing_every(n: int, value: Column) -> Column:
        return F.when(key % n != 0, value)

    return joined.select(
        key.alias("game_id"),
        F.col("o_orderdate").cast("date").alias("game_date"),
        "home_team",
        "away_team",
        F.when(key % 101 == 0, F.lit(None))
        .when(key % 97 == 0, F.lit(0.0))
        .when(key % 2 == 0, -number(100 + key % 300))
        .otherwise(number(100 + key % 400))
        .alias("home_moneyline"),
        F.when(key % 2 == 0, number(100 + key % 280))
        .otherwise(-number(100 + key % 380))
        .alias("away_moneyline"),
        number(1 + F.col("h_nation")).alias("home_team_rank"),
        number(1 + F.col("a_nation")).alias("away_team_rank"),
        missing_every(13, number(key % 6)).alias("home_days_rest"),
        number((key + 2) % 5).alias("away_days_rest"),
        missing_every(29, number(1 + key % 4)).alias("home_games_last_7_days"),
        number(1 + (key + 1) % 4).alias("away_games_last_7_days"),
        missing_every(31, F.col("o_totalprice") / 100.0).alias("home_travel_miles_last_7_days"),
        number(key * 7 % 4000).alias("away_travel_miles_last_7_days"),
        number(F.when(key % 7 == 0, 1).otherwise(0)).alias("home_is_cross_country_trip"),
        number(F.when(key % 9 == 0, 1).otherwise(0)).alias("away_is_cross_country_trip"),
        missing_every(23, 105.0 + F.col("h_balance") / 500.0).alias("home_team_avg_pts_scored"),
        (105.0 + F.col("a_balance") / 500.0).alias("away_team_avg_pts_scored"),
        (115.0 - F.col("h_balance") / 1000.0).alias("home_team_avg_pts_scored_opp"),
        (115.0 - F.col("a_balance") / 1000.0).alias("away_team_avg_pts_scored_opp"),
        (number(F.col("o_custkey") * 37 % 1000) / 1000.0).alias("home_team_win_pct"),
        (number(F.col("a_key") * 37 % 1000) / 1000.0).alias("away_team_win_pct"),
        (number(key % 11) / 10.0).alias("home_team_win_pct_last10"),
        (number(key * 3 % 11) / 10.0).alias("away_team_win_pct_last10"),
        number(key % 6).alias("home_star_score"),
        number((key * 5 + 1) % 6).alias("away_star_score"),
        (F.col("h_balance") / 2000.0).alias("home_active_vorp"),
        (F.col("a_balance") / 2000.0).alias("away_active_vorp"),
        F.when(F.col("o_orderstatus") == "F", "W")
        .when(F.col("o_orderstatus") == "O", "L")
        .when(key % 2 == 0, "W")
        .otherwise("L")
        .alias("outcome"),
    )
