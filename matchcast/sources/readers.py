"""Reading feature tables, flags and CSV files, and the gates a job passes before it scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SORT_COLUMN = "home_team_avg_pts_scored"


def read_table(
    spark: SparkSession,
    path: str | None = None,
    schema: T.StructType | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A stored table: a Parquet folder, or a JDBC table given by its reader options."""
    if jdbc is not None:
        table = spark.read.format("jdbc").options(**jdbc).load()
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        table = reader.parquet(path)
    return numeric_as_double(table)


def numeric_as_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, so that no later arithmetic is done in decimals."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header, read by a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def first_seen_order(df: DataFrame, keys: list[str]) -> list[Column]:
    """Ascending points scored, missing last, with the keys breaking ties."""
    lead = [F.col(SORT_COLUMN).asc_nulls_last()] if SORT_COLUMN in df.columns else []
    return lead + [F.col(k).asc_nulls_last() for k in keys]


def scan_games(games: DataFrame, keys: list[str] = ("game_date", "home_team")) -> DataFrame:
    """Tonight's games in presentation order; unsorted if the sort column is absent."""
    if SORT_COLUMN not in games.columns:
        return games
    return games.orderBy(*first_seen_order(games, list(keys)))


# --- gates -----------------------------------------------------------------------------------


def flag_value(flags: DataFrame, flag: str) -> DataFrame:
    """One row: whether the flag is on. A flag that is not listed is off."""
    on = F.max_by(F.col("is_enabled"), -F.col("id")) if "id" in flags.columns else F.max("is_enabled")
    return flags.where(F.col("flag") == F.lit(flag)).agg(
        F.coalesce(on != 0, F.lit(False)).alias("enabled")
    )


def is_enabled(flags: DataFrame, flag: str) -> bool:
    return flag_value(flags, flag).first()["enabled"]


def gate_on_flag(games: DataFrame, flags: DataFrame, flag: str) -> DataFrame:
    """All games if the flag is on, none otherwise."""
    return games.where(flag_value(flags, flag).scalar())


def leading_date(games: DataFrame, keys: list[str] = ("game_date", "home_team")) -> DataFrame:
    """One row: the date of the game that comes first in presentation order."""
    order = []
    for name in ([SORT_COLUMN] if SORT_COLUMN in games.columns else []) + list(keys):
        order += [F.col(name).isNull(), F.col(name)]
    rank = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    return games.agg(F.min_by(F.to_date("game_date"), rank).alias("first_date"))


def gate_on_date(
    games: DataFrame, as_of: dt.date, keys: list[str] = ("game_date", "home_team")
) -> DataFrame:
    """All games if the first one is played on ``as_of``, none otherwise."""
    fresh = leading_date(games, keys).select(F.col("first_date") == F.lit(as_of))
    return games.where(F.coalesce(fresh.scalar(), F.lit(False)))


def mark_stale(
    games: DataFrame, as_of: dt.date, keys: list[str] = ("game_date", "home_team")
) -> DataFrame:
    """Keep all games and say in ``stale`` whether the first one is from another day."""
    first = leading_date(games, keys).scalar()
    return games.withColumn("stale", ~first.eqNullSafe(F.lit(as_of)))


def drop_strict(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns that must all be there."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to drop are missing: {missing}")
    return df.drop(*columns)


def drop_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop those of the columns that are there."""
    return df.drop(*columns)


def align_columns(df: DataFrame, columns: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly the given columns in that order; absent ones hold ``fill``."""
    present = set(df.columns)
    return df.select(*(F.col(c) if c in present else F.lit(fill).alias(c) for c in columns))
