"""Target encoding, one-hot columns, label indexes and value cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchcast.operators.order import with_position

NUMERIC = (T.NumericType,)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Names of the numeric columns in table order, without the excluded ones."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in skip]


def clean(value: Column) -> Column:
    """The value as a double, with NaN and both infinities turned into null."""
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def clean_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = numeric_columns(df) if columns is None else columns
    return df.withColumns({c: clean(F.col(c)) for c in names})


def encode_target(df: DataFrame, target: str = "outcome") -> DataFrame:
    """Text ``W`` in any case becomes 1 and every other text, or none, 0. Numbers stay."""
    if target not in df.columns:
        raise ValueError(f"no target column {target!r}")
    if not isinstance(df.schema[target].dataType, T.StringType):
        return df
    won = F.upper(F.col(target)) == "W"
    return df.withColumn(target, F.when(won, F.lit(1)).otherwise(F.lit(0)))


def encode_win_loss(value: Column) -> Column:
    """Only ``W`` and ``L`` are replaced; any other text is read as a number if it is one."""
    text = value.cast("string")
    return F.when(text == "W", F.lit(1)).when(text == "L", F.lit(0)).otherwise(
        text.try_cast("int")
    )


def decode_target(value: Column) -> Column:
    """1 becomes ``W``, 0 becomes ``L``, everything else is missing."""
    return F.when(value == 1, F.lit("W")).when(value == 0, F.lit("L"))


def categories(df: DataFrame, column: str, limit: int) -> list:
    """The sorted distinct values of a categorical column; more than ``limit`` is an error."""
    rows = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.lit(1))
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"{column!r} has more than {limit} values")
    return sorted(row[0] for row in rows)


def category_name(value) -> str:
    if isinstance(value, float) and value.is_integer():
        return f"{value:.1f}"
    return str(value)


def one_hot(df: DataFrame, columns: list[str], widest: int = 1000) -> DataFrame:
    """Replace each column by 0/1 columns for all but the first of its sorted values.

    ``widest`` is the number of columns a single one may become; with more values it is an error.
    """
    indicators = {}
    for column in columns:
        for value in categories(df, column, widest)[1:]:
            indicators[f"{column}_{category_name(value)}"] = F.coalesce(
                (F.col(column) == F.lit(value)).cast("int"), F.lit(0)
            )
    return df.withColumns(indicators).drop(*columns)


def label_index(df: DataFrame, column: str, output: str) -> DataFrame:
    """Position of the value among the sorted distinct values of its column, from 0.

    The distinct values are numbered range by range and joined back, so there may be any number.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
    known = with_position(values.orderBy("_value"), output).withColumn(output, F.col(output).cast("int"))
    return df.join(known, F.col(column) == F.col("_value"), "left").drop("_value")


def parse_date(value: Column) -> Column:
    """Date of a text or timestamp."""
    return F.to_date(value)
