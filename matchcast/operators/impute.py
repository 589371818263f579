"""Feature preparation fitted on training rows: derive, clean, impute; and standardising."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.functions.derive import derive_features
from matchcast.functions.encode import clean, clean_numeric, numeric_columns
from matchcast.operators.order import exact_medians
from matchcast.schema import ROW_KEY, TARGET


@dataclass
class FeatureState:
    """What preparation learned: the column order and one median per column.

    ``empty`` lists columns that had no value in training; they are filled with 0.
    """

    columns: list[str]
    medians: dict[str, float]
    empty: list[str] = field(default_factory=list)


def fit_features(
    train: DataFrame, exclude: tuple[str, ...] = (TARGET, ROW_KEY)
) -> FeatureState:
    """Learn the numeric columns and their medians from the training rows only."""
    derived = derive_features(train)
    columns = numeric_columns(derived, exclude)
    medians = exact_medians(clean_numeric(derived, columns).select(*columns), columns)
    empty = [c for c in columns if medians[c] is None]
    return FeatureState(columns, {c: 0.0 if c in empty else medians[c] for c in columns}, empty)


def apply_features(df: DataFrame, state: FeatureState | None) -> DataFrame:
    """Derive, clean and impute. A column the table lacks is filled with its training median."""
    if state is None:
        raise ValueError("features are not fitted; call fit_features on training rows first")
    derived = derive_features(df)
    present = set(derived.columns)
    filled = {
        c: F.coalesce(clean(F.col(c)), F.lit(state.medians[c]))
        if c in present
        else F.lit(float(state.medians[c]))
        for c in state.columns
    }
    return derived.withColumns(filled)


def impute_median(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill missing values of ``df`` with the medians of ``train``."""
    medians = exact_medians(clean_numeric(train, columns).select(*columns), columns)
    return df.withColumns(
        {c: F.coalesce(clean(F.col(c)), F.lit(medians[c] if medians[c] is not None else 0.0))
         for c in columns}
    )


@dataclass
class Standardiser:
    """Mean and population standard deviation per column; a zero deviation counts as one."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - self.means[c]) / self.deviations[c] for c in self.means}
        )


def fit_standardiser(
    df: DataFrame, columns: list[str], weight: str | None = None
) -> Standardiser:
    """Learn means and deviations; rows may carry a weight (copies of a row).

    Weighted deviations take a second pass, from the means, so that nothing cancels.
    """
    if weight is None:
        aggregates = []
        for c in columns:
            aggregates += [F.avg(c).alias(f"{c}:mean"), F.stddev_pop(c).alias(f"{c}:std")]
        row = df.agg(*aggregates).first()
        means = {c: row[f"{c}:mean"] or 0.0 for c in columns}
        return Standardiser(means, {c: row[f"{c}:std"] or 1.0 for c in columns})
    w = F.col(weight).cast("double")

    def weighted(values: dict) -> dict:
        means = {c: F.sum(w * v) / F.sum(F.when(F.col(c).isNotNull(), w)) for c, v in values.items()}
        return df.agg(*(m.alias(c) for c, m in means.items())).first().asDict()

    means = {c: m or 0.0 for c, m in weighted({c: F.col(c).cast("double") for c in columns}).items()}
    squares = weighted({c: (F.col(c) - means[c]) * (F.col(c) - means[c]) for c in columns})
    return Standardiser(means, {c: (squares[c] or 0.0) ** 0.5 or 1.0 for c in columns})
