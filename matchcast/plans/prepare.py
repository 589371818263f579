"""From a raw game table to training and test rows without look-ahead."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.durable import durable
from matchcast.functions.encode import encode_target, parse_date
from matchcast.operators.impute import FeatureState, apply_features, fit_features
from matchcast.operators.splits import temporal_layout
from matchcast.schema import GAME_ORDER, METADATA_COLUMNS, ROW_KEY, TARGET

LABEL = "label"


@dataclass
class Prepared:
    """All games with features filled from the training part, and what was learned there.

    ``rows`` keeps the keys and odds beside the features and marks ``is_test`` and ``fold``.
    """

    rows: DataFrame
    state: FeatureState
    features: list[str]

    @property
    def train(self) -> DataFrame:
        return self.rows.where(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("is_test"))


def prepare_train_test(
    games: DataFrame,
    test_size: float = 0.2,
    folds: int = 5,
    order: list[str] = GAME_ORDER,
    target: str = TARGET,
    keep_unplayed: bool = False,
) -> Prepared:
    """Parse dates, encode the target, split in time, fit features on train, apply to all.

    Games without an outcome are left out unless ``keep_unplayed`` asks for them as losses. The dated
    and encoded games are written once; everything that is learned, and every use of the rows,
    reads them from there.
    """
    if target not in games.columns:
        raise ValueError(f"no target column {target!r}")
    played = games if keep_unplayed else games.where(F.col(target).isNotNull())
    dated = played.withColumn(order[0], parse_date(F.col(order[0])))
    encoded = encode_target(dated, target).withColumnRenamed(target, LABEL)
    laid_out = temporal_layout(durable(encoded), test_size, folds, order)
    not_features = (LABEL, ROW_KEY, "fold", *[k for k in order if k not in METADATA_COLUMNS])
    state = fit_features(laid_out.where(~F.col("is_test")), exclude=not_features)
    rows = apply_features(laid_out, state)
    features = [c for c in state.columns if c not in METADATA_COLUMNS]
    return Prepared(rows, state, features)
