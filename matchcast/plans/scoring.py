"""Nightly scoring: gates, win probabilities and the keyed write."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.functions.encode import clean_numeric
from matchcast.functions.odds import probability_pair, round_even
from matchcast.operators.ensembles import load_model
from matchcast.operators.impute import apply_features
from matchcast.operators.learners import Artifacts, Classifier
from matchcast.schema import (
    AWAY_PROBABILITY,
    HOME_PROBABILITY,
    TARGET,
    UPSERT_KEYS,
    V1_EXCLUDE_COLUMNS,
)
from matchcast.sources import readers, writers

logger = logging.getLogger(__name__)

SEASON_FLAG = "season"


def _without_scores(games: DataFrame) -> DataFrame:
    """No rows, with the columns a scored table has."""
    none = games.drop(TARGET).where(F.lit(False))
    missing = F.lit(None).cast("double")
    return none.withColumns({HOME_PROBABILITY: missing, AWAY_PROBABILITY: missing})


def score_v1(
    games: DataFrame, classifier: Classifier, as_of: dt.date, keys: list[str] = UPSERT_KEYS
) -> DataFrame:
    """Win probabilities if the games are of ``as_of``, no rows otherwise.

    The columns that never enter the model must all be present, and so must the model's own.
    """
    fresh = readers.gate_on_date(games, as_of, keys)
    features = readers.drop_strict(fresh, V1_EXCLUDE_COLUMNS)
    absent = [c for c in classifier.features if c not in features.columns]
    if absent:
        raise ValueError(f"games lack the model's columns {absent}")
    scored = classifier.score(fresh.drop(TARGET), "_p")
    p = F.col("_p")
    return scored.withColumns(
        {AWAY_PROBABILITY: round_even(1.0 - p, 3), HOME_PROBABILITY: round_even(p, 3)}
    ).drop("_p")


def score_v2(
    games: DataFrame,
    artifacts: Artifacts,
    as_of: dt.date,
    keys: list[str] = UPSERT_KEYS,
    on_error: str = "raise",
    mark_stale: bool = False,
) -> DataFrame:
    """Win probabilities of all games, prepared with what training learned.

    Games of another day are scored all the same; ``mark_stale`` says so in a column. A column the
    table lacks takes its training median. ``on_error="empty"`` turns a failure into no rows.
    """
    try:
        return _score_prepared(games, artifacts, as_of, keys, mark_stale)
    except Exception:
        if on_error != "empty":
            raise
        logger.exception("scoring failed")
        return _without_scores(games)


def _score_prepared(
    games: DataFrame, artifacts: Artifacts, as_of: dt.date, keys: list[str], mark_stale: bool
) -> DataFrame:
    classifier = artifacts.classifier
    kept = [c for c in games.columns if c != TARGET]
    prepared = apply_features(games.withColumn("_row", F.struct(*kept)), artifacts.state)
    aligned = prepared.select(
        "_row", *(c for c in _aligned(prepared, classifier.features))
    )
    scored = classifier.score(aligned, "_p")
    home, away = probability_pair(F.col("_p"))
    result = scored.select(
        "_row.*", home.alias(HOME_PROBABILITY), away.alias(AWAY_PROBABILITY)
    )
    return readers.mark_stale(result, as_of, keys) if mark_stale else result


def _aligned(df: DataFrame, features: list[str]) -> list:
    present = set(df.columns)
    return [F.col(c) if c in present else F.lit(0.0).alias(c) for c in features]


def nightly(
    spark: SparkSession,
    games: DataFrame,
    flags: DataFrame,
    model_path: str,
    target_path: str,
    as_of: dt.date,
    version: int = 1,
    keys: list[str] = UPSERT_KEYS,
) -> str:
    """The nightly job; says where it stopped: ``disabled``, ``no games``, ``no scores``, ``written``."""
    if not readers.is_enabled(flags, SEASON_FLAG):
        return "disabled"
    if games.isEmpty():
        return "no games"
    artifacts = load_model(spark, model_path)
    if version == 1:
        scored = score_v1(clean_numeric(games, artifacts.classifier.features), artifacts.classifier, as_of)
    else:
        scored = score_v2(games, artifacts, as_of)
    return "written" if writers.upsert(scored, target_path, keys) else "no scores"
