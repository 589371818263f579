"""Scores of fixed linear models: a long score table that needs no training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchcast.functions.odds import sigmoid
from matchcast.plans.prepare import LABEL, Prepared

# Intercept and weights of three linear models over derived features.
LINEAR_MODELS = {
    "balanced": (0.06, {"win_pct_diff": 1.0, "star_score_diff": 0.1, "fatigue_diff": 0.05}),
    "form": (-0.1, {"recent_form_diff": 1.5, "net_rating_diff": 0.02, "rank_diff": 0.01}),
    "strength": (0.2, {"win_pct_diff": 4.0, "vorp_diff": 0.05, "travel_diff": -0.0001}),
}


def log_odds(intercept: float, weights: dict[str, float]) -> Column:
    total = F.lit(intercept)
    for name, weight in weights.items():
        total = total + F.col(name) * weight
    return total


def linear_scores(
    prepared: Prepared, carry: list[str] = (), models: dict = LINEAR_MODELS
) -> DataFrame:
    """``run, model, fold, game_id, y, p`` of every fold (run ``cv``) and the test part (``test``).

    Columns to ``carry`` stand beside them.
    """
    scored = F.array(
        *(
            F.struct(F.lit(name).alias("model"), sigmoid(log_odds(*form)).alias("p"))
            for name, form in models.items()
        )
    )
    in_test = F.col("is_test")
    return (
        prepared.rows.where(F.col("fold") >= 0)
        .select(
            F.when(in_test, "test").otherwise("cv").alias("run"),
            F.when(in_test, 0).otherwise(F.col("fold")).alias("fold"),
            "game_id",
            F.col(LABEL).alias("y"),
            *carry,
            F.explode(scored).alias("scored"),
        )
        .select("run", "scored.model", "fold", "game_id", "y", "scored.p", *carry)
    )
