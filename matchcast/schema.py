"""Table contracts: column names, types and keys shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# The feature columns of the second-generation game table.
FEATURE_COLUMNS = [
    "home_team_rank",
    "home_days_rest",
    "home_team_avg_pts_scored",
    "home_team_avg_pts_scored_opp",
    "home_team_win_pct",
    "home_team_win_pct_last10",
    "home_star_score",
    "home_active_vorp",
    "home_pct_vorp_missing",
    "home_travel_miles_last_7_days",
    "home_games_last_7_days",
    "home_is_cross_country_trip",
    "away_team_rank",
    "away_days_rest",
    "away_team_avg_pts_scored",
    "away_team_avg_pts_scored_opp",
    "away_team_win_pct",
    "away_team_win_pct_last10",
    "away_star_score",
    "away_active_vorp",
    "away_pct_vorp_missing",
    "away_travel_miles_last_7_days",
    "away_games_last_7_days",
    "away_is_cross_country_trip",
    "travel_miles_differential",
    "star_score_differential",
    "active_vorp_differential",
]

# Columns that describe a game but never enter a model.
METADATA_COLUMNS = [
    "home_team",
    "away_team",
    "home_moneyline",
    "away_moneyline",
    "game_date",
    "home_team_predicted_win_pct",
    "away_team_predicted_win_pct",
    "ml_accuracy",
    "ml_money_col",
    "home_implied_probability",
    "away_implied_probability",
    "ml_prediction",
    "actual_outcome",
    "proper_date",
]

# Columns the derivation step adds.
DERIVED_COLUMNS = [
    "win_pct_diff",
    "recent_form_diff",
    "rank_diff",
    "star_score_diff",
    "vorp_diff",
    "travel_diff",
    "home_net_rating",
    "away_net_rating",
    "net_rating_diff",
    "home_fatigue_index",
    "away_fatigue_index",
    "fatigue_diff",
    "home_momentum",
    "away_momentum",
]

# Columns the first-generation scorer must find and remove.
V1_EXCLUDE_COLUMNS = [
    "home_team",
    "home_moneyline",
    "away_team",
    "away_moneyline",
    "game_date",
    "outcome",
]

TARGET = "outcome"
ROW_KEY = "game_id"
UPSERT_KEYS = ["home_team", "game_date"]
GAME_ORDER = ["game_date", "home_team", "away_team", "game_id"]

HOME_PROBABILITY = "home_team_predicted_win_pct"
AWAY_PROBABILITY = "away_team_predicted_win_pct"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_TEXT, _DOUBLE, _DATE = T.StringType(), T.DoubleType(), T.DateType()
_LONG, _INT, _TIME = T.LongType(), T.IntegerType(), T.TimestampType()

_V1_STATS = [
    ("team_rank", _LONG),
    ("days_rest", _INT),
    ("team_avg_pts_scored", _DOUBLE),
    ("team_avg_pts_scored_opp", _DOUBLE),
    ("team_win_pct", _DOUBLE),
    ("team_win_pct_last10", _DOUBLE),
    ("is_top_players", _DOUBLE),
]
_V2_STATS = [
    ("team_rank", _LONG),
    ("days_rest", _DOUBLE),
    ("team_avg_pts_scored", _DOUBLE),
    ("team_avg_pts_scored_opp", _DOUBLE),
    ("team_win_pct", _DOUBLE),
    ("team_win_pct_last10", _DOUBLE),
    ("star_score", _LONG),
    ("active_vorp", _DOUBLE),
    ("pct_vorp_missing", _DOUBLE),
    ("travel_miles_last_7_days", _DOUBLE),
    ("games_last_7_days", _LONG),
    ("is_cross_country_trip", _INT),
]
_GAME_HEAD = [
    ("home_team", _TEXT),
    ("away_team", _TEXT),
    ("home_moneyline", _DOUBLE),
    ("away_moneyline", _DOUBLE),
    ("game_date", _DATE),
]


def _both_sides(stats: list[tuple[str, T.DataType]]) -> list[tuple[str, T.DataType]]:
    return [(f"{side}_{name}", dtype) for side in ("home", "away") for name, dtype in stats]


_V2_DIFFERENTIALS = [
    ("travel_miles_differential", _DOUBLE),
    ("star_score_differential", _LONG),
    ("active_vorp_differential", _DOUBLE),
]

GAMES_V1 = _struct(*_GAME_HEAD, *_both_sides(_V1_STATS), ("outcome", _INT))
GAMES_V2 = _struct(
    *_GAME_HEAD, *_both_sides(_V2_STATS), *_V2_DIFFERENTIALS, ("outcome", _TEXT)
)
PREDICTIONS_V1 = _struct(
    ("index", _LONG),
    *[(n, _TEXT if n == "game_date" else d) for n, d in _GAME_HEAD],
    *_both_sides([(n, _LONG if d is _INT or n == "is_top_players" else d) for n, d in _V1_STATS]),
    (HOME_PROBABILITY, _DOUBLE),
    (AWAY_PROBABILITY, _DOUBLE),
)
PREDICTIONS_V2 = _struct(
    *_GAME_HEAD,
    *_both_sides(_V2_STATS),
    *_V2_DIFFERENTIALS,
    (HOME_PROBABILITY, _DOUBLE),
    (AWAY_PROBABILITY, _DOUBLE),
    ("created_at", _TIME),
)
FLAGS = _struct(
    ("id", _INT),
    ("flag", _TEXT),
    ("is_enabled", _INT),
    ("created_at", _TIME),
    ("modified_at", _TIME),
)
# The archive of played games: first-generation features, the outcome and what the old job added.
PAST_GAMES = _struct(
    *[f for f in _GAME_HEAD if f[0] != "game_date"],
    *_both_sides(_V1_STATS),
    (HOME_PROBABILITY, _DOUBLE),
    (AWAY_PROBABILITY, _DOUBLE),
    ("ml_accuracy", _DOUBLE),
    ("ml_money_col", _DOUBLE),
    ("home_implied_probability", _DOUBLE),
    ("away_implied_probability", _DOUBLE),
    ("outcome", _TEXT),
    ("ml_prediction", _TEXT),
    ("actual_outcome", _TEXT),
    ("proper_date", _DATE),
)
