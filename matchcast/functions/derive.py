"""Matchup features derived from the two sides of a game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("home", "away")

# Each difference as name, minuend, subtrahend. A lower rank is better, hence the swap.
DIFFERENCES = [
    ("win_pct_diff", "home_team_win_pct", "away_team_win_pct"),
    ("recent_form_diff", "home_team_win_pct_last10", "away_team_win_pct_last10"),
    ("rank_diff", "away_team_rank", "home_team_rank"),
    ("star_score_diff", "home_star_score", "away_star_score"),
    ("vorp_diff", "home_active_vorp", "away_active_vorp"),
    ("travel_diff", "home_travel_miles_last_7_days", "away_travel_miles_last_7_days"),
]

# Stand-ins for missing parts of the fatigue index, and the weights of its parts.
FATIGUE_DEFAULTS = {
    "days_rest": 2.0,
    "games_last_7_days": 2.0,
    "travel_miles_last_7_days": 500.0,
    "is_cross_country_trip": 0.0,
}
FATIGUE_WEIGHTS = {"rest": 1.5, "games": 1.0, "travel": 0.5, "cross_country": 2.0}
FULL_REST_DAYS = 3.0


def fatigue_index(
    rest: Column, games: Column, miles: Column, cross_country: Column | None = None
) -> Column:
    """Tiredness of one side from rest days, recent games, miles travelled and a long trip."""
    rest = F.coalesce(rest, F.lit(FATIGUE_DEFAULTS["days_rest"]))
    games = F.coalesce(games, F.lit(FATIGUE_DEFAULTS["games_last_7_days"]))
    miles = F.coalesce(miles, F.lit(FATIGUE_DEFAULTS["travel_miles_last_7_days"]))
    index = (
        (FULL_REST_DAYS - F.least(rest, F.lit(FULL_REST_DAYS))) * FATIGUE_WEIGHTS["rest"]
        + games * FATIGUE_WEIGHTS["games"]
        + F.log1p(miles) * FATIGUE_WEIGHTS["travel"]
    )
    if cross_country is None:
        return index
    trip = F.coalesce(cross_country, F.lit(FATIGUE_DEFAULTS["is_cross_country_trip"]))
    return index + trip * FATIGUE_WEIGHTS["cross_country"]


def derive_features(df: DataFrame) -> DataFrame:
    """Add every derived column whose inputs the table has, in one projection.

    A missing input gives a missing difference; only the fatigue index has stand-in values.
    """
    present = set(df.columns)

    def number(name: str) -> Column:
        return F.col(name).cast("double")

    def has(*names: str) -> bool:
        return present.issuperset(names)

    added: dict[str, Column] = {
        name: number(left) - number(right)
        for name, left, right in DIFFERENCES
        if has(left, right)
    }

    for side in SIDES:
        scored, allowed = f"{side}_team_avg_pts_scored", f"{side}_team_avg_pts_scored_opp"
        if has(scored, allowed):
            added[f"{side}_net_rating"] = number(scored) - number(allowed)
    if {"home_net_rating", "away_net_rating"} <= added.keys():
        added["net_rating_diff"] = added["home_net_rating"] - added["away_net_rating"]

    for side in SIDES:
        parts = [f"{side}_{p}" for p in FATIGUE_DEFAULTS if p != "is_cross_country_trip"]
        trip = f"{side}_is_cross_country_trip"
        if has(*parts):
            added[f"{side}_fatigue_index"] = fatigue_index(
                *(number(p) for p in parts), number(trip) if has(trip) else None
            )
    if {"home_fatigue_index", "away_fatigue_index"} <= added.keys():
        added["fatigue_diff"] = added["away_fatigue_index"] - added["home_fatigue_index"]

    for side in SIDES:
        recent, season = f"{side}_team_win_pct_last10", f"{side}_team_win_pct"
        if has(recent, season):
            added[f"{side}_momentum"] = number(recent) - number(season)

    return df.withColumns(added)


def log_skewed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace the named columns the table has by ``log(1 + x)``."""
    return df.withColumns({c: F.log1p(F.col(c)) for c in columns if c in df.columns})
