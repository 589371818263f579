"""American odds, implied probabilities and probability rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bookmaker's margin and the range his probabilities are held in.
MARGIN = 0.04
PRICE_FLOOR = 0.05
PRICE_CEILING = 0.95


def implied_probability(odds: Column) -> Column:
    """Share of outcomes at which a bet at these odds breaks even; odds of 0 count as +100."""
    stake_for_100 = -odds
    return (
        F.when(odds == 0, F.lit(0.5))
        .when(odds > 0, F.lit(100.0) / (odds + 100.0))
        .otherwise(stake_for_100 / (stake_for_100 + 100.0))
    )


def decimal_payout(odds: Column) -> Column:
    """Total paid per unit staked; missing for odds of 0, which nobody can bet at."""
    return F.when(odds > 0, odds / 100.0 + 1.0).otherwise(
        F.try_divide(F.lit(100.0), -odds) + 1.0
    )


def american_odds(probability: Column) -> Column:
    """Whole-number odds a bookmaker offers for a true probability, margin included."""
    priced = F.least(
        F.greatest(probability + MARGIN / 2, F.lit(PRICE_FLOOR)), F.lit(PRICE_CEILING)
    )
    against = F.lit(1.0) - priced
    return F.when(priced >= 0.5, round_even(-(priced / against) * 100.0)).otherwise(
        round_even((against / priced) * 100.0)
    )


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even in binary arithmetic, scaled by a power of ten."""
    if digits == 0:
        return F.rint(value)
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def probability_pair(home: Column, digits: int = 3) -> tuple[Column, Column]:
    """Home and away probability, each rounded half to even from the unrounded number."""
    return round_even(home, digits), round_even(F.lit(1.0) - home, digits)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
