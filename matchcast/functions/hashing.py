"""Uniform numbers that depend on the row's key and a seed alone.

Unlike ``rand``, they stay the same when a lost task runs again, when the data are partitioned
differently, or in another SQL engine.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tasks get this module's helpers by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A prime just below 2^31, so that the product of two residues fits a long, and two multipliers.
MODULUS = 2147483647
MULTIPLIERS = (48271, 69621)
# Mixed keys are whole numbers below this.
SPAN = MODULUS * MODULUS


def key_residue(key: Column, dtype: T.DataType | None = None) -> Column:
    """The key as a whole number below SPAN; keys that are no integers are hashed first."""
    number = key.cast("long") if isinstance(dtype, T.IntegralType) or dtype is None else F.xxhash64(key)
    return F.pmod(number, F.lit(SPAN))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _round(residue: Column, salt: Column) -> Column:
    """Scramble a number below MODULUS with a salt: two rounds of squaring, scaling and shifting."""
    first, second = MULTIPLIERS
    m = F.lit(MODULUS)
    return _let(
        F.pmod((residue + salt * 7919 + 1) * first, m),
        lambda a: _let(
            F.pmod(F.pmod(a * a + salt * 104729 + 12345, m) * second + residue, m),
            lambda c: F.pmod(c * c + c * first, m),
        ),
    )


def mix(residue: Column, salt: int | Column) -> Column:
    """Scramble a residue with a salt to a number below SPAN; all its digits count.

    Both halves of the key enter each half of the result, so keys that agree in one of them differ.
    """
    salt = F.lit(salt).cast("long") if isinstance(salt, int) else salt.cast("long")
    m = F.lit(MODULUS)
    low = F.pmod(residue, m)
    high = F.round((residue - low) / MODULUS).cast("long")
    return _let(
        _round(F.pmod(_round(low, salt) + high, m), salt + 101),
        lambda two: two * MODULUS + _round(F.pmod(two + low, m), salt + 211),
    )


def uniform(residue: Column, salt: int | Column) -> Column:
    """A number in (0, 1) for this key and salt."""
    return (mix(residue, salt).cast("double") + 0.5) / float(SPAN)


def _round_of(residue: np.ndarray, salt: int) -> np.ndarray:
    first, second = MULTIPLIERS
    a = (residue + salt * 7919 + 1) * first % MODULUS
    c = ((a * a + salt * 104729 + 12345) % MODULUS * second + residue) % MODULUS
    return (c * c + c * first) % MODULUS


def uniform_of(residue: np.ndarray, salt: int) -> np.ndarray:
    """``uniform`` of whole numbers in numpy, digit for digit."""
    low, high = residue % MODULUS, residue // MODULUS
    one = _round_of(low, salt)
    two = _round_of((one + high) % MODULUS, salt + 101)
    mixed = two * MODULUS + _round_of((two + low) % MODULUS, salt + 211)
    return (mixed.astype(np.float64) + 0.5) / float(SPAN)


def hashed_uniform(key: Column, salt: int) -> Column:
    """A number in (0, 1) from Spark's own hash; shorter code where no other engine must agree."""
    return (F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(SPAN)).cast("double") + 0.5) / float(SPAN)


def normal(key: Column, salt: int) -> Column:
    """A standard normal number (Box-Muller) from two uniforms of the key."""
    radius = F.sqrt(-2.0 * F.log(hashed_uniform(key, 2 * salt)))
    return radius * F.cos(2.0 * F.pi() * hashed_uniform(key, 2 * salt + 1))


# P(X <= k) of a Poisson(1) variable, k = 0, 1, ...; beyond them the chance is 1e-9.
POISSON_ONE = [
    0.36787944117144233,
    0.7357588823428847,
    0.9196986029286058,
    0.9810118431238462,
    0.9963401531726563,
    0.9994058151824183,
    0.9999167588507119,
    0.9999897508033253,
    0.9999988747974020,
    0.9999998885745217,
    0.9999999899522336,
]


def poisson_limits(rate: float) -> list[float]:
    """Chances of at most 0, 1, ... events, up to a tail below 1e-12."""
    if rate == 1.0:
        return POISSON_ONE
    limits, term, total = [], math.exp(-rate), 0.0
    while total < 1 - 1e-12 and len(limits) < 200:
        total += term
        limits.append(total)
        term *= rate / len(limits)
    return limits


def with_poisson(df: DataFrame, u: Column, output: str, rate: float = 1.0) -> DataFrame:
    """Add the Poisson count of a uniform number: how many of the limits it passes.

    The number is a column of its own first, so that it is worked out once per row.
    """
    limits = poisson_limits(rate)
    count = F.lit(len(limits))
    for k in reversed(range(len(limits))):
        count = F.when(F.col("_u") <= limits[k], F.lit(k)).otherwise(count)
    return df.withColumn("_u", u).withColumn(output, count).drop("_u")
