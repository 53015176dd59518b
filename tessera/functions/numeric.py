"""Numeric helpers: hash uniforms, sigmoid, softmax, argmax, threshold grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
# Threshold grid of the validation search: 181 points from 0.05 to 0.95,
# point i = 0.05 + i * ((0.95 - 0.05) / 180), the last one exactly 0.95;
# 0.5 is an extra candidate tried first.
GRID_START = 0.05
GRID_STOP = 0.95
GRID_POINTS = 181
DEFAULT_THRESHOLD = 0.5
# ----------------------------------------------------------------------------

GRID_STEP = (GRID_STOP - GRID_START) / (GRID_POINTS - 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(c, modulus: int) -> Column:
    """First 8 hex digits of md5 as an unsigned 32-bit integer, mod ``modulus``."""
    return F.pmod(hash32(c), F.lit(modulus))


def hash32(c) -> Column:
    return F.conv(F.substring(F.md5(_col(c)), 1, 8), 16, 10).cast("bigint")


def hash_uniform(c) -> Column:
    """A uniform in [0, 1) from the first 8 hex digits of md5."""
    return hash32(c) / F.lit(4294967296.0)


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def softmax_prob(logits, cls: int = 1) -> Column:
    """Stable softmax of an array column, probability of class ``cls``."""
    lg = _col(logits)
    m = F.array_max(lg)
    ex = F.transform(lg, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.element_at(ex, cls + 1) / total


def argmax_class(logits) -> Column:
    """0-based index of the first maximum."""
    lg = _col(logits)
    return (F.array_position(lg, F.array_max(lg)) - 1).cast("int")


def threshold_at(i) -> Column:
    """Grid value for 0-based index column ``i`` (exact np.linspace values)."""
    i = _col(i)
    return F.when(i == GRID_POINTS - 1, F.lit(GRID_STOP)).otherwise(
        F.lit(GRID_START) + i.cast("double") * F.lit(GRID_STEP))


def grid_values() -> list[float]:
    vals = [GRID_START + i * GRID_STEP for i in range(GRID_POINTS)]
    vals[-1] = GRID_STOP
    return vals


def grid_bucket(prob) -> Column:
    """Index of the highest grid threshold <= prob, or -1 below the grid.

    One arithmetic guess corrected by one step against the exact grid values
    instead of 181 comparisons per row.
    """
    p = _col(prob)
    guess = F.least(F.greatest(F.floor((p - F.lit(GRID_START)) / F.lit(GRID_STEP)).cast("int"),
                               F.lit(-1)), F.lit(GRID_POINTS - 1))
    down = F.when((guess >= 0) & (threshold_at(guess) > p), guess - 1).otherwise(guess)
    up = F.when((down + 1 <= GRID_POINTS - 1) & (threshold_at(down + 1) <= p), down + 1).otherwise(down)
    return up


def apply_threshold(prob, threshold) -> Column:
    """``prob >= threshold`` as 0/1 (inclusive)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (_col(prob) >= t).cast("int")
