"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating scale used by the reference predictor.
RATING_LO = 1.0
RATING_HI = 5.0

# Similarities are compared after rounding to this many places, so that
# float summation order (which differs between engines and runs) cannot
# reorder neighbours; ties are then broken by neighbour id.
SIM_ROUND = 9
# A rating this close to its user's mean counts as equal to it: the mean of
# equal ratings can miss them by a rounding error.
SAME_RATING = 1e-12
# Output doubles are rounded to this many places in the registered queries.
OUT_ROUND = 6


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def scale(x, avg, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Room left on the rating scale in the direction of ``x`` from ``avg``.

    ``hi - avg`` above the mean, ``avg - lo`` below it, ``1`` on it (within
    ``SAME_RATING``).
    """
    x, avg = _c(x), _c(avg)
    return (
        F.when(F.abs(x - avg) < SAME_RATING, F.lit(1.0))
        .when(x > avg, F.lit(float(hi)) - avg)
        .when(x < avg, avg - F.lit(float(lo)))
        .otherwise(F.lit(1.0))
    )


def safe_div(num, den) -> Column:
    """``num / den``, or 0.0 when ``den`` is 0 or null (ANSI-safe)."""
    num, den = _c(num), _c(den)
    return F.when(den.isNotNull() & (den != 0), num / den).otherwise(F.lit(0.0))


def denormalise(avg, dev, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Map a weighted deviation back to the rating scale.

    ``avg + dev * scale(avg + dev, avg)``; the comparison is on ``avg + dev``
    against ``avg`` exactly as the reference writes it.
    """
    avg, dev = _c(avg), _c(dev)
    return avg + dev * scale(avg + dev, avg, lo, hi)


def rounded_sim(sim="sim") -> Column:
    return F.round(_c(sim), SIM_ROUND)


def out_round(x) -> Column:
    """Round for output; ``+ 0.0`` turns a negative zero into 0.0."""
    return F.round(_c(x), OUT_ROUND) + F.lit(0.0)
