"""Means, normalised deviations and unit-length user profiles.

Each step is a grouped aggregate (partial + final hash aggregation, so a
user holding a large share of the rows is pre-aggregated map-side) and an
equi-join back on ``user``.  The join side carrying one row per user is
small relative to the ratings; Catalyst/AQE choose broadcast or
sort-merge from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.functions.expr import RATING_HI, RATING_LO, SAME_RATING, safe_div, scale


def user_mean(ratings: DataFrame) -> DataFrame:
    """Per-user average rating: ``user, mean`` (Eq1)."""
    return ratings.groupBy("user").agg(
        (F.sum("rating") / F.count("rating")).alias("mean")
    )


def item_mean(ratings: DataFrame) -> DataFrame:
    """Per-item average rating: ``item, mean``."""
    return ratings.groupBy("item").agg(
        (F.sum("rating") / F.count("rating")).alias("mean")
    )


def normalized_deviation(
    ratings: DataFrame,
    means: DataFrame | None = None,
    lo: float = RATING_LO,
    hi: float = RATING_HI,
) -> DataFrame:
    """``user, item, dev`` with ``dev = (r - a) / scale(r, a)`` (Eq3).

    Rows whose rating equals the user's mean (within ``SAME_RATING``) have
    ``dev = 0``; callers that only need the non-zero part filter them (they add
    nothing downstream).
    """
    if means is None:
        means = user_mean(ratings)
    j = ratings.select("user", "item", "rating").join(means, "user")
    away = F.col("rating") - F.col("mean")
    dev = F.when(F.abs(away) < SAME_RATING, F.lit(0.0)).otherwise(away / scale("rating", "mean", lo, hi))
    return j.select("user", "item", dev.alias("dev"))


def user_norm(deviations: DataFrame) -> DataFrame:
    """L2 norm of each user's deviations: ``user, norm``."""
    return deviations.groupBy("user").agg(
        F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm")
    )


def unit_profile(deviations: DataFrame) -> DataFrame:
    """``user, item, weight``: deviations divided by the user's norm (Eq4).

    Zero weights are dropped: a zero cell contributes nothing to any dot
    product, so the similarity join only sees stored non-zero cells.
    """
    nz = deviations.where(F.col("dev") != 0)
    norms = user_norm(nz)
    return (
        nz.join(norms, "user")
        .select("user", "item", safe_div("dev", "norm").alias("weight"))
        .where(F.col("weight") != 0)
    )
