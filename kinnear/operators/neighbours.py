"""k nearest neighbours under the dense ranking rule.

The rule ranks each user's *dense* similarity vector over all ``n_users``
users, so when a user has fewer than ``k`` positive similarities the
remaining slots go to zero entries (the user itself and users without a
co-rated item) and then to negative ones.  Zeros add nothing to a
prediction; negatives do.  Without materialising the dense vector, the
position of each stored entry is:

* a positive one: its rank among the positives;
* a negative one: ``n_users + 1 -`` its place from the lowest one up.

Ranks order by similarity rounded to 9 places, descending, then by
neighbour id.  One ranking serves every ``k' <= k``: the neighbours for
``k'`` are the rows with ``rank <= k'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinnear.functions.expr import rounded_sim
from kinnear.operators.nearest import blocks_pay, nearest
from kinnear.operators.pruning import knn_pruned
from kinnear.operators.similarity import Shape, both_directions, similarities
from kinnear.session import materialize

def _best(directed: DataFrame) -> Window:
    return Window.partitionBy("user").orderBy(rounded_sim("sim").desc(), F.col("neighbour").asc())


def rank_positives(directed: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest positive similarities of each user: ``user, neighbour, sim, rank``.

    ``row_number() <= k`` is evaluated with a group limit before and after the
    shuffle, so no task sends or holds more than ``k`` rows a user.
    """
    positive = directed.where(rounded_sim("sim") > 0)
    return positive.withColumn("rank", F.row_number().over(_best(positive))).where(F.col("rank") <= k).select(
        "user", "neighbour", "sim", F.col("rank").cast("long").alias("rank"))


def rank_signed(directed: DataFrame, k: int, n_users: int) -> DataFrame:
    """All entries of both signs that reach rank ``k``: ``user, neighbour, sim, rank``, in one pass over ``directed``.

    A negative entry's rank is its distance from the far end of the dense
    vector: the lowest one has rank ``n_users``, the next ``n_users - 1``.  So
    one ``row_number`` by user and sign, from the largest absolute value down,
    ranks both; nothing is counted, and the similarities are computed once.
    Before that, positives past the k-th go by a group limit, in which every
    negative is a group of its own.
    """
    value = rounded_sim("sim")
    positive = value > 0
    lone = directed.where(value != 0).withColumn("_lone", F.when(value < 0, F.col("neighbour")))
    best = Window.partitionBy("user", "_lone").orderBy(value.desc(), F.col("neighbour").asc())
    limited = lone.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k)
    signed = limited.withColumn("_positive", positive)
    # of equal values the smaller id is first, which is the last one from the far end
    from_end = Window.partitionBy("user", "_positive").orderBy(
        F.abs(value).desc(), F.when(positive, F.col("neighbour")).asc(), F.when(~positive, F.col("neighbour")).desc())
    place = signed.withColumn("_place", F.row_number().over(from_end).cast("long"))
    rank = F.when(F.col("_positive"), F.col("_place")).otherwise(F.lit(n_users) + 1 - F.col("_place"))
    return place.select("user", "neighbour", "sim", rank.cast("long").alias("rank")).where(F.col("rank") <= k)


def _users_in_reach(profiles: DataFrame, k: int, n_users: int) -> DataFrame:
    """Users with enough co-ratings that more than ``n_users - k`` of their similarities could be negative."""
    raters = profiles.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    partners = profiles.select("user", "item").join(raters, "item").groupBy("user").agg(F.sum(F.col("n") - 1).alias("n"))
    return partners.where(F.col("n") > n_users - k).select("user")


def knn(profiles: DataFrame, k: int, n_users: int, strategy: str = "auto", written: bool = False, **options) -> DataFrame:
    """The k nearest neighbours of every user: ``user, neighbour, sim, rank``.

    ``n_users`` is the dimension of the rating matrix, rated users or not; it
    decides where negatives rank and can't be under the users seen.  The
    profiles are read by several branches; unless they are a ``written``
    table they are written first.

    ``auto`` and ``rows`` (:mod:`kinnear.operators.nearest`) give out the best of each
    user only; ``auto`` takes the pairs' way where that shuffles less.

    Negatives are ranked only if the data could bring one to rank ``k``, and
    for users for whom it could; either way the similarities are computed once.
    ``strategy="pruned"`` leaves out pairs that can't be among anybody's first
    ``k`` (:mod:`kinnear.operators.pruning`), unless negatives could be.
    """
    if not written:
        profiles = materialize(profiles)
    shape = Shape.of(profiles)
    if n_users < shape.users:
        raise ValueError(f"n_users={n_users}, but {shape.users} users have a profile")
    reach = None
    if k > 0 and shape.partners > n_users - k:
        reach = materialize(_users_in_reach(profiles, k, n_users))
        reach = reach if reach.limit(1).count() else None
    if strategy == "pruned" and reach is None:
        return knn_pruned(profiles, k, shape=shape, **options)
    if strategy == "rows" or (strategy in ("auto", "pruned") and k > 0 and not options and blocks_pay(profiles, shape)):
        return nearest(profiles, k, shape, None if reach is None else n_users, **options)
    directed = both_directions(similarities(profiles, "auto" if strategy == "pruned" else strategy, shape, **options))
    if reach is None:
        return rank_positives(directed, k)
    # others' negatives can't reach rank k and stay out of the shuffle
    near = directed.join(reach.withColumn("_near", F.lit(True)), "user", "left").where((rounded_sim("sim") > 0) | F.col("_near"))
    return rank_signed(near.drop("_near"), k, n_users)


def neighbour_lists(neighbours: DataFrame) -> DataFrame:
    """One row per user with its neighbours ordered by rank.

    ``user, neighbours: array<struct<rank, neighbour, sim>>``; the array
    holds at most ``k`` entries.
    """
    return neighbours.groupBy("user").agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "neighbour", "sim"))
        ).alias("neighbours")
    )


def explode_neighbours(lists: DataFrame) -> DataFrame:
    """Inverse of :func:`neighbour_lists`: ``user, neighbour, sim, rank``."""
    return lists.select("user", F.inline("neighbours")).select(
        "user", "neighbour", "sim", "rank"
    )
