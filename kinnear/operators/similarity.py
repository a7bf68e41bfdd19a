"""Cosine similarity between users (dot products of unit profiles).

Two exact strategies compute the pairs; Spark does the joins, routing,
grouping and ranking of both:

``join``
    Profiles self-joined on ``item`` and summed per user pair.  Every item
    emits all pairs of its raters, so its cost is ``Σ n_i²`` rows: best for
    sparse data, where that is little more than the pairs that exist.  Hot
    items are dealt into chunks and joined as pairs of chunks.

``tiles``
    Users are hashed into blocks.  A cell is sent only to the blocks that hold
    its item (an equi-join with the distinct ``(item, block)``), so a cell is
    copied at most ``min(raters of the item, blocks)`` times.  Each pair of
    blocks is one bounded dense-by-dense product of at most a block's users
    each way; Python does that arithmetic and nothing else.  Best where items
    are hot: a product costs nanoseconds instead of a shuffled row.

``auto`` compares the two costs from counted figures (cells, users, ``Σ n_i²``).

Users with more than ``heavy_user_cells`` cells would make a block's task
large, so they stay out of the tiles and are joined with everybody (linear in
the data).  All paths return the same raw sums; signs and ranks are taken from
the sum rounded to 9 places, in one place (``rounded_sim``), whatever path a
pair came from.  The order of summation differs between the paths, so a sum
that straddles a rounding boundary may differ in the ninth place.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.functions.expr import rounded_sim
from kinnear.session import materialize

# The tile product travels to the Python workers by value, so executors do
# not need this package installed (only numpy and pandas).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Users and cells of a block, on average; users above the last are joined.
BLOCK_USERS, BLOCK_CELLS, HEAVY_USER_CELLS = 1024, 1_000_000, 200_000
#: Raters of an item up to which the join strategy keeps them together.
CHUNK_RATERS = 2048
#: Cells of looked-up users that may be broadcast (some 24 bytes each).
BROADCAST_CELLS = 2_000_000
#: Products summed at a time in a sparse tile.
PRODUCTS_AT_ONCE = 4_000_000
#: Routed cells a task should hold, and the most partitions ever asked for.
CELLS_PER_TASK, MOST_PARTITIONS = 2_000_000, 65_536


@dataclass(frozen=True)
class Shape:
    """Counted figures of a profile table; all that the plan choice needs."""

    cells: int
    users: int
    products: float  # Σ over items of raters²
    partners: float = math.inf  # no user shares items with more others than this
    of_user: float = math.inf  # cells of the user with the most

    @classmethod
    def of(cls, profiles: DataFrame) -> Shape:
        raters = profiles.groupBy("item").agg(F.count(F.lit(1)).cast("double").alias("n"))
        by_item = raters.agg(
            F.sum("n").alias("cells"), F.sum(F.col("n") * F.col("n")).alias("products"), F.max("n").alias("raters"))
        users = profiles.groupBy("user").agg(F.count(F.lit(1)).alias("c"))
        by_user = users.agg(F.count(F.lit(1)).alias("users"), F.max("c").alias("of_user"))
        both = by_item.unionByName(by_user, allowMissingColumns=True)  # two rows, one job
        one = both.agg(*[F.max(c).alias(c) for c in ("cells", "users", "products", "raters", "of_user")]).first()
        partners = min(int(one.users or 0) - 1, float(one.of_user or 0) * (float(one.raters or 0.0) - 1))
        return cls(int(one.cells or 0), int(one.users or 0), float(one.products or 0.0), max(0.0, partners), float(one.of_user or 0))


def num_blocks(shape: Shape, block_users: int = BLOCK_USERS, block_cells: int = BLOCK_CELLS) -> int:
    """Blocks of about ``block_users`` users and at most about ``block_cells`` cells; a figure of the data alone."""
    return max(1, math.ceil(shape.users / block_users), min(shape.users, math.ceil(shape.cells / block_cells)))


def tile_partitions(shape: Shape, blocks: int, parallelism: int) -> int:
    """Shuffle partitions of the tile stage: by routed cells and cores, never one a block pair."""
    pairs = blocks * (blocks + 1) // 2
    by_size = math.ceil(shape.cells * blocks / CELLS_PER_TASK)
    return max(1, min(pairs, max(8 * parallelism, by_size), MOST_PARTITIONS))


def choose_strategy(shape: Shape, blocks: int) -> str:
    """The cheaper of the two, in seconds of one core (measured orders of magnitude)."""
    routed = min(shape.products, float(shape.cells) * blocks)
    tiles = routed * 1e-6 + min(blocks * (blocks + 1) / 2, routed) * 5e-3 + shape.products * 1e-8
    return "tiles" if tiles < shape.products * 1e-6 else "join"


def _sides(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        profiles.select("user", "item", F.col("weight").alias("wa")),
        profiles.select(F.col("user").alias("neighbour"), "item", F.col("weight").alias("wb")),
    )


def _dot(joined: DataFrame, *keys: str) -> DataFrame:
    return joined.groupBy(*keys).agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))


def _chunked(profiles: DataFrame, chunk_raters: int) -> DataFrame:
    """The cells with ``chunks``, the parts their item's raters are dealt into, and ``chunk``, the part of this one."""
    raters = profiles.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk_raters)
    # written: a plain table, so that adaptive execution can broadcast it or split a hot item's rows
    hot = materialize(raters.select("item", F.ceil(F.col("n") / chunk_raters).cast("int").alias("chunks")))
    cells = profiles.join(hot, "item", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    return cells.withColumn("chunk", F.pmod(F.xxhash64("user"), F.col("chunks")).cast("int"))


def similarity_join(profiles: DataFrame, chunk_raters: int = CHUNK_RATERS) -> DataFrame:
    """``user, neighbour, sim`` of all co-rating pairs, ``user < neighbour``, by self-join on item.

    An item with more than ``chunk_raters`` raters is dealt into chunks by
    user; every pair of its chunks is a key of its own, so no key of the join
    has more than about ``chunk_raters`` rows a side, whoever rated the item.
    Its cells are sent once for each chunk.  Sums are partial in the join's
    stage and final by pair.
    """
    cells = _chunked(profiles, chunk_raters)
    a = cells.select("user", "item", F.col("weight").alias("wa"), F.col("chunk").alias("p"),
                     F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("q"))
    b = cells.select(F.col("user").alias("neighbour"), "item", F.col("weight").alias("wb"), F.col("chunk").alias("q"),
                     F.explode(F.sequence(F.lit(0), "chunk")).alias("p"))
    met = a.join(b, ["item", "p", "q"]).where((F.col("p") < F.col("q")) | (F.col("user") < F.col("neighbour")))
    return _dot(met.select(F.least("user", "neighbour").alias("user"), F.greatest("user", "neighbour").alias("neighbour"), "wa", "wb"),
                "user", "neighbour")


def similarity_one_user(profiles: DataFrame, users) -> DataFrame:
    """The similarities of the given users to everybody else: ``user, neighbour, sim``.

    ``users`` is a literal or a DataFrame with column ``user`` (every
    distinct user of it counts).  The join on item emits one row per co-rating
    of a given user, so it is linear in the data for each.
    """
    a, b = _sides(profiles)
    if isinstance(users, DataFrame):
        mine = a.join(users.select("user").distinct(), "user", "left_semi")
    else:
        mine = a.where(F.col("user") == F.lit(users))
    return _dot(mine.join(b, "item").where(F.col("user") != F.col("neighbour")), "user", "neighbour")


def similarity_of_users(profiles: DataFrame, users: DataFrame, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """:func:`similarity_one_user` of many users at once: ``user, neighbour, sim``.

    The cells of the wanted users are written and counted.  Up to
    ``broadcast_cells`` they travel to the profiles, which then stay where
    they are; beyond that both sides are joined by item, hot items as pairs
    of (chunk of the wanted, all others) so that no key is unbounded.
    """
    a, b = _sides(profiles)
    wanted = materialize(a.join(users.select("user").distinct(), "user", "left_semi"))
    cells = wanted.count()
    if cells <= broadcast_cells:
        met = b.join(F.broadcast(wanted), "item")
    else:
        chunked = _chunked(profiles, CHUNK_RATERS).select(F.col("user").alias("neighbour"), "item", F.col("weight").alias("wb"), "chunk")
        chunks = chunked.select("item", "chunk").distinct()  # a wanted cell meets each chunk of its item
        met = wanted.join(chunks, "item").join(chunked, ["item", "chunk"])
    return _dot(met.where(F.col("user") != F.col("neighbour")), "user", "neighbour")


def tile_product(a: tuple, b: tuple, shape: tuple[int, int, int], at_once: int = PRODUCTS_AT_ONCE) -> np.ndarray:
    """Dense product of two sparse blocks ``(row, item, weight)``; ``shape``: rows of a, rows of b, items.

    Blocks that are mostly filled are multiplied as matrices; others by the
    products of the cells that share an item, summed ``at_once`` at a time.
    """
    (au, ai, aw), (bu, bi, bw), (na, nb, ni) = a, b, shape
    if (na + nb) * ni <= 8 * (len(aw) + len(bw)):
        x, y = np.zeros((na, ni)), np.zeros((nb, ni))
        x[au, ai], y[bu, bi] = aw, bw
        return x @ y.T
    order = np.argsort(bi, kind="stable")
    bu, bw = bu[order], bw[order]
    first = np.searchsorted(bi[order], np.arange(ni + 1))
    low, n = first[ai], first[ai + 1] - first[ai]
    out, total = np.zeros(na * nb), np.cumsum(n)
    start = 0
    while start < len(n):
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + at_once, "right")))
        here = n[start:end]
        cell = np.repeat(np.arange(start, end), here)
        other = low[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(here) - here, here)
        out += np.bincount(au[cell] * nb + bu[other], aw[cell] * bw[other], na * nb)
        start = end
    return out.reshape(na, nb)


def _tile(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
    """The non-zero similarities between two blocks (``user`` of the first, ``neighbour`` of the second)."""
    item, names = pd.factorize(cells["item"])
    side = cells["block"].to_numpy()
    users = cells["user"].to_numpy()
    weight = cells["weight"].to_numpy(np.float64)
    blocks, ids = [], []
    for block in key:
        mine = side == block
        known, row = np.unique(users[mine], return_inverse=True)
        blocks.append((row, item[mine], weight[mine]))
        ids.append(known)
    product = tile_product(*blocks, (len(ids[0]), len(ids[1]), len(names)))
    if key[0] == key[1]:
        product = np.triu(product, 1)
    i, j = np.nonzero(product)
    return pd.DataFrame({"user": ids[0][i], "neighbour": ids[1][j], "sim": product[i, j]})


def similarity_tiles(profiles: DataFrame, blocks: int, partitions: int) -> DataFrame:
    """``user, neighbour, sim`` of all co-rating pairs, each once, by tiles of user blocks."""
    cells = profiles.select("user", "item", "weight", F.pmod(F.xxhash64("user"), F.lit(blocks)).cast("int").alias("block"))
    holds = cells.select("item", F.col("block").alias("other")).distinct()
    routed = cells.join(holds, "item").select(
        "user", "item", "weight", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    kind = profiles.schema["user"].dataType.simpleString()
    # an explicit count: the work of a tile is arithmetic, which the size of its input does not show
    return routed.repartition(partitions, "a", "b").groupBy("a", "b").applyInPandas(
        _tile, f"user {kind}, neighbour {kind}, sim double")


def similarities(
    profiles: DataFrame,
    strategy: str = "auto",
    shape: Shape | None = None,
    block_users: int = BLOCK_USERS,
    heavy_user_cells: int = HEAVY_USER_CELLS,
) -> DataFrame:
    """``user, neighbour, sim``: every co-rating pair once, in either order.

    ``profiles`` is read by several branches: hand in a written table.
    """
    shape = shape or Shape.of(profiles)
    blocks = num_blocks(shape, block_users)
    if strategy == "auto":
        strategy = choose_strategy(shape, blocks)
    if strategy == "join":
        return similarity_join(profiles)
    if strategy != "tiles":
        raise ValueError(f"unknown strategy {strategy!r}")
    heavy = profiles.groupBy("user").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_user_cells).select("user")
    partitions = tile_partitions(shape, blocks, profiles.sparkSession.sparkContext.defaultParallelism)
    light = similarity_tiles(profiles.join(heavy, "user", "left_anti"), blocks, partitions)
    a, b = _sides(profiles)
    mine = a.join(heavy, "user", "left_semi")
    others = b.join(heavy.select(F.col("user").alias("neighbour"), F.lit(True).alias("is_heavy")), "neighbour", "left")
    # a pair of two heavy users comes up from both sides; one is taken
    pairs = mine.join(others, "item").where(
        (F.col("user") < F.col("neighbour")) | (F.col("is_heavy").isNull() & (F.col("user") != F.col("neighbour"))))
    return light.unionByName(_dot(pairs, "user", "neighbour"))


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each pair from both sides: ``user, neighbour, sim``."""
    return pairs.select(F.explode(F.array(
        F.struct("user", "neighbour", "sim"),
        F.struct(F.col("neighbour").alias("user"), F.col("user").alias("neighbour"), "sim"))).alias("p")).select("p.*")


def similarity_pairs(profiles: DataFrame, strategy: str = "auto", **options) -> DataFrame:
    """Every unordered pair with a non-zero similarity: ``user < neighbour``.

    The output itself can be quadratic in the users; for neighbours use
    :func:`kinnear.operators.neighbours.knn`.  ``auto`` takes the users by blocks
    (:func:`kinnear.operators.nearest.all_pairs`) where that sends less.
    """
    from kinnear.operators import nearest  # which imports this module

    shape = options.pop("shape", None) or Shape.of(profiles)
    if strategy == "auto" and not options and nearest.blocks_pay(profiles, shape):
        return nearest.all_pairs(profiles, shape).where(rounded_sim("sim") != 0)
    return similarities(profiles, strategy, shape, **options).where(rounded_sim("sim") != 0).select(
        F.least("user", "neighbour").alias("user"), F.greatest("user", "neighbour").alias("neighbour"), "sim")
