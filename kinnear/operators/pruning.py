"""Exact k nearest neighbours without the products of pairs that cannot enter.

The items are ordered from rarely to often rated and cut into classes of about
equal work (co-rating products).  Of every profile, which has length 1, the
lengths of its parts above each class are kept (``heads``).

1. *First pass.*  Some partners of each user get their exact similarity, and
   the k-th largest of these is a lower bound of the user's k-th similarity
   (``least``; 0 with fewer than k).  In dense data they are the users next to
   it among those whose two heaviest cells are the same items with the same
   signs; in sparse data the best ones by the products of the rarest classes.
2. *Cut.*  By Cauchy and Schwarz the part of a user above class c adds at most
   ``heads[c]`` times the longest such part of anybody.  From the lowest class
   on where that is under the bound, two users who share nothing below cannot
   be neighbours, so products of two parts above their users' cuts are left out.
3. *Bound.*  A pair's sum so far plus the product of the two lengths above the
   higher of both cuts bounds its similarity; pairs under both users' bounds go.
4. *Completion.*  What remains is completed by the items above the cut.

Every step is a join or an aggregate; a pair is multiplied from one side only.

Large tables go by blocks of users (:mod:`kinnear.operators.nearest`) instead, so
that no row of a pair is shuffled: in the first pass all partners who share an
item of the rarest classes count (:class:`FirstPass`), in the second a block's
users leave out what is above their own cuts, and what survives their own bounds
is completed at once (:class:`SecondPass`).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinnear.functions.expr import SIM_ROUND, rounded_sim
from kinnear.operators.nearest import Block, blocks_pay, lot_count, packed_lots, passed
from kinnear.operators.similarity import Shape, both_directions
from kinnear.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Classes of items, and those of them that the first pass multiplies.
CLASSES, FIRST = 32, 3
#: The first pass goes by signature if its products are at most this share of all, in parts of so many users.
DENSE, GROUP_USERS = 0.1, 4096
#: Partners of a user that get their exact similarity in the first pass, in multiples of k.
PARTNERS = 3
#: Ranks compare rounded similarities, so bounds are relaxed by two units of the last place.
SLACK = 2 * 10.0**-SIM_ROUND
#: In blocks an item's number starts with its class, above this many bits; a user's bound and cut travel as cells of these items.
CLASS_BITS, LEAST, CUT = 48, -1, -2


def item_classes(profiles: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(item, n, class): raters and class of every item; more raters never mean a lower class.

    The boundaries come from the distinct numbers of raters, of which there
    are fewer than the root of twice the cells; items with equal numbers are
    spread over the share of their number by a hash.
    """
    items = profiles.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    work = items.groupBy("n").agg((F.count(F.lit(1)).cast("double") * F.col("n") * F.col("n")).alias("work"))
    before = F.coalesce(F.sum("work").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    steps = work.select("n", "work", before.alias("before"), F.sum("work").over(Window.partitionBy()).alias("all"))
    place = F.pmod(F.xxhash64("item"), F.lit(1 << 20)) / float(1 << 20)
    share = (F.col("before") + place * F.col("work")) / F.col("all")
    return items.join(F.broadcast(steps), "n").select("item", "n", F.least(F.floor(share * classes), F.lit(classes - 1)).cast("int").alias("class"))


def user_heads(cells: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(user, heads): lengths of the profile's parts above class 0, 1, .. ; above the last it is 0."""
    square = F.col("weight") * F.col("weight")
    above = [F.sqrt(F.coalesce(F.sum(F.when(F.col("class") > c, square)), F.lit(0.0))) for c in range(classes)]
    return cells.groupBy("user").agg(F.array(*above).alias("heads"))


def _ends(cells: DataFrame, name: str, weight: str, *more: str) -> DataFrame:
    return cells.select(F.col("user").alias(name), "item", F.col("weight").alias(weight), *[F.col(c).alias(f"{c}_{weight}") for c in more])


def _completed(pairs: DataFrame, cells: DataFrame, above: Column) -> DataFrame:
    """``pairs(user, neighbour, sim, above)`` with the products of the items in classes over ``above`` added."""
    mine = cells.select("user", "item", F.col("weight").alias("wa"), "class")
    theirs = cells.select(F.col("user").alias("neighbour"), "item", F.col("weight").alias("wb"))
    rest = pairs.withColumn("above", above).join(mine, "user").where(F.col("class") > F.col("above")).join(theirs, ["neighbour", "item"])
    rest = rest.groupBy("user", "neighbour").agg(F.sum(F.col("wa") * F.col("wb")).alias("rest"))
    return pairs.join(rest, ["user", "neighbour"], "left").withColumn("sim", F.col("sim") + F.coalesce("rest", F.lit(0.0))).drop("rest")


def seeds_by_signature(cells: DataFrame, k: int) -> DataFrame:
    """(user, neighbour, sim = 0): users beside each other by their heaviest weight, within groups of equal heaviest cells.

    A group is dealt into parts of bounded size by a hash, so no window holds a large one.
    """
    heavy = F.slice(F.sort_array(F.collect_list(F.struct(F.abs("weight").alias("a"), "item", F.signum("weight").alias("sign"))), asc=False), 1, 2)
    # a user's own cells, cut to its heaviest before they are gathered
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.abs("weight").desc(), "item"))
    named = cells.withColumn("_n", place).where(F.col("_n") <= 2).groupBy("user").agg(heavy.alias("h")).select(
        "user", F.xxhash64(F.transform("h", lambda x: F.struct(x["item"], x["sign"]))).alias("group"), F.col("h")[0]["a"].alias("most"))
    sizes = named.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / GROUP_USERS).alias("parts"))
    dealt = named.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("user"), F.col("parts")))
    order = Window.partitionBy("group", "part").orderBy("most", "user")
    beside = F.collect_list("user").over(order.rowsBetween(1, -(-PARTNERS * k // 2)))
    pairs = dealt.select("user", beside.alias("beside")).select("user", F.explode("beside").alias("neighbour"), F.lit(0.0).alias("sim"))
    return both_directions(pairs)


def seeds_by_rare_items(cells: DataFrame, k: int, first: int) -> DataFrame:
    """(user, neighbour, sim): the best partners by the products of the ``first`` classes."""
    rare = cells.where(F.col("class") < first)
    a, b = _ends(rare, "user", "wa"), _ends(rare, "neighbour", "wb")
    met = a.join(b, "item").where(F.col("user") < F.col("neighbour")).groupBy("user", "neighbour").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("sim"))
    directed = both_directions(met)
    likely = F.row_number().over(Window.partitionBy("user").orderBy(F.col("sim").desc(), "neighbour"))
    return directed.withColumn("rn", likely).where(F.col("rn") <= PARTNERS * k).drop("rn")


def least_similarity(cells: DataFrame, k: int, first: int = FIRST, dense: bool = False) -> DataFrame:
    """(user, least): a lower bound of the k-th largest similarity of every user who has k partners in the first pass."""
    seeds, multiplied = (seeds_by_signature(cells, k), 0) if dense else (seeds_by_rare_items(cells, k, first), first)
    # a pair that both of its users chose is completed once, and counts for both whoever chose it
    once = seeds.select(F.least("user", "neighbour").alias("user"), F.greatest("user", "neighbour").alias("neighbour"), "sim").dropDuplicates(["user", "neighbour"])
    exact = both_directions(_completed(materialize(once), cells, F.lit(multiplied - 1))).where(F.col("sim") > 0)
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.col("sim").desc(), "neighbour"))
    return exact.withColumn("rn", place).where(F.col("rn") <= k).where(F.col("rn") == k).select("user", F.col("sim").alias("least"))


@dataclass(frozen=True)
class Pruned:
    """What the passes read: written tables and the classes."""

    cells: DataFrame  # user, item, weight, class, n, cut, least, head (the length above the cut)
    heads: DataFrame  # user, heads
    classes: int
    first: int
    dense: bool


def _classed(profiles: DataFrame, classes: int) -> tuple[DataFrame, DataFrame]:
    """The written classes of the items, and the written cells with them."""
    kinds = materialize(item_classes(profiles, classes))
    return kinds, materialize(profiles.select("user", "item", "weight").join(kinds, "item"))


def _is_dense(kinds: DataFrame, k: int) -> bool:
    size = kinds.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
    return PARTNERS * k * (size[0] or 0) <= DENSE * (size[1] or 0.0)


def _bounds(cells: DataFrame, least: DataFrame, classes: int) -> tuple[DataFrame, DataFrame]:
    """(user, heads, least), written, and (user, cut, least, head)."""
    users = materialize(user_heads(cells, classes).join(least, "user", "left").withColumn("least", F.coalesce("least", F.lit(0.0))))
    longest = users.agg(*[F.max(F.col("heads")[c]).alias(f"m{c}") for c in range(classes)]).first()
    reach = F.zip_with("heads", F.array(*[F.lit(float(m or 0.0)) for m in longest]), lambda mine, most: mine * most)
    under = F.transform(reach, lambda x: x < F.col("least") - SLACK)  # lengths fall with the class: false .. true
    first_under = F.array_position(under, True).cast("int")  # from 1; 0 if none is
    cut = F.when(first_under > 0, first_under - 1).otherwise(classes - 1)  # classes up to the cut are multiplied
    return users, users.withColumn("cut", cut).select("user", "cut", "least", F.col("heads")[F.col("cut")].alias("head"))


def prepare(profiles: DataFrame, k: int, classes: int = CLASSES, first: int = FIRST) -> Pruned:
    """Classes, heads, bounds and cuts of a written profile table."""
    kinds, cells = _classed(profiles, classes)
    dense = _is_dense(kinds, k)
    users, bounds = _bounds(cells, least_similarity(cells, k, first, dense), classes)
    return Pruned(materialize(cells.join(bounds, "user")), users.select("user", "heads"), classes, first, dense)


def pair_sums(p: Pruned) -> DataFrame:
    """(user, neighbour, sim, above, most, least): sums of the products that are not left out, each pair once.

    ``most``: what the products left out can add, by the lengths above either user's own cut.
    """
    low = F.col("class") <= F.col("cut")
    a = p.cells.where(low).select("user", "item", F.col("weight").alias("wa"), F.col("cut").alias("ca"), F.col("least").alias("la"), F.col("head").alias("ha"))
    b = p.cells.select(F.col("user").alias("neighbour"), "item", F.col("weight").alias("wb"), low.alias("both"),
                       F.col("cut").alias("cb"), F.col("least").alias("lb"), F.col("head").alias("hb"))
    met = a.join(b, "item").where(F.when(F.col("both"), F.col("user") < F.col("neighbour")).otherwise(F.col("user") != F.col("neighbour")))
    turned = F.col("user") > F.col("neighbour")
    one = lambda x, y, name: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name)
    named = met.select(one("user", "neighbour", "user"), one("neighbour", "user", "neighbour"), (F.col("wa") * F.col("wb")).alias("w"),
                       F.greatest("ca", "cb").alias("above"), F.least("la", "lb").alias("least"), (F.col("ha") * F.col("hb")).alias("most"))
    return named.groupBy("user", "neighbour").agg(
        F.sum("w").alias("sim"), F.first("above").alias("above"), F.first("most").alias("most"), F.first("least").alias("least"))


def survivors(p: Pruned, sums: DataFrame) -> DataFrame:
    """The pairs whose bound reaches the lower of both users' bounds.

    First by the lengths that came with the sums: the arrays of all lengths
    are much longer than a pair's row, so few pairs should meet them.
    """
    heads = p.heads
    likely = materialize(sums.where(F.col("sim") + F.col("most") >= F.col("least") - SLACK).drop("most"))
    bounded = likely.join(heads.withColumnRenamed("heads", "ha"), "user").join(
        heads.select(F.col("user").alias("neighbour"), F.col("heads").alias("hb")), "neighbour")
    bound = F.col("sim") + F.col("ha")[F.col("above")] * F.col("hb")[F.col("above")]
    return bounded.where(bound >= F.col("least") - SLACK).select("user", "neighbour", "sim", "above")


def pruned_similarities(profiles: DataFrame, k: int, classes: int = CLASSES, first: int = FIRST) -> DataFrame:
    """``user, neighbour, sim``: every pair that is among the k best positive ones of either side, and some more; each once.

    ``profiles`` is a written table of unit profiles.  The similarities are
    exact; pairs that are missing are in nobody's first k.
    """
    p = prepare(profiles, k, classes, first)
    left = materialize(survivors(p, pair_sums(p)))
    return _completed(left, p.cells, F.col("above")).select("user", "neighbour", "sim")


def products(profiles: DataFrame, k: int, classes: int = CLASSES, first: int = FIRST) -> DataFrame:
    """One row of counted products: ``plain`` (all co-ratings, each once), ``first_pass`` (at most), ``second_pass``, ``completion``."""
    p = prepare(profiles, k, classes, first)
    pairs = lambda n: n * (n - 1) / 2
    head = F.sum((F.col("class") > F.col("cut")).cast("long"))
    items = p.cells.groupBy("item", "class").agg(F.count(F.lit(1)).alias("n"), head.alias("h"))
    counted = items.agg(
        F.sum(pairs(F.col("n"))).alias("plain"),
        (F.lit(float(PARTNERS * k)) * F.sum("n") if p.dense else F.sum(F.when(F.col("class") < first, pairs(F.col("n"))))).alias("first_pass"),
        F.sum(pairs(F.col("n")) - pairs(F.col("h"))).alias("second_pass"))
    left = survivors(p, pair_sums(p))
    mine = p.cells.select("user", "item", "class")
    theirs = p.cells.select(F.col("user").alias("neighbour"), "item")
    rest = left.join(mine, "user").where(F.col("class") > F.col("above")).join(theirs, ["neighbour", "item"])
    done = rest.agg(F.count(F.lit(1)).cast("double").alias("completion"))
    return counted.join(F.broadcast(done), F.lit(True)).select(*[F.col(c).cast("long").alias(c) for c in ("plain", "first_pass", "second_pass", "completion")])


class FirstPass(Block):
    """The k best of a user among those who share an item of the ``first`` classes with it."""

    full = -1

    def __init__(self, k: int, first: int):
        super().__init__(k, False)
        self.rare = first

    def meet(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> None:
        code = self.numbers(items)
        known = code >= 0
        owner, code, weights = np.repeat(np.arange(len(users)), sizes)[known], code[known], weights[known]
        rare = (items[known] >> CLASS_BITS) < self.rare
        for cell, other, pair in self.shared(len(users), owner, code):
            some = np.unique(pair[rare[cell]])
            if len(some):
                place = np.minimum(np.searchsorted(some, pair), len(some) - 1)
                of_some = some[place] == pair
                sim = np.bincount(place[of_some], weights[cell[of_some]] * self.weight[other[of_some]], len(some))
                b, a = np.divmod(some, len(self.ids))
                near = sim >= self.under[a]
                self.offer(a[near], users[b[near]], sim[near])


class SecondPass(Block):
    """The k best of a user, without the products above its cut of pairs that stay under its bound."""

    full = -1

    def __init__(self, k: int, classes: int):
        super().__init__(k, False)
        self.classes, self.bounds = classes, []

    def bounded(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> tuple:
        """The cells of users without their bounds, and (least, cut, heads) of each."""
        real, owner = items >= 0, np.repeat(np.arange(len(users)), sizes)
        owner, own, squares = owner[real], items[real], weights[real] ** 2
        by_class = np.bincount(owner * self.classes + (own >> CLASS_BITS), squares, len(users) * self.classes).reshape(-1, self.classes)
        above = np.cumsum(by_class[:, ::-1], axis=1)[:, ::-1] - by_class
        bounds = (weights[items == LEAST], weights[items == CUT].astype(np.int64), np.sqrt(np.maximum(above, 0.0)))
        return (users, np.bincount(owner, minlength=len(users)), own, weights[real]), bounds

    def add(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> None:
        cells, bounds = self.bounded(users, sizes, items, weights)
        super().add(*cells)
        self.bounds.append(bounds)

    def seal(self) -> None:
        super().seal()
        self.bound, self.cut, self.heads = (np.concatenate(x) for x in zip(*self.bounds))
        self.bounds.clear()

    def meet(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> None:
        (users, sizes, items, weights), (_, _, heads) = self.bounded(users, sizes, items, weights)
        code = self.numbers(items)
        known = code >= 0
        owner, code, weights, kind = np.repeat(np.arange(len(users)), sizes)[known], code[known], weights[known], (items >> CLASS_BITS)[known]
        for cell, other, pair in self.shared(len(users), owner, code):
            low = kind[cell] <= self.cut[self.row[other]]
            met, place = np.unique(pair[low], return_inverse=True)
            if not len(met):
                continue
            sim = np.bincount(place, weights[cell[low]] * self.weight[other[low]], len(met))
            b, a = np.divmod(met, len(self.ids))
            near = sim + heads[b, self.cut[a]] * self.heads[a, self.cut[a]] >= self.bound[a] - SLACK
            met, sim, a, b = met[near], sim[near], a[near], b[near]
            if len(met) and not low.all():  # what was left out, for those that remain
                place = np.minimum(np.searchsorted(met, pair), len(met) - 1)
                rest = ~low & (met[place] == pair)
                sim += np.bincount(place[rest], weights[cell[rest]] * self.weight[other[rest]], len(met))
            near = sim >= self.under[a]
            self.offer(a[near], users[b[near]], sim[near])


def pruned_by_blocks(profiles: DataFrame, k: int, shape: Shape, classes: int = CLASSES, first: int = FIRST, lots: int | None = None) -> DataFrame:
    """:func:`knn_pruned` by blocks of users, for integers as users and users of bounded size."""
    lots = lots or lot_count(shape, k, profiles.sparkSession.sparkContext.defaultParallelism)
    kinds, cells = _classed(profiles, classes)
    out = "user long, neighbour long, sim double, rank long"
    number = F.shiftleft(F.col("class").cast("long"), CLASS_BITS).bitwiseOR(F.monotonically_increasing_id())
    coded = materialize(kinds.select("item", number.alias("code")))
    coded = materialize(cells.join(coded, "item").select("user", F.col("code").alias("item"), "weight"))
    if _is_dense(kinds, k):
        least = least_similarity(cells, k, first, True)
    else:
        best = passed(packed_lots(coded, lots, shape.cells), lambda: FirstPass(k, first), None, out)
        least = best.where(F.col("rank") == k).select(F.col("user").cast(profiles.schema["user"].dataType).alias("user"), F.col("sim").alias("least"))
    _, bounds = _bounds(cells, least, classes)
    extra = bounds.select("user", F.inline(F.array(
        F.struct(F.lit(LEAST).cast("long").alias("item"), F.col("least").alias("weight")),
        F.struct(F.lit(CUT).cast("long").alias("item"), F.col("cut").cast("double").alias("weight")))))
    packed = packed_lots(coded.unionByName(extra), lots, shape.cells)
    return passed(packed, lambda: SecondPass(k, classes), None, out)


def knn_pruned(profiles: DataFrame, k: int, classes: int = CLASSES, first: int = FIRST, shape: Shape | None = None) -> DataFrame:
    """The k largest positive similarities of every user: ``user, neighbour, sim, rank``; by blocks where that sends less."""
    shape = shape or Shape.of(profiles)
    if k > 0 and blocks_pay(profiles, shape):
        best = pruned_by_blocks(profiles, k, shape, classes, first)
        kind = profiles.schema["user"].dataType
        return best.select(F.col("user").cast(kind).alias("user"), F.col("neighbour").cast(kind).alias("neighbour"), "sim", "rank")
    directed = both_directions(pruned_similarities(profiles, k, classes, first)).where(rounded_sim("sim") > 0)
    best = Window.partitionBy("user").orderBy(rounded_sim("sim").desc(), F.col("neighbour").asc())
    return directed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "user", "neighbour", "sim", F.col("rank").cast("long").alias("rank"))
