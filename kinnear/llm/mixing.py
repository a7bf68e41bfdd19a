"""Mixing sources to target weights by hierarchical budgets.

The tree is domain - language - source.  A token budget runs down the tree by
the weights of the nodes.  A leaf can give at most EPOCHS times its tokens;
what a leaf or subtree can't give is offered to its siblings by their weights,
and only what no sibling can give goes up to be offered by the ancestor to
others.  Every leaf then gives a prefix of its documents in seeded epochs:
each epoch is a fresh order by hash, whole epochs come first, the last one is
cut where the leaf's budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinnear.llm.tables import stage

#: Epochs a leaf may give at most, seed of the orders.
EPOCHS, SEED = 4, 17
#: The cut of a leaf is searched in LEVELS steps of 2**BITS hash ranges each.
LEVELS, BITS = 2, 8
#: Leaves whose budgets are broadcast (some 60 bytes each).
LEAVES_OUT = 200_000
#: Domains of the corpus: sources by the number in their name.
DOMAINS = 4


def default_domain(source: Column) -> Column:
    """One of DOMAINS groups of sources, by the number a source's name ends in; ``other`` without one."""
    number = F.regexp_extract(F.coalesce(source.cast("string"), F.lit("")), r"(\d{1,9})$", 1)
    return F.when(number == "", "other").otherwise(F.concat(F.lit("d"), (number.try_cast("long") % DOMAINS).cast("string")))


def default_tokens(text: Column) -> Column:
    """Blank-separated words and an end; at least 1."""
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return (F.size(words) + 1).cast("long")


def shared_out(children: DataFrame, parents: list[str]) -> DataFrame:
    """``children(*parents, weight, capacity, given)`` with ``budget``: each parent's ``given`` shared among its children.

    By weight, none above its capacity; what a child can't take goes to its
    siblings by their weights, and weightless children share what is left by
    their capacities.  In order of capacity a weight, every child is full up
    to the first whose share of what is left is under its capacity; it and
    all after it take that share.  One sort a parent, whatever the sizes.
    """
    siblings = Window.partitionBy(*parents)
    total = F.sum("weight").over(siblings)
    # weightless ones come last and share by capacity
    weighted = children.withColumn("_late", total <= 0).withColumn("_late", F.col("_late") | (F.col("weight") <= 0)).withColumn(
        "_w", F.when(F.col("_late"), F.col("capacity")).otherwise(F.col("weight").cast("double")))
    per = F.when(F.col("_w") > 0, F.col("capacity") / F.col("_w")).otherwise(F.lit(0.0))
    order = Window.partitionBy(*parents).orderBy("_late", "_per", "_name").rowsBetween(Window.unboundedPreceding, -1)
    rank = Window.partitionBy(*parents, "_late").orderBy("_per", "_name").rowsBetween(Window.unboundedPreceding, -1)
    name = F.concat_ws("\x00", *[c for c in ("domain", "lang", "source") if c in children.columns])
    placed = weighted.withColumn("_per", per).withColumn("_name", name)
    left = F.greatest(F.col("given") - F.coalesce(F.sum("capacity").over(order), F.lit(0.0)), F.lit(0.0))
    weights = F.sum("_w").over(Window.partitionBy(*parents, "_late")) - F.coalesce(F.sum("_w").over(rank), F.lit(0.0))
    levels = placed.withColumn("_level", F.when(weights > 0, left / weights).otherwise(F.lit(0.0)))
    full = F.col("_per") <= F.col("_level")
    stop = F.min(F.when(~full, F.struct("_per", "_name", "_level"))).over(Window.partitionBy(*parents, "_late"))["_level"]
    budget = F.when(full, F.col("capacity")).otherwise(F.least(F.col("capacity"), stop * F.col("_w")))
    return levels.withColumn("budget", budget).drop("_late", "_w", "_per", "_name", "_level")


def leaf_budgets(leaves: DataFrame, total: int | None = None, weights: dict[tuple[str, ...], float] | None = None,
                 epochs: int = EPOCHS) -> DataFrame:
    """(domain, lang, source, tokens, leaf_budget): whole-token budgets of ``leaves(domain, lang, source, tokens)``.

    ``weights`` by path, e.g. ("d0",), ("d0", "en"), ("d0", "en", "src4");
    paths that aren't given weigh 1.  ``total``: by default the tokens there
    are.  Capacities are summed up the tree and budgets shared out down it,
    one grouped pass a level; leaves stay in Spark.  No leaves: no rows.
    """
    spark, path = leaves.sparkSession, ["domain", "lang", "source"]
    given = spark.createDataFrame(
        [(*(list(k) + [None] * 3)[:3], len(k), float(w)) for k, w in (weights or {}).items()],
        "_d string, _l string, _s string, _depth int, _weight double")

    def weigh(nodes: DataFrame, depth: int) -> DataFrame:
        mine = F.broadcast(given.where(F.col("_depth") == depth))  # as many as the caller wrote down
        same = [F.col(c) == F.col(g) for c, g in zip(path[:depth], ("_d", "_l", "_s"))]
        on = same[0]
        for more in same[1:]:
            on = on & more
        return nodes.join(mine, on, "left").withColumn("weight", F.coalesce("_weight", F.lit(1.0))).drop("_d", "_l", "_s", "_depth", "_weight")

    bottom = leaves.withColumn("capacity", (F.col("tokens") * epochs).cast("double"))
    langs = bottom.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    every = Window.partitionBy()  # the domains: a handful of rows
    wanted = F.sum("tokens").over(every).cast("double") if total is None else F.lit(float(total))
    top = weigh(domains, 1).withColumn("given", F.least(wanted, F.sum("capacity").over(every)))
    above = shared_out(top, []).select("domain", F.col("budget").alias("given"))
    for depth, nodes in ((2, langs), (3, bottom)):
        parents = path[:depth - 1]
        below = shared_out(weigh(nodes.join(above, parents), depth), parents)
        above = below.select(*path[:depth], F.col("budget").alias("given"))
    return below.select(*path, "tokens", F.bround("budget").cast("long").alias("leaf_budget"))


def _order(epoch: Column, seed: int) -> Column:
    """A document's place in an epoch: a hash of seed, epoch, id and text."""
    return F.xxhash64(F.lit(seed), epoch, F.col("__id"), F.col("__key"))


def mixture(docs: DataFrame, total: int | None = None, weights: dict[tuple[str, ...], float] | None = None,
            epochs: int = EPOCHS, seed: int = SEED, domain: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ids, domain, lang, source, tokens, leaf_budget, epochs (how often it is drawn).

    ``total``: tokens of the mixture, by default as many as ``docs`` has.
    Columns read: doc_id, text, lang, source; a null lang or source is a leaf
    of its own (``unknown``).  Null and empty texts have one token, the end.
    Rows that repeat an id and text are drawn alike.  An empty table gives an
    empty mixture.  A document is drawn if the tokens before it in its
    leaf's epoch are under the leaf's budget, so a leaf exceeds its budget by
    less than one document (copies of one row count as one).

    The leaves' budgets are a table (:func:`leaf_budgets`), broadcast up to
    LEAVES_OUT leaves and joined by shuffle beyond.  Within a leaf, documents are ordered
    by hash; token sums by hash range tell which 1 / 65,536 of the leaf the cut
    lies in, and only that range is sorted, so no task orders a whole leaf.
    """
    text = F.col("text").cast("string")
    rows = stage(docs.select(
        F.col("doc_id").cast("long").alias("__id"), F.xxhash64(text).alias("__key"),
        F.coalesce((default_domain(F.col("source")) if domain is None else domain).cast("string"), F.lit("other")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("unknown")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("source"),
        (default_tokens(F.col("text")) if tokens is None else tokens).alias("tokens"),
    ))
    path = ["domain", "lang", "source"]
    leaves = rows.groupBy(*path).agg(F.sum("tokens").cast("long").alias("tokens"))
    have = F.greatest("tokens", F.lit(1))
    budget = stage(leaf_budgets(leaves, total, weights, epochs).select(
        *path, "leaf_budget", F.floor(F.col("leaf_budget") / have).alias("whole"), (F.col("leaf_budget") % have).alias("rest")))
    small = F.broadcast if budget.count() <= LEAVES_OUT else (lambda table: table)  # one row a leaf, at most one cut a leaf
    budget = small(budget)
    placed = rows.join(budget, path).withColumn("place", _order(F.col("whole"), seed))
    cuts = budget.select(*path, F.lit(0).cast("long").alias("cut"), F.lit(0).cast("long").alias("before"))
    for level in range(1, LEVELS + 1):
        # one hash range of the level before is cut into 2**BITS smaller ones
        cuts = placed.join(small(cuts), path).where(_range(level - 1) == F.col("cut")).groupBy(
            *path, "rest", "before", _range(level).alias("cut")).agg(F.sum("tokens").alias("here"))
        earlier = F.sum("here").over(Window.partitionBy(*path).orderBy("cut").rowsBetween(Window.unboundedPreceding, -1))
        cuts = cuts.withColumn("before", F.col("before") + F.coalesce(earlier, F.lit(0))).where(
            (F.col("before") < F.col("rest")) & (F.col("before") + F.col("here") >= F.col("rest"))).select(*path, "cut", "before")
    marked = placed.join(small(cuts), path, "left")
    here = _range(LEVELS)
    # rows that repeat each other end at the same sum, less what they have themselves
    order = Window.partitionBy(*path).orderBy("place", "__id", "__key")
    own = Window.partitionBy(*path, "place", "__id", "__key")
    ahead = F.col("before") + F.sum("tokens").over(order) - F.sum("tokens").over(own)
    drawn_there = marked.where(here == F.col("cut")).withColumn("ahead", ahead).select(
        *_OUT, (F.col("whole") + (F.col("ahead") < F.col("rest")).cast("long")).alias("epochs"))
    elsewhere = marked.where(F.col("cut").isNull() | (here != F.col("cut"))).select(
        *_OUT, (F.col("whole") + F.coalesce(here < F.col("cut"), F.lit(False)).cast("long")).alias("epochs"))
    return drawn_there.unionByName(elsewhere).withColumnsRenamed({"__id": "doc_id", "__key": "text_key"})


def _range(level: int) -> Column:
    """The hash range of a document's place at a level; level 0 is the whole leaf."""
    return F.shiftrightunsigned("place", 64 - BITS * level) if level else F.lit(0).cast("long")


_OUT = ["__id", "__key", "domain", "lang", "source", "tokens", "leaf_budget"]


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns), each as often as the mixture draws it.

    Odd rows as in :func:`mixture`: null and empty texts are drawn like
    others, repeated rows each as often as one of them, rows without an id by
    their texts; an empty table gives no rows.
    """
    drawn = mixture(docs, **options).where("epochs > 0").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.max("epochs").alias("__epochs"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__key"))
    repeated = docs.join(drawn, same).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__epochs"))))
    return repeated.select(docs.columns)
