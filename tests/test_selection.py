"""Pruned k-NN, signed ranking, chunked join and many lookups against plain computations."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinnear.operators import neighbours as N
from kinnear.operators.neighbours import knn, rank_signed
from kinnear.operators.pruning import item_classes, knn_pruned, products, user_heads
from kinnear.operators.similarity import similarity_join, similarity_of_users, similarity_one_user, similarity_tiles
from kinnear.session import materialize

CELLS = "user long, item long, weight double"


def profiles(seed: int, users: int, items: int, hot: float, clusters: int = 0):
    """Unit profiles with a few items that nearly everybody rated and some rare ones; clustered users have nearly equal ones."""
    r = np.random.default_rng(seed)
    base = r.normal(size=(max(1, clusters), items))
    out = []
    for u in range(users):
        chance = np.where(np.arange(items) < hot * items, 0.9, 0.15)
        rated = np.flatnonzero(r.random(items) < chance)
        w = r.normal(size=items)[rated] if not clusters else base[u % clusters][rated] + 0.1 * r.normal(size=len(rated))
        length = np.sqrt((w * w).sum())
        out += [(u, int(i), float(x / length)) for i, x in zip(rated, w) if length > 0]
    return out


def dense(cells):
    users, items = 1 + max(c[0] for c in cells), 1 + max(c[1] for c in cells)
    m = np.zeros((users, items))
    for u, i, w in cells:
        m[u, i] = w
    return m @ m.T


def top_positive(cells, k):
    sims, out = dense(cells), set()
    for u in range(len(sims)):
        order = sorted((-round(sims[u, v], 9), v) for v in range(len(sims)) if v != u and round(sims[u, v], 9) > 0)
        out |= {(u, v, r, -s) for r, (s, v) in enumerate(order[:k], 1)}
    return out


def rows(df):
    return {(r.user, r.neighbour, r["rank"], round(r.sim, 9)) for r in df.collect()}


@pytest.mark.parametrize("shape", [(60, 40, 0.2, 0), (60, 40, 0.2, 6), (40, 6, 1.0, 4), (30, 50, 0.0, 0)])
@pytest.mark.parametrize("k", [1, 4])
def test_pruned_equals_all_pairs(spark, shape, k):
    cells = profiles(3, *shape)
    table = materialize(spark.createDataFrame(cells, CELLS))
    for classes, first in ((32, 3), (4, 1), (1, 1)):
        assert rows(knn_pruned(table, k, classes, first)) == top_positive(cells, k), (classes, first)


def test_pruning_leaves_products_out(spark):
    cells = profiles(5, 120, 60, 0.2, 8)
    table = materialize(spark.createDataFrame(cells, CELLS))
    counted = products(table, 2).first()
    raters = np.bincount([i for _, i, _ in cells])
    assert counted.plain == (raters * (raters - 1) // 2).sum()
    assert counted.second_pass + counted.completion < counted.plain


def test_pruned_odd_tables(spark):
    """Equal profiles, users alone on their items, one user, no rows."""
    cells = [(u, 0, 1.0) for u in range(6)] + [(9, 5, 1.0), (10, 6, 0.6), (10, 7, 0.8)]
    table = materialize(spark.createDataFrame(cells, CELLS))
    assert rows(knn_pruned(table, 3)) == {(u, v, r, 1.0) for u in range(6) for r, v in enumerate([x for x in range(6) if x != u][:3], 1)}
    assert knn_pruned(materialize(table.limit(0)), 3).collect() == []
    assert knn_pruned(materialize(table.where("user = 10")), 3).collect() == []


def test_item_classes_rise_with_raters(spark):
    cells = profiles(7, 50, 30, 0.3)
    table = spark.createDataFrame(cells, CELLS)
    found = {r.item: (r.n, r["class"]) for r in item_classes(table).collect()}
    counts = np.bincount([i for _, i, _ in cells])
    assert {i: n for i, (n, _) in found.items()} == {i: n for i, n in enumerate(counts) if n}
    by_n = sorted(found.values())
    assert all(a[1] <= b[1] for a, b in zip(by_n, by_n[1:]) if a[0] < b[0])
    classed = table.join(item_classes(table).select("item", "class"), "item")
    for r in user_heads(classed).collect():
        for c in (0, 10, 31):
            want = np.sqrt(sum(w * w for u, i, w in cells if u == r.user and found[i][1] > c))
            assert abs(r.heads[c] - want) < 1e-12


@pytest.mark.parametrize("k", [1, 3, 7, 9, 12])
def test_signed_ranks_by_the_dense_rule(spark, k):
    """Positives first, zeros (oneself among them) between, negatives last; ties by id."""
    r = random.Random(k)
    n_users, sims = 9, {}
    for u in range(8):
        for v in range(u):
            sims[u, v] = r.choice([0.5, 0.5, 0.25, -0.5, -0.5, -0.125, 0.0, None])
    directed = [(a, b, s) for (u, v), s in sims.items() if s is not None for a, b in ((u, v), (v, u))]
    expected = set()
    for u in range(8):
        row = {v: s for a, v, s in directed if a == u}
        order = sorted(range(n_users), key=lambda v: (-row.get(v, 0.0), 0 if row.get(v, 0.0) else 1, v))
        expected |= {(u, v, i, row[v]) for i, v in enumerate(order[:k], 1) if row.get(v)}
    table = spark.createDataFrame(directed, "user long, neighbour long, sim double")
    assert rows(rank_signed(table, k, n_users)) == expected


def test_similarities_are_computed_once(spark, monkeypatch):
    """With negatives in reach the plan holds one tile stage."""
    cells = profiles(1, 20, 10, 0.5)
    plan = knn(spark.createDataFrame(cells, CELLS), 15, 20, strategy="tiles")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1
    calls = []
    monkeypatch.setattr(N, "similarities", lambda *a, **b: calls.append(1) or similarity_join(a[0]))
    knn(spark.createDataFrame(cells, CELLS), 15, 20)
    assert calls == [1]


def test_hot_item_in_chunks(spark):
    """One item rated by everybody: the same sums as tiles, and no key of the join with more than a chunk a side."""
    cells = [(u, 0, 0.1 + u / 1000) for u in range(400)] + profiles(2, 400, 25, 0.0)
    cells = list({(u, i): (u, i, w) for u, i, w in cells}.values())
    table = materialize(spark.createDataFrame(cells, CELLS))
    want = {(min(r.user, r.neighbour), max(r.user, r.neighbour)): r.sim for r in similarity_tiles(table, 3, 4).collect()}
    for chunk in (16, 100, 10_000):
        found = {(r.user, r.neighbour): r.sim for r in similarity_join(table, chunk).collect()}
        assert all(a < b for a, b in found)
        assert found.keys() == want.keys() and max(abs(found[p] - want[p]) for p in want) < 1e-12


def test_largest_task_of_a_hot_item(spark):
    """The pairs of one hot item are made in many tasks, none of which makes a large share."""
    table = spark.range(2000).select(F.col("id").alias("user"), F.lit(0).cast("long").alias("item"), F.lit(0.5).alias("weight"))
    from kinnear.operators.similarity import _chunked

    cells = _chunked(table, 100)
    a = cells.select("item", F.col("chunk").alias("p"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("q"))
    b = cells.select("item", F.col("chunk").alias("q"), F.explode(F.sequence(F.lit(0), "chunk")).alias("p"))
    sides = [x.groupBy("item", "p", "q").count() for x in (a, b)]
    made = sides[0].join(sides[1].withColumnRenamed("count", "m"), ["item", "p", "q"]).select((F.col("count") * F.col("m")).alias("n"))
    total, most, keys = made.agg(F.sum("n"), F.max("n"), F.count("n")).first()
    assert keys == 20 * 21 // 2 and most < 0.02 * total


@pytest.mark.parametrize("limit", [10**6, 0])
def test_many_lookups(spark, limit):
    cells = profiles(4, 50, 20, 0.3)
    table = materialize(spark.createDataFrame(cells, CELLS))
    users = spark.createDataFrame([(u,) for u in (0, 3, 3, 7, 999)], "user long")
    found = {(r.user, r.neighbour): round(r.sim, 12) for r in similarity_of_users(table, users, limit).collect()}
    want = {}
    for u in (0, 3, 7):
        want |= {(u, r.neighbour): round(r.sim, 12) for r in similarity_one_user(table, u).collect()}
    assert found == want


def test_pairs_are_bounded_before_they_meet_the_lengths(spark):
    """Pair sums carry one length a user and drop below their bounds before the arrays of lengths are joined."""
    from kinnear.operators import pruning as P

    table = materialize(spark.createDataFrame(profiles(5, 120, 60, 0.2, 8), CELLS))
    p = P.prepare(table, 2)
    assert "heads" not in p.cells.columns and "most" in P.pair_sums(p).columns
    sums = P.pair_sums(p)
    heads = {r.user: r.heads for r in p.heads.collect()}
    want = {(r.user, r.neighbour) for r in sums.collect()
            if r.sim + heads[r.user][r.above] * heads[r.neighbour][r.above] >= r.least - P.SLACK}
    left = P.survivors(p, sums)
    assert {(r.user, r.neighbour) for r in left.collect()} == want and len(want) < sums.count()


@pytest.mark.parametrize(("shape", "k"), [((90, 120, 0.05), 4), ((60, 40, 0.3), 1)])
def test_pruned_by_blocks(spark, monkeypatch, shape, k):
    """The passes in blocks give the rows of all pairs, and no row of a pair is shuffled."""
    from kinnear.operators import nearest, pruning
    from kinnear.operators.similarity import Shape

    monkeypatch.setattr(nearest, "PRODUCTS_AT_ONCE", 300)
    r = np.random.default_rng(k)
    cells = []
    for u in range(shape[0]):
        rated = np.flatnonzero(r.random(shape[1]) < shape[2] * 4 / (1 + np.arange(shape[1])) ** 0.5)
        w = r.normal(size=len(rated)) * np.where(u % 3, 1, 30.0 / (1 + rated))
        cells += [(u * 7 - 50, int(i), float(x / np.sqrt((w * w).sum()))) for i, x in zip(rated, w)]
    table = materialize(spark.createDataFrame(cells, "user long, item long, weight double"))
    want = rows(knn(table, k, 10_000, strategy="join", written=True))
    for classes, first in ((8, 2), (32, 3)):
        assert rows(pruning.pruned_by_blocks(table, k, Shape.of(table), classes, first, 4)) == want
    monkeypatch.setattr(nearest, "LEAST_PRODUCTS", 0)
    monkeypatch.setattr(nearest, "CELL_BYTES", 0)
    found = knn(table, k, 10_000, strategy="pruned", written=True)
    assert rows(found) == want and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
