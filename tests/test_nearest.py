"""The k best of every user from blocks, against the pairs' way and plain sums."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinnear.operators import nearest as M
from kinnear.operators.neighbours import knn
from kinnear.operators.similarity import Shape
from kinnear.session import materialize

CELLS = "user long, item long, weight double"


def cells_of(seed: int, users: int, items: int, chance: float, values=None):
    r = np.random.default_rng(seed)
    out = []
    for u in range(users):
        rated = np.flatnonzero(r.random(items) < chance)
        w = r.normal(size=len(rated)) if values is None else r.choice(values, len(rated))
        out += [(u * 7 % 1009, int(i) * 3, float(x / np.sqrt((w * w).sum()))) for i, x in zip(rated, w)]
    return out


def rows(df):
    return sorted((r.user, r["rank"], r.neighbour, round(r.sim, 8)) for r in df.collect())


@pytest.mark.parametrize("shape", [(90, 120, 0.05, None), (70, 5, 1.0, None), (60, 40, 0.3, [-1.0, 1.0])])
@pytest.mark.parametrize("k", [1, 7, 65])
def test_blocks_equal_pairs(spark, monkeypatch, shape, k):
    """Sparse, full and tied profiles, negatives in reach or not, ordered in small lots."""
    for name, size in (("SEGMENT_ROWS", 40), ("WAITING", 50), ("PRODUCTS_AT_ONCE", 300)):
        monkeypatch.setattr(M, name, size)
    table = materialize(spark.createDataFrame(cells_of(k, *shape), CELLS))
    n = shape[0]
    assert rows(knn(table, k, n, strategy="rows", written=True, blocks=3)) == rows(knn(table, k, n, strategy="join", written=True))


def test_blocks_of_named_items_and_equal_users(spark):
    """Items that are texts; a large group of equal users keeps the smallest ids."""
    table = materialize(spark.range(300).select(
        F.col("id").alias("user"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit(None))).alias("item"), F.lit(0.5**0.5).alias("weight")))
    got = rows(knn(table, 3, 1000, strategy="rows", written=True, blocks=2))
    assert got == [(u, r, v, 1.0) for u in range(300) for r, v in enumerate([x for x in range(4) if x != u][:3], 1)]


def test_rounded_units_as_spark(spark):
    sims = [0.5, -0.5, 5e-10, -5e-10, 4.9999999e-10, 0.1234567885, 0.1234567895, -0.1234567885, 0.9999999995, 1.0000000000000002, 0.3000000005]
    table = spark.createDataFrame([(s,) for s in sims], "s double")
    want = [r.u for r in table.select((F.round("s", 9) * 1e9).alias("s")).select(F.round("s").cast("long").alias("u")).collect()]
    assert M.rounded_units(np.array(sims)).tolist() == want


def test_full_tables_shuffle_no_row_a_pair(spark):
    """Dense data with negatives in reach go by blocks: the plan has no pairs to rank, only the k best of each."""
    table = materialize(spark.createDataFrame(cells_of(2, 400, 6, 1.0), CELLS))
    out = knn(table, 5, 400, written=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan and "Generate explode(array(struct" not in plan
    assert out.groupBy("user").count().agg(F.max("count")).first()[0] == 5


def test_block_count_is_bounded_by_memory():
    assert M.block_count(Shape(171_000_000, 5_400_000, 4.2e9, 800.0), 30, 12) == 15
    assert M.block_count(Shape(171_000_000, 5_400_000, 4.2e9, 800.0), 200, 12) == 18
    assert M.block_count(Shape(0, 0, 0.0, 0.0), 30, 12) == 1


def test_no_route_that_no_item_takes(spark):
    """Neighbours are joined by user only if an item has k raters; both ways give the same sums."""
    from kinnear.operators.predict import _fanout

    test = spark.createDataFrame([(1, 5), (2, 5), (1, 6)], "user long, item long")
    near = spark.createDataFrame([(1, 2, 0.5, 1), (1, 3, 0.25, 2), (2, 3, 1.0, 1)], "user long, neighbour long, sim double, rank long")
    dev = spark.createDataFrame([(2, 5, 0.5), (3, 5, -1.0), (3, 6, 1.0)], "user long, item long, dev double")
    found = {k: _fanout(test, near, dev, k) for k in (None, 2, 3)}
    plan = {k: df._jdf.queryExecution().analyzed().toString() for k, df in found.items()}
    assert "Union" in plan[2] and "Union" not in plan[3]
    assert len({tuple(sorted(map(tuple, df.select("user", "item", "sim", "rank", "dev").collect()))) for df in found.values()}) == 1


def test_cells_are_sent_once_a_task_however_many_blocks(spark):
    """Many neighbours need more blocks, not more copies of the cells: tasks take their blocks in turn."""
    large = Shape(171_000_000, 3_600_000, 4.2e9, 2700.0)
    assert M.block_count(large, 1400, 12) == 70 and M.task_count(large, 12) == 12
    table = materialize(spark.createDataFrame(cells_of(3, 200, 60, 0.2), CELLS))
    found = knn(table, 150, 200, strategy="rows", written=True, blocks=11)
    assert rows(found) == rows(knn(table, 150, 200, strategy="join", written=True))
    task_numbers = "sequence(0, 3"
    assert task_numbers in found._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("held", [0, 64 << 20])
def test_packed_cells_come_back(monkeypatch, held):
    """Ids and items of any sign and size, users without cells, values kept in a file or in memory."""
    monkeypatch.setattr(M, "HELD_BYTES", held)
    monkeypatch.setattr(M, "PACK_CELLS", 4)
    want = {5: [(-(2**63), 0.5), (2**63 - 1, 0.5), (7, -1.0)], -7: [], 2**62: [(3, 1e-300), (3, 2.0)], 9: [(i, float(i)) for i in range(9)]}
    batch = pa.RecordBatch.from_arrays([
        pa.array(list(want), pa.int64()), pa.array([[i for i, _ in c] for c in want.values()], pa.list_(pa.int64())),
        pa.array([[w for _, w in c] for c in want.values()], pa.list_(pa.float64()))], names=["user", "items", "weights"])
    passing = M.Passing()
    for value in M._pack([batch]):
        passing.add(*(value.column(i)[0].as_py() for i in range(3)))
    for _ in range(2):
        got = {}
        for users, sizes, items, weights in passing:
            ends = np.cumsum(sizes)
            got |= {int(u): list(zip(items[e - n:e].tolist(), weights[e - n:e].tolist())) for u, n, e in zip(users, sizes, ends)}
        assert len(passing.sizes) > 1 and {u: sorted(c) for u, c in got.items()} == {u: sorted(c) for u, c in want.items()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_packed_pairs_meet_as_rows_do(spark, monkeypatch, kind):
    """Hot items, users with many pairs, repeated and unknown keys: each way gives the hits of the plain joins."""
    from kinnear.operators import predict as P

    monkeypatch.setattr(P, "PAIRS_OF_USER", 12)
    monkeypatch.setattr(P, "GROUP_ROWS", 300)
    r = np.random.default_rng(5)
    draw = lambda n, *most: [tuple(int(x) for x in row) for row in np.column_stack([r.integers(0, m, n) for m in most])]
    test = spark.createDataFrame(draw(300, 40, 30) + [(1, i) for i in range(25)], "user long, item long")
    near = spark.createDataFrame(draw(500, 40, 50, 8), "user long, neighbour long, rank long").withColumn("sim", F.col("rank") / 8)
    dev = spark.createDataFrame(draw(400, 50, 28) + [(u, 3) for u in range(50)], "user long, item long").withColumn("dev", F.col("user") - 20.0)
    test, dev = (t.withColumn("user", F.when(F.col("user") != 7, F.col("user")).cast(kind)) for t in (test, dev))
    near = near.withColumns({c: F.when(F.col(c) != 9, F.col(c)).cast(kind) for c in ("user", "neighbour")})
    hits = lambda k: sorted(map(tuple, P._fanout(test, near, dev, k).select("user", "item", "sim", "rank", "dev").collect()))
    assert hits(10) == hits(20) == hits(1000) == hits(None) and hits(10)
    plan = P._fanout(test, near, dev, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_items_with_some_more_raters_than_k_take_no_second_route(spark):
    """An item with 60 raters is met by them at k=30: the neighbours are not shuffled twice for it."""
    from kinnear.operators import predict as P

    test = spark.range(40).select(F.col("id").alias("user"), F.lit(5).cast("long").alias("item"))
    near = spark.range(400).select((F.col("id") % 40).alias("user"), (F.col("id") % 77).alias("neighbour"), (F.col("id") / 400).alias("sim"))
    dev = spark.range(60).select(F.col("id").alias("user"), F.lit(5).cast("long").alias("item"), (F.col("id") - 9.5).alias("dev"))
    found = P._fanout(test, near, dev, 30)
    assert "Union" not in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, P._fanout(test, near, dev).select(*found.columns).collect()))


@pytest.mark.parametrize("most_tasks", [2, 100])
@pytest.mark.parametrize("shape", [(90, 120, 0.05, None), (70, 5, 1.0, None), (60, 40, 0.3, [-1.0, 1.0])])
def test_written_cells_are_read_and_not_sent(spark, monkeypatch, shape, most_tasks):
    """Large tables: every task reads the written cells, one block or several in turn; no copy of a cell is shuffled."""
    for name, size in (("SENT_CELLS", 0), ("MOST_TASKS", most_tasks), ("HELD_BYTES", 100), ("PRODUCTS_AT_ONCE", 300)):
        monkeypatch.setattr(M, name, size)
    table = materialize(spark.createDataFrame(cells_of(4, *shape), CELLS))
    for k in (3, 65):
        found = knn(table, k, shape[0], strategy="rows", written=True, blocks=5)
        assert rows(found) == rows(knn(table, k, shape[0], strategy="join", written=True))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Coalesce" in plan and found.rdd.getNumPartitions() == min(most_tasks, 5)
    assert rows(knn(table.limit(0), 3, shape[0], strategy="rows", blocks=2)) == []


def test_own_cells_may_come_last():
    """A block is met by the users that came before its own cells as well; several blocks take their turns."""
    r = np.random.default_rng(1)
    value = lambda users: (len(users), 3 * len(users), next(M._pack([pa.RecordBatch.from_arrays([
        pa.array(users, pa.int64()), pa.array([[1, 2, 3]] * len(users), pa.list_(pa.int64())),
        pa.array(r.normal(size=(len(users), 3)).tolist(), pa.list_(pa.float64()))], names=["user", "items", "weights"])])).column(2)[0].as_py())
    first, second = value([1, 2, 3]), value([4, 5])
    given = [(0, *first), (1, *second), (None, *first), (None, *second)]

    def out(order, *lots):
        batch = pa.RecordBatch.from_arrays([pa.array([given[i][j] for i in order], t) for j, t in enumerate(
            [pa.int32(), pa.int64(), pa.int64(), pa.binary()])], names=["lot", "users", "cells", "packed"])
        made = M._passed({lot: 1 for lot in lots}, lambda: M.Block(9, False), None)([batch])
        return sorted(tuple(x.values()) for b in made for x in b.to_pylist())

    assert out([0, 2, 3], 0) == out([2, 0, 3], 0) == out([3, 2, 0], 0)
    assert sorted(out([0, 2, 3], 0) + out([1, 2, 3], 1)) == out([3, 0, 2, 1], 0, 1) != []


@pytest.mark.parametrize("items", [[-(2**63), 2**63 - 1, 5], [7, 9, 8, 1_000], [-3, -3, 4]])
def test_items_are_numbered(items):
    block = M.Block(1, False)
    code, n = block.named(np.array(items))
    assert n == len(set(items)) and sorted(set(code.tolist())) == list(range(n))
    assert block.numbers(np.array(items)).tolist() == code.tolist() and block.numbers(np.array([6, 2**62, -(2**62)])).tolist() == [-1] * 3


def test_blocks_fit_a_worker():
    """Blocks at 360 times sf0.1 hold 2M cells and keep 6M rows on average, not 12M and 60M."""
    for k, n in ((30, 96), (200, 180), (1400, 708)):
        shape = Shape(171_000_000, 5_400_000, 4.2e9, 800.0)
        lots = M.lot_count(shape, k, 12)
        assert lots == n and shape.cells / lots <= M.LOT_CELLS and min(shape.users * min(k, shape.partners), shape.products) / lots <= M.LOT_KEPT


@pytest.mark.parametrize("shape", [(90, 120, 0.05, None), (70, 5, 1.0, None)])
def test_all_pairs_by_blocks(spark, monkeypatch, shape):
    """Pairs come from blocks: each once, repeated cells added up, and no exchange after the cells are written."""
    from kinnear.operators.similarity import similarity_pairs

    cells = cells_of(6, *shape)
    table = materialize(spark.createDataFrame(cells + cells[:20], CELLS))
    plain = similarity_pairs(table, "join")
    monkeypatch.setattr(M, "LEAST_PRODUCTS", 0)
    monkeypatch.setattr(M, "CELL_BYTES", 0)
    found = similarity_pairs(table)
    some = lambda df: sorted((r.user, r.neighbour, round(r.sim, 8)) for r in df.collect())
    assert some(found) == some(plain) and some(M.all_pairs(table, Shape.of(table), 3)) == some(plain)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() and found.rdd.getNumPartitions() > 1
