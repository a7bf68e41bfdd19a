"""The tile product against a dense product, the plan choice, and both strategies on two shapes of data."""

import numpy as np
import pandas as pd
import pytest

from kinnear.operators.similarity import (
    MOST_PARTITIONS,
    Shape,
    _tile,
    choose_strategy,
    num_blocks,
    similarities,
    tile_partitions,
    tile_product,
)


@pytest.mark.parametrize("at_once", [1, 7, 1000])
@pytest.mark.parametrize("fill", [0.05, 0.3, 0.9])
def test_product(at_once, fill):
    rng = np.random.default_rng(3)
    x, y = (np.where(rng.random((n, 15)) < fill, rng.normal(size=(n, 15)), 0) for n in (20, 13))
    cells = [(*np.nonzero(m), m[np.nonzero(m)]) for m in (x, y)]
    assert np.allclose(tile_product(*cells, (20, 13, 15), at_once), x @ y.T)


@pytest.mark.parametrize("names", [np.arange(12), np.array([f"item {i}" for i in range(12)])])
def test_tile_emits_each_pair_once(names):
    rng = np.random.default_rng(1)
    cells = pd.DataFrame({"user": np.repeat(np.arange(30), 5), "item": names[rng.integers(0, 12, 150)], "weight": rng.normal(size=150)})
    cells = cells.drop_duplicates(["user", "item"])
    cells["block"] = cells.user % 2
    m = cells.pivot(index="user", columns="item", values="weight").fillna(0).to_numpy()
    got = {}
    for key in [(0, 0), (0, 1), (1, 1)]:
        out = _tile(key, cells[cells.block.isin(key)])
        for u, v, s in out.itertuples(index=False):
            pair = (min(u, v), max(u, v))
            assert pair not in got
            got[pair] = s
    want = {(u, v): m[u] @ m[v] for u in range(30) for v in range(u + 1, 30) if abs(m[u] @ m[v]) > 1e-15}
    assert got.keys() >= want.keys()
    assert all(got[p] == pytest.approx(s) for p, s in want.items())


def test_plan_choice_at_scale():
    """1e11 cells: no overflow, bounded partitions; the sparse shape joins, the hot one uses tiles."""
    sparse = Shape(10**11, 3 * 10**9, 10**11 * 25.0)
    blocks = num_blocks(sparse)
    assert 1 <= tile_partitions(sparse, blocks, 4000) <= MOST_PARTITIONS
    assert choose_strategy(sparse, blocks) == "join"
    hot = Shape(800_000, 6040, 327e6)
    assert choose_strategy(hot, num_blocks(hot)) == "tiles"
    assert tile_partitions(hot, num_blocks(hot), 8) <= 64
    assert num_blocks(Shape(0, 0, 0.0)) == 1 and tile_partitions(Shape(0, 0, 0.0), 1, 8) == 1


def _shape(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "hot":  # two items rated by everybody, a long tail
        cells = [(u, i, float(rng.normal())) for u in range(60) for i in {0, 1, *rng.integers(2, 40, 3).tolist()}]
    else:
        cells = [(u, i, float(rng.normal())) for u in range(90) for i in set(rng.integers(0, 300, 4).tolist())]
    return spark.createDataFrame(cells, "user long, item long, weight double")


@pytest.mark.parametrize("kind", ["hot", "sparse"])
@pytest.mark.parametrize("heavy", [10**6, 5, 4, 0])  # users at the bound, over it, and all of them
def test_strategies_agree(spark, kind, heavy):
    p = _shape(spark, kind).cache()

    def pairs(**options):
        rows = similarities(p, **options).collect()
        found = {(min(r.user, r.neighbour), max(r.user, r.neighbour)): r.sim for r in rows}
        assert len(found) == len(rows)  # each pair once
        return {k: v for k, v in found.items() if abs(v) > 1e-12}

    want = pairs(strategy="join")
    got = pairs(strategy="tiles", block_users=16, heavy_user_cells=heavy)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
