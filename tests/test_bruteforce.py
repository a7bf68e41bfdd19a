"""Spark operators against the dense NumPy statement of the predictor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import RATINGS, SF_SMALL
from bruteforce import model, neighbours, predict as bf_predict
from kinnear.operators.neighbours import knn
from kinnear.operators.predict import predict
from kinnear.operators.profile import normalized_deviation, unit_profile, user_mean
from kinnear.sources.ratings import train_test


@pytest.fixture(scope="module")
def r1(spark):
    r, train, test = train_test(spark, SF_SMALL)
    tr = [tuple(x) for x in train.collect()]
    te = [tuple(x) for x in test.collect()]
    users = sorted({u for u, _, _ in tr} | {u for u, _, _ in te})
    return train, test, tr, te, users


def _spark_knn(train, k, n_users, **kw):
    means = user_mean(train)
    d = normalized_deviation(train, means)
    return means, d, knn(unit_profile(d), k, n_users, **kw)


@pytest.mark.parametrize(
    "k,kw",
    [
        (10, {}),
        (30, {"strategy": "tiles", "block_users": 16}),
        (100, {"strategy": "tiles", "block_users": 40}),
        (149, {"strategy": "tiles", "block_users": 70, "heavy_user_cells": 30}),
        (30, {"strategy": "join"}),
    ],
)
def test_r1_against_bruteforce(spark, r1, k, kw):
    train, test, tr, te, users = r1
    m = model(tr, users)
    want_n = neighbours(m, k)
    means, d, n = _spark_knn(train, k, len(users), **kw)
    got = {}
    for r in n.collect():
        got.setdefault(r.user, []).append((r.neighbour, r.sim, r.rank))
    for u in users:
        w = sorted(want_n.get(u, []), key=lambda t: t[2])
        g = sorted(got.get(u, []), key=lambda t: t[2])
        assert [(v, r) for v, _, r in g] == [(v, r) for v, _, r in w], u
        assert np.allclose([s for _, s, _ in g], [s for _, s, _ in w], atol=1e-12)
    want_p = bf_predict(m, want_n, te)
    got_p = {(r.user, r.item): r.prediction for r in predict(test, n, d, means).collect()}
    assert set(got_p) == set(want_p)
    for key, w in want_p.items():
        assert got_p[key] == pytest.approx(w, abs=1e-9), key


def test_random_dense_rule(spark):
    """Small random matrices, k close to the user count: negatives rank in."""
    rng = np.random.default_rng(7)
    for trial in range(4):
        n_users, n_items = 12, 9
        cells = [
            (u, i, float(rng.integers(1, 6)))
            for u in range(1, n_users + 1)
            for i in range(1, n_items + 1)
            if rng.random() < 0.45
        ]
        users = sorted({u for u, _, _ in cells})
        df = spark.createDataFrame(cells, RATINGS)
        m = model(cells, users)
        for k in (3, 8, len(users) - 1, len(users) + 2):
            want = {(u, v, r) for u, lst in neighbours(m, k).items() for v, _, r in lst}
            _, _, n = _spark_knn(df, k, len(users), strategy=("join", "tiles")[trial % 2], block_users=5)
            got = {(r.user, r.neighbour, r.rank) for r in n.collect()}
            assert got == want, (trial, k)


def test_input_order_does_not_matter(spark, r1):
    train, _, _, _, users = r1
    # a different, deterministic row order and partitioning of the same cells
    shuffled = train.repartition(7, F.col("item")).sortWithinPartitions(F.col("rating").desc(), "item")
    _, _, a = _spark_knn(train, 20, len(users))
    _, _, b = _spark_knn(shuffled, 20, len(users), strategy="tiles", block_users=30)
    cols = ["user", "neighbour", "rank"]
    x = set(map(tuple, a.select(cols).collect()))
    y = set(map(tuple, b.select(cols).collect()))
    assert len(x) == len(y) and not (x ^ y)
