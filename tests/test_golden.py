"""G1: the hand-checkable 5 x 6 matrix (expected values from FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from kinnear.operators.evaluate import cold_start, mae, sparse_difference
from kinnear.operators.neighbours import knn
from kinnear.operators.predict import predict
from kinnear.operators.profile import normalized_deviation, unit_profile, user_mean, user_norm
from kinnear.operators.similarity import similarity_one_user, similarity_pairs
from kinnear.plans.pipeline import fit

# Fixed expected values of the G1 fixture.
MEANS = {1: 4.0, 2: 3.333333, 3: 2.666667, 4: 2.0, 5: 4.0}
NORMS = {1: 1.054093, 2: 1.469694, 3: 1.469694, 4: 0.0, 5: 1.054093}
SIMS = {(1, 2): 0.473365, (1, 3): -0.860663, (1, 5): 0.9, (2, 3): -0.833333, (2, 5): 0.258199, (3, 5): -0.645497}
# k -> (non-zero edges, p(1,4), p(2,3), p(3,3), p(4,1), p(5,2), p(1,6), MAE)
BY_K = {
    1: (3, 4, 3.333333, 2.666667, 2, 3, 4, 0.666666667),
    2: (6, 5, 3.333333, 2.666667, 2, 2.554137, 4, 0.907643833),
    3: (7, 5, 3.333333, 2.666667, 2, 2.554137, 4, 0.907643833),
    4: (8, 5, 3.333333, 2.666667, 2, 2.554137, 4, 0.907643833),
    5: (12, 4.612903, 3.333333, 2.666667, 2, 1.997951, 4, 0.935825333),
}
CELLS = [(1, 4), (2, 3), (3, 3), (4, 1), (5, 2), (1, 6)]


def test_means_norms_deviations(g1):
    train, _ = g1
    m = {r.user: r.mean for r in user_mean(train).collect()}
    assert m == pytest.approx(MEANS, abs=1e-6)
    d = normalized_deviation(train)
    n = {r.user: r.norm for r in user_norm(d).collect()}
    assert n == pytest.approx(NORMS, abs=1e-6)
    dev = {(r.user, r.item): r.dev for r in d.collect()}
    assert dev[(1, 3)] == 0.0  # rating equal to the mean
    assert dev[(2, 1)] == pytest.approx(0.4)
    assert all(abs(v) <= 1 for v in dev.values())
    # user 4 has all-equal ratings: no profile row at all
    assert unit_profile(d).where(F.col("user") == 4).count() == 0


@pytest.mark.parametrize("strategy", ["tiles", "join"])
def test_similarities(g1, strategy):
    train, _ = g1
    p = unit_profile(normalized_deviation(train))
    s = {(r.user, r.neighbour): r.sim for r in similarity_pairs(p, strategy=strategy, block_users=2).collect()}
    assert s == pytest.approx(SIMS, abs=1e-6)


@pytest.mark.parametrize("strategy", ["tiles", "join"])
@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_predictions_by_k(g1, k, strategy):
    train, test = g1
    means = user_mean(train)
    d = normalized_deviation(train, means)
    n = knn(unit_profile(d), k, n_users=5, strategy=strategy, block_users=2)
    exp = BY_K[k]
    assert n.count() == exp[0]
    p = predict(test, n, d, means)
    got = {(r.user, r.item): r.prediction for r in p.collect()}
    for cell, want in zip(CELLS, exp[1:7]):
        assert got[cell] == pytest.approx(want, abs=1e-6), (k, cell)
    assert mae(p).first().mae == pytest.approx(exp[7], abs=1e-6)


def test_negative_neighbours_enter_in_dense_order(g1):
    # user 3 has no positive similarity: k=3 reaches its first negative
    # (closest to zero, user 5), k=4 the second (user 2)
    train, _ = g1
    p = unit_profile(normalized_deviation(train))
    for k, want in [(2, set()), (3, {5}), (4, {5, 2}), (5, {5, 2, 1})]:
        got = {r.neighbour for r in knn(p, k, n_users=5).where(F.col("user") == 3).collect()}
        assert got == want, k


def test_unseen_user_is_null_and_counted(g1, spark):
    train, test = g1
    test_b = test.unionByName(spark.createDataFrame([(6, 1, 4.0)], test.schema))
    means = user_mean(train)
    d = normalized_deviation(train, means)
    n = knn(unit_profile(d), 5, n_users=6)
    p = predict(test_b, n, d, means)
    row = p.where(F.col("user") == 6).first()
    assert row.prediction is None
    cs = {r.kind: r.n for r in cold_start(train, test_b).collect()}
    assert cs == {"user": 1, "item": 1}
    # MAE ignores the unpredictable cell; n_users=6 adds one more zero column
    # for every user, which moves user 3's negatives one rank later
    m = mae(p).first()
    assert m.n == 6


def test_matrix_dimension_is_explicit(g1):
    """User 4 has no profile row but is a column of the matrix: k=3 gives 7 edges, and fewer users than seen is an error."""
    train, _ = g1
    p = unit_profile(normalized_deviation(train))
    assert fit(train, 3).neighbours.count() == 7
    with pytest.raises(TypeError):
        knn(p, 3)
    with pytest.raises(ValueError, match="n_users"):
        knn(p, 3, n_users=3)


def test_equal_ratings_have_no_profile(spark):
    """Three ratings of 1.35: their mean misses them by a rounding error, which is no deviation."""
    train = spark.createDataFrame([(1, i, 1.35) for i in range(3)] + [(2, 0, 1.0), (2, 1, 5.0)], "user long, item long, rating double")
    d = normalized_deviation(train)
    assert [r.dev for r in d.where("user = 1").collect()] == [0.0] * 3
    assert {r.user for r in unit_profile(d).collect()} == {2}


def test_repeated_test_rows_survive(g1, spark):
    train, test = g1
    model = fit(train, 5, n_users=5)
    twice = test.unionByName(test).unionByName(test.withColumn("rating", F.lit(1.0)))
    got = model.predict(twice)
    assert got.count() == 3 * test.count()
    assert mae(model.predict(test.unionByName(test))).first().n == 2 * mae(model.predict(test)).first().n
    multi = model.predict_multi_k(twice, [2, 5])
    assert multi.count() == 3 * test.count()


def test_repeated_ratings_are_refused_or_merged(g1):
    train, _ = g1
    with pytest.raises(Exception, match="duplicate rating"):
        fit(train.unionByName(train.limit(1)), 2)
    assert fit(train.unionByName(train), 3, duplicates="max").neighbours.count() == 7


def test_several_users_at_once(g1):
    train, _ = g1
    p = unit_profile(normalized_deviation(train))
    got = {(r.user, r.neighbour): r.sim for r in similarity_one_user(p, p.where("user in (1, 2)")).collect()}
    assert got.keys() == {(1, 2), (1, 3), (1, 5), (2, 1), (2, 3), (2, 5)}
    assert got[(1, 5)] == pytest.approx(0.9, abs=1e-6)


def test_prediction_routes_agree(spark):
    """Items with k - 1, k and k + 1 raters give the same predictions by either route."""
    train = spark.createDataFrame(
        [(u, 100, float(u % 5 + 1)) for u in range(1, 9)] + [(u, 200 + j, float((u * j) % 5 + 1)) for j, n in enumerate((2, 3, 4)) for u in range(1, n + 1)],
        "user long, item long, rating double")
    model = fit(train, 3)
    test = spark.createDataFrame([(u, 200 + j, 3.0) for u in range(1, 9) for j in range(3)], "user long, item long, rating double")
    rows = lambda k: sorted(map(tuple, predict(test, model.neighbours, model.deviations, model.means, k=k).collect()))
    for x, y in zip(rows(3), rows(None), strict=True):
        assert x[:3] == y[:3] and x[3] == pytest.approx(y[3])


def test_sparse_difference(spark):
    a = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0)], "user long, item long, rating double")
    b = spark.createDataFrame([(1, 2, 1.0), (2, 2, 4.0)], "user long, item long, rating double")
    assert {tuple(r) for r in sparse_difference(a, b).collect()} == {(1, 1, 5.0), (1, 2, 2.0), (2, 2, -4.0)}
