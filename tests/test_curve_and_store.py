"""The whole k curve, mergeable error summaries, nested-list prediction and stored models."""

import math

import pytest
from pyspark.sql import functions as F

from kinnear.operators.evaluate import error_moments, error_stats_by_k, error_summary, merge_moments, moment_summary
from kinnear.operators.neighbours import neighbour_lists
from kinnear.operators.predict import predict, predict_from_lists, predict_multi_k
from kinnear.plans.pipeline import fit
from kinnear.plans.store import load_model, neighbours_of, save_model
from kinnear.session import scratch_folder
from kinnear.sources.ratings import train_test

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    _, train, test = train_test(spark, SF)
    return train, test, fit(train, 40, 150, duplicates=None)


def test_curve_equals_each_k(spark, g1, real):
    for train, test, model, ks in ((*g1, fit(g1[0], 5, 5), [1, 2, 3, 4, 5]), (*real, [1, 2, 7, 30, 40])):
        twice = test.unionByName(test.limit(3)).unionByName(spark.createDataFrame([(987654, 1, 4.0)], "user long, item long, rating double"))
        curve = {r.k: r for r in model.error_curve(twice).collect()}
        assert sorted(curve) == list(range(1, model.k + 1))
        multi = model.predict_multi_k(twice, ks)
        for r in error_stats_by_k(multi, ks).collect():
            assert curve[r.k].n == r.n and abs(curve[r.k].mae - r.mae) < 1e-9
            assert abs(curve[r.k].rmse - math.sqrt(r.var_e + r.mae**2)) < 1e-9
    with pytest.raises(ValueError, match="ranked for"):
        model.error_curve(test, 41)
    assert [r.n for r in model.error_curve(test.limit(0), 2).collect()] == [0, 0]


def test_summaries_roll_up(spark, real):
    train, test, model = real
    more = test.unionByName(spark.createDataFrame([(987654, 1, 4.0)], "user long, item long, rating double"))
    ks = [5, 40]
    multi = model.predict_multi_k(more, ks)
    errors = [(r.user, k, None if r[f"prediction_{k}"] is None else abs(r.rating - r[f"prediction_{k}"])) for r in multi.collect() for k in ks]

    def want(found):
        found = [e for e in found if e is not None]
        n, mean = len(found), sum(found) / len(found) if found else None
        var = sum((e - mean) ** 2 for e in found) / n if found else None
        return n, mean, var, min(found, default=None), max(found, default=None)

    groups = {("user", u, k): [] for u, k, _ in errors} | {("k", None, k): [] for k in ks} | {("total", None, None): []}
    for u, k, e in errors:
        for key in (("user", u, k), ("k", None, k), ("total", None, None)):
            groups[key].append(e)
    found = {(r.level, r.user, r.k): r for r in error_summary(multi, ks).collect()}
    assert found.keys() == groups.keys() and found["user", 987654, 5].n == 0
    for key, errs in groups.items():
        n, mean, var, least, most = want(errs)
        r = found[key]
        assert (r.n, r.least, r.most) == (n, least, most)
        assert mean is None and r.average is None or abs(r.average - mean) < 1e-9 and abs(r.variance - var) < 1e-9 and abs(r.stddev**2 - var) < 1e-9
    # merged in any grouping, the same
    states = error_moments(multi, ks)
    halves = states.withColumn("half", F.col("user") % 2)
    again = merge_moments(merge_moments(halves, "half", "k"))
    a, b = moment_summary(again).first(), found["total", None, None]
    assert a.n == b.n and abs(a.average - b.average) < 1e-9 and abs(a.variance - b.variance) < 1e-9


@pytest.mark.parametrize("most_raters", [500, 5, 0])
def test_nested_lists_predict_the_same(spark, g1, real, most_raters):
    for test, model in ((g1[1], fit(g1[0], 5, 5)), real[1:]):
        want = predict(test, model.neighbours, model.deviations, model.means)
        found = predict_from_lists(test, neighbour_lists(model.neighbours), model.deviations, model.means, most_raters=most_raters)
        rows = lambda df: sorted((r.user, r.item, r.rating, round(r.prediction, 9)) for r in df.collect())
        assert rows(found) == rows(want)


def test_nested_lists_shuffle_no_neighbours(spark, real):
    """No row per neighbour: the joined rows are the test pairs."""
    _, test, model = real
    plan = predict_from_lists(test, neighbour_lists(model.neighbours), model.deviations, model.means)._jdf.queryExecution().optimizedPlan().toString()
    folded = plan.split("Union")[1].split("Aggregate [user")[0]
    assert "Generate" not in folded


def test_stored_model(spark, real):
    train, test, model = real
    path = scratch_folder(spark)
    save_model(model, path, buckets=4)
    loaded = load_model(spark, path)
    assert (loaded.k, loaded.n_users, loaded.lo, loaded.hi, loaded.written) == (40, 150, 1.0, 5.0, True)
    for name in ("means", "deviations", "profiles", "neighbours"):
        a, b = getattr(model, name), getattr(loaded, name)
        assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    rows = lambda df: sorted((r.user, r.item, r.rating, round(r.prediction, 9)) for r in df.collect())
    assert rows(loaded.predict(test)) == rows(model.predict(test))
    assert rows(loaded.predict(test, 10)) == rows(model.predict(test, 10))
    with pytest.raises(Exception, match="(?i)exist"):
        save_model(model, path)
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # off: the plan names the buckets that are read
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        found = neighbours_of(loaded, [7])
        assert {r["rank"] for r in found.collect()} == {r["rank"] for r in model.neighbours.where("user = 7").collect()}
        assert "SelectedBucketsCount: 1 out of 4" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)


def test_stored_model_joins_without_an_exchange(spark, real):
    """The model's side of a join on user is read in its buckets: no exchange."""
    model = real[2]
    path = scratch_folder(spark)
    save_model(model, path, buckets=4)
    loaded = load_model(spark, path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = loaded.neighbours.join(loaded.means, "user")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        pairs = spark.range(100).select(F.col("id").alias("user"), F.col("id").alias("item"))
        plan = pairs.join(loaded.neighbours, "user").join(loaded.means, "user")._jdf.queryExecution().executedPlan().toString()
        # the pairs alone are dealt by user
        assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2 and plan.count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_incomplete_model(spark):
    path = scratch_folder(spark)
    spark.createDataFrame([("means",)], "name string").write.json(path + "/manifest")
    with pytest.raises(ValueError, match="no complete model"):
        load_model(spark, path)


def test_lists_and_multi_k_agree(real):
    _, test, model = real
    multi = predict_multi_k(test, model.neighbours, model.deviations, model.means, [40])
    lists = predict_from_lists(test, neighbour_lists(model.neighbours), model.deviations, model.means)
    a = sorted((r.user, r.item, round(r.prediction_40, 9)) for r in multi.collect())
    assert a == sorted((r.user, r.item, round(r.prediction, 9)) for r in lists.collect())
