"""Registered queries: one per operator, on ratings derived from the order
tables (``lineitem ⋈ orders``) under ``sf_dir``.

Output columns use short names (``u, i, v`` = user, item, neighbour) and
doubles rounded to 6 places, so that they compare with the SQL texts in
:mod:`kinnear.plans.oracle`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinnear.functions.expr import OUT_ROUND, out_round, scale
from kinnear.operators.evaluate import cell_errors, cold_start, error_stats_by_k, error_summary, mae, sparse_difference
from kinnear.operators.neighbours import explode_neighbours, knn, neighbour_lists
from kinnear.operators.predict import error_curve, predict, predict_from_lists, predict_multi_k, weighted_deviation
from kinnear.operators.profile import (
    item_mean,
    normalized_deviation,
    unit_profile,
    user_mean,
    user_norm,
)
from kinnear.operators.similarity import similarity_join, similarity_of_users, similarity_one_user, similarity_pairs
from kinnear.plans.pipeline import evaluate as evaluate_job
from kinnear.plans.pipeline import fit
from kinnear.plans.store import load_model, save_model
from kinnear.session import materialize, materialize_by, scratch_folder
from kinnear.sources.ratings import (
    TASK_ROWS,
    by_flag,
    coalesce_duplicates,
    dealt,
    duplicate_stats,
    early_split,
    holdout_split,
    load_tables,
    nation_ratings,
    order_lines,
    order_ratings,
    parse_lines,
    read_ratings,
    read_ratings_counted,
    read_ratings_csv,
    read_split,
    write_split,
)
from kinnear.sources.report import nest_report

# Fixed query parameters (the same values appear in the SQL texts).
K_MAIN = 30
KS = (30, 100, 200)
K_DENSE = 1400
HOLDOUT_N = 2
# nations as users: 25 whatever the scale, so negatives rank in at every scale
K_NATION = 20
KS_NATION = (5, 15, 25)
EARLY_DAYS = 365
# the whole curve: every k up to this
K_CURVE = 100
# users looked up at once
LOOKUPS = 1000
# raters of an item that stay together in the chunked join of 25 nations
CHUNK_NATION = 5


def _r(x: str) -> F.Column:
    return out_round(F.col(x))


class Tables:
    """The chain of tables every query starts from (lazily built).

    ``materialize_ratings=True`` (queries that build neighbours) writes the
    derived ratings once: they feed the user count, the profiles and the
    test side, which would otherwise each repeat the order-table join.  They
    are dealt by user once, and what is grouped or joined by user after that
    is not shuffled again.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize_ratings: bool = False):
        lineitem, orders = load_tables(spark, sf_dir, "lineitem", "orders")
        self.spark = spark
        self.lines = order_lines(lineitem, orders)
        self.ratings = order_ratings(lineitem, orders)
        if materialize_ratings:
            parts = max(spark.sparkContext.defaultParallelism, math.ceil(lineitem.count() / TASK_ROWS))
            self.ratings = materialize_by(order_ratings(lineitem, orders, parts), "user", parts)
        self.train, self.test = by_flag(self.ratings)
        self.means = user_mean(self.train)
        self.deviations = normalized_deviation(self.train, self.means)
        if materialize_ratings:  # the profiles and both sides of a prediction read them
            self.deviations = materialize_by(self.deviations, "user", parts)
        self.profiles = unit_profile(self.deviations)
        self._n_users = None

    def n_users(self) -> int:
        """Dimension of the rating matrix: users seen in train or test."""
        if self._n_users is None:
            self._n_users = self.ratings.select("user").distinct().count()
        return self._n_users

    def neighbours(self, k: int) -> DataFrame:
        # knn writes the profiles it reads from several branches
        return knn(self.profiles, k, self.n_users())


def _nt(spark, sf_dir) -> Tables:
    """Tables for the queries that build neighbours."""
    return Tables(spark, sf_dir, materialize_ratings=True)


def _out_nbrs(n: DataFrame) -> DataFrame:
    return n.select(
        F.col("user").alias("u"), F.col("neighbour").alias("v"), _r("sim").alias("sim"), F.col("rank").cast("long").alias("rank")
    )


# --------------------------------------------------------------------------
# A: sources
# --------------------------------------------------------------------------


def q_ratings_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.ratings.select(
        F.col("user").alias("u"), F.col("item").alias("i"), "rating",
        F.col("is_test").cast("long").alias("is_test"),
    )


def q_parse_fields(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # each rating rendered as a text line with padded fields and an extra
    # trailing field, then parsed back with the regex separator "::"
    lines = t.ratings.select(
        F.concat(
            F.col("user").cast("string"), F.lit("::"),
            F.col("item").cast("string"), F.lit(" ::"),
            F.col("rating").cast("string"), F.lit("::"),
            F.col("is_test").cast("string"),
        ).alias("value")
    )
    p = parse_lines(lines, sep="::")
    return p.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating")


def q_ratings_text(spark, sf_dir):
    """The ratings written as delimited text to the shared folder and read back."""
    t = Tables(spark, sf_dir)
    folder = scratch_folder(spark)
    fields = [F.col(c).cast("string") for c in ("user", "item", "rating", "is_test")]
    t.ratings.select(F.concat_ws("::", *fields).alias("value")).write.text(folder)
    return read_ratings(spark, folder, sep="::").select(F.col("user").alias("u"), F.col("item").alias("i"), "rating")


def q_ratings_csv(spark, sf_dir):
    """The ratings as padded lines with an extra field, written and read back by the CSV source."""
    t = Tables(spark, sf_dir)
    folder = scratch_folder(spark)
    text = lambda c: F.col(c).cast("string")
    line = F.concat(text("user"), F.lit("::"), text("item"), F.lit(" ::"), text("rating"), F.lit(":: "), text("is_test"))
    t.ratings.select(line.alias("value")).write.text(folder)
    return read_ratings_csv(spark, folder, sep="::").select(F.col("user").alias("u"), F.col("item").alias("i"), "rating")


def q_ratings_rejects(spark, sf_dir):
    """Lines of which those of every seventh user are malformed: the ratings and the number of rejects, from one reading pass."""
    t = Tables(spark, sf_dir)
    folder = scratch_folder(spark)
    item = F.when(F.col("user") % 7 == 0, F.lit("x")).otherwise(F.col("item").cast("string"))
    t.ratings.select(F.concat_ws("::", F.col("user").cast("string"), item, F.col("rating").cast("string")).alias("value")).write.text(folder)
    ratings, seen = read_ratings_counted(spark, folder, sep="::")
    ratings = materialize(ratings)
    return ratings.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating", F.lit(int(seen.get["rejected"])).cast("long").alias("rejected"))


def q_split_files(spark, sf_dir):
    """The ratings split into train and test files by their flag, each side read back."""
    folder = scratch_folder(spark)
    write_split(Tables(spark, sf_dir).ratings, folder)
    sides = [read_split(spark, folder, side).withColumn("side", F.lit(side)) for side in ("train", "test")]
    return sides[0].unionByName(sides[1]).select(F.col("user").alias("u"), F.col("item").alias("i"), "rating", "side")


def q_dedup_policies(spark, sf_dir):
    """Each duplicate policy on the order lines, whose (customer, part) pairs repeat."""
    sides = (t.select(*c) for t, c in zip(load_tables(spark, sf_dir, "lineitem", "orders"), (
        ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity"), ("o_orderkey", "o_custkey"))))
    lines = materialize(order_lines(*dealt([*sides], ["l_orderkey"], ["o_orderkey"])).select("user", "item", "rating"))
    (lines,) = dealt([lines], ["user", "item"])
    out = None
    for policy in ("sum", "max", "mean"):
        one = coalesce_duplicates(lines, policy).select(
            F.lit(policy).alias("policy"), F.col("user").alias("u"), F.col("item").alias("i"), _r("rating").alias("rating"))
        out = one if out is None else out.unionByName(one)
    return out


def q_sparse_difference(spark, sf_dir):
    """Best rating of the test lines minus best rating of the train lines, over the cells of either."""
    lines = Tables(spark, sf_dir).lines
    test, train = (coalesce_duplicates(x, "max") for x in (lines.where("is_test"), lines.where("not is_test")))
    return sparse_difference(test, train).select(F.col("user").alias("u"), F.col("item").alias("i"), _r("diff").alias("diff"))


def q_dedup_ratings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = duplicate_stats(t.lines)
    return d.select(
        F.col("user").alias("u"), F.col("item").alias("i"), "n", "r_sum", "r_max", _r("r_mean").alias("r_mean")
    )


def q_holdout_split(spark, sf_dir):
    t = Tables(spark, sf_dir)
    h = holdout_split(t.ratings.select("user", "item", "rating"), n=HOLDOUT_N)
    return h.select(F.col("user").alias("u"), F.col("item").alias("i"), F.col("is_test").cast("long").alias("is_test"))


# --------------------------------------------------------------------------
# B: cell expressions and filters
# --------------------------------------------------------------------------


def q_positive_cells(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.test.where(F.col("rating") > 0).select(F.col("user").alias("u"), F.col("item").alias("i"), "rating")


def q_positive_deviations(spark, sf_dir):
    """The cell filter on signed values, where it does drop cells."""
    d = Tables(spark, sf_dir).deviations.where(F.col("dev") > 0)
    return d.select(F.col("user").alias("u"), F.col("item").alias("i"), _r("dev").alias("dev"))


def q_item_slice(spark, sf_dir):
    t = Tables(spark, sf_dir)
    top = (
        t.train.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("item").asc()).limit(1).select("item")
    )
    s = t.deviations.join(F.broadcast(top), "item")
    return s.select(F.col("user").alias("u"), _r("dev").alias("dev"))


def q_scale_expr(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.train.join(t.means, "user")
    return j.select(
        F.col("user").alias("u"), F.col("item").alias("i"),
        out_round(scale("rating", "mean")).alias("scale"),
    )


def q_normalized_deviation(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.deviations.select(F.col("user").alias("u"), F.col("item").alias("i"), _r("dev").alias("dev"))


def q_unit_profile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.profiles.select(F.col("user").alias("u"), F.col("item").alias("i"), _r("weight").alias("weight"))


# --------------------------------------------------------------------------
# D: aggregates
# --------------------------------------------------------------------------


def q_user_mean(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.means.select(F.col("user").alias("u"), _r("mean").alias("mean"))


def q_item_mean(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return item_mean(t.train).select(F.col("item").alias("i"), _r("mean").alias("mean"))


def q_user_norm(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return user_norm(t.deviations).select(F.col("user").alias("u"), _r("norm").alias("norm"))


# --------------------------------------------------------------------------
# F1 / F2 / E: similarities and neighbours
# --------------------------------------------------------------------------


def q_similarity_pairs(spark, sf_dir):
    t = _nt(spark, sf_dir)
    s = similarity_pairs(materialize(t.profiles))
    return s.select(F.col("user").alias("u"), F.col("neighbour").alias("v"), _r("sim").alias("sim"))


def q_similarity_one_user(spark, sf_dir):
    t = Tables(spark, sf_dir)
    top = (
        t.profiles.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("user").asc()).limit(1).select("user")
    )
    s = similarity_one_user(t.profiles, top).where(F.round("sim", 9) != 0)
    return s.select(F.col("neighbour").alias("v"), _r("sim").alias("sim"))


def q_similarity_many_users(spark, sf_dir):
    """The similarities of the users with the most cells, LOOKUPS of them, in one pass."""
    profiles = materialize(Tables(spark, sf_dir).profiles)
    top = profiles.groupBy("user").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("user").asc()).limit(LOOKUPS)
    s = similarity_of_users(profiles, top).where(F.round("sim", 9) != 0)
    return s.select(F.col("user").alias("u"), F.col("neighbour").alias("v"), _r("sim").alias("sim"))


def q_similarity_chunked(spark, sf_dir):
    """The join strategy on the nations' ratings, where every item is rated by most users, hot items in chunks."""
    r = materialize(nation_ratings(*load_tables(spark, sf_dir, "lineitem", "orders", "customer")))
    p = materialize(unit_profile(normalized_deviation(r, user_mean(r))))
    s = similarity_join(p, chunk_raters=CHUNK_NATION).where(F.round("sim", 9) != 0)
    return s.select(F.col("user").alias("u"), F.col("neighbour").alias("v"), _r("sim").alias("sim"))


def q_knn_pruned(spark, sf_dir):
    t = _nt(spark, sf_dir)
    return _out_nbrs(knn(t.profiles, K_MAIN, t.n_users(), strategy="pruned"))


def q_events_knn_pruned(spark, sf_dir):
    p, n = _event_profiles(spark, sf_dir)
    return _out_nbrs(knn(p, K_EVENTS, n, strategy="pruned"))


def q_knn_topk(spark, sf_dir):
    return _out_nbrs(_nt(spark, sf_dir).neighbours(K_MAIN))


def q_knn_dense_rank(spark, sf_dir):
    return _out_nbrs(_nt(spark, sf_dir).neighbours(K_DENSE))


def _nation_neighbours(spark, sf_dir, k: int) -> DataFrame:
    r = materialize(nation_ratings(*load_tables(spark, sf_dir, "lineitem", "orders", "customer")))
    return knn(unit_profile(normalized_deviation(r, user_mean(r))), k, r.select("user").distinct().count())


def q_knn_dense_nation(spark, sf_dir):
    return _out_nbrs(_nation_neighbours(spark, sf_dir, K_NATION))


def q_knn_multi_k_nation(spark, sf_dir):
    return _edges_by_k(_nation_neighbours(spark, sf_dir, max(KS_NATION)), KS_NATION)


def q_knn_multi_k(spark, sf_dir):
    return _edges_by_k(_nt(spark, sf_dir).neighbours(max(KS)), KS)


def _edges_by_k(n: DataFrame, ks) -> DataFrame:
    aggs = []
    for k in ks:
        inside = F.col("rank") <= k
        aggs += [
            F.count(F.when(inside, 1)).alias(f"e_{k}"),
            F.count(F.when(inside & (F.round("sim", 9) < 0), 1)).alias(f"ne_{k}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(k).cast("long").alias("k"),
                F.col(f"e_{k}").alias("edges"),
                F.col(f"ne_{k}").alias("negative_edges"),
            )
            for k in ks
        ]
    )
    return n.agg(*aggs).select(F.inline(rows))


def q_neighbour_lists(spark, sf_dir):
    n = _nt(spark, sf_dir).neighbours(K_MAIN)
    lists = neighbour_lists(n)
    return lists.select(F.col("user").alias("u"), "neighbours")


def q_neighbour_lists_text(spark, sf_dir):
    """The ordered lists as text, which compares with SQL."""
    lists = neighbour_lists(_nt(spark, sf_dir).neighbours(K_MAIN))
    ids = F.transform("neighbours", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["neighbour"].cast("string")))
    return lists.select(F.col("user").alias("u"), F.array_join(ids, ",").alias("neighbours"))


def q_neighbour_explode(spark, sf_dir):
    n = _nt(spark, sf_dir).neighbours(K_MAIN)
    return _out_nbrs(explode_neighbours(neighbour_lists(n)))


# --------------------------------------------------------------------------
# D5 / F4 / F5 / F6: prediction and evaluation
# --------------------------------------------------------------------------


def _predictions(t: Tables, k: int) -> DataFrame:
    return predict(t.test, t.neighbours(k), t.deviations, t.means, k=k)


def q_weighted_deviation(spark, sf_dir):
    t = _nt(spark, sf_dir)
    w = weighted_deviation(t.test, t.neighbours(K_MAIN), t.deviations, t.means, K_MAIN)
    return w.select(F.col("user").alias("u"), F.col("item").alias("i"), _r("wdev").alias("wdev"))


def q_predict(spark, sf_dir):
    t = _nt(spark, sf_dir)
    p = _predictions(t, K_MAIN)
    return p.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating", _r("prediction").alias("prediction"))


def q_cell_errors(spark, sf_dir):
    t = _nt(spark, sf_dir)
    e = cell_errors(_predictions(t, K_MAIN))
    return e.select(F.col("user").alias("u"), F.col("item").alias("i"), _r("abs_error").alias("abs_error"))


def q_mae(spark, sf_dir):
    t = _nt(spark, sf_dir)
    return mae(_predictions(t, K_MAIN)).select(_r("mae").alias("mae"), "n")


def _stats(spark, sf_dir) -> DataFrame:
    t = _nt(spark, sf_dir)
    multi = predict_multi_k(t.test, t.neighbours(max(KS)), t.deviations, t.means, KS)
    return error_stats_by_k(multi, KS)


def q_mae_by_k(spark, sf_dir):
    return _stats(spark, sf_dir).select("k", _r("mae").alias("mae"), "n")


def q_mae_curve(spark, sf_dir):
    """The errors for every k up to K_CURVE from one ranking."""
    t = _nt(spark, sf_dir)
    curve = error_curve(t.test, t.neighbours(K_CURVE), t.deviations, t.means, K_CURVE)
    return curve.select("k", "n", _r("mae").alias("mae"), _r("rmse").alias("rmse"))


def q_error_summary(spark, sf_dir):
    """Error summaries by user and k, by k and in all, from one set of states."""
    t = _nt(spark, sf_dir)
    multi = predict_multi_k(t.test, t.neighbours(max(KS)), t.deviations, t.means, KS)
    return error_summary(multi, KS).select(
        "level", F.coalesce("user", F.lit(-1)).cast("long").alias("u"), F.coalesce("k", F.lit(-1)).cast("long").alias("k"), "n",
        # nudged: summaries of few errors lie exactly between two rounded values
        *[out_round(F.col(c) + F.lit(1e-10)).alias(c) for c in ("average", "variance", "stddev", "least", "most")])


def q_predict_lists(spark, sf_dir):
    """Predictions from nested neighbour lists, without a row per neighbour."""
    t = _nt(spark, sf_dir)
    p = predict_from_lists(t.test, neighbour_lists(t.neighbours(K_MAIN)), t.deviations, t.means)
    return p.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating", _r("prediction").alias("prediction"))


def q_stored_model(spark, sf_dir):
    """A model fitted, saved, loaded and asked for predictions."""
    t = _nt(spark, sf_dir)
    folder = scratch_folder(spark)
    save_model(fit(t.train, K_MAIN, t.n_users(), duplicates=None), folder)
    p = load_model(spark, folder).predict(t.test)
    return p.select(F.col("user").alias("u"), F.col("item").alias("i"), "rating", _r("prediction").alias("prediction"))


def q_summary_stats(spark, sf_dir):
    s = _stats(spark, sf_dir)
    return s.select(
        "k", _r("min_e").alias("min_e"), _r("max_e").alias("max_e"), _r("mae").alias("avg_e"),
        _r("var_e").alias("var_e"), _r("std_e").alias("std_e"),
    )


def q_cold_start(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cold_start(t.train, t.test)


def q_cold_start_early(spark, sf_dir):
    """Train: the first year's order lines; test: the later ones, with many unseen users and items."""
    return cold_start(*early_split(*load_tables(spark, sf_dir, "lineitem", "orders"), EARLY_DAYS))


def q_report_nested(spark, sf_dir):
    """The nested report of the sink; its metrics as text in millionths, which compares with SQL."""
    report = nest_report(q_metrics_report(spark, sf_dir))
    entries = F.transform(F.map_entries("metrics"), lambda e: F.concat(
        e["key"], F.lit("="), F.round(e["value"] * 1000000).cast("long").cast("string")))
    return report.select("section", F.array_join(entries, ",").alias("metrics"))


def q_metrics_report(spark, sf_dir):
    s = _stats(spark, sf_dir)
    names = [("average", "mae"), ("min", "min_e"), ("max", "max_e"), ("variance", "var_e"), ("stddev", "std_e")]
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), out_round(F.col(c)).alias("value"))
            for m, c in names
        ]
    )
    return s.select(
        F.concat(F.lit("abs_error k="), F.col("k").cast("string")).alias("section"), F.inline(rows)
    )


def q_evaluate(spark, sf_dir):
    t = _nt(spark, sf_dir)
    m = evaluate_job(t.train, t.test, KS, n_users=t.n_users(), duplicates=None)  # one row a cell already
    return m.select("section", "metric", out_round(F.col("value")).alias("value"))


K_EVENTS = 10


def _event_profiles(spark, sf_dir) -> tuple[DataFrame, int]:
    """Profiles and number of users of the ``events`` table read as ratings
    (user × event type, average value): a dense matrix in which every item is
    rated by nearly every user.  The rating scale ``lo``/``hi`` is taken from
    the data."""
    (events,) = load_tables(spark, sf_dir, "events")
    r = events.groupBy("user_id", "event_type").agg(F.avg("value").alias("rating")).select(
        F.col("user_id").alias("user"), F.col("event_type").alias("item"), "rating"
    )
    r = materialize(r)
    b = r.agg(F.min("rating").alias("lo"), F.max("rating").alias("hi"), F.countDistinct("user").alias("n")).first()
    means = user_mean(r)
    return unit_profile(normalized_deviation(r, means, lo=b["lo"], hi=b["hi"])), int(b["n"])


def q_events_knn(spark, sf_dir):
    """The k-NN on the ``events`` table: the hot-item case for the similarity step."""
    p, n = _event_profiles(spark, sf_dir)
    return _out_nbrs(knn(p, K_EVENTS, n))


def q_embedding_knn(spark, sf_dir):
    """Cosine k-NN on the ``embeddings`` table: each vector's components are
    its cells (item = dimension), normalised to unit length by the same
    profile operator, then ranked by the same k-NN (no mean or scale step)."""
    (emb,) = load_tables(spark, sf_dir, "embeddings")
    cells = emb.select(F.col("vec_id").alias("user"), F.posexplode("embedding").alias("item", "dev")).select(
        "user", F.col("item").cast("long").alias("item"), F.col("dev").cast("double").alias("dev")
    )
    p = materialize(unit_profile(materialize(cells)))
    n_users = p.select("user").distinct().count()
    return _out_nbrs(knn(p, K_EVENTS, n_users, written=True))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_scan": q_ratings_scan,
    "parse_fields": q_parse_fields,
    "ratings_text": q_ratings_text,
    "dedup_ratings": q_dedup_ratings,
    "dedup_policies": q_dedup_policies,
    "sparse_difference": q_sparse_difference,
    "positive_deviations": q_positive_deviations,
    "cold_start_early": q_cold_start_early,
    "report_nested": q_report_nested,
    "knn_dense_nation": q_knn_dense_nation,
    "knn_multi_k_nation": q_knn_multi_k_nation,
    "neighbour_lists_text": q_neighbour_lists_text,
    "holdout_split": q_holdout_split,
    "positive_cells": q_positive_cells,
    "item_slice": q_item_slice,
    "scale_expr": q_scale_expr,
    "user_mean": q_user_mean,
    "item_mean": q_item_mean,
    "user_norm": q_user_norm,
    "normalized_deviation": q_normalized_deviation,
    "unit_profile": q_unit_profile,
    "similarity_pairs": q_similarity_pairs,
    "similarity_one_user": q_similarity_one_user,
    "knn_topk": q_knn_topk,
    "knn_dense_rank": q_knn_dense_rank,
    "knn_multi_k": q_knn_multi_k,
    "neighbour_lists": q_neighbour_lists,
    "neighbour_explode": q_neighbour_explode,
    "weighted_deviation": q_weighted_deviation,
    "predict": q_predict,
    "cell_errors": q_cell_errors,
    "mae": q_mae,
    "mae_by_k": q_mae_by_k,
    "cold_start": q_cold_start,
    "summary_stats": q_summary_stats,
    "metrics_report": q_metrics_report,
    "evaluate": q_evaluate,
    "events_knn": q_events_knn,
    "embedding_knn": q_embedding_knn,
    "knn_pruned": q_knn_pruned,
    "events_knn_pruned": q_events_knn_pruned,
    "similarity_chunked": q_similarity_chunked,
    "similarity_many_users": q_similarity_many_users,
    "mae_curve": q_mae_curve,
    "error_summary": q_error_summary,
    "predict_lists": q_predict_lists,
    "stored_model": q_stored_model,
    "ratings_csv": q_ratings_csv,
    "ratings_rejects": q_ratings_rejects,
    "split_files": q_split_files,
}
