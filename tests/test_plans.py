"""Plan shape: no cartesian products, no row-at-a-time Python, pruning."""

import pytest

from conftest import SF_SMALL
from kinnear.operators.similarity import similarities
from kinnear.plans.queries import QUERIES, Tables
from kinnear.session import materialize, release, shared_folder
from kinnear.sources.ratings import holdout_split, order_lines, load_tables

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["predict", "mae_by_k", "knn_dense_rank", "holdout_split", "cold_start", "evaluate"])
def test_no_cartesian_and_no_row_udf(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in BAD:
        assert bad not in p, (name, bad)


def test_scan_prunes_columns(spark):
    lineitem, orders = load_tables(spark, SF_SMALL, "lineitem", "orders")
    p = _plan(order_lines(lineitem, orders))
    assert "l_extendedprice" not in p and "o_totalprice" not in p


def test_holdout_uses_group_limit(spark):
    t = Tables(spark, SF_SMALL)
    p = _plan(holdout_split(t.ratings.select("user", "item", "rating"), 2))
    assert "WindowGroupLimit" in p


def test_neighbours_use_group_limit(spark):
    """Top k by group limits on both sides of the shuffle."""
    p = _plan(Tables(spark, SF_SMALL).neighbours(10))
    assert p.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in p


def test_tiles_route_by_item(spark):
    """Cells reach the tiles by an equi-join with the blocks that hold their item."""
    t = Tables(spark, SF_SMALL)
    p = _plan(similarities(materialize(t.profiles), "tiles", block_users=40))
    assert "FlatMapGroupsInPandas" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_shared_folder_rule(spark):
    """A cluster must name a shared folder; local masters get a scratch one; a named folder is always taken."""
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(None, "spark://host:7077")
    with pytest.raises(ValueError):
        shared_folder("", "local-cluster[3,2,1000]")
    assert shared_folder("/shared/x", "yarn") == "/shared/x"
    assert shared_folder(None, "local[4]").startswith("/tmp/")


def test_intermediate_tables_are_removed(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5
    assert release(spark) >= 1 and release(spark) == 0


def test_ratings_are_dealt_by_user_once(spark, tmp_path):
    """Means, deviations, profiles and lists by user read the written ratings as they lie; rows as without."""
    from pyspark.sql import functions as F

    from kinnear.plans.queries import Tables

    lines = spark.range(900).select((F.col("id") % 200).alias("l_orderkey"), (F.col("id") * 7 % 31).alias("l_partkey"),
                                    (F.col("id") % 4).cast("int").alias("l_linenumber"), (1.0 + F.col("id") * 13 % 50).alias("l_quantity"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(200).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 9 > 0, F.col("id") % 23).alias("o_custkey")).write.parquet(
        f"{tmp_path}/orders.parquet")
    plain, dealt = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path), True)
    for name in ("ratings", "train", "test", "means", "deviations", "profiles"):
        a, b = (getattr(t, name) for t in (plain, dealt))
        some = lambda df: sorted(map(str, df.select(*sorted(df.columns), F.lit(0).alias("z")).collect()))
        assert some(a) == some(b) and b.columns == a.columns, name
        if name != "ratings":
            assert "Exchange" not in b._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", ""), name
    assert "Exchange" not in dealt.ratings.groupBy("user").count()._jdf.queryExecution().executedPlan().toString()
