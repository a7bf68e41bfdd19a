"""Fitted models saved under a path and loaded again, in this session or another.

The model's tables are Parquet, bucketed and sorted by user, so a join on user
reads them as they lie: no exchange on the model's side, rows in order within a
bucket, and a lookup of some users reads their buckets only.  A manifest with the model's
figures and the tables' schemas is written last; a folder without one is not a
model.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinnear.plans.pipeline import Model

TABLES = ("means", "deviations", "profiles", "neighbours")
#: Rows of the largest table a bucket should hold, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 2_000_000, 8_192
_SORT = {"means": ["user"], "deviations": ["user", "item"], "profiles": ["user", "item"], "neighbours": ["user", "rank"]}


def save_model(model: Model, path: str, buckets: int | None = None) -> None:
    """Writes ``model`` under ``path``; an existing model there is an error.

    ``buckets``: by default one for some two million rows of the largest table.
    """
    spark = model.means.sparkSession
    tables = {name: getattr(model, name) for name in TABLES}
    if buckets is None:
        rows = max(tables[name].count() for name in ("deviations", "neighbours"))
        buckets = max(1, min(MOST_BUCKETS, -(-rows // BUCKET_ROWS)))
    for name, table in tables.items():
        made = f"kinnear_{uuid.uuid4().hex}"
        # hash-partitioned like the buckets, so that every bucket is one file of one task
        table.repartition(buckets, "user").write.bucketBy(buckets, "user").sortBy(*_SORT[name]).option(
            "path", f"{path}/{name}").format("parquet").saveAsTable(made)
        spark.sql(f"DROP TABLE {made}")  # the catalog's entry; the files are external and stay
    facts = [(name, _ddl(table), buckets, model.k, model.n_users, model.lo, model.hi) for name, table in tables.items()]
    spark.createDataFrame(facts, "name string, ddl string, buckets int, k long, n_users long, lo double, hi double").coalesce(1).write.json(
        f"{path}/manifest")


def _ddl(table: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)


def load_model(spark: SparkSession, path: str) -> Model:
    """The model under ``path``, its tables known to the catalog with their buckets."""
    facts = spark.read.schema("name string, ddl string, buckets int, k long, n_users long, lo double, hi double").json(f"{path}/manifest").collect()
    if {f.name for f in facts} != set(TABLES):
        raise ValueError(f"no complete model under {path}")
    tables = {}
    for f in facts:
        named = f"kinnear_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{f.name}"
        order = ", ".join(f"`{c}`" for c in _SORT[f.name])
        spark.sql(f"DROP TABLE IF EXISTS {named}")
        spark.sql(f"CREATE TABLE {named} ({f.ddl}) USING parquet CLUSTERED BY (`user`) SORTED BY ({order}) INTO {f.buckets} BUCKETS "
                  f"LOCATION '{path}/{f.name}'")
        tables[f.name] = spark.table(named)
    one = facts[0]
    return Model(**tables, k=one.k, n_users=one.n_users, lo=one.lo, hi=one.hi, written=True)


def neighbours_of(model: Model, users: list[int]) -> DataFrame:
    """The ranked neighbours of some users; of a loaded model only their buckets are read."""
    return model.neighbours.where(F.col("user").isin([int(u) for u in users]))
