"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinnear.session import materialize as stage  # noqa: F401
from kinnear.session import scratch_folder  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Texts go to the Python workers in Arrow batches of at most so many bytes.
BATCH_BYTES = 8 << 20


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; the session's limit on the bytes of an Arrow batch is lowered to BATCH_BYTES if it is higher."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(conf.get(name)).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return docs


def id_fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


#: Places in which a key's vectors are added up before they meet.
SALTS = 16


def sum_vectors(parts: DataFrame) -> DataFrame:
    """(key, vector): element-wise sums of ``parts(key long, vector array<double>)`` by key.

    Each task streams through its sorted rows and holds one vector at a time.
    A key has a row from every task that made ``parts``, so its rows are added
    up in SALTS places first.
    """

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, None
        for frame in frames:
            for k, v in zip(frame["key"].tolist(), frame["vector"]):
                if k == key:
                    total = total + v
                    continue
                if total is not None:
                    yield pd.DataFrame({"key": [key], "vector": [total]})
                key, total = k, np.asarray(v)
        if total is not None:
            yield pd.DataFrame({"key": [key], "vector": [total]})

    def summed(rows: DataFrame, *by: str) -> DataFrame:
        return rows.repartition(*by).sortWithinPartitions("key").select("key", "vector").mapInPandas(add, "key long, vector array<double>")

    return summed(summed(parts.withColumn("salt", F.spark_partition_id() % SALTS), "key", "salt"), "key")
