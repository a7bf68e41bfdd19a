"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app: str = "kinnear",
    driver_memory: str = "16g",
) -> SparkSession:
    """A local session for tests and the bench (cluster jobs bring their own)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_folder(named: str | None, master: str) -> str:
    """Where intermediate tables go: the folder the cluster names.

    Without one, a fresh scratch folder will do for a local master; elsewhere
    the executors could not see it, so that is an error.
    """
    if named:
        return named
    if not master.startswith("local[") and master != "local":
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="kinnear-", dir="/tmp")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, from ``spark.checkpoint.dir`` (see :func:`shared_folder`)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(shared_folder(named, sc.master))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A new path under the session's part of the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: ``df`` written as Parquet to the shared folder and read back.

    It survives the loss of executors and keeps column pruning and size
    statistics for the plans that read it.  :func:`release` removes it.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """:func:`materialize` in ``buckets`` by a column: joins and groups by it read the table as it lies, without an exchange.

    ``df`` should come partitioned by the column in as many parts, so that every bucket is one file.
    """
    spark, path = df.sparkSession, scratch_folder(df.sparkSession)
    made = f"kinnear_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(made)
    return spark.table(made)


def small_batches(df: DataFrame, most: int) -> DataFrame:
    """``df``; the session's limit on the bytes of an Arrow batch is lowered to ``most`` if it is higher."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(conf.get(name)).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= most:
        conf.set(name, str(most))
    return df


def release(spark: SparkSession) -> int:
    """Removes the intermediate tables this session has written so far; returns how many.

    Call it when the results that read them have been written or collected.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        return 0
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(top) if s.getPath().getName().startswith("stage-")] if fs.exists(top) else []
    for path in found:
        fs.delete(path, True)
    return len(found)
