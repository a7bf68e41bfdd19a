"""Score a stream of (user, item[, rating]) pairs against a fitted model.

The model (means, deviations, ranked neighbours) is static; each
micro-batch of pairs is a static DataFrame inside ``foreachBatch``, so the
batch :func:`kinnear.operators.predict.predict` plan runs unchanged (joins
by user and by (neighbour, item), one grouped aggregate per pair) and no
streaming state is kept.  Every batch is written under its own
``batch_id=<n>`` folder with overwrite, so a batch replayed after a
failure (the checkpoint gives at-least-once delivery) replaces its own
output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinnear.plans.pipeline import Model

PAIRS_SCHEMA = "user long, item long, rating double"


def score_batches(model: Model, out_path: str, k: int | None = None):
    """The ``foreachBatch`` function writing predictions of each batch.

    The model's tables must be written ones: a lazy model would run the
    similarity step again for every batch.
    """
    if not model.written:
        raise ValueError("score with a written model: fit(..., materialize=True)")

    def run(batch: DataFrame, batch_id: int) -> None:
        pred = model.predict(batch, k)
        (
            pred.withColumn("batch_id", F.lit(int(batch_id)))
            .write.mode("overwrite")
            .parquet(f"{out_path}/batch_id={int(batch_id)}")
        )

    return run


def score_stream(
    pairs: DataFrame,
    model: Model,
    out_path: str,
    checkpoint_location: str,
    k: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the scoring query; ``pairs`` is a streaming DataFrame."""
    w = pairs.writeStream.foreachBatch(score_batches(model, out_path, k)).option(
        "checkpointLocation", checkpoint_location
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_pair_files(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream parquet files of pairs dropped into ``path``."""
    r = spark.readStream.schema(PAIRS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
