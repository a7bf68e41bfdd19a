"""Streaming scoring equals batch prediction."""

import tempfile

import pytest

from conftest import SF_SMALL
from kinnear.plans.pipeline import fit
from kinnear.sources.ratings import train_test
from kinnear.streaming.scoring import read_pair_files, score_batches, score_stream


def test_lazy_model_is_refused(spark):
    _, train, _ = train_test(spark, SF_SMALL)
    with pytest.raises(ValueError, match="written model"):
        score_batches(fit(train, 5, materialize=False), "/unused")


def test_stream_scores_like_batch(spark):
    _, train, test = train_test(spark, SF_SMALL)
    model = fit(train, 20, materialize=True)
    scratch = tempfile.mkdtemp(prefix="kinnear-stream-", dir="/tmp")
    # the test pairs arrive as several files
    test.repartition(3).write.parquet(f"{scratch}/in")
    q = score_stream(
        read_pair_files(spark, f"{scratch}/in", max_files_per_trigger=1),
        model,
        f"{scratch}/out",
        f"{scratch}/ckpt",
    )
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(f"{scratch}/out")
    assert got.select("batch_id").distinct().count() >= 2
    cols = ["user", "item", "prediction"]
    want = model.predict(test).select(*cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))
