"""Importance resampling of documents towards a target distribution.

Documents and target texts are bags of hashed word n-grams.  A bucket's gain
is the logarithm of its frequency in the target over that in the documents,
and a document's weight its mean gain; with Gumbel noise on the weights, the
highest scores are a draw without replacement in proportion to the weights.

Words come from bytes: one 256-byte table lower-cases and blanks the
separators, ``bytes.split`` finds the words, the crc32 of a word seeds that of
the n-gram it starts, and Counters reduce the n-grams of a text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinnear.llm.tables import small_batches, stage

#: Production parameters: buckets, longest n-gram, seed of the noise, least words, share drawn in percent.
BUCKETS, WORDS, SEED, LEAST_WORDS, PERCENT = 10_000, 2, 7, 20, 25
#: Bytes of a text split at a time; a longer word is taken whole.
PIECE = 1 << 20

#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` with A-Z lower-cased; everything else is a blank.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def ngram_counts(text: bytes, n: int) -> Iterator[tuple[int, Counter]]:
    """(new words, crc32 -> count of the runs of 1 to ``n`` words that end in them), piece by piece of a text."""
    blanked, at, tail = text.translate(TABLE), 0, []
    while at < len(blanked):
        end = blanked.find(b" ", at + PIECE)
        end = len(blanked) if end < 0 else end
        words = tail + blanked[at:end].split()
        at, old = end, len(tail)
        grams, spaced = list(map(crc32, words)), [b" " + w for w in words]
        counts = Counter(grams[old:])
        for more in range(1, n):
            grams = list(map(crc32, spaced[more:], grams))  # each run's crc32 seeds that of the run one word longer
            counts.update(grams[max(0, old - more):])
        yield len(words) - old, counts
        tail = words[len(words) - n + 1:] if n > 1 else []


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """UTF-8 bytes of the texts, nulls as empty ones, without decoding them."""
    for value in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()):
        yield value.as_py() or b""


def _folded(counts: Counter, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the Counter's n-grams; a bucket can come up more than once."""
    n = len(counts)
    return np.fromiter(counts.keys(), np.int64, n) % buckets, np.fromiter(counts.values(), np.int64, n)


def bucket_totals(docs: DataFrame, buckets: int = BUCKETS, n: int = WORDS) -> DataFrame:
    """(bucket, n): n-grams of all rows of ``docs(text)`` by bucket.

    Each task sends one sum a bucket; null and empty texts have none, no rows: none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch, "text"):
                for _, counts in ngram_counts(text, n):
                    which, times = _folded(counts, buckets)
                    np.add.at(total, which, times)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    parts = small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, n: int = WORDS) -> list[int]:
    """The gain of every bucket in thousandths, by add-one smoothed frequencies; at most ``buckets`` rows reach the driver."""
    tables = []
    for rows in (docs, target):
        counts = dict(bucket_totals(rows, buckets, n).collect())
        tables.append((counts, sum(counts.values())))
    (s, all_s), (t, all_t) = tables
    return [
        math.floor(1000 * math.log(float(t.get(b, 0) + 1) * float(all_s + buckets) / (float(s.get(b, 0) + 1) * float(all_t + buckets))))
        for b in range(buckets)]


def weights(docs: DataFrame, gains: list[int], n: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of every row's n-grams, 0 without any."""
    table = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch, "text"):
                words = features = total = 0
                for new, counts in ngram_counts(text, n):
                    which, times = _folded(counts, len(table))
                    words, features, total = words + new, features + int(times.sum()), total + int(table[which] @ times)
                rows.append((words, features, total // features if features else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the SHA-256 of ``seed:doc_id`` (a null id: nothing after the colon)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored(doc_id, n_words, score, ..)`` with ``rank``: 1, 2, .. by score, then smaller doc_id, null for rows not drawn.

    Of the N rows with ``least_words`` words, ``percent * N // 100`` are drawn.
    Scores are whole thousandths of logarithms of counts, so there are some
    hundred thousand distinct ones at any number of rows: a count by score
    tells every score's first rank and which scores are drawn, and only those
    rows are numbered, score by score.  Null ids come after the others; equal
    (score, doc_id) are numbered in any order.
    """
    able = F.col("n_words") >= least_words
    counts = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("c"))
    higher = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = counts.select(
        "score", F.coalesce(F.sum("c").over(higher), F.lit(0)).alias("before"),
        F.floor(F.sum("c").over(Window.partitionBy()) * percent / 100).alias("quota")).where(F.col("before") < F.col("quota"))
    drawn = scored.join(F.broadcast(steps), "score", "left").withColumn("in", able & F.col("before").isNotNull())
    number = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    first = drawn.where("in").withColumn("rank", F.col("before") + number)
    first = first.withColumn("rank", F.when(F.col("rank") <= F.col("quota"), F.col("rank")))
    rest = drawn.where(~F.col("in")).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).select(*scored.columns, F.col("rank").cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, n: int = WORDS, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs``.

    Null and empty texts have no words and weight 0; repeated rows each get
    their row and count each; a null doc_id is kept.  An empty target or no
    documents: gains by the smoothing alone.  Texts are handled in pieces, so
    memory is a text and its pieces' counts.  Other columns are not read.
    """
    gains = bucket_gains(docs, target, buckets, n)
    scored = weights(docs, gains, n).withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long"))
    return ranked(stage(scored), percent, least_words)


def resampled_documents(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`resample` draws; rows with a drawn id that repeat stay together.

    Rows with a null id are never drawn.
    """
    drawn = resample(docs, target, **parameters).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, F.col("doc_id").cast("long") == F.col("_drawn"), "left_semi")
