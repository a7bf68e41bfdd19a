"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

1. Statistics of each text (lengths, character classes, repetition) are
   computed from its bytes in Arrow batches.
2. A seeded random projection followed by a cosine approximates a Gaussian
   kernel over the standardised statistics.
3. Every partition sums its normal equations; the sums are added by row of
   the matrix in a shuffle, and the (features + 1)-square system, whose size
   does not depend on the data, is solved once.
4. Raw scores of rows left out of step 3 are counted in fixed bins; pooling
   adjacent violators over these bins gives a monotone map to [0, 1].
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import id_fold, small_batches, stage, sum_vectors
from kinnear.llm.words import ALNUM, LOWER, NOT_SPACE, buffer_of, chunks, mix, span_hashes, spans, sums, text_column

#: Random Fourier features, ridge penalty a row, kernel width, seed, bins of the calibration.
FEATURES, RIDGE, WIDTH, SEED, BINS = 192, 1e-3, 4.0, 11, 400
#: Documents whose fold is HELD_OUT never teach; those of CALIBRATE only calibrate.
HELD_OUT, CALIBRATE = 0, 4
#: A document with at least this score is predicted good.
THRESHOLD = 0.3

_CLASSES = {
    "letters": [*range(97, 123), *range(128, 256)],
    "capitals": range(65, 91),
    "digits": range(48, 58),
    "blanks": [9, 11, 12, 13, 32],
    "lines": [10],
    "stops": [ord(c) for c in ".,;:?'\"()-"],
    "shouts": [ord("!")],
    "symbols": [ord(c) for c in "#*$%&|<>~^_=+{}[]\\/@`"],
}
N_STATS = len(_CLASSES) + 8


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeats(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document: how many of its keys occurred before in it."""
    order = np.sort(mix(keys + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & ~np.uint64(0xFFF) | (doc % 4096).astype(np.uint64))
    again = order[1:][order[1:] == order[:-1]]
    return np.bincount((again & np.uint64(0xFFF)).astype(np.int64), minlength=n)[:n].astype(float)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``N_STATS`` numbers a text (at most 4096 texts); an empty text has zeros."""
    data, offsets = buffer_of(texts)
    n, size = len(texts), np.diff(offsets).astype(float)
    columns = []
    for members in _CLASSES.values():
        table = np.zeros(256, np.int8)
        table[list(members)] = 1
        columns.append(_share(sums(table[data], offsets), size))
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    words = np.diff(first).astype(float)
    doc = np.repeat(np.arange(n), np.diff(first))
    lowered = LOWER[data]
    length = (ends - starts).astype(float)
    hashes = span_hashes(lowered, starts, ends)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    odd = np.zeros(len(hashes))
    if len(hashes):
        odd = (~ALNUM[lowered[ends - 1]] & ~np.isin(data[ends - 1], [46, 44])).astype(float)
    inside = doc[1:] == doc[:-1]  # a pair of words lies in one text
    two = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[inside]
    columns += [
        np.log1p(words),
        _share(sums(length, first), words),
        np.sqrt(np.maximum(_share(sums(length**2, first), words) - _share(sums(length, first), words) ** 2, 0)),
        _share(_repeats(hashes, doc, n), words),
        _share(_repeats(two, doc[:-1][inside], n), words),
        _share(sums(same, first), words),
        _share(sums(odd, first), words),
        np.log1p(_share(words, 1 + sums(data == 10, offsets))),
    ]
    return np.where(size[:, None] > 0, np.column_stack(columns), 0.0) if n else np.zeros((0, N_STATS))


def _statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch):
            rows = statistics(text_column(part, "text")).astype(np.float32)
            stats = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_STATS).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part.column(0), stats], names=["doc_id", "stats"])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in chunks(batch, "text"):
        for i in range(0, part.num_rows, 4096):
            yield part.slice(i, 4096)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<float>) per row; only doc_id and text are read."""
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _statistics_batches, "doc_id long, stats array<float>")


@dataclass
class QualityModel:
    """Everything a task needs to score a text: a few hundred kilobytes at most."""

    mean: np.ndarray
    deviation: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.deviation, -6, 6)
        waves = np.cos(z @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([np.ones(len(z)), waves])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0.0, 1.0)


def _matrix(stats: pd.Series) -> np.ndarray:
    return np.stack(stats.to_numpy()).astype(float) if len(stats) else np.zeros((0, N_STATS))


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing fit of least weighted squares (pooled adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Fits on all labelled rows outside the held-out fold.

    ``stats(doc_id, stats)``, ``labels(doc_id, quality)``.  Null ids, null
    labels and labels other than 0 and 1 teach nothing; a repeated row counts
    as often as it is there.  Without any label every score is 0.5.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    rows = stage(
        stats.join(marks.where("y in (0, 1)"), "doc_id")
        .withColumn("fold", id_fold(F.col("doc_id")))
        .where(F.col("fold") != HELD_OUT)
        .select("stats", "y", "fold")
    )
    moments = rows.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
        F.avg(F.col("x").cast("double")).alias("m"), F.stddev_pop(F.col("x").cast("double")).alias("s")).orderBy("i").collect()
    rng = np.random.default_rng(SEED)
    model = QualityModel(
        np.array([r.m for r in moments]) if moments else np.zeros(N_STATS),
        np.array([max(r.s, 1e-6) for r in moments]) if moments else np.ones(N_STATS),
        rng.normal(size=(N_STATS, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]),
    )
    if not moments:
        return model

    def normal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for frame in frames:
            x = model.features(_matrix(frame["stats"]))
            total += x.T @ np.column_stack([x, frame["y"].to_numpy()])
        yield pd.DataFrame({"key": range(FEATURES + 1), "vector": list(total)})

    parts = rows.where(F.col("fold") != CALIBRATE).mapInPandas(normal, "key long, vector array<double>")
    system = np.array([r.vector for r in sum_vectors(parts).orderBy("key").collect()])
    gram, target = system[:, :-1], system[:, -1]
    penalty = RIDGE * max(gram[0, 0], 1) * np.eye(FEATURES + 1)
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, target)

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = np.clip(model.raw(_matrix(frame["stats"])), -0.5, 1.5)
            yield pd.DataFrame({"bin": np.floor((raw + 0.5) / 2 * BINS).astype(int), "y": frame["y"].to_numpy()})

    bins = (
        rows.where(F.col("fold") == CALIBRATE).mapInPandas(binned, "bin long, y double")
        .groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    )
    if not bins:  # too few labels to leave a fold out: the raw score, clipped
        model.edges, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    n = np.array([float(b.n) for b in bins])
    middle = (np.array([b.bin for b in bins]) + 0.5) * 2 / BINS - 0.5
    prior = target[0] / max(gram[0, 0], 1)
    model.edges = middle
    level = isotonic(np.array([b.y for b in bins]), n)
    # a touch of the raw score keeps the order inside a level; the prior keeps levels off 0 and 1
    model.levels = 0.98 * level + 0.015 * np.clip(middle, 0, 1) + 0.005 * prior
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of ``stats(doc_id, stats)``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": model.score(_matrix(frame["stats"]))})

    return stats.mapInPandas(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts have all-zero statistics and are scored like any
    other; repeated rows each get their row; a null doc_id is not held out.
    """
    stats = stage(document_statistics(docs))
    return score(stats, fit(stats, labels)).select(
        "doc_id",
        F.coalesce(id_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold.

    The texts are read twice (once for the fit, once to filter), which needs
    no shuffle of texts.  Null and empty texts have a score like any other,
    repeated rows stay or go together, rows without an id are scored too; a
    table without labelled rows keeps what the untrained score reaches, and an
    empty one gives no rows.
    """
    model = fit(stage(document_statistics(docs)), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                yield part.filter(pa.array(model.score(statistics(text_column(part, "text"))) >= threshold))

    return small_batches(docs).mapInArrow(run, docs.schema)
