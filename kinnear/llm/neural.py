"""A log-bilinear language model trained by noise-contrastive estimation in numpy.

Units.  The OUTPUTS most frequent training tokens are units of their own; any
other word belongs to one of CLASSES classes by its last bytes and is
predicted as class, then word by its count within the class.  The context is
the word before (CONTEXT frequent words, other words by class) and the one
before that (FAR frequent words or none of them).

Model.  score(u | c, f) = (near[c] + far[f]) . out[u] + bias[u].  Training is
noise-contrastive: each task runs over its documents and tells true units from
shared noise draws, which needs no normaliser; the tasks' parameters are then
averaged, weighted by their tokens, in a shuffle.  Every training token is
seen once, in ROUNDS rounds over disjoint documents that go on from the
average.  Scoring normalises exactly: one batched product of all contexts with
all units gives the log of the normaliser of every (c, f).

Counts of all distinct tokens stay distributed.  Only the HEAD most frequent
tokens go to the tasks with their counts; the other tokens of a document are
joined with their counts in a shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import id_fold, small_batches, stage, sum_vectors
from kinnear.llm.words import chunks

#: The fold that is never trained on.
HELD_OUT = 1
OUTPUTS, CLASSES, CONTEXT, FAR, HEAD = 3000, 64, 1000, 63, 65_536
SIZE, NOISE, BATCH, RATE, ROUNDS, SEED = 24, 24, 4096, 0.15, 2, 5
#: The token that ends a document; no word holds a blank.
END = b" "
#: Parameter rows sent together.
BLOCK = 64


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of a text and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["token", "c"])

    for batch in batches:
        for text in batch.column(0):
            counts.update(tokens(text.as_py()))
            if len(counts) > 300_000:  # bounds the task's memory; the shuffle adds up
                yield flush()
                counts.clear()
    if counts:
        yield flush()


def token_counts(docs: DataFrame) -> DataFrame:
    """(token binary, c): how often each token occurs in all rows of ``docs``."""
    return small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "token binary, c long").groupBy("token").agg(
        F.sum("c").alias("c"))


@dataclass
class Units:
    """The frequent tokens and what counting says about the others."""

    total: int  # N: training tokens
    distinct: int  # V: distinct training tokens
    head: dict[bytes, int]  # rank of the most frequent tokens
    counts: np.ndarray  # their counts, by rank
    class_mass: np.ndarray  # per class: sum of c + 0.5 over its training words, 0.5 more for the unseen
    classes: np.ndarray = field(init=False)  # the class of every unit
    head_units: np.ndarray = field(init=False)  # the unit of every rank
    noise: np.ndarray = field(init=False)  # unit probabilities

    def __post_init__(self) -> None:
        own = np.array(list(map(class_of, self.head)), np.int64)
        self.classes = np.concatenate([own[:self.outputs], np.arange(CLASSES)])
        self.head_units = np.where(np.arange(len(own)) < self.outputs, np.arange(len(own)), self.outputs + own)
        self.noise = np.full(len(self.classes), 1 / len(self.classes))

    @property
    def outputs(self) -> int:
        return min(OUTPUTS, len(self.head))

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(units, ranks) of the tokens; rank -1: not in the head."""
        rank = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, len(words))
        unit = np.append(self.head_units, 0)[rank]
        rare = np.flatnonzero(rank < 0)
        unit[rare] = [self.outputs + class_of(words[i]) for i in rare.tolist()]
        return unit, rank


def learn_units(counts: DataFrame) -> Units:
    """Totals, the head and the class sums of all counted tokens (sizes don't grow with the data).

    The head has HEAD tokens, or all if there are fewer: by count, of equal
    counts those with the smallest hash.
    """
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # whole sixteenths of powers of two from the top, then as many of the next one as there is room for
    step = F.floor(F.log2("c") * 16)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    least, cut, many = None, None, 0
    for r in steps:
        if many + r.n > HEAD:
            cut = r.step
            break
        least, many = r.step, many + r.n
    found = counts.where(step >= least).collect() if least is not None else []
    if cut is not None and many < HEAD:
        order = [F.desc("c"), F.xxhash64("token"), "token"]
        found += counts.where(step == cut).orderBy(*order).limit(HEAD - many).collect()
    head = sorted(((bytes(r.token), int(r.c)) for r in found), key=lambda x: (-x[1], x[0]))
    units = Units(int(sums.n), int(sums.v), {w: i for i, (w, _) in enumerate(head)},
                  np.array([c for _, c in head], float), np.full(CLASSES, 0.5))
    outputs = units.outputs
    own = {w for w, _ in head[:outputs]}

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros((CLASSES, 2))
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in own:
                    mass[class_of(word)] += (c + 0.5, c)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int64()), pa.array(mass[:, 0]), pa.array(mass[:, 1])], names=["k", "mass", "c"])

    seen = np.zeros(CLASSES)
    for r in counts.mapInArrow(by_class, "k long, mass double, c double").groupBy("k").agg(F.sum("mass").alias("mass"), F.sum("c").alias("c")).collect():
        units.class_mass[r.k] += r.mass
        seen[r.k] = r.c
    p = np.concatenate([[c for _, c in head[:outputs]], seen + 0.5])
    units.noise = p / p.sum()
    return units


@dataclass
class Parameters:
    near: np.ndarray
    far: np.ndarray
    out: np.ndarray  # the last column is the bias

    @classmethod
    def start(cls, units: Units) -> Parameters:
        rng = np.random.default_rng(SEED)
        n = units.outputs
        out = rng.normal(0, 0.1, (n + CLASSES, SIZE + 1))
        out[:, SIZE] = np.log(units.noise)
        return cls(rng.normal(0, 0.1, (min(CONTEXT, n) + CLASSES + 1, SIZE)), rng.normal(0, 0.1, (min(FAR, n) + 1, SIZE)), out)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.near, self.far, self.out)])

    def like(self, values: np.ndarray) -> Parameters:
        shapes, at = [], 0
        for x in (self.near, self.far, self.out):
            shapes.append(values[at:at + x.size].reshape(x.shape).copy())
            at += x.size
        return Parameters(*shapes)

    def log_normaliser(self) -> np.ndarray:
        """ln of the sum over all units of exp(score) for every (near, far) context."""
        w, bias = self.out[:, :SIZE].astype(np.float32), self.out[:, SIZE].astype(np.float32)
        a = self.near.astype(np.float32) @ w.T + bias
        b = self.far.astype(np.float32) @ w.T
        # exp(a + b) sums to a product of two matrices once both are scaled by their largest entries
        top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
        with np.errstate(divide="ignore"):
            z = np.log((np.exp(a - top_a).astype(np.float64) @ np.exp(b - top_b).astype(np.float64).T)) + top_a + top_b.T
        return z


def contexts(unit: np.ndarray, first: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """(near, far) context numbers of every token; ``first``: marks the documents' first tokens."""
    outputs = units.outputs
    n_near, n_far = min(CONTEXT, outputs), min(FAR, outputs)
    as_near = np.where(unit < n_near, unit, n_near + units.classes[unit])
    as_far = np.where(unit < n_far, unit, n_far)
    near = np.concatenate([[n_near + CLASSES], as_near[:-1]])
    near[first] = n_near + CLASSES  # nothing before
    far = np.concatenate([[n_far, n_far], as_far[:-2]])[:len(unit)]
    far[first] = n_far
    second = np.flatnonzero(first) + 1
    far[second[second < len(unit)]] = n_far
    return near, far


def _documents(texts: pa.Array, units: Units):
    """(words, unit, rank, lengths) of the texts of one chunk."""
    words: list[bytes] = []
    lengths = []
    for text in texts:
        found = tokens(text.as_py())
        lengths.append(len(found))
        words += found
    unit, rank = units.of(words)
    return words, unit, rank, np.array(lengths, np.int64)


def _marks(lengths: np.ndarray) -> np.ndarray:
    first = np.zeros(int(lengths.sum()), bool)
    first[np.cumsum(lengths)[:-1]] = True
    if len(first):
        first[0] = True
    return first


def _scatter(target: np.ndarray, rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sums of their values)."""
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    at = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    return sorted_rows[at], np.add.reduceat(values[order], at, axis=0)


class Trainer:
    """Noise-contrastive steps with per-row AdaGrad on float32 copies of the parameters."""

    def __init__(self, start: Parameters, noise: np.ndarray, seed: int):
        self.near, self.far = start.near.astype(np.float32), start.far.astype(np.float32)
        self.out = start.out.astype(np.float32)
        self.scale = [np.full(len(x), 1e-2, np.float32) for x in (self.near, self.far, self.out)]
        self.rng = np.random.default_rng(seed)
        self.cumulative = np.cumsum(noise)
        self.log_noise = np.log(noise * NOISE).astype(np.float32)

    def _move(self, which: int, rows: np.ndarray, gradient: np.ndarray) -> None:
        table, scale = (self.near, self.far, self.out)[which], self.scale[which]
        scale[rows] += np.mean(gradient**2, axis=1)
        table[rows] += (RATE / np.sqrt(scale[rows]))[:, None] * gradient

    def step(self, near: np.ndarray, far: np.ndarray, unit: np.ndarray) -> None:
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(self.cumulative) - 1)
        h = np.ones((len(unit), SIZE + 1), np.float32)
        h[:, :SIZE] = self.near[near] + self.far[far]
        true, wrong = self.out[unit], self.out[drawn]
        up = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", h, true) - self.log_noise[unit], -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-(h @ wrong.T - self.log_noise[drawn]), -30, 30)))
        n = np.float32(len(unit))
        gradient = (up[:, None] * true + down @ wrong)[:, :SIZE] / n
        rows, change = _scatter(self.out, unit, up[:, None] * h / n)
        self._move(2, rows, change)
        rows, change = _scatter(self.out, drawn, (down.T @ h) / n)
        self._move(2, rows, change)
        self._move(0, *_scatter(self.near, near, gradient))
        self._move(1, *_scatter(self.far, far, gradient))

    def learn(self, near: np.ndarray, far: np.ndarray, unit: np.ndarray) -> None:
        for i in range(0, len(unit), BATCH):
            self.step(near[i:i + BATCH], far[i:i + BATCH], unit[i:i + BATCH])

    def parameters(self) -> Parameters:
        return Parameters(*(x.astype(float) for x in (self.near, self.far, self.out)))


def _round(docs: DataFrame, units: Units, start: Parameters, turn: int) -> Parameters:
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, weight = Trainer(start, units.noise, SEED + turn), 0
        for batch in batches:
            for part in chunks(batch, "text"):
                _, unit, _, lengths = _documents(part.column(0), units)
                trainer.learn(*contexts(unit, _marks(lengths), units), unit)
                weight += len(unit)
        if weight:
            values = trainer.parameters().flat() * weight
            blocks = [np.append(values[i:i + BLOCK * SIZE], weight) for i in range(0, len(values), BLOCK * SIZE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.list_(pa.float64()))], names=["key", "vector"])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(train, "key long, vector array<double>")
    blocks = sum_vectors(parts).orderBy("key").collect()
    if not blocks:
        return start
    return start.like(np.concatenate([np.array(r.vector[:-1]) / r.vector[-1] for r in blocks]))


@dataclass
class LanguageModel:
    units: Units
    parameters: Parameters

    def scorer(self):
        """texts -> (n_tokens, head sums, tail words): all a text's score needs but the counts of its rarer words."""
        units, p = self.units, self.parameters
        z = p.log_normaliser()
        w, bias = p.out[:, :SIZE].astype(np.float32), p.out[:, SIZE]
        tables = (p.near.astype(np.float32) @ w.T + bias.astype(np.float32), p.far.astype(np.float32) @ w.T)
        log_count = np.append(np.log10(units.counts + 0.5), 0.0)  # the last: not in the head
        log_mass = np.log10(units.class_mass)
        outputs = units.outputs

        def run(texts: pa.Array):
            words, unit, rank, lengths = _documents(texts, units)
            near, far = contexts(unit, _marks(lengths), units)
            model = (tables[0][near, unit] + tables[1][far, unit] - z[near, far]) / np.log(10)
            # a word of a class is drawn within the class by its count
            within = unit >= outputs
            model = model + np.where(within, log_count[rank] - log_mass[np.where(within, unit - outputs, 0)], 0)
            base = log_count[rank]
            first = np.concatenate([[0], np.cumsum(lengths)])
            total = lambda x: np.add.reduceat(x, first[:-1]) if len(lengths) else np.zeros(0)
            rare = np.flatnonzero(rank < 0)
            doc = np.searchsorted(first, rare, "right") - 1
            return lengths, total(model), total(base), total((rank >= 0).astype(np.int64)), [words[i] for i in rare.tolist()], doc

        return run


def fit(docs: DataFrame, counts: DataFrame | None = None) -> LanguageModel:
    """Trains on every row of ``docs``: its tokens are counted, then each is learnt once."""
    units = learn_units(stage(token_counts(docs)) if counts is None else counts)
    parameters = Parameters.start(units)
    text = F.col("text").cast("string")
    for turn in range(ROUNDS):
        parameters = _round(docs.where(F.pmod(F.xxhash64(text), F.lit(ROUNDS)) == turn), units, parameters, turn)
    return LanguageModel(units, parameters)


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Learns from all rows outside the held-out fold (a null doc_id is in no
    fold and is learnt from).  Null and empty texts are the end token alone;
    repeated rows each count and each get their row.  Without training text
    both scores are those of the single unseen token.  Other columns are not read.
    """
    fold = F.coalesce(id_fold(F.col("doc_id").cast("long")) == HELD_OUT, F.lit(False))
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("held_out"), F.col("text").cast("string").alias("text"))
    seen = rows.where(~F.col("held_out"))
    counts = stage(token_counts(seen))
    model = fit(seen, counts)
    units = model.units

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = model.scorer()
        for batch in batches:
            for part in chunks(batch, "text"):
                n, own, base, known, rare, doc = run(part.column(2))
                tails = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32)), pa.array(rare, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(own, pa.float64()), pa.array(base, pa.float64()), pa.array(known, pa.int64()), tails],
                    names=["doc_id", "held_out", "n_tokens", "own", "base", "known", "rare"])

    scored = stage(rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, own double, base double, known long, rare array<binary>")
                   .withColumn("row", F.monotonically_increasing_id()))
    tail = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("n"))
    log_count = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    sums = tail.join(counts, "token", "left").groupBy(F.col("row").alias("tail_row")).agg(
        F.sum(F.col("n") * log_count).alias("rare_log"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"))
    log_total = float(np.log10(units.total + 0.5 * (units.distinct + 1)))
    extra = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(sums, F.col("row") == F.col("tail_row"), "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(units.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * log_total).alias("base_score"),
        (F.col("own") + extra).alias("score"),
    )
