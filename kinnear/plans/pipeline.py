"""Fit / predict / evaluate: the whole predictor as one chain of DataFrames.

``fit`` builds means, deviations, unit profiles and the ranked neighbour
table once and writes the tables that predictions read (means, deviations,
neighbours) to the shared folder, so that several predictions (one per k, or
repeated scoring) do not run the similarity step again, and a lost executor
only costs the tasks after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.functions.expr import RATING_HI, RATING_LO, rounded_sim
from kinnear.operators.evaluate import cold_start, error_stats_by_k
from kinnear.operators.neighbours import knn
from kinnear.operators.predict import error_curve, predict, predict_multi_k
from kinnear.operators.profile import normalized_deviation, unit_profile, user_mean
from kinnear.session import materialize as _written
from kinnear.sources.ratings import coalesce_duplicates


@dataclass
class Model:
    means: DataFrame
    deviations: DataFrame
    profiles: DataFrame
    neighbours: DataFrame
    k: int
    n_users: int
    lo: float = RATING_LO
    hi: float = RATING_HI
    written: bool = False

    def predict(self, test: DataFrame, k: int | None = None) -> DataFrame:
        n = self.neighbours
        if k is not None:
            if k > self.k:
                raise ValueError(f"model ranked for k={self.k}, asked for k={k}")
            n = n.where(F.col("rank") <= k)
        return predict(test, n, self.deviations, self.means, self.lo, self.hi, k or self.k)

    def predict_multi_k(self, test: DataFrame, ks: Sequence[int]) -> DataFrame:
        if max(ks) > self.k:
            raise ValueError(f"model ranked for k={self.k}, asked for k={max(ks)}")
        return predict_multi_k(test, self.neighbours, self.deviations, self.means, ks, self.lo, self.hi)

    def error_curve(self, test: DataFrame, k: int | None = None) -> DataFrame:
        """Errors for every k up to ``k`` (by default all that the model is ranked for)."""
        if (k or self.k) > self.k:
            raise ValueError(f"model ranked for k={self.k}, asked for k={k}")
        return error_curve(test, self.neighbours, self.deviations, self.means, k or self.k, self.lo, self.hi)


def fit(
    train: DataFrame,
    k: int,
    n_users: int | None = None,
    lo: float = RATING_LO,
    hi: float = RATING_HI,
    materialize: bool = True,
    strategy: str = "auto",
    duplicates: str | None = "error",
    **knn_options,
) -> Model:
    """Means → deviations → unit profiles → k-NN (ranked for ``k``).

    ``n_users``: dimension of the matrix; by default the users of ``train``.
    ``duplicates``: what to do with a repeated ``(user, item)`` (see
    ``coalesce_duplicates``); None for ratings that are unique by construction.
    """
    if duplicates is not None:
        train = coalesce_duplicates(train, duplicates)
    means = user_mean(train)
    if materialize:
        means = _written(means)
    deviations = normalized_deviation(train, means, lo, hi)
    if materialize:
        deviations = _written(deviations)
    profiles = _written(unit_profile(deviations))
    if n_users is None:
        n_users = means.count()
    neighbours = knn(profiles, k, n_users, strategy=strategy, written=True, **knn_options)
    if materialize:
        neighbours = _written(neighbours)
    return Model(means, deviations, profiles, neighbours, k, n_users, lo, hi, materialize)


def _rows(*triples) -> F.Column:
    """``inline`` argument: literal (section, metric) with a value column."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    (sec if isinstance(sec, F.Column) else F.lit(sec)).alias("section"),
                    F.lit(metric).alias("metric"),
                    val.cast("double").alias("value"),
                )
                for sec, metric, val in triples
            ]
        )
    )


def evaluate(
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int],
    n_users: int | None = None,
    lo: float = RATING_LO,
    hi: float = RATING_HI,
    materialize: bool = True,
    strategy: str = "auto",
    model: Model | None = None,
    duplicates: str | None = "error",
    **knn_options,
) -> DataFrame:
    """The whole job; returns metrics as ``section, metric, value`` rows.

    Sections: ``data`` (cell counts, users, cold-start cells) and one
    ``k=<k>`` section per k (MAE, predicted cells, edges, negative edges).
    One ranking at ``max(ks)`` serves every k; each summary is one global
    aggregate unpivoted with ``inline``.  The model tables are
    written by default because several outputs read them.
    """
    ks = sorted(set(int(k) for k in ks))
    if model is None:
        model = fit(train, max(ks), n_users, lo, hi, materialize, strategy, duplicates, **knn_options)
    stats = error_stats_by_k(model.predict_multi_k(test, ks), ks).select(
        F.concat(F.lit("k="), F.col("k").cast("string")).alias("section"), "mae", "n"
    )
    edge_aggs = []
    for k in ks:
        inside = F.col("rank") <= k
        edge_aggs += [
            F.count(F.when(inside, 1)).alias(f"e_{k}"),
            F.count(F.when(inside & (rounded_sim("sim") < 0), 1)).alias(f"ne_{k}"),
        ]
    edges = model.neighbours.agg(*edge_aggs)
    cold = cold_start(train, test)
    cells = (
        train.agg(F.count(F.lit(1)).alias("tr"))
        .select(_rows(("data", "train_cells", F.col("tr")), ("data", "users", F.lit(model.n_users))))
    )
    parts = [
        cells,
        test.agg(F.count(F.lit(1)).alias("x")).select(_rows(("data", "test_cells", F.col("x")))),
        cold.select(
            F.lit("data").alias("section"),
            F.concat(F.lit("cold_"), F.col("kind"), F.lit("s")).alias("metric"),
            F.col("n").cast("double").alias("value"),
        ),
        stats.select(_rows((F.col("section"), "mae", F.col("mae")), (F.col("section"), "predicted", F.col("n")))),
        edges.select(
            _rows(
                *[(f"k={k}", "edges", F.col(f"e_{k}")) for k in ks],
                *[(f"k={k}", "negative_edges", F.col(f"ne_{k}")) for k in ks],
            )
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
