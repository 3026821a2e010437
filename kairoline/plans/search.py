"""Time-ordered cross-validation and parameter search.

The least-squares family is scored from normal-equation sums per segment: one pass over the data
serves every fold, every candidate and every penalty. Other models are fitted fold by fold on
Spark ML; independent fits are submitted side by side.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.operators import arima, arima_folds, gram, profile, split
from kairoline.operators.grid import with_nulls
from kairoline.plans.regressors import LINEAR, SERIES, build, mean_label, ranked_neighbours, scaled_solution, series_kind
from kairoline.plans.stages import PopulationScaler
from kairoline.session import settle

LEADERBOARD = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("cv_rmse", T.DoubleType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])


@dataclass
class Candidate:
    type: str
    params: dict[str, Any] = field(default_factory=dict)
    scaling: bool = False
    tuning_params: dict[str, list] = field(default_factory=dict)


@dataclass
class Evaluation:
    candidate: Candidate
    cv_rmse: float
    best_params: dict[str, Any] | None
    tried: list[tuple[dict[str, Any], float]]


@dataclass
class Folds:
    """A feature table with segments, and the sums of its linear family once they are needed."""

    rows: DataFrame
    features: Sequence[str]
    label: str
    k: int
    ids: Sequence[str] = ()
    preparation: Callable[[], list] | None = None  # stages refitted inside every fold
    fit_scope: str = "fold"
    series: Sequence[str] = ()
    time: str | None = None
    hours: float = 3
    _changes: dict[int, tuple[DataFrame, DataFrame]] = field(default_factory=dict)
    _prepared: dict[int, DataFrame] = field(default_factory=dict)
    _sums: list[tuple[gram.Gram, gram.Gram]] | None = None

    def prepared(self, f: int) -> DataFrame:
        """Rows of one fold after its preparation, ``_role`` 0 for training and 1 for test.

        Fitted once per fold and kept, so candidates and parameters do not repeat it.
        """
        if f not in self._prepared:
            train, test = split.fold_frames(self.rows, f)
            model = Pipeline(stages=self.preparation()).fit(train)
            both = model.transform(train).withColumn("_role", F.lit(0)).unionByName(
                model.transform(test).withColumn("_role", F.lit(1)))
            self._prepared[f] = both.persist()
        return self._prepared[f]

    def frames(self, f: int) -> tuple[DataFrame, DataFrame]:
        """(train, test) of one fold."""
        if self.preparation is None:
            return split.fold_frames(self.rows, f)
        both = self.prepared(f)
        return both.where("_role = 0"), both.where("_role = 1")

    @property
    def sums(self) -> list[tuple[gram.Gram, gram.Gram]]:
        """(train, test) sums of every fold."""
        if self._sums is None and self.preparation is None:
            parts = gram.accumulate_by(self.rows, self.features, self.label, "segment")
            train, self._sums = parts[0], []
            for f in range(self.k):
                self._sums.append((train, parts[f + 1]))
                train = train + parts[f + 1]
        elif self._sums is None:
            found = [gram.accumulate_by(self.prepared(f), self.features, self.label, "_role") for f in range(self.k)]
            self._sums = [(g[0], g[1]) for g in found]
        return self._sums

    def changes(self, order: int) -> tuple[DataFrame, DataFrame]:
        """Changes of the label along each series, and their sums per segment; taken once per order of differences."""
        if order not in self._changes:
            rows = self.rows.withColumn(self.label, F.col(self.label).cast("double"))
            found = settle(arima.lagged_changes(rows, self.series, self.time, self.label, self.hours, order, ["segment"]))
            self._changes[order] = found, settle(arima_folds.segment_sums(found, self.series, self.time, self.label))
        return self._changes[order]

    def release(self) -> None:
        for df in (self.rows, *self._prepared.values()):
            df.unpersist()
        self._prepared.clear()


def make_folds(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, k: int = 5,
               preparation: Callable[[], list] | None = None, fit_scope: str = "fold", series: Sequence[str] = (),
               time: str | None = None, hours: float = 3) -> Folds:
    """Number the rows in time order and cut them into segments.

    ``series``, ``time`` (the first of ``order`` if not given) and ``hours`` serve the series models.

    ``preparation`` builds the imputation stages. With ``fit_scope="fold"`` they learn from the
    training rows of each fold only, with ``"all"`` from the whole table.
    """
    if fit_scope not in ("fold", "all"):
        raise ValueError("fit_scope must be 'fold' or 'all'")
    placed = split.with_segments(df, order, k)
    if preparation is not None and fit_scope == "all":
        placed = Pipeline(stages=preparation()).fit(placed).transform(placed)
        preparation = None
    return Folds(placed.persist(), list(features), label, k, list(order), preparation, fit_scope, list(series),
                 time or order[0], hours)


def grid(params: dict[str, Sequence]) -> list[dict[str, Any]]:
    """Full product; names in alphabetical order, the last one varying fastest."""
    names = sorted(params)
    return [dict(zip(names, values)) for values in itertools.product(*[list(params[n]) for n in names])]


def sample_grid(params: dict[str, Sequence], n_iter: int = 30, seed: int = 42) -> list[dict[str, Any]]:
    """Distinct draws from the grid; the whole grid when it is not larger than ``n_iter``."""
    everything = grid(params)
    return everything if len(everything) <= n_iter else random.Random(seed).sample(everything, n_iter)


def _linear_fold_errors(folds: Folds, candidate: Candidate, params: dict) -> list[float]:
    last_train, last_test = folds.sums[-1]
    errors = []
    for train, test in folds.sums:
        basis = (train if folds.fit_scope == "fold" else last_train + last_test) if candidate.scaling else None
        fit = scaled_solution(candidate.type, params, train, basis)
        errors.append(math.sqrt(max(fit.sse(test), 0.0) / test.n))
    return errors


def _fitted_fold_error(folds: Folds, candidate: Candidate, params: dict, f: int, scaler=None) -> float:
    train, test = folds.frames(f)
    stages = build(candidate.type, params, folds.features, folds.label, folds.ids, folds.series, folds.time, folds.hours)
    if scaler is not None:
        train, test = scaler.transform(train), scaler.transform(test)
    elif candidate.scaling:
        stages.insert(0, PopulationScaler(inputCols=list(folds.features)))
    model = Pipeline(stages=stages).fit(train)
    return model.transform(test).agg(profile.rmse(folds.label, "prediction")).first()[0]


def fitted_fold_errors(folds: Folds, candidate: Candidate, params: dict, workers: int = 4) -> list[float]:
    """Fit and score every fold on Spark ML; independent fits run side by side."""
    scaler = None
    if candidate.scaling and folds.fit_scope == "all":
        scaler = PopulationScaler(inputCols=list(folds.features)).fit(folds.rows)
    if folds.preparation is not None:
        for f in range(folds.k):
            folds.prepared(f)
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(lambda f: _fitted_fold_error(folds, candidate, params, f, scaler), range(folds.k)))


def neighbour_fold_errors(folds: Folds, candidate: Candidate, points: Sequence[dict], workers: int = 4) -> list[list[float]]:
    """RMSE of every fold for each of several parameter sets, from one ranked-neighbour join per fold.

    The join is made for the largest number of neighbours; smaller ones and both weightings are read from it in one aggregate.
    """
    settings = [(int(p.get("n_neighbors", 5)), p.get("weights", "uniform")) for p in points]
    for p in points:
        build(candidate.type, p, folds.features, folds.label, folds.ids)  # refuses unknown parameters
    whole = PopulationScaler(inputCols=list(folds.features)).fit(folds.rows) if candidate.scaling and folds.fit_scope == "all" else None
    if folds.preparation is not None:
        for f in range(folds.k):
            folds.prepared(f)

    def fold(f: int) -> list[float]:
        train, test = folds.frames(f)
        if candidate.scaling:
            scaler = whole or PopulationScaler(inputCols=list(folds.features)).fit(train)
            train, test = scaler.transform(train), scaler.transform(test)
        near = ranked_neighbours(test, train.where(F.col(folds.label).isNotNull()), folds.ids, folds.features, folds.label,
                                 max(k for k, _ in settings))
        means = near.groupBy(*folds.ids).agg(*[mean_label(k, w).alias(f"_p{i}") for i, (k, w) in enumerate(settings)])
        both = with_nulls(test.select(*folds.ids, F.col(folds.label).alias("_truth")), means, list(folds.ids), how="left")
        return list(both.agg(*[profile.rmse("_truth", f"_p{i}").alias(f"_e{i}") for i in range(len(settings))]).first())

    with ThreadPoolExecutor(workers) as pool:
        by_fold = list(pool.map(fold, range(folds.k)))
    return [list(errors) for errors in zip(*by_fold, strict=True)]


def series_fold_errors(folds: Folds, candidate: Candidate, params: dict) -> list[float]:
    """All series and folds are fitted from the same sums, and all test rows are forecast in one job."""
    kind, order = series_kind(candidate.type, params)
    changes, sums = folds.changes(order)
    fits = arima_folds.fold_fits(changes, sums, kind, folds.series, folds.time, folds.k, folds.hours)
    found = {r["fold"]: r["rmse"] for r in arima_folds.fold_errors(
        changes, fits, kind, folds.series, folds.time, folds.label, folds.k, folds.hours, order).collect()}
    missing = [f for f in range(folds.k) if found.get(f) is None]
    if missing:
        raise ValueError(f"{candidate.type}: no test row of folds {missing} has a forecast")
    return [found[f] for f in range(folds.k)]


def fold_errors(folds: Folds, candidate: Candidate, params: dict | None = None) -> list[float]:
    """RMSE of every fold."""
    params = candidate.params if params is None else params
    if candidate.type in LINEAR:
        return _linear_fold_errors(folds, candidate, params)
    if candidate.type in SERIES:
        return series_fold_errors(folds, candidate, params)
    if candidate.type == "KNeighborsRegressor":
        return neighbour_fold_errors(folds, candidate, [params])[0]
    return fitted_fold_errors(folds, candidate, params)


def cv_rmse(folds: Folds, candidate: Candidate, params: dict | None = None) -> float:
    """Mean over folds of the RMSE of each fold."""
    errors = fold_errors(folds, candidate, params)
    return sum(errors) / len(errors)


def search(folds: Folds, candidate: Candidate, tuning: bool = True, search_type: str = "random",
           n_iter: int = 30, seed: int = 42) -> Evaluation:
    """Score a candidate, over its grid where tuning is on; the first of equal scores wins."""
    if not tuning or not candidate.tuning_params:
        score = cv_rmse(folds, candidate)
        return Evaluation(candidate, score, None, [(candidate.params, score)])
    if search_type == "grid":
        points = grid(candidate.tuning_params)
    elif search_type == "random":
        points = sample_grid(candidate.tuning_params, n_iter, seed)
    else:
        raise ValueError(f"unknown search type: {search_type}")
    if candidate.type == "KNeighborsRegressor":
        found = neighbour_fold_errors(folds, candidate, [{**candidate.params, **p} for p in points])
        tried = [(p, sum(errors) / len(errors)) for p, errors in zip(points, found, strict=True)]
    else:
        tried = [(p, cv_rmse(folds, candidate, {**candidate.params, **p})) for p in points]
    best, score = min(tried, key=lambda t: t[1])
    return Evaluation(candidate, score, best, tried)


def evaluate(folds: Folds, candidates: Sequence[Candidate], **options) -> list[Evaluation]:
    return [search(folds, c, **options) for c in candidates]


def _text(params: dict | None) -> dict[str, str] | None:
    return None if params is None else {k: str(v) for k, v in params.items()}


def leaderboard(spark: SparkSession, evaluations: Sequence[Evaluation]) -> DataFrame:
    """One row per candidate."""
    rows = [(i, e.candidate.type, float(e.cv_rmse), _text(e.best_params)) for i, e in enumerate(evaluations)]
    return spark.createDataFrame(rows, LEADERBOARD)


def trials(spark: SparkSession, evaluation: Evaluation) -> DataFrame:
    """One row per tried parameter set."""
    rows = [(i, evaluation.candidate.type, float(s), _text(p)) for i, (p, s) in enumerate(evaluation.tried)]
    return spark.createDataFrame(rows, LEADERBOARD)


def best_candidate(board: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lowest error; the earliest on ties. Candidates without a score do not count."""
    board = board.where(F.col("cv_rmse").isNotNull() & ~F.isnan("cv_rmse"))
    best = F.min_by(F.struct(*[c for c in board.columns if c not in by]), F.struct("cv_rmse", "seq"))
    return board.groupBy(*by).agg(best.alias("_b")).where(F.col("_b").isNotNull()).select(*by, "_b.*")
