"""Regressors by type name, as pipeline stages.

Spark ML does the fitting wherever it has the model. Penalties are translated so that the
objective is the usual one per type; the least-squares family shares the formulas below.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Params
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.operators import arima, arima_folds, gram, grid, knn
from kairoline.plans.grown import ExtraTrees, SecondOrderBoosting
from kairoline.plans.stages import _Stage, _WithDonors, param
from kairoline.session import scratch_path, settle

VECTOR = "features_vector"
_IGNORED = {"random_state", "n_jobs", "verbose", "verbosity", "algorithm", "max_iter", "tol", "solver", "selection"}


class _PenaltyParams(Params):
    kind = param("kind", "ridge, elastic_net or sgd")
    alpha = param("alpha", "penalty weight")
    l1Ratio = param("l1Ratio", "share of the absolute penalty")
    featuresCol = param("featuresCol", "feature vector")
    labelCol = param("labelCol", "label")


class PenalisedRegression(_Stage, Estimator, _PenaltyParams):
    """Ridge, elastic net and their stochastic-gradient form on unscaled columns.

    Spark ML divides the label by its deviation s before it applies a penalty, which leaves the
    absolute part as it is and multiplies the squared part by s. The objective
    sum r^2 / 2n + a |w|_1 + b |w|^2 / 2 therefore needs the strengths a and b * s.

    The normal-equation solver reads the data once, also with an absolute penalty (it iterates on
    the sums), and uses the population deviation. It takes up to 4096 features.
    """

    _defaults = {"kind": "ridge", "alpha": 1.0, "l1Ratio": 0.0, "featuresCol": VECTOR, "labelCol": "label"}

    @keyword_only
    def __init__(self, *, kind=None, alpha=None, l1Ratio=None, featuresCol=None, labelCol=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        label, alpha, kind = self.get("labelCol"), self.get("alpha"), self.get("kind")
        row = dataset.agg(F.count(label), F.stddev_pop(label)).first()
        n, deviation = row[0], row[1] or 1.0
        share = self.get("l1Ratio")
        absolute = alpha * share if kind == "elastic_net" else 0.0
        squared = {"ridge": alpha / n, "sgd": alpha, "elastic_net": alpha * (1 - share)}[kind] * deviation
        total = absolute + squared
        return LinearRegression(
            featuresCol=self.get("featuresCol"), labelCol=label, solver="normal", standardization=False,
            regParam=total, elasticNetParam=absolute / total if total else 0.0, maxIter=10_000, tol=1e-12,
        ).fit(dataset)


class _ExpressionParams(Params):
    inputCols = param("inputCols", "feature columns")
    labelCol = param("labelCol", "label")
    fitted = param("fitted", "coefficients and intercept, as JSON")


class BayesianRidge(_Stage, Estimator, _ExpressionParams):
    """Evidence-maximised ridge: one pass for the sums, the fixed point on p x p numbers."""

    _defaults = {"inputCols": [], "labelCol": "label", "fitted": "{}"}

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LinearExpressionModel":
        fit = gram.bayes_ridge(gram.accumulate(dataset, self.get("inputCols"), self.get("labelCol")))
        model = LinearExpressionModel()
        self._copyValues(model)
        return model._set(fitted=json.dumps({"coef": fit.coef.tolist(), "intercept": fit.intercept}))


class LinearExpressionModel(_Stage, Model, _ExpressionParams):
    """Prediction as a plain column expression."""

    _defaults = {"inputCols": [], "labelCol": "label", "fitted": "{}"}

    def __init__(self):
        super().__init__()
        self._start({})

    @property
    def coefficients(self) -> list[float]:
        return json.loads(self.get("fitted"))["coef"]

    @property
    def intercept(self) -> float:
        return json.loads(self.get("fitted"))["intercept"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        total = F.lit(self.intercept)
        for c, w in zip(self.get("inputCols"), self.coefficients):
            total = total + F.lit(w) * F.col(c)
        return dataset.withColumn("prediction", total)


class _BoostParams(Params):
    rounds = param("rounds", "number of trees at most")
    maxDepth = param("maxDepth", "depth of each tree")
    learningRate = param("learningRate", "shrinkage of the tree weights")
    featuresCol = param("featuresCol", "feature vector")
    labelCol = param("labelCol", "label")
    seed = param("seed", "random seed")
    votes = param("votes", "tree weights, as JSON")


_BOOST_DEFAULTS = {"rounds": 50, "maxDepth": 3, "learningRate": 1.0, "featuresCol": VECTOR,
                   "labelCol": "label", "seed": 42, "votes": "[]"}


class AdaBoostR2(_Stage, Estimator, _BoostParams):
    """AdaBoost.R2 (Drucker 1997) with linear loss over weighted regression trees."""

    _defaults = _BOOST_DEFAULTS

    @keyword_only
    def __init__(self, *, rounds=None, maxDepth=None, learningRate=None, featuresCol=None, labelCol=None, seed=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "AdaBoostR2Model":
        features, label, rate = self.get("featuresCol"), self.get("labelCol"), self.get("learningRate")
        rows = settle(dataset.select(features, F.col(label).cast("double").alias(label), F.lit(1.0).alias("_w")))
        trees, votes = [], []
        for i in range(self.get("rounds")):
            tree = DecisionTreeRegressor(featuresCol=features, labelCol=label, weightCol="_w", seed=self.get("seed") + i,
                                         maxDepth=self.get("maxDepth"), predictionCol="_p").fit(rows)
            scored = tree.transform(rows).withColumn("_e", F.abs(F.col(label) - F.col("_p")))
            largest, missed, weights = scored.agg(F.max("_e"), F.sum(F.col("_w") * F.col("_e")), F.sum("_w")).first()
            if not largest:
                trees, votes = [*trees, tree], [*votes, 1.0 if not votes else max(votes) + math.log(1e12)]
                break
            loss = F.col("_e") / F.lit(largest)
            mean_loss = missed / weights / largest
            if mean_loss >= 0.5 and trees:
                break
            beta = mean_loss / (1.0 - mean_loss)
            trees.append(tree)
            votes.append(rate * math.log(1.0 / beta))
            if mean_loss >= 0.5 or i == self.get("rounds") - 1:
                break
            weight = F.col("_w") * F.pow(F.lit(beta), rate * (1.0 - loss))
            # Each round reads the weights of the last one only.
            rows = settle(scored.select(features, label, weight.alias("_w")))
        model = AdaBoostR2Model()
        self._copyValues(model)
        model.trees = trees
        return model._set(votes=json.dumps(votes))


class _TreesWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc)
        for i, tree in enumerate(self.stage.trees):
            tree.save(f"{path}/trees/{i}")


class _TreesReader(MLReader):
    def load(self, path: str) -> "AdaBoostR2Model":
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        stage = AdaBoostR2Model()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        count = len(json.loads(stage.get("votes")))
        stage.trees = [DecisionTreeRegressionModel.load(f"{path}/trees/{i}") for i in range(count)]
        return stage


class AdaBoostR2Model(_Stage, Model, _BoostParams):
    """Weighted median of the tree predictions."""

    _defaults = _BOOST_DEFAULTS
    trees: Sequence[DecisionTreeRegressionModel] = ()

    def __init__(self):
        super().__init__()
        self._start({})

    def write(self):
        return _TreesWriter(self)

    @classmethod
    def read(cls):
        return _TreesReader()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes, df = json.loads(self.get("votes")), dataset
        for i, tree in enumerate(self.trees):
            df = tree.copy().setPredictionCol(f"_p{i}").transform(df)
        pairs = F.array_sort(F.array(*[
            F.struct(F.col(f"_p{i}").alias("p"), F.lit(float(v)).alias("v")) for i, v in enumerate(votes)]))
        start = F.struct(F.lit(0.0).alias("seen"), F.lit(None).cast("double").alias("median"))

        def step(acc, x):
            seen = acc["seen"] + x["v"]
            found = F.when(seen >= F.lit(0.5 * sum(votes)), x["p"])
            return F.struct(seen.alias("seen"), F.coalesce(acc["median"], found).alias("median"))

        median = F.aggregate(pairs, start, step, lambda acc: acc["median"])
        return df.withColumn("prediction", median).drop(*[f"_p{i}" for i in range(len(votes))])


class _NearParams(Params):
    inputCols = param("inputCols", "feature columns")
    labelCol = param("labelCol", "label")
    idCols = param("idCols", "columns that identify a row; they also order ties")
    k = param("k", "number of neighbours")
    weights = param("weights", "uniform or distance")


_NEAR_DEFAULTS = {"inputCols": [], "labelCol": "label", "idCols": [], "k": 5, "weights": "uniform"}


class NeighbourRegressor(_Stage, Estimator, _NearParams):
    _defaults = _NEAR_DEFAULTS

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, idCols=None, k=None, weights=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NeighbourRegressorModel":
        if not self.get("idCols"):
            raise ValueError("idCols must identify the rows")
        path = scratch_path(dataset.sparkSession, "donors")
        keep = [*self.get("idCols"), self.get("labelCol"), *self.get("inputCols")]
        dataset.where(F.col(self.get("labelCol")).isNotNull()).select(*dict.fromkeys(keep)).write.parquet(path)
        model = NeighbourRegressorModel()
        self._copyValues(model)
        model.donor_path = path
        return model


class NeighbourRegressorModel(_WithDonors, _Stage, Model, _NearParams):
    _defaults = _NEAR_DEFAULTS

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        donors = dataset.sparkSession.read.parquet(self.donor_path)
        predicted = neighbour_means(dataset, donors, self.get("idCols"), self.get("inputCols"),
                                    self.get("labelCol"), self.get("k"), self.get("weights"))
        return grid.with_nulls(dataset, predicted, self.get("idCols"), how="left")


def ranked_neighbours(receivers: DataFrame, donors: DataFrame, ids: Sequence[str], coords: Sequence[str],
                      label: str, k: int, **limits) -> DataFrame:
    """Per receiver its ``k`` nearest donors with their label ``_y``, ``distance`` and ``rank``."""
    as_id = lambda d: [F.col(c) for c in ids]
    return knn.nearest(
        receivers.select(*as_id(receivers), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(coords)]),
        donors.select(*as_id(donors), F.col(label).cast("double").alias("_y"),
                      *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(coords)]),
        ids, ids, [f"_x{i}" for i in range(len(coords))], k, "_y", **limits)


def mean_label(k: int, weights: str = "uniform") -> Column:
    """Aggregate over ranked neighbours: the mean label of the first ``k``; with ``distance`` weights 1/d, and where some donor
    lies at distance 0 only those count."""
    near = F.col("rank") <= k
    if weights == "uniform":
        return F.avg(F.when(near, F.col("_y")))
    if weights != "distance":
        raise ValueError(f"unknown weights: {weights}")
    exact = F.avg(F.when(near & (F.col("distance") == 0), F.col("_y")))
    inverse = F.when(near & (F.col("distance") > 0), 1 / F.col("distance"))
    return F.coalesce(exact, F.sum(F.col("_y") * inverse) / F.sum(inverse))


def neighbour_means(receivers: DataFrame, donors: DataFrame, ids: Sequence[str], coords: Sequence[str],
                    label: str, k: int, weights: str = "uniform", **limits) -> DataFrame:
    """Mean label of the ``k`` nearest donors."""
    mean = mean_label(k, weights).alias("prediction")
    return ranked_neighbours(receivers, donors, ids, coords, label, k, **limits).groupBy(*ids).agg(mean)


class _SeriesParams(Params):
    kind = param("kind", "ar or ma")
    order = param("order", "0: the values themselves, 1: their changes")
    seriesCols = param("seriesCols", "columns that identify a series")
    timeCol = param("timeCol", "time column")
    labelCol = param("labelCol", "label")
    hours = param("hours", "step of the time grid in hours")


_SERIES_DEFAULTS = {"kind": "ar", "order": 1, "seriesCols": [], "timeCol": "time", "labelCol": "label", "hours": 3}


class SeriesRegressor(_Stage, Estimator, _SeriesParams):
    """First-order model of every series; its fits are kept as a table, one row per series."""

    _defaults = _SERIES_DEFAULTS

    @keyword_only
    def __init__(self, *, kind=None, order=None, seriesCols=None, timeCol=None, labelCol=None, hours=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SeriesRegressorModel":
        series, ts, label, hours = (self.get(c) for c in ("seriesCols", "timeCol", "labelCol", "hours"))
        rows = dataset.withColumns({label: F.col(label).cast("double"), "segment": F.lit(0)})
        changes = settle(arima.lagged_changes(rows, series, ts, label, hours, self.get("order"), ["segment"]))
        sums = arima_folds.segment_sums(changes, series, ts, label)
        path = scratch_path(dataset.sparkSession, "series")
        arima_folds.fold_fits(changes, sums, self.get("kind"), series, ts, 1, hours).drop("fold").write.parquet(path)
        model = SeriesRegressorModel()
        self._copyValues(model)
        model.donor_path = path
        return model


class SeriesRegressorModel(_WithDonors, _Stage, Model, _SeriesParams):
    """Forecasts from the last row seen; rows at or before it and unknown series have no prediction."""

    _defaults = _SERIES_DEFAULTS

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fits = dataset.sparkSession.read.parquet(self.donor_path)
        return arima_folds.forecast(dataset, fits, self.get("kind"), self.get("seriesCols"), self.get("timeCol"), (),
                                    self.get("hours"), self.get("order"))


def series_kind(kind: str, params: dict) -> tuple[str, int]:
    """``ar`` or ``ma``, and the order of differences; other orders are refused."""
    wanted = (1, 0) if kind == "AR" else (0, 1)
    found = (int(params.get("AR_order", wanted[0])), int(params.get("MA_order", wanted[1])))
    order = int(params.get("difference_order", 1))
    if found != wanted or order not in (0, 1):
        raise ValueError(f"{kind} takes AR_order {wanted[0]}, MA_order {wanted[1]} and difference_order 0 or 1")
    return ("ar" if kind == "AR" else "ma"), order


def _depth(value) -> int:
    """Spark ML grows trees to depth 30 at most; an open depth means that, a deeper one is refused."""
    if value is not None and int(value) > 30:
        raise ValueError(f"max_depth {value}: trees end at depth 30")
    return 30 if value is None else int(value)


def _subset(value) -> str:
    if value in (None, 1.0, "all"):
        return "all"
    return {"sqrt": "sqrt", "log2": "log2"}.get(value, str(value))


def _tried(value, p: int) -> int:
    """Features tried per node: all, a root, a logarithm, a share or a number of them."""
    if value in (None, "all"):
        return p
    if value in ("sqrt", "log2"):
        return max(1, int(math.sqrt(p) if value == "sqrt" else math.log2(p)))
    return max(1, int(value * p) if isinstance(value, float) else min(int(value), p))


def _leaf(params: dict) -> int:
    """Rows per leaf. A split minimum of m has no Spark ML counterpart of its own; a node with fewer
    than m rows cannot give two leaves of half of m each."""
    return max(int(params.get("min_samples_leaf", 1)), math.ceil(int(params.get("min_samples_split", 2)) / 2))


# Parameter names taken by each type, beside those that do not change a result.
KNOWN = {
    "LinearRegression": set(), "Ridge": {"alpha"}, "Lasso": {"alpha"}, "ElasticNet": {"alpha", "l1_ratio"},
    "BayesianRidge": set(), "SGDRegressor": {"alpha"},
    "DecisionTreeRegressor": {"max_depth", "min_samples_split", "min_samples_leaf"},
    "RandomForest": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features"},
    "ExtraTreesRegressor": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features"},
    "GradientBoostingRegressor": {"n_estimators", "max_depth", "learning_rate", "subsample", "min_samples_split", "min_samples_leaf"},
    "XGBRegressor": {"n_estimators", "max_depth", "learning_rate", "subsample", "reg_lambda", "gamma", "min_child_weight", "max_bin"},
    "AdaBoostRegressor": {"n_estimators", "learning_rate", "max_depth"},
    "KNeighborsRegressor": {"n_neighbors", "weights"},
    **{kind: {"AR_order", "difference_order", "MA_order"} for kind in ("AR", "MA", "MA1")},
}
LINEAR = ("LinearRegression", "Ridge", "Lasso", "ElasticNet", "BayesianRidge", "SGDRegressor")
SERIES = ("AR", "MA", "MA1")  # fitted per series


def build(kind: str, params: dict, features: Sequence[str], label: str = "label", ids: Sequence[str] = (),
          series: Sequence[str] = (), time: str = "time", hours: float = 3) -> list:
    """Stages that turn feature columns (series models: time and label) into a ``prediction`` column."""
    if kind not in KNOWN:
        raise ValueError(f"unknown model type: {kind}")
    strange = set(params) - KNOWN[kind] - _IGNORED
    if strange:
        raise ValueError(f"{kind} does not take {sorted(strange)}")
    features, seed, p = list(features), int(params.get("random_state", 42)), params
    if kind == "BayesianRidge":
        return [BayesianRidge(inputCols=features, labelCol=label)]
    if kind == "KNeighborsRegressor":
        return [NeighbourRegressor(inputCols=features, labelCol=label, idCols=list(ids),
                                   k=int(p.get("n_neighbors", 5)), weights=p.get("weights", "uniform"))]
    if kind == "ExtraTreesRegressor":
        return [ExtraTrees(inputCols=features, labelCol=label, options=json.dumps({
            "trees": int(p.get("n_estimators", 100)), "depth": _depth(p.get("max_depth")), "leaf": int(p.get("min_samples_leaf", 1)),
            "split": int(p.get("min_samples_split", 2)), "subset": _tried(p.get("max_features"), len(features)), "seed": seed}))]
    if kind in ("GradientBoostingRegressor", "XGBRegressor"):
        second = kind == "XGBRegressor"
        return [SecondOrderBoosting(inputCols=features, labelCol=label, options=json.dumps({
            "rounds": int(p.get("n_estimators", 100)), "depth": _depth(p.get("max_depth", 6 if second else 3)),
            "rate": float(p.get("learning_rate", 0.3 if second else 0.1)), "subsample": float(p.get("subsample", 1.0)),
            "ridge": float(p.get("reg_lambda", 1.0)) if second else 0.0, "least_gain": float(p.get("gamma", 0.0)),
            "leaf": float(p.get("min_child_weight", 1.0)) if second else int(p.get("min_samples_leaf", 1)),
            "split": int(p.get("min_samples_split", 2)), "bins": int(p.get("max_bin", 256)), "seed": seed}))]
    if kind in SERIES:
        form, order = series_kind(kind, p)
        return [SeriesRegressor(kind=form, order=order, seriesCols=list(series), timeCol=time, labelCol=label, hours=hours)]
    common = {"featuresCol": VECTOR, "labelCol": label}
    if kind == "LinearRegression":
        model = LinearRegression(**common, regParam=0.0, standardization=False, solver="normal")
    elif kind == "Ridge":
        model = PenalisedRegression(kind="ridge", alpha=float(p.get("alpha", 1.0)), **common)
    elif kind == "SGDRegressor":
        model = PenalisedRegression(kind="sgd", alpha=float(p.get("alpha", 1e-4)), **common)
    elif kind in ("Lasso", "ElasticNet"):
        share = 1.0 if kind == "Lasso" else float(p.get("l1_ratio", 0.5))
        model = PenalisedRegression(kind="elastic_net", alpha=float(p.get("alpha", 1.0)), l1Ratio=share, **common)
    elif kind == "DecisionTreeRegressor":
        model = DecisionTreeRegressor(**common, seed=seed, maxDepth=_depth(p.get("max_depth")), minInstancesPerNode=_leaf(p))
    elif kind == "RandomForest":
        model = RandomForestRegressor(
            **common, seed=seed, numTrees=int(p.get("n_estimators", 100)), maxDepth=_depth(p.get("max_depth")),
            minInstancesPerNode=_leaf(p), featureSubsetStrategy=_subset(p.get("max_features")))
    else:
        model = AdaBoostR2(**common, rounds=int(p.get("n_estimators", 50)), learningRate=float(p.get("learning_rate", 1.0)),
                           maxDepth=int(p.get("max_depth", 3)), seed=seed)
    return [VectorAssembler(inputCols=features, outputCol=VECTOR), model]


def linear_solution(kind: str, params: dict, sums: gram.Gram) -> gram.LinearFit:
    """The same objectives solved from normal-equation sums."""
    if kind == "LinearRegression":
        return gram.ols(sums)
    if kind == "Ridge":
        return gram.ridge(sums, float(params.get("alpha", 1.0)))
    if kind == "SGDRegressor":
        return gram.ridge(sums, float(params.get("alpha", 1e-4)) * sums.n)
    if kind == "Lasso":
        return gram.elastic_net(sums, float(params.get("alpha", 1.0)), 1.0)
    if kind == "ElasticNet":
        return gram.elastic_net(sums, float(params.get("alpha", 1.0)), float(params.get("l1_ratio", 0.5)))
    if kind == "BayesianRidge":
        return gram.bayes_ridge(sums)
    raise ValueError(f"not a linear model: {kind}")


def scaled_solution(kind: str, params: dict, sums: gram.Gram, scaling_from: gram.Gram | None) -> gram.LinearFit:
    """Fit on columns standardised by the moments of ``scaling_from``; coefficients are returned
    for the unscaled columns, so errors can be read from unscaled sums."""
    if scaling_from is None:
        return linear_solution(kind, params, sums)
    spread = np.sqrt(np.maximum(np.diag(scaling_from.centred)[:-1] / scaling_from.n, 0.0))
    spread = np.where(spread > 0, spread, 1.0)
    unit = np.concatenate([[1.0], 1.0 / spread, [1.0]])
    stretched = gram.Gram(sums.features, sums.shift * unit[1:], sums.sums * np.outer(unit, unit))
    fit = linear_solution(kind, params, stretched)
    return gram.LinearFit(fit.features, fit.coef / spread, fit.intercept)
