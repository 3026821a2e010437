"""Pipeline stages around ``operators.trees``."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.operators import trees
from kairoline.plans.stages import _Stage, param


class _GrownParams(Params):
    inputCols = param("inputCols", "feature columns")
    labelCol = param("labelCol", "label")
    options = param("options", "keyword arguments of the grower, as JSON")
    combine = param("combine", "mean of the trees, or their sum on top of the base")
    base = param("base", "prediction without a tree")


_DEFAULTS = {"inputCols": [], "labelCol": "label", "options": "{}", "combine": "mean", "base": 0.0}


class _Grower(_Stage, Estimator, _GrownParams):
    _defaults = _DEFAULTS

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, options=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _model(self, found: list[trees.Tree], **values) -> "GrownTreesModel":
        model = GrownTreesModel()
        self._copyValues(model)
        model.trees = found
        return model._set(**values)


class ExtraTrees(_Grower):
    """Mean of trees with random thresholds."""

    def _fit(self, dataset: DataFrame) -> "GrownTreesModel":
        found = trees.extra_trees(dataset, self.get("inputCols"), self.get("labelCol"), **json.loads(self.get("options")))
        return self._model(found, combine="mean")


class SecondOrderBoosting(_Grower):
    """Trees on gradients and Hessians of the squared error, added up."""

    def _fit(self, dataset: DataFrame) -> "GrownTreesModel":
        found = trees.boosted(dataset, self.get("inputCols"), self.get("labelCol"), **json.loads(self.get("options")))
        return self._model(found.trees, combine="sum", base=float(found.base))


_FIELDS = ("feature", "cut", "left", "right", "value", "rows", "gain", "place")


class _GrownWriter(MLWriter):
    def __init__(self, stage: "GrownTreesModel"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc)
        nodes = pd.DataFrame([{"tree": t, "node": n, **{c: getattr(tree, c)[n] for c in _FIELDS}}
                              for t, tree in enumerate(self.stage.trees) for n in range(len(tree.feature))])
        nodes["place"] = nodes["place"].astype(str)  # grows by one bit a level
        self.sparkSession.createDataFrame(nodes).write.parquet(f"{path}/nodes")


class _GrownReader(MLReader):
    def load(self, path: str) -> "GrownTreesModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        stage = GrownTreesModel()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        rows = self.sparkSession.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        stage.trees = [trees.Tree(*([] for _ in _FIELDS)) for _ in range(1 + max((r["tree"] for r in rows), default=-1))]
        for r in rows:
            for c in _FIELDS:
                getattr(stage.trees[r["tree"]], c).append(int(r[c]) if c == "place" else r[c])
        return stage


class GrownTreesModel(_Stage, Model, _GrownParams):
    """A row with a missing feature has no prediction."""

    _defaults = _DEFAULTS
    trees: list[trees.Tree] = []

    def __init__(self):
        super().__init__()
        self._start({})

    def write(self):
        return _GrownWriter(self)

    @classmethod
    def read(cls):
        return _GrownReader()

    @property
    def featureImportances(self) -> DenseVector:
        return Vectors.dense(trees.importances(self.trees, len(self.get("inputCols"))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        arrays, base = [t.arrays() for t in self.trees], self.get("base")
        share = 1.0 / max(len(arrays), 1) if self.get("combine") == "mean" else 1.0
        width = len(self.get("inputCols"))

        @F.pandas_udf("double")
        def predict(rows: pd.Series) -> pd.Series:
            known = rows.notna().to_numpy()
            out = np.full(len(rows), np.nan)
            x = np.array(list(rows[known]), float).reshape(-1, width)
            total = np.zeros(len(x))
            for tree in arrays:
                total += tree[4][trees.leaves(tree, x)]
            out[known] = base + share * total
            return pd.Series(out)

        cols = [F.col(f"`{c}`").cast("double") for c in self.get("inputCols")]
        whole = F.lit(True)
        for c in cols:
            whole = whole & c.isNotNull() & ~F.isnan(c)
        return dataset.withColumn("prediction", F.when(whole, predict(F.when(whole, F.array(*cols)))))
