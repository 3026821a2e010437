"""Pipeline stages: reading preparation, calendar features, imputers and the scaler.

Fitted state is bounded by the calendar or by the number of columns and is kept as parameters.
Only the neighbour imputer holds a table, which is stored as parquet next to the stage.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReader, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.functions import calendar
from kairoline.functions.scalars import parse_time, strip_prefix
from kairoline.operators import grid, impute, scale
from kairoline.session import scratch_path


def param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Keyword construction and plain access to parameter values."""

    _defaults: dict = {}

    def _start(self, kwargs: dict) -> None:
        self._setDefault(**self._defaults)
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def get(self, name: str):
        return self.getOrDefault(name)


class _ReadingParams(Params):
    codes = param("codes", "column -> prefix of coded numbers, as JSON")
    timeCol = param("timeCol", "time column, text or timestamp")
    hours = param("hours", "grid step in hours")
    seriesCols = param("seriesCols", "columns that identify a series")
    regular = param("regular", "keep on-grid rows only (batch tables)")
    mode = param("mode", "calendar features: cyclical, onehot or none")
    dropFirst = param("dropFirst", "leave out the first one-hot level")
    dropCols = param("dropCols", "columns to remove if present")
    duplicates = param("duplicates", "steps read more than once: error, first or keep (batch tables)")


class ReadingPrep(_Stage, Transformer, _ReadingParams):
    """Codes to numbers, text to time, off-grid and empty rows out, calendar features in.

    The grid starts at the first reading of the table (per series). A stream has no first reading:
    there every request counts as its own table, so all of them are on their grid. Steps read more than once are left alone
    (requests may name the same time) unless ``duplicates`` says otherwise, as training does.
    """

    _defaults = {"codes": "{}", "timeCol": "time", "hours": 3, "seriesCols": [], "regular": True,
                 "mode": "cyclical", "dropFirst": False, "dropCols": ["Unnamed: 0"], "duplicates": "keep"}

    @keyword_only
    def __init__(self, *, codes=None, timeCol=None, hours=None, seriesCols=None, regular=None,
                 mode=None, dropFirst=None, dropCols=None, duplicates=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df, ts, series = dataset, self.get("timeCol"), self.get("seriesCols")
        types = dict(df.dtypes)
        for name, prefix in json.loads(self.get("codes")).items():
            if types.get(name) == "string":
                df = df.withColumn(name, strip_prefix(name, prefix))
        if types.get(ts) == "string":
            df = df.withColumn(ts, parse_time(ts))
        df = df.drop(*self.get("dropCols"))
        if ts not in types:
            return df
        if self.get("regular") and not df.isStreaming:
            values = [c for c in df.columns if c not in (ts, *series)]
            df = grid.single_steps(df, series, ts, self.get("duplicates"))
            df = grid.on_grid(df, series, ts, values, self.get("hours"))
        mode = self.get("mode")
        return calendar.add_calendar(df, ts, None if mode == "none" else mode, self.get("dropFirst"))


class _ImputeParams(Params):
    inputCol = param("inputCol", "column to fill; a table without it passes unchanged")
    timeCol = param("timeCol", "time column")
    seriesCols = param("seriesCols", "columns that identify a series")
    strategy = param("strategy", "group_median, pattern, interpolate, mean or median")
    maxGap = param("maxGap", "longest gap to interpolate, in hours")
    hours = param("hours", "grid step in hours")
    state = param("state", "fitted medians, as JSON rows")


_LEVELS = {"group_median": (("hour", "dow", "month"),), "pattern": impute.PATTERN_LEVELS,
           "interpolate": impute.FALLBACK_LEVELS, "median": ((),)}
_IMPUTE_DEFAULTS = {"inputCol": "", "timeCol": "time", "seriesCols": [], "strategy": "pattern",
                    "maxGap": 24.0, "hours": 3, "state": "[]"}


class SeasonalImputer(_Stage, Estimator, _ImputeParams):
    _defaults = _IMPUTE_DEFAULTS

    @keyword_only
    def __init__(self, *, inputCol=None, timeCol=None, seriesCols=None, strategy=None, maxGap=None, hours=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SeasonalImputerModel":
        column, strategy, rows = self.get("inputCol"), self.get("strategy"), []
        if column in dataset.columns:
            if strategy == "mean":
                rows = [[0, dataset.agg(F.avg(column)).first()[0]]]
            elif strategy in _LEVELS:
                levels = _LEVELS[strategy]
                state = impute.level_medians(dataset, self.get("timeCol"), column, levels)
                keys = sorted({k for level in levels for k in level})
                # At most 24 x 7 x 12 calendar cells.
                rows = [list(r) for r in state.select("_level", *[f"_{k}" for k in keys], "_median").collect()]
            else:
                raise ValueError(f"unknown strategy: {strategy}")
        model = SeasonalImputerModel()
        self._copyValues(model)
        return model._set(state=json.dumps(rows))


class SeasonalImputerModel(_Stage, Model, _ImputeParams):
    _defaults = _IMPUTE_DEFAULTS

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column, strategy = self.get("inputCol"), self.get("strategy")
        rows = json.loads(self.get("state"))
        if column not in dataset.columns or not rows:
            return dataset
        ts, order = self.get("timeCol"), dataset.columns
        if strategy == "mean":
            return dataset.withColumn(column, F.coalesce(F.col(column), F.lit(rows[0][1])))
        levels = _LEVELS[strategy]
        keys = sorted({k for level in levels for k in level})
        state = dataset.sparkSession.createDataFrame(
            [tuple(r) for r in rows], ", ".join(["_level int", *[f"_{k} int" for k in keys], "_median double"]))
        df = dataset.withColumn("_raw", F.col(column).cast("double"))
        source = "_raw"
        if strategy == "interpolate":
            from kairoline.operators.fill import interpolate
            df = interpolate(df, self.get("seriesCols"), ts, "_raw", "_line", self.get("maxGap"), self.get("hours"))
            source = "_line"
        done = impute.fill_from_levels(df, ts, source, "_filled", state, levels)
        return done.select(*[F.col("_filled").alias(c) if c == column else F.col(f"`{c}`") for c in order])


class _NeighbourParams(Params):
    inputCol = param("inputCol", "column to fill; a table without it passes unchanged")
    timeCol = param("timeCol", "time column")
    seriesCols = param("seriesCols", "columns that, with the time, identify a row")
    k = param("k", "number of neighbours")
    columns = param("columns", "numeric columns in the distance")
    moments = param("moments", "scaling of the distance columns, as JSON")
    scaled = param("scaled", "standardise the distance columns")


_NEIGHBOUR_DEFAULTS = {"inputCol": "", "timeCol": "time", "seriesCols": [], "k": 5, "columns": [],
                       "moments": "{}", "scaled": False}


class NeighbourImputer(_Stage, Estimator, _NeighbourParams):
    """Nearest-neighbour imputer; the donors are the rows it was fitted on."""

    _defaults = _NEIGHBOUR_DEFAULTS

    @keyword_only
    def __init__(self, *, inputCol=None, timeCol=None, seriesCols=None, k=None, scaled=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NeighbourImputerModel":
        model = NeighbourImputerModel()
        self._copyValues(model)
        column = self.get("inputCol")
        if column in dataset.columns:
            skip = (column, *self.get("seriesCols"), *calendar.CYCLICAL)
            columns = impute.numeric_columns(dataset, skip)
            scaling = scale.moments(dataset, columns) if self.get("scaled") and columns else {}
            keep = [*self.get("seriesCols"), self.get("timeCol"), column, *columns]
            path = scratch_path(dataset.sparkSession, "donors")
            dataset.where(F.col(column).isNotNull()).select(*keep).write.parquet(path)
            model._set(columns=columns, moments=json.dumps(scaling))
            model.donor_path = path
        return model


class _DonorWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sc)
        if self.stage.donor_path:
            self.sparkSession.read.parquet(self.stage.donor_path).write.parquet(f"{path}/donors")


class _DonorReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.donor_path = f"{path}/donors"
        return stage


class _WithDonors:
    """Persistence for models that carry a table."""

    donor_path: str | None = None

    def write(self):
        return _DonorWriter(self)

    @classmethod
    def read(cls):
        return _DonorReader(cls)


class NeighbourImputerModel(_WithDonors, _Stage, Model, _NeighbourParams):
    _defaults = _NEIGHBOUR_DEFAULTS

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        column = self.get("inputCol")
        if column not in dataset.columns or not self.donor_path:
            return dataset
        ts, columns, order = self.get("timeCol"), self.get("columns"), dataset.columns
        donors = dataset.sparkSession.read.parquet(self.donor_path)
        df = dataset.withColumns({f"_n_{c}": F.col(c).cast("double") for c in columns})
        donors = donors.withColumns({f"_n_{c}": F.col(c).cast("double") for c in columns})
        scaling = {f"_n_{c}": v for c, v in json.loads(self.get("moments")).items()}
        if scaling:
            df, donors = (scale.standardise(d, list(scaling), scaling) for d in (df, donors))
        df, donors = (d.withColumn("_raw", F.col(column).cast("double")) for d in (df, donors))
        done = impute.impute_knn(df, ts, "_raw", "_filled", [*self.get("seriesCols"), ts],
                                 [f"_n_{c}" for c in columns], self.get("k"), donors)
        return done.select(*[F.col("_filled").alias(c) if c == column else F.col(f"`{c}`") for c in order])


class _ScaleParams(Params):
    inputCols = param("inputCols", "columns to standardise")
    moments = param("moments", "mean and population deviation per column, as JSON")


class PopulationScaler(_Stage, Estimator, _ScaleParams):
    """(x - mean) / population deviation, in place; nulls stay."""

    _defaults = {"inputCols": [], "moments": "{}"}

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._start(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        model = PopulationScalerModel()
        self._copyValues(model)
        return model._set(moments=json.dumps(scale.moments(dataset, self.get("inputCols"))))


class PopulationScalerModel(_Stage, Model, _ScaleParams):
    _defaults = {"inputCols": [], "moments": "{}"}

    def __init__(self):
        super().__init__()
        self._start({})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return scale.standardise(dataset, self.get("inputCols"), json.loads(self.get("moments")))


# Imputer type names as configurations spell them.
IMPUTERS = {
    "TimeAwareKNNImputer": lambda column, time, series, n_neighbors=5, scaled=False: NeighbourImputer(
        inputCol=column, timeCol=time, seriesCols=series, k=n_neighbors, scaled=scaled),
    "ValenciaPressureImputer": lambda column, time, series: SeasonalImputer(
        inputCol=column, timeCol=time, seriesCols=series, strategy="group_median"),
    "InterpolationImputer": lambda column, time, series, max_gap=24, hours=3: SeasonalImputer(
        inputCol=column, timeCol=time, seriesCols=series, strategy="interpolate", maxGap=float(max_gap), hours=hours),
    "SimplifiedPatternImputer": lambda column, time, series: SeasonalImputer(
        inputCol=column, timeCol=time, seriesCols=series, strategy="pattern"),
    "SimpleImputer": lambda column, time, series, strategy="mean": SeasonalImputer(
        inputCol=column, timeCol=time, seriesCols=series, strategy=strategy),
}


def build_imputer(kind: str, column: str | None, time: str = "time", series=(), **params):
    if kind not in IMPUTERS:
        raise ValueError(f"unknown imputer: {kind}")
    return IMPUTERS[kind](column or "", time, list(series), **params)
