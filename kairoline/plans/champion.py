"""From a feature table to a kept or replaced champion model."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairoline.functions import calendar
from kairoline.operators.grid import single_steps
from kairoline.plans import search as s
from kairoline.plans.regressors import build
from kairoline.plans.stages import PopulationScaler, ReadingPrep, build_imputer
from kairoline.plans.tracking import RunTables, now, upload_decision


@dataclass
class Setup:
    """What a training run needs to know about its table."""

    label: str
    features: Sequence[str]  # model inputs after preparation
    order: Sequence[str] = ("time",)  # identifies a row, in time order
    time: str = "time"
    series: Sequence[str] = ()
    codes: str = "{}"
    hours: int = 3
    calendar_mode: str = "cyclical"
    impute_column: str | None = None
    imputer: str = "TimeAwareKNNImputer"
    imputer_params: dict | None = None
    n_splits: int = 5
    split_type: str = "time_series"
    tuning: bool = True
    search_type: str = "random"
    n_iter: int = 30
    seed: int = 42
    fit_scope: str = "fold"
    drop: Sequence[str] = calendar.BOOKKEEPING[:1]
    duplicates: str = "error"  # steps read more than once in the training table: error, first or keep

    def prep(self, duplicates: str = "keep") -> ReadingPrep:
        return ReadingPrep(codes=self.codes, timeCol=self.time, hours=self.hours, seriesCols=list(self.series),
                           mode=self.calendar_mode or "none", dropCols=list(self.drop), duplicates=duplicates)

    def imputation(self) -> list:
        if not self.impute_column:
            return []
        return [build_imputer(self.imputer, self.impute_column, self.time, self.series, **(self.imputer_params or {}))]


@dataclass
class Outcome:
    model: PipelineModel
    model_type: str
    cv_rmse: float
    is_new: bool
    version: int
    run_id: str


def folds_for(df: DataFrame, setup: Setup) -> s.Folds:
    if setup.split_type != "time_series":
        raise ValueError(f"unknown split type: {setup.split_type}")
    prepared = setup.prep(setup.duplicates).transform(df)
    preparation = setup.imputation if setup.impute_column else None
    return s.make_folds(prepared, setup.order, setup.features, setup.label, setup.n_splits, preparation, setup.fit_scope,
                        setup.series, setup.time, setup.hours)


def refit(df: DataFrame, setup: Setup, candidate: s.Candidate, best_params: dict | None) -> PipelineModel:
    """Preparation and model fitted on all rows; found parameters replace the given ones."""
    if setup.duplicates == "first":
        df = single_steps(df, setup.series, setup.time, "first")
    stages = [setup.prep(), *setup.imputation()]
    if candidate.scaling:
        stages.append(PopulationScaler(inputCols=list(setup.features)))
    stages += build(candidate.type, best_params or candidate.params, setup.features, setup.label, setup.order,
                    setup.series, setup.time, setup.hours)
    return Pipeline(stages=stages).fit(df)


def choose(df: DataFrame, setup: Setup, candidates: Sequence[s.Candidate], tables: RunTables,
           model_name: str = "champion", tags: dict[str, str] | None = None) -> Outcome:
    """Score the candidates, compare the best with production, refit and register a better one."""
    spark, run_id = df.sparkSession, uuid.uuid4().hex
    folds = folds_for(df, setup)
    try:
        found = s.evaluate(folds, candidates, tuning=setup.tuning, search_type=setup.search_type,
                           n_iter=setup.n_iter, seed=setup.seed)
        rows = folds.rows.count()
    finally:
        folds.release()
    board = s.leaderboard(spark, found)
    tables.log_scores(run_id, board)
    best = s.best_candidate(board)
    production = tables.production(model_name)
    verdict = upload_decision(best, production).first()
    if verdict["upload"]:
        winner = found[best.first()["seq"]]
        model = refit(df, setup, winner.candidate, winner.best_params)
        path = f"{tables.root}/models/{run_id}"
        model.write().overwrite().save(path)
        version = tables.register(model_name, run_id, winner.candidate.type, winner.cv_rmse, path)
    else:
        held = production.first()
        path, version = held["path"], held["version"]
        model = PipelineModel.load(path)
    tables.add("runs", run_id=run_id, created_at=now(), model_type=verdict["model_type"], cv_rmse=verdict["cv_rmse"],
               rows=rows, is_new=verdict["upload"], version=version, path=path, status="done", tags=tags)
    return Outcome(model, verdict["model_type"], verdict["cv_rmse"], verdict["upload"], version, run_id)


def load_latest(tables: RunTables) -> PipelineModel:
    row = tables.latest_path().first()
    if row is None:
        raise LookupError("no run recorded")
    return PipelineModel.load(row["path"])


def score(model: PipelineModel, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keys, F.col("prediction"))
