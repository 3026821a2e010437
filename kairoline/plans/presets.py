"""Candidate lists to start from."""

from __future__ import annotations

from kairoline.plans.search import Candidate

SEED = 42

# Default parameters and tuning grids per model type; depths end at 30.
BASELINE = (
    Candidate("LinearRegression", {}, scaling=True),
    Candidate("Ridge", {"alpha": 1.0, "random_state": SEED}, True, {"alpha": [0.1, 1.0, 10.0, 100.0]}),
)
SHALLOW = (
    *BASELINE,
    Candidate("Lasso", {"alpha": 1.0, "random_state": SEED}, True, {"alpha": [0.01, 0.1, 1.0, 10.0]}),
    Candidate("ElasticNet", {"alpha": 1.0, "l1_ratio": 0.5, "random_state": SEED}, True,
              {"alpha": [0.1, 1.0, 10.0], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]}),
    Candidate("RandomForest", {"n_estimators": 100, "max_depth": 10, "random_state": SEED}, False,
              {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 20, 30], "min_samples_split": [2, 5, 10],
               "min_samples_leaf": [1, 2, 4]}),
    Candidate("ExtraTreesRegressor", {"n_estimators": 100, "max_depth": 10, "random_state": SEED}, False,
              {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 20, 30], "min_samples_split": [2, 5, 10]}),
    Candidate("GradientBoostingRegressor", {"n_estimators": 100, "max_depth": 4, "learning_rate": 0.1, "random_state": SEED}, False,
              {"n_estimators": [50, 100, 200], "max_depth": [3, 4, 5, 6], "learning_rate": [0.01, 0.1, 0.2]}),
    Candidate("XGBRegressor", {"n_estimators": 100, "max_depth": 4, "learning_rate": 0.1, "random_state": SEED}, False,
              {"n_estimators": [50, 100, 200], "max_depth": [3, 4, 5, 6], "learning_rate": [0.01, 0.1, 0.2]}),
    Candidate("KNeighborsRegressor", {"n_neighbors": 8}, True,
              {"n_neighbors": [3, 5, 8, 12, 15], "weights": ["uniform", "distance"]}),
)
ARIMA = (
    Candidate("MA1", {"AR_order": 0, "difference_order": 1, "MA_order": 1}),
    Candidate("AR", {"AR_order": 1, "difference_order": 1, "MA_order": 0}),
)
