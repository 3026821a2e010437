"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("readings", "quality", "gaps", "profiles", "history", "regression", "selection", "tracking", "scoring")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    for module in _MODULES:
        import_module(f"kairoline.catalog.{module}")
