"""Writers for feature tables and predictions, and the completeness check of outputs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Feature table without an index column; CSV keeps its header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_predictions(scored: DataFrame, path: str, keys: Sequence[str] = ("ts",),
                      prediction: str = "prediction", fmt: str = "parquet") -> str:
    return write_features(scored.select(*keys, prediction), path, fmt)


def missing_outputs(spark: SparkSession, root: str, expected: Sequence[str]) -> DataFrame:
    """Expected paths (relative to ``root``) under which no file was written."""
    base = root.rstrip("/")
    plain = re.sub("^file:/*", "/", base)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select(
        F.split(F.substr(F.regexp_replace("path", "^file:/*", "/"), F.lit(len(plain) + 2)), "/").alias("parts"))
    # a file proves every folder above it
    there = found.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("parts")), lambda n: F.array_join(
        F.slice("parts", F.lit(1), n), "/"))).alias("expected")).distinct()
    wanted = spark.createDataFrame([(e,) for e in expected], "expected string")
    return wanted.join(there, "expected", "left_anti")
