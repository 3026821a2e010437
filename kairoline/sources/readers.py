"""Scans with fixed schemas, request parsing and target split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairoline.operators.contract import DOCUMENT, PROBLEMS


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV under a given schema; columns are found by name, in any order, and types are never inferred.

    Missing or unknown columns raise; a value that does not fit its type becomes null (``checked_csv`` names them).
    """
    return checked_csv(spark, path, schema).drop(PROBLEMS)


def _fits(text: Column, kind: T.DataType) -> tuple[Column, Column]:
    """The value of a text in a type, and whether it fits: whole numbers have no fraction, numbers are finite."""
    value = text.try_cast(kind)
    if not isinstance(kind, T.NumericType):
        return value, value.isNotNull()
    number = text.try_cast("double")
    value = number.try_cast(kind) if isinstance(kind, T.IntegralType) else value
    exact = F.coalesce(value, text.try_cast(kind)) if isinstance(kind, T.IntegralType) else value
    fits = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")) & exact.isNotNull()
    if isinstance(kind, T.IntegralType):
        exact = F.coalesce(text.try_cast(kind), value)
        fits = fits & (number == F.floor(number))
    return F.when(fits, exact), fits


def checked_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_csv``, with ``PROBLEMS``: ``type:f`` for every value that is there but does not fit its type.

    The contract then reports and quarantines such rows like bad request documents. A fraction is no whole number, and
    an infinite or undefined number is none.
    """
    found = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [f.name for f in schema if f.name not in found.columns]
    unknown = [c for c in found.columns if c not in schema.names]
    if missing or unknown:
        raise ValueError(f"{path}: missing columns {missing}, unknown columns {unknown}")
    values, problems = [], []
    for f in schema:
        text = F.col(f"`{f.name}`")
        value, fits = _fits(text, f.dataType)
        values.append(value.alias(f.name))
        problems.append(F.when(text.isNotNull() & ~fits, F.lit(f"type:{f.name}")))
    return found.select(*values, F.array_compact(F.array(*problems)).alias(PROBLEMS))


def load_tables(spark: SparkSession, data_path: str, train: str, test: str, submission: str,
                schema: T.StructType, submission_schema: T.StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, test and sample submission tables; test lacks the trailing target column."""
    base = data_path.rstrip("/")
    return (
        read_csv(spark, f"{base}/{train}", schema),
        read_csv(spark, f"{base}/{test}", T.StructType(schema.fields[:-1])),
        read_csv(spark, f"{base}/{submission}", submission_schema),
    )


def request_schema(features: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("features", features)])


def read_requests(spark: SparkSession, path: str, features: T.StructType) -> DataFrame:
    """Request documents ``{"features": {...}}``, one row each."""
    return spark.read.schema(request_schema(features)).option("multiLine", True).json(path).select("features.*")


def parse_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Replace a JSON text column by its fields.

    The fields come out of a generator, so later filters cannot be rewritten in terms of the text:
    each document is parsed once, however many columns are tested.
    """
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.inline(F.array(F.from_json(column, schema))))


def parse_requests(df: DataFrame, column: str, features: T.StructType) -> DataFrame:
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.inline(F.array(F.from_json(column, request_schema(features))["features"])))


def checked_requests(df: DataFrame, column: str, features: T.StructType) -> DataFrame:
    """Features of request documents with ``PROBLEMS``, what is wrong with each, and ``DOCUMENT``, its text.

    ``malformed:document``: no JSON, or no object of features; ``missing:f``: the field is absent; ``type:f``: a number
    or flag where text is due, a value that is no finite number where one is due, or a fraction where a whole number is. A field that is there and null is fine.
    Every document keeps its row.
    """
    rest = [c for c in df.columns if c != column]
    parsed = F.try_variant_get(F.try_parse_json(column), "$.features", "variant")
    # Generators keep later filters from repeating the work once per tested column, as in ``parse_json``.
    rows = df.select(*rest, F.inline(F.array(F.struct(F.col(column).alias(DOCUMENT), parsed.alias("_v")))))
    whole = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    values, found = [], [F.when(~whole, F.lit("malformed:document"))]
    for f in features:
        path = f"$['{f.name}']"
        item = F.try_variant_get(F.col("_v"), path, "variant")
        value = F.try_variant_get(F.col("_v"), path, f.dataType.simpleString())
        kind = F.schema_of_variant(item)
        wrong = (kind != "STRING") if isinstance(f.dataType, T.StringType) else (value.isNull() | (kind == "BOOLEAN"))
        if isinstance(f.dataType, T.NumericType):
            number = F.try_variant_get(F.col("_v"), path, "double")
            wrong = wrong | F.isnan(number) | (F.abs(number) == float("inf"))
            if isinstance(f.dataType, T.IntegralType):
                wrong = wrong | (number != F.floor(number))
            value = F.when(~wrong, value)
        values.append(value.alias(f.name))
        found.append(F.when(whole & item.isNull(), F.lit(f"missing:{f.name}")).when(
            whole & (kind != "VOID") & wrong, F.lit(f"type:{f.name}")))
    return rows.select(*rest, DOCUMENT, F.inline(F.array(F.struct(
        *values, F.array_compact(F.array(*found)).alias(PROBLEMS)))))


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and target name; the label stays in its row."""
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    return [c for c in df.columns if c != target], target
