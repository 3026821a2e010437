"""Data contracts: column presence and type, sign rules, reports and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Columns that request parsing adds: what is wrong with the document, and its text.
PROBLEMS, DOCUMENT = "_problems", "_document"


@dataclass(frozen=True)
class Field:
    name: str
    type: str  # "double", "bigint", "string"
    required: bool = True
    rule: str | None = None  # "non_negative" or "positive"


@dataclass(frozen=True)
class Check:
    rule: str
    column: str
    failed: Column


def _bad(field: Field, df: DataFrame) -> list[Check]:
    if field.name not in df.columns:
        return [Check("missing", field.name, F.lit(field.required))]
    c = F.col(f"`{field.name}`")
    stored = df.schema[field.name].dataType
    checks = []
    if field.type == "string":
        # Numbers are not taken for text, so a numeric column breaks the rule where it has values.
        failed = F.lit(False) if isinstance(stored, T.StringType) else c.isNotNull()
        checks.append(Check("type", field.name, failed))
        number = None
    else:
        number = c.try_cast("double") if isinstance(stored, T.StringType) else c
        if isinstance(stored, T.StringType):
            checks.append(Check("type", field.name, c.isNotNull() & number.isNull()))
        elif not isinstance(stored, T.NumericType):
            checks.append(Check("type", field.name, c.isNotNull()))
            number = None
        if field.type == "bigint" and number is not None:
            checks.append(Check("whole_number", field.name, number.isNotNull() & (number != F.floor(number))))
    if field.rule and number is not None:
        failed = number < 0 if field.rule == "non_negative" else number <= 0
        checks.append(Check(field.rule, field.name, F.coalesce(failed, F.lit(False))))
    return checks


def checks(df: DataFrame, contract: Sequence[Field]) -> list[Check]:
    return [check for field in contract for check in _bad(field, df)]


def long_form(row: DataFrame, names: Sequence[Sequence[str]], values: Sequence[str],
              labels: Sequence[str], value: str) -> DataFrame:
    """Turn the columns of a one-row aggregate into rows."""
    items = F.array(*[
        F.struct(*[F.lit(x).alias(label) for x, label in zip(tags, labels)], F.col(f"`{v}`").alias(value))
        for tags, v in zip(names, values)
    ])
    rest = [c for c in row.columns if c not in values]
    return row.select(*rest, F.explode(items).alias("_i")).select(*rest, "_i.*")


def report(df: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """One pass over the table: violations per rule and column, beside the row count."""
    found = checks(df, contract)
    if PROBLEMS in df.columns:  # values that did not fit their type are null by now
        fields = {f.name: f for f in contract}
        early = [f"type:{c}" for c in df.columns if c in fields]
        found = [c for c in found if f"{c.rule}:{c.column}" not in early] + [
            Check("type", name[5:], F.array_contains(PROBLEMS, name)) for name in early]
    totals = [F.coalesce(F.sum(c.failed.cast("bigint")), F.lit(0)).alias(f"_{i}") for i, c in enumerate(found)]
    row = df.agg(F.count("*").alias("rows"), *totals)
    out = long_form(row, [(c.rule, c.column) for c in found], [f"_{i}" for i in range(len(found))],
                    ("rule", "column"), "violations")
    return out.select("rule", "column", "violations", "rows")


def tag_errors(df: DataFrame, contract: Sequence[Field], out: str = "errors") -> DataFrame:
    """Add the names of the broken rules of every row, those found when it was parsed first."""
    named = [F.when(c.failed, F.lit(f"{c.rule}:{c.column}")) for c in checks(df, contract)]
    broken = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    if PROBLEMS in df.columns:
        broken = F.array_distinct(F.concat(F.col(PROBLEMS), broken))
    return df.withColumn(out, broken).drop(PROBLEMS)


def split(df: DataFrame, contract: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their errors)."""
    tagged = tag_errors(df, contract)
    return tagged.where(F.size("errors") == 0).drop("errors", DOCUMENT), tagged.where(F.size("errors") > 0)


class ContractViolation(ValueError):
    pass


def validate(df: DataFrame, contract: Sequence[Field], strict: bool = False) -> DataFrame:
    """The report; with ``strict`` any violation raises."""
    result = report(df, contract)
    if strict:
        broken = result.where("violations > 0").collect()  # at most one row per rule and column
        if broken:
            raise ContractViolation("; ".join(f"{r['rule']}:{r['column']}={r['violations']}" for r in broken))
    return result


def column_set(spark, columns: Sequence[str], name: str = "column") -> DataFrame:
    return spark.createDataFrame([(c,) for c in columns], T.StructType([T.StructField(name, T.StringType())]))


def column_diff(df: DataFrame, other: DataFrame | Sequence[str]) -> DataFrame:
    """Columns found on one side only, with the side."""
    theirs = other.columns if isinstance(other, DataFrame) else list(other)
    spark = df.sparkSession
    ours, theirs = column_set(spark, df.columns), column_set(spark, theirs)
    return (
        ours.exceptAll(theirs).withColumn("side", F.lit("left"))
        .unionByName(theirs.exceptAll(ours).withColumn("side", F.lit("right")))
    )


def fill_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of values per column: ``column``, ``filled``."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns])
    return long_form(row, [(c,) for c in columns], list(columns), ("column",), "filled")


def unknown_columns(df: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """Columns outside the contract and how many values they hold."""
    known = {f.name for f in contract}
    extra = [c for c in df.columns if c not in known]
    return fill_counts(df, extra) if extra else column_set(df.sparkSession, []).withColumn("filled", F.lit(0).cast("bigint"))
