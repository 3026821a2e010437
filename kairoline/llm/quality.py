"""Quality rules with thresholds that follow each language and source.

Every document gets five exact counts. Four shares derived from them go into one quantile sketch per language, source
and measure: a histogram over values cut to their leading six bits (relative error at most 1/32). Sketches merge by
adding counts, so they are built with map-side combining, and a source with few documents uses the merged sketch of its
language. A document is rejected when a share leaves its group's fence (quartiles and their distance, plus a slack that
keeps even groups from rejecting their own tail). Fences are joined back on language and source.

Defined results: a null text has no words and fails the base rule; null languages and sources form groups of their
own; repeated rows are judged each; an empty table gives an empty result; input columns of any name are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairoline.llm.common import SEPARATORS, col, fresh, let, settled, sized, words

WINDOW = 8


@dataclass(frozen=True)
class Rules:
    """Parameters of the verdict; shares are in parts of 10,000, word length in hundredths of a code point."""

    min_words: int = 20
    repeat_percent: int = 30
    reach: int = 3  # fence = quartile +- reach * distance of the quartiles +- slack
    symbol_slack: int = 500
    line_slack: int = 4000
    repeat_slack: int = 3000
    length_slack: int = 150
    min_group: int = 100  # smaller groups use the sketch of their language


#: Measure, its slack, and whether it also has a lower fence.
MEASURES = (("symbols", "symbol_slack", False), ("lines", "line_slack", False), ("repeats", "repeat_slack", False),
            ("length", "length_slack", True))


def repeated_words(ws: Column) -> Column:
    """Words inside 8-word windows that occur at least twice, the first occurrence included.

    Windows are 64-bit hashes; only a text in which a hash repeats sorts them to find the covered words.
    """
    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda t: let(
            F.array_sort(F.transform(F.filter(t, lambda x, j: (
                (j > 0) & F.get(t, F.greatest(j - 1, F.lit(0)))["h"].eqNullSafe(x["h"]))
                | F.get(t, j + 1)["h"].eqNullSafe(x["h"])), lambda x: x["i"])),
            lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)))

    hashes = let(ws, lambda w: F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def metrics(text: Column) -> Column:
    """Struct of exact counts of one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return let(words(t), lambda w: let(lines, lambda ls: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.translate(t, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words"))))


def base_failed(m: Column, rules: Rules) -> Column:
    return (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.repeat_percent * m["n_words"])


def _shares(m: Column) -> dict[str, Column]:
    def share(scale: int, part: str, whole: str) -> Column:
        return F.floor(scale * m[part] / F.greatest(m[whole], F.lit(1))).cast("long")

    return {"symbols": share(10_000, "n_symbols", "word_chars"), "lines": share(10_000, "n_dup_lines", "n_lines"),
            "repeats": share(10_000, "n_repeat_words", "n_words"), "length": share(100, "word_chars", "n_words")}


def _cut(v: Column) -> Column:
    """The value with all but its leading six bits cleared: the name of its bucket."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return v - F.pmod(v, F.call_function("shiftleft", F.lit(1).cast("long"), shift))


def sketch(measured: DataFrame, m: str, lang: str, source: str, rules: Rules) -> DataFrame:
    """One row per language, source, measure and bucket; adding ``n`` merges sketches."""
    s = _shares(col(m))
    long = measured.filter(~base_failed(col(m), rules)).select(
        col(lang).alias("lang"), col(source).alias("source"),
        F.inline(F.array(*[F.struct(F.lit(k).alias("measure"), _cut(s[k]).alias("bucket")) for k, _, _ in MEASURES])))
    return long.groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sk: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys, "measure")
    run = sk.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("total", F.sum("n").over(w))
    return run.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"))


def fences(sk: DataFrame, rules: Rules) -> DataFrame:
    """Per language and source, the bounds of every measure."""
    own = _quartiles(sk, ["lang", "source"]).alias("o")
    merged = sk.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    wide = _quartiles(merged, ["lang"]).alias("l")
    both = own.join(wide, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure")))
    small = F.col("o.total") < rules.min_group
    q1, q3 = (F.when(small, F.col(f"l.{q}")).otherwise(F.col(f"o.{q}")) for q in ("q1", "q3"))
    picked = both.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"),
                         F.col("o.measure").alias("measure"), q1.alias("q1"), q3.alias("q3"))
    out = []
    for name, slack, lower in MEASURES:
        of = F.col("measure") == name
        gap = rules.reach * (F.col("q3") - F.col("q1")) + getattr(rules, slack)
        out.append(F.max(F.when(of, F.col("q3") + gap)).alias(f"{name}_most"))
        if lower:
            out.append(F.max(F.when(of, F.col("q1") - gap)).alias(f"{name}_least"))
    return picked.groupBy("lang", "source").agg(*out)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          rules: Rules = Rules(), keep: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """``docs`` (columns ``keep``, all by default) with a metrics struct and a verdict; returns both names too.

    Texts are measured once: the measured rows are settled, then sketched and judged from there.
    """
    m, verdict, lg, so = fresh(docs, "quality_metrics", "quality_kept", "quality_lang", "quality_source")
    columns = docs.columns if keep is None else keep
    measured = settled(docs.select(*[col(c) for c in columns], col(lang).alias(lg), col(source).alias(so),
                                   metrics(col(text)).alias(m)))
    bounds = settled(fences(sketch(measured, m, lg, so, rules), rules))
    b = sized(bounds).alias("bounds")
    s = _shares(F.col(f"docs.{m}"))
    inside = F.lit(True)
    for name, _, lower in MEASURES:
        inside = inside & (s[name] <= F.col(f"bounds.{name}_most"))
        if lower:
            inside = inside & (s[name] >= F.col(f"bounds.{name}_least"))
    judged = measured.alias("docs").join(
        b, F.col(f"docs.{lg}").eqNullSafe(F.col("bounds.lang"))
        & F.col(f"docs.{so}").eqNullSafe(F.col("bounds.source")), "left")
    ok = ~base_failed(F.col(f"docs.{m}"), rules) & F.coalesce(inside, F.lit(True))
    return judged.select("docs.*", ok.alias(verdict)).drop(lg, so), m, verdict


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns."""
    judged, _, verdict = judge(docs, rules=rules)
    return judged.filter(col(verdict)).select(*[col(c) for c in docs.columns])
