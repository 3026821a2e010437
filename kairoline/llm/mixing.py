"""Mixing sources to target weights by Poisson replication.

Each source's mean repetition rate is its share of the wanted rows over the rows it has. Every document draws a Poisson
count with that mean by inverting the distribution at a hash of its content and the seed, is exploded by the count, and
the copies are dealt out and sorted by a hash, which is a global shuffle. Means above ``PIECE`` are drawn as a sum of
independent Poisson counts, so the inverted table stays short at any rate.

Defined results: a null source is a source of its own; a source without a weight has weight ``default``; equal rows
draw equal counts; an empty table stays empty; null texts and ids are drawn like any other; input columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, fresh, let, settled, sized

PIECE = 8.0
#: Terms of the inverted table: a Poisson count with mean 8 exceeds 63 with probability below 1e-30.
TERMS = 64


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) with 52 bits from md5, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, source: str, weights: dict[str | None, float] | None, default: float = 1.0,
          total: int | None = None) -> DataFrame:
    """Rows, mean repetition rate and cumulative Poisson table per source; ``total`` wanted rows, all by default."""
    n = settled(docs.groupBy(col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")))
    w = F.lit(float(default))
    for name, weight in (weights or {}).items():
        w = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(w)
    weighted = n.withColumn("weight", w)
    whole = weighted.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    target = F.lit(total).cast("double") if total is not None else F.col("rows").cast("double")
    rate = F.coalesce(F.try_divide(target * F.col("weight"), F.col("weights") * F.col("n")), F.lit(0.0))
    rated = weighted.join(F.broadcast(whole)).select("source", "n", rate.alias("rate"))  # one row on the right
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    cut = rated.withColumn("pieces", pieces).withColumn("mean", F.col("rate") / F.col("pieces"))
    # cdf[i] = exp(-mean) * sum of mean^k / k! for k up to i, summed from the small index up
    first = F.exp(-F.col("mean"))
    acc = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)),
                      F.struct(first.alias("p"), F.array(first).alias("cdf")),
                      lambda a, k: let(a["p"] * F.col("mean") / k, lambda p: F.struct(p.alias("p"), F.concat(
                          a["cdf"], F.array(F.element_at(a["cdf"], -1) + p)).alias("cdf"))))
    return cut.withColumn("cdf", acc["cdf"])


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, default: float = 1.0,
        total: int | None = None, seed: str = "mix", id_col: str = "doc_id", source: str = "source",
        text: str = "text", copy: str | None = None, order: str | None = None) -> DataFrame:
    """Copies of ``docs`` in globally shuffled order, with the copy's number and order key where named."""
    copy_name, order_name, rate_name, key_name = fresh(docs, copy or "mix_copy", order or "mix_order", "mix_rate",
                                                       "mix_key")
    table = sized(settled(rates(docs, source, weights, default, total).select(
        F.col("source").alias("_mix_source"), F.struct("mean", "pieces", "cdf").alias(rate_name))))
    key = F.md5(F.concat_ws(":", F.coalesce(col(id_col).cast("string"), F.lit("null")),
                            F.md5(F.coalesce(col(text), F.lit("null")))))
    keyed = docs.withColumn(key_name, key).join(table, col(source).eqNullSafe(F.col("_mix_source")))
    rate = col(rate_name)
    drawn = let(rate["cdf"], lambda cdf: F.aggregate(
        F.transform(F.sequence(F.lit(1), rate["pieces"]), lambda i: let(
            uniform(F.lit(seed), col(key_name), i.cast("string")),
            lambda u: F.size(F.filter(cdf, lambda c: c <= u)))), F.lit(0), lambda a, x: a + x))
    kept = [col(c) for c in docs.columns]
    copies = keyed.select(*kept, col(key_name), drawn.alias("_mix_n")).filter("_mix_n > 0").select(
        *kept, col(key_name), F.explode(F.sequence(F.lit(1), F.col("_mix_n"))).alias(copy_name))
    dealt = copies.withColumn(order_name, F.md5(F.concat_ws(":", F.lit(seed), col(key_name),
                                                            col(copy_name).cast("string"))))
    out = dealt.repartition(col(order_name)).sortWithinPartitions(order_name)
    names = [n for n, wanted in ((copy_name, copy), (order_name, order)) if wanted]
    return out.select(*kept, *[col(n) for n in names])
