"""Feature scores: mutual information, lasso path, linear contributions, permutation importance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Transformer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairoline.operators import gram, profile
from kairoline.operators.contract import long_form
from kairoline.operators.order import positions
from kairoline.operators.quantiles import IN_MEMORY_ROWS, quantiles


def _bin(column: str, cuts: Sequence[float]):
    out = F.lit(0)
    for cut in cuts:
        out = out + (F.col(column) > F.lit(float(cut))).cast("int")
    return out


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10,
                       limit: int = IN_MEMORY_ROWS) -> DataFrame:
    """Mutual information (nats) between quantile bins of every feature and of the label.

    All features are counted in one pass; the count table has bins x bins rows per feature.
    """
    names = [*features, label]
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    n = df.count()
    cut_rows = quantiles(profile.melt(df, names), ["column"], "value", probs, limit,
                         n if n <= limit else None).collect()  # one row per column
    cuts = {r["column"]: sorted({r[p] for p in probs}) for r in cut_rows}
    binned = df.select(*[_bin(c, cuts.get(c, [])).alias(c) for c in names], *[F.col(c).isNotNull().alias(f"_ok_{c}") for c in names])
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bx"), F.col(f"_ok_{f}").alias("ok")) for f in features])
    counts = (
        binned.where(f"`_ok_{label}`").select(F.col(label).alias("by"), F.explode(cells).alias("_c")).select("by", "_c.*").where("ok")
        .groupBy("feature", "bx", "by").agg(F.count("*").cast("double").alias("n"))
    )
    per = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))  # noqa: E731 - bins x bins rows
    joint = counts.select("feature", "n", per("bx").alias("nx"), per("by").alias("ny"), per().alias("nn"))
    return joint.groupBy("feature").agg(
        F.sum(F.col("n") / F.col("nn") * F.log(F.col("n") * F.col("nn") / (F.col("nx") * F.col("ny")))).alias("mutual_info"))


def lasso_path(df: DataFrame, features: Sequence[str], label: str, order: Sequence[str], folds: int = 5,
               n_alphas: int = 100, eps: float = 1e-3) -> DataFrame:
    """Lasso on standardised features, its penalty chosen by cross-validation over contiguous folds.

    One pass collects sums per fold; the whole path and all folds are solved from them.
    Columns: ``feature``, ``coef`` (standardised), ``alpha``.
    """
    placed = positions(df.select(*order, *[c for c in (*features, label) if c not in order]), order)
    n = placed.count()
    sizes = [n // folds + (i < n % folds) for i in range(folds)]
    starts = np.cumsum([0, *sizes])[1:-1]
    fold = F.lit(0)
    for start in starts:
        fold = fold + (F.col("pos") >= F.lit(int(start))).cast("int")
    parts = gram.accumulate_by(placed.withColumn("_fold", fold), features, label, "_fold")
    total = sum((parts[i] for i in range(1, folds)), parts[0])
    spread = np.sqrt(np.diag(total.centred)[:-1] / total.n)
    unit = np.concatenate([[1.0], 1.0 / np.where(spread > 0, spread, 1.0), [1.0]])
    scaled = {i: gram.Gram(g.features, g.shift * unit[1:], g.sums * np.outer(unit, unit)) for i, g in parts.items()}
    whole = sum((scaled[i] for i in range(1, folds)), scaled[0])
    top = np.abs(whole.centred[:-1, -1]).max() / whole.n
    alphas = top * np.logspace(0, np.log10(eps), n_alphas)
    errors = np.zeros(n_alphas)
    for i in range(folds):
        train = sum((scaled[j] for j in range(folds) if j not in (i, (i + 1) % folds)), scaled[(i + 1) % folds])
        for a, alpha in enumerate(alphas):
            errors[a] += gram.elastic_net(train, alpha).sse(scaled[i]) / scaled[i].n
    best = float(alphas[int(errors.argmin())])
    fit = gram.elastic_net(whole, best)
    return df.sparkSession.createDataFrame(
        [(f, float(c), best) for f, c in zip(features, fit.coef)], "feature string, coef double, alpha double")


def linear_contributions(df: DataFrame, coefficients: dict[str, float], means: dict[str, float]) -> DataFrame:
    """Adds ``contrib_<feature>`` = w (x - mean): each feature's share of prediction - mean prediction."""
    return df.withColumns({f"contrib_{c}": F.lit(float(w)) * (F.col(c) - F.lit(float(means[c]))) for c, w in coefficients.items()})


def mean_contributions(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature: the global ranking of the linear attribution."""
    row = df.agg(*[F.avg(F.abs(f"contrib_{f}")).alias(f) for f in features])
    return long_form(row, [(f,) for f in features], list(features), ("feature",), "importance")


def tree_importances(features: Sequence[str], model, spark, top: int | None = None) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out


def permutation_importance(df: DataFrame, model: Transformer, features: Sequence[str], label: str,
                           ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Rise of the RMSE when one column is shuffled against the others.

    The rows get one random order; every column is then read from the row ``shift`` places away
    in it, a random partner that differs per feature. All features share one shuffle of the table
    and one scoring pass.
    """
    keep = list(dict.fromkeys([*ids, *features, label]))
    # A hash of the ids keeps the random order the same when a task is rerun.
    placed = positions(df.select(*keep).withColumn("_random", F.xxhash64(F.lit(seed), *ids)), ["_random", *ids])
    n = placed.count()
    rng = np.random.default_rng(seed)
    shifts = {f: int(rng.integers(1, n)) if n > 1 else 0 for f in features}
    variants = [placed.select(*keep, F.lit("").alias("feature"))]
    donated = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.pmod(F.col("pos") + F.lit(s), F.lit(n)).alias("pos"), F.col(f).cast("double").alias("_new"))
        for f, s in shifts.items()
    ]))
    moved = placed.select(donated.alias("_d")).select("_d.*")
    changed = placed.join(moved, "pos")
    variants.append(changed.select(
        *[F.when(F.col("feature") == c, F.col("_new")).otherwise(F.col(c).cast("double")).alias(c) if c in features else F.col(c)
          for c in keep], "feature"))
    scored = model.transform(variants[0].unionByName(variants[1]))
    errors = scored.groupBy("feature").agg(profile.rmse(label, "prediction").alias("rmse"))
    base = errors.where("feature = ''").select(F.col("rmse").alias("_base"))
    return errors.where("feature <> ''").join(F.broadcast(base), F.lit(True)).select(
        "feature", (F.col("rmse") - F.col("_base")).alias("importance"), F.col("_base").alias("base_rmse"))

