"""Normal-equation sums on Spark, and the small solves that use them.

One pass adds up Z'Z for Z = [1, features, label] per segment of the table. Everything that
follows has p x p numbers: least squares, ridge, lasso, elastic net, evidence-maximised ridge, and
their cross-validated errors for any number of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gram:
    """Z'Z of the (shifted) columns [1, features, label]."""

    features: tuple[str, ...]
    shift: np.ndarray  # subtracted from features and label before summing
    sums: np.ndarray

    @property
    def n(self) -> float:
        return self.sums[0, 0]

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.features, self.shift, self.sums + other.sums)

    @property
    def means(self) -> np.ndarray:
        """Means of features and label in original units."""
        return self.shift + self.sums[0, 1:] / self.n

    @property
    def centred(self) -> np.ndarray:
        """Cross products of features and label about their means."""
        s = self.sums[0, 1:]
        return self.sums[1:, 1:] - np.outer(s, s) / self.n

    def take(self, names: Sequence[str]) -> "Gram":
        at = [self.features.index(c) for c in names]
        cols = [0, *[i + 1 for i in at], len(self.features) + 1]
        return Gram(tuple(names), self.shift[[*at, -1]], self.sums[np.ix_(cols, cols)])


def accumulate_by(df: DataFrame, features: Sequence[str], label: str, segment: str | None = None,
                  nulls: str = "error") -> dict[int, Gram]:
    """Sums per segment. A null or NaN in a used column raises with the counts per column, found in the same pass;
    ``nulls="drop"`` leaves such rows out instead.

    Columns are shifted by the values of some row first, so no digits are lost to large offsets;
    the shift changes the arithmetic only, not the sums about the mean.
    """
    cols = [*features, label]
    used = df.select(
        (F.col(segment) if segment else F.lit(0)).cast("int").alias("_segment"),
        *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)],
    )
    if nulls not in ("error", "drop"):
        raise ValueError(f"unknown null policy: {nulls}")
    row = used.na.drop().first() or (used.limit(1).count() and (0, *[0.0] * len(cols))) or None
    if row is None:
        return {}
    shift = np.array(row[1:], float)
    width = len(cols) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int | None, np.ndarray] = {}
        for batch in batches:
            seg = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(seg)), *[
                batch.column(i + 1).to_numpy(zero_copy_only=False) - shift[i] for i in range(len(cols))]])
            gaps = np.isnan(z)
            if gaps.any():
                lost = totals.setdefault(None, np.zeros((width, width)))
                lost[0] += gaps.sum(axis=0)
                whole = ~gaps.any(axis=1)
                z, seg = z[whole], seg[whole]
            for s in np.unique(seg):
                part = z[seg == s]
                totals[int(s)] = totals.get(int(s), np.zeros((width, width))) + part.T @ part
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([m.ravel().tolist() for m in totals.values()], pa.list_(pa.float64()))],
                names=["segment", "sums"])

    parts = used.mapInArrow(run, "segment int, sums array<double>")
    summed = parts.groupBy("segment").agg(Summarizer.sum(array_to_vector("sums")).alias("s"))
    rows = summed.select("segment", vector_to_array("s").alias("s")).collect()  # segments x p^2 numbers
    lost = next((r["s"][1:width] for r in rows if r["segment"] is None), None)
    if lost is not None and nulls == "error":
        where = ", ".join(f"{c} ({int(n)})" for c, n in zip(cols, lost, strict=True) if n)
        raise ValueError(f"nulls left in {where}; impute them or pass nulls='drop'")
    rows = [r for r in rows if r["segment"] is not None]
    return {r["segment"]: Gram(tuple(features), shift, np.array(r["s"]).reshape(width, width)) for r in rows}


def accumulate(df: DataFrame, features: Sequence[str], label: str) -> Gram:
    found = accumulate_by(df, features, label)
    if not found:
        raise ValueError("no complete rows")
    return found[0]


@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coef: np.ndarray
    intercept: float
    rss: float = float("nan")
    std_error: np.ndarray | None = None

    def sse(self, g: Gram) -> float:
        """Sum of squared errors of this fit on the rows summed in ``g``."""
        w = np.concatenate([[self.intercept + g.shift[:-1] @ self.coef - g.shift[-1]], self.coef, [-1.0]])
        return float(w @ g.sums @ w)


def _finish(g: Gram, coef: np.ndarray, std_error=None) -> LinearFit:
    m = g.means
    c = g.centred
    w = np.append(coef, -1.0)
    return LinearFit(g.features, coef, float(m[-1] - m[:-1] @ coef), float(w @ c @ w), std_error)


def ols(g: Gram, names: Sequence[str] | None = None) -> LinearFit:
    g = g.take(names) if names is not None else g
    c = g.centred
    xx, xy = c[:-1, :-1], c[:-1, -1]
    inverse = np.linalg.pinv(xx)
    fit = _finish(g, inverse @ xy)
    spare = g.n - len(g.features) - 1
    errors = np.sqrt(np.maximum(np.diag(inverse) * fit.rss / spare, 0)) if spare > 0 else None
    return LinearFit(fit.features, fit.coef, fit.intercept, fit.rss, errors)


def ridge(g: Gram, alpha: float) -> LinearFit:
    """Squared errors + alpha * |w|^2, intercept free."""
    c = g.centred
    return _finish(g, np.linalg.solve(c[:-1, :-1] + alpha * np.eye(len(g.features)), c[:-1, -1]))


def elastic_net(g: Gram, alpha: float, l1_ratio: float = 1.0, tol: float = 1e-10, sweeps: int = 10_000) -> LinearFit:
    """Squared errors / 2n + alpha * l1 * |w|_1 + alpha * (1 - l1) / 2 * |w|^2 by coordinate descent."""
    c = g.centred / g.n
    xx, xy = c[:-1, :-1], c[:-1, -1]
    w = np.zeros(len(xy))
    scale = np.sqrt(max(c[-1, -1], 1e-300))
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if xx[j, j] <= 0:
                continue
            pull = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha * l1_ratio, 0.0) / (xx[j, j] + alpha * (1 - l1_ratio))
            moved = max(moved, abs(new - w[j]) * np.sqrt(xx[j, j]))
            w[j] = new
        if moved <= tol * scale:
            break
    return _finish(g, w)


def bayes_ridge(g: Gram, rounds: int = 300, tol: float = 1e-3, a1: float = 1e-6, a2: float = 1e-6,
                l1: float = 1e-6, l2: float = 1e-6) -> LinearFit:
    """Ridge whose noise and weight precisions maximise the evidence (MacKay's updates)."""
    c = g.centred
    xx, xy = c[:-1, :-1], c[:-1, -1]
    values, vectors = np.linalg.eigh(xx)
    values, turned = np.maximum(values, 0.0), vectors.T @ xy
    noise, weight = 1.0 / (c[-1, -1] / g.n + np.finfo(float).eps), 1.0
    coef = None
    for _ in range(rounds):
        new = vectors @ (turned / (values + weight / noise))
        residual = np.append(new, -1.0) @ c @ np.append(new, -1.0)
        effective = np.sum(noise * values / (weight + noise * values))
        weight = (effective + 2 * l1) / (new @ new + 2 * l2)
        noise = (g.n - effective + 2 * a1) / (residual + 2 * a2)
        if coef is not None and np.abs(coef - new).sum() < tol:
            break
        coef = new
    return _finish(g, vectors @ (turned / (values + weight / noise)))
