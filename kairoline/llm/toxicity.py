"""Toxicity scores from positive and unlabelled texts.

A linear numpy classifier over hashed words and word beginnings is trained by non-negative risk minimisation: confirmed toxic texts are the
positives, a sample of all texts is unlabelled, and the class prior corrects the risk of calling a text clean; where the
corrected part turns negative (over-fitting) the step goes the other way. Several classifiers on different unlabelled
samples are averaged. Scoring reads whole texts.

Bounds: at most about ``positives`` toxic texts and ``unlabelled`` other texts per classifier are gathered (hash samples
of those sizes in expectation); the model has ``2 ** bits`` weights. Nothing else is collected.

Defined results: a null or empty text scores as one without words; repeated rows score alike; without a positive text
every score is 0; an empty table stays empty; labels with a null id or mark, or for unknown documents, teach nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Training:
    """Parameters; the two sample sizes bound what reaches the driver."""

    positives: int = 2500
    unlabelled: int = 5000
    models: int = 3
    bits: int = 20
    kept: int = 2000  # features with a weight: those whose share differs most between positives and unlabelled
    stems: tuple[int, ...] = (4, 5, 6)  # lengths of the word beginnings
    epochs: int = 120
    rate: float = 0.05
    decay: float = 1e-4
    beta: float = 0.0
    gamma: float = 1.0
    prior: float | None = None  # share of toxic texts; from the training labels if not given


@dataclass
class Model:
    weights: np.ndarray = field(repr=False)
    bias: float = 0.0
    empty: bool = False


def places(word: str, p: Training) -> list[int]:
    """Hashed features of one word."""
    mask = (1 << p.bits) - 1
    return [zlib.crc32(word.encode()) & mask,
            *(zlib.crc32(f"{n}:{word[:n]}".encode()) & mask for n in p.stems if len(word) >= n)]


def features(text: str | None, p: Training) -> list[int]:
    """Distinct hashed features of a whole text."""
    return sorted({f for w in set(_WORD.findall((text or "").lower())) for f in places(w, p)})


def _rows(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Flat feature numbers and the row of each."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(lists)), sizes)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, p: Training) -> Model:
    """Full-batch Adam on the non-negative risk with logistic loss."""
    size = 1 << p.bits
    if not positive:
        return Model(np.zeros(size), 0.0, True)
    (fp, rp), (fu, ru) = _rows(positive), _rows(unlabelled)
    a, c = np.bincount(fp, minlength=size) / len(positive), np.bincount(fu, minlength=size) / max(len(unlabelled), 1)
    mean = (a + c) / 2
    contrast = (a - c) ** 2 / np.maximum(mean * (1 - mean), 1e-9)
    used = np.sort(np.argsort(-contrast, kind="stable")[:p.kept])
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    (fp, rp), (fu, ru) = ((place[f][place[f] >= 0], r[place[f] >= 0]) for f, r in ((fp, rp), (fu, ru)))
    full, size = size, len(used)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0

    def margin(f, r, n):
        return np.bincount(r, weights=w[f], minlength=n) + b

    def slope(f, r, g):
        return np.bincount(f, weights=g[r], minlength=size), float(g.sum())

    np_, nu = len(positive), max(len(unlabelled), 1)
    for step in range(1, p.epochs + 1):
        zp, zu = margin(fp, rp, np_), margin(fu, ru, len(unlabelled))
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        # loss(z, +1) = log(1 + e^-z), slope s - 1; loss(z, -1) = log(1 + e^z), slope s
        clean = np.logaddexp(0, zu).sum() / nu - prior * np.logaddexp(0, zp).sum() / np_
        gp, gp0 = slope(fp, rp, (sp - 1) * prior / np_)
        gu, gu0 = slope(fu, ru, su / nu)
        gn, gn0 = slope(fp, rp, -prior * sp / np_)
        if clean >= -p.beta:
            g, g0 = gp + gu + gn, gp0 + gu0 + gn0
        else:
            g, g0 = -p.gamma * (gu + gn), -p.gamma * (gu0 + gn0)
        g = g + p.decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * g0, 0.999 * vb + 0.001 * g0 * g0
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        w -= p.rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= p.rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    weights = np.zeros(full)
    weights[used] = w
    return Model(weights, b)


def share(*parts: Column) -> Column:
    """A number in [0, 1) from md5, for samples that do not move."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("double") / float(1 << 48)


def fit(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], p: Training = Training(),
        id_col: str = "doc_id", text: str = "text", mark: str = "toxic") -> list[Model]:
    """Train on documents whose id passes ``learn``; only there are labels read."""
    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t, p))

    known = labels.filter(learn(col(id_col)) & col(id_col).isNotNull() & col(mark).isNotNull()).groupBy(
        col(id_col).alias("_id")).agg(F.max(col(mark)).alias("_mark"))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("_mark") == 1, 1)), F.lit(0))).first()
    if not toxic:
        return [train([], [], 0.5, p)]
    prior = min(max(p.prior if p.prior is not None else toxic / n, 1e-3), 0.9)
    chosen = known.filter((F.col("_mark") == 1) & (share(F.lit("p"), F.col("_id").cast("string")) < p.positives / toxic))
    pool = docs.filter(learn(col(id_col)))
    held = [np.asarray(r[0], np.int64) for r in pool.select(col(id_col).alias("_id"), col(text).alias("_text")).join(
        F.broadcast(chosen), "_id").select(hashed("_text")).toLocalIterator()]  # chosen: ``positives`` ids
    whole = pool.count()
    rows = pool.withColumn("_u", share(F.lit("u"), col(id_col).cast("string"))).filter(
        F.col("_u") < min(p.unlabelled * p.models / max(whole, 1), 1.0))
    others = [(r[0], np.asarray(r[1], np.int64)) for r in rows.select("_u", hashed(col(text))).toLocalIterator()]
    others.sort(key=lambda x: x[0])
    if len(others) < p.models:
        return [train(held, [x for _, x in others], prior, p)]
    return [train(held, [x for _, x in others[i::p.models]], prior, p) for i in range(p.models)]


def score(docs: DataFrame, models: list[Model], text: str = "text", into: str = "score", cache: int = 1_000_000,
          p: Training = Training()) -> DataFrame:
    """``docs`` with the mean probability of the models; whole texts, no shuffle."""
    if any(m.empty for m in models):
        return docs.withColumn(into, F.lit(0.0))
    stacked = np.stack([m.weights for m in models])
    active = np.flatnonzero(np.any(stacked != 0, axis=0))  # at most ``kept`` per model
    shared = docs.sparkSession.sparkContext.broadcast(
        ({int(f): i for i, f in enumerate(active)}, stacked[:, active], [m.bias for m in models]))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        number, weights, biases = shared.value

        class Known(dict):
            def __missing__(self, word: str) -> tuple[int, ...]:
                if len(self) >= cache:
                    self.clear()
                found = self[word] = tuple(number[f] for f in places(word, p) if f in number)
                return found

        known = Known()

        def one(t):
            found = set().union(*map(known.__getitem__, set(_WORD.findall((t or "").lower()))))
            z = weights[:, sorted(found)].sum(axis=1) + biases
            return float(np.mean(1 / (1 + np.exp(-np.clip(z, -500, 500)))))
        return texts.map(one)

    return docs.withColumn(into, scored(col(text)))
