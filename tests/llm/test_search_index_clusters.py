"""Bag search, run-length index and threshold clustering against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kairoline.llm import centroids, lexical, run_index

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k):
    cut = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in cut), sum(len(t) for _, t in cut)
    df = Counter(x for _, t in cut for x in set(t))
    out = []
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    for item, of_item in wanted.items():
        scored = []
        for d, t in cut:
            tf = Counter(t)
            m = 10 + 90 * len(t) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 8 * m))
                    for x in of_item if tf[x])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def random_docs(seed, n, words):
    rnd = random.Random(seed)
    vocab = [rnd.choice(["Ab", "ß", "x9", "É", "q"]) + str(i) for i in range(words)]
    docs = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choices(vocab, k=rnd.randint(0, 12)))) for i in range(n)]
    return vocab, docs + [(n + i, docs[i % 7][1]) for i in range(n)]


@pytest.mark.parametrize("block", [100_000, 7])
def test_search_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    vocab, docs = random_docs(3, 60, 25)
    docs += [(None, vocab[0] + " " + vocab[1]), (5, docs[5][1]), (900, None), (901, "")]
    items = [("a", " ".join(vocab[:6])), ("b", vocab[3].upper()), ("c", "unknown words"), ("d", None), (None, vocab[2]),
             ("b", vocab[4] + " " + vocab[4])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ITEM", F.lit(1)).withColumn("score", F.lit("x"))
    got = lexical.search(d.repartition(5), spark.createDataFrame(items, "item_id string, text string"), k=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items, 4)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([("a", "word")], "item_id string, text string")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "word")], "doc_id long, text string"), items.limit(0)).count() == 0


def test_classes_are_scored_once_and_expanded_by_id(spark):
    docs = spark.createDataFrame([(i, "Same words here") for i in range(500)] + [(1000, "other text")], "doc_id long, text string")
    got = lexical.search(docs, spark.createDataFrame([(1, "same OTHER")], "item_id int, text string"), k=10).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1000)] + [(i + 2, i) for i in range(9)]


def test_terms_of_a_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 16)
    text = "Große Wörter, und 12 mehr; x" * 20 + "y" * 100
    assert [t.decode() for some in lexical.terms(text.encode()) for t in some] == TERM.findall(text.translate(LOWER))


def plain_strip(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out.append((d, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]), list(zip(edges[::2].tolist(), edges[1::2].tolist()))))
    return sorted(out, key=str)


def stripped(spark, rows, length, parts=4):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted(((r["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["removed"]])
                   for r in run_index.strip(docs, length).collect()), key=str)


def passages(seed, n):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdeé ", k=rnd.randint(1, 6))) for _ in range(40)]
    shared = [" ".join(rnd.choices(words, k=30)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 25))) for _ in range(3)]
        for _ in range(rnd.randint(0, 2)):
            s = rnd.choice(shared)
            a = rnd.randint(0, len(s) // 2)
            parts.insert(rnd.randint(0, 3), s[a:a + rnd.randint(20, len(s))])
        rows.append((i, "".join(parts)))
    return rows


SPECIAL = [(100, None), (101, ""), (102, "z" * 500), (103, "z" * 39), (104, "abc" * 200), (None, "abcabc" * 150), (105, "q" * 40),
           (106, "\0" * 90), (3, "q" * 40), (107, "ab" * 2000)]


@pytest.mark.parametrize("crowd", [1000, 3])
def test_index_removes_what_windows_say(spark, monkeypatch, crowd):
    monkeypatch.setattr(run_index, "CROWD", crowd)
    monkeypatch.setattr(run_index, "BUCKET_ROWS", 40)
    rows = passages(5, 60)
    rows += [(200, rows[0][1]), (201, rows[0][1]), rows[1], (202, rows[2][1][3:] + "!"), *SPECIAL]
    for length in (40, 64, 150):
        assert stripped(spark, rows, length) == plain_strip(rows, length)


def test_index_parts_and_empty(spark, monkeypatch):
    monkeypatch.setattr(run_index, "PART_BYTES", 300)
    rows = passages(9, 40)
    assert stripped(spark, rows, 50, 1) == plain_strip(rows, 50)
    assert stripped(spark, [], 50) == []
    with pytest.raises(ValueError, match="has a column"):
        run_index.strip(spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, KEPT int"))
    docs = spark.createDataFrame([(1, "a" * 300, 2)], "doc_id long, text string, index_place int")
    assert run_index.strip(docs).columns == ["doc_id", "text", "index_place", "kept", "removed"]


def test_suffix_order_and_longest_matches():
    rnd = random.Random(2)
    for n in [*range(1, 40), 300, 400]:
        t = bytes(rnd.choice(b"ab\xff") for _ in range(n)) if n < 300 else b"abaab" * (n // 5)
        text = np.frombuffer(t, np.uint8)
        assert run_index.suffix_order(text).tolist() == sorted(range(n), key=lambda i: t[i:])

        def shared(i, j):
            k = 0
            while max(i, j) + k < n and t[i + k] == t[j + k]:
                k += 1
            return k

        if n < 300:
            longest = [max((shared(i, j) for j in range(n) if j != i), default=0) for i in range(n)]
            assert run_index.RunIndex.build(text).matching().tolist() == longest


def plain_clusters(rows, p):
    kept = [(i, [math.floor(p.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == p.dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{p.seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:p.k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), n) for n, x in enumerate(c)) for _, v in kept]

    for _ in range(p.rounds):
        who = assign()
        for n in range(len(c)):
            mine = [v for (_, v), w in zip(kept, who, strict=True) if w[1] == n]
            if mine:
                c[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    who = assign()
    inertia = Counter()
    for d, n in who:
        inertia[n] += d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest())
                   for (i, _), (d, n) in zip(kept, who, strict=True)), key=str)


def test_clusters_equal_plain(spark):
    rnd = random.Random(7)
    p = centroids.Clustering(k=5, dim=6, rounds=4, scale=8)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.25, 0.5, 2.0]) + rnd.choice([0, 0, rnd.random()]) for _ in range(6)]) for i in range(80)]
    rows += [(i, rows[0][1]) for i in range(500, 560)] + [rows[3], rows[3], (None, rows[4][1]), (700, None), (701, []), (702, [1.0] * 5),
             (703, [float("nan")] * 6), (704, [None] + [0.0] * 5), (705, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).repartition(4)
    out = centroids.with_inertia(*centroids.cluster(df, p))
    got = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain_clusters(rows, p)


def test_few_or_no_vectors(spark):
    p = centroids.Clustering(k=5, dim=2, rounds=3)
    for rows in ([(1, [1.0, 2.0]), (2, [1.0, 2.5])], []):
        out = centroids.with_inertia(*centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), p))
        assert sorted(r["distance"] for r in out.collect()) == [0] * len(rows)
    wide = spark.createDataFrame([(1, [1e9, 0.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in centroids.cluster(wide, p)[0].collect()] == [2]


def test_nearest_with_ties_and_many_centroids():
    rng = np.random.default_rng(4)
    x, c = rng.integers(-3, 4, (300, 5)), rng.integers(-3, 4, (40, 5))
    who, far, met = centroids.nearest(x, c)
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    assert who.tolist() == d.argmin(1).tolist() and far.tolist() == d.min(1).tolist()
    assert met.max() <= 40
    x, c = rng.integers(0, 1000, (200, 2)), rng.integers(0, 1000, (200, 2))
    who, _, met = centroids.nearest(x, c)
    assert who.tolist() == ((x[:, None] - c[None]) ** 2).sum(2).argmin(1).tolist() and met.mean() < 100
