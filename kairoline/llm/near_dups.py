"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Every text becomes a weighted bag of five-word shingles: how often the
shingle occurs times its inverse document frequency, which a count-min table of fixed size estimates from all texts.
Consistent weighted samples of the bag form a sketch; bands of it are the buckets. Equal texts collapse to one sketch
before anything is bucketed, and only texts that share a bucket with another one travel again. Links are candidate pairs whose
weighted Jaccard similarity, computed from the whole texts, is at least the threshold, and classes are the connected
components of the links.

A bucket never emits all its pairs. Every member is first linked with the smallest member of one of its buckets, the one
whose sketch agrees best. Members of a bucket that are then still in different classes are compared in
blocks, sketch against sketch, and pairs that could reach the threshold are verified inside the block, which emits only
links that join two classes. So output stays in proportion to the members, and no candidate link between two classes is
left out.

Defined results: a text with one to four words has one shingle, its whole word list; texts without words are alike only
if they are equal; a null text is in no class with another row. Rows without an id take part; the class id is the
smallest id of the class, null if it has none. Repeated rows are in one class. An empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, fresh, settled, sized, words

SHINGLE = 5
#: Twelve bands of three: a pair at the threshold shares no bucket with odds of 2 in 10,000, one at 0.9 of 1 in 10^7.
SAMPLES = 36
BAND = 3
THRESHOLD = 0.8
FLOOR = 0.8
#: Count-min table: rows x 2^CELLS counters, 8 MB whatever the size of the corpus.
ROWS, CELLS = 2, 20
#: A pair at the threshold has sketches that agree in fewer samples with odds of about 2 in 10,000.
MAYBE = 20
BLOCK = 512
_POOL = 1 << 16
_WORD = re.compile(r"[^ \t-\r]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def hash_words(text: str) -> np.ndarray:
    """``word_hashes`` of one text, inside a task."""
    return np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in _WORD.findall(text)], np.uint64).view(np.int64)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """64-bit shingles of a list of word hashes, in order of position."""
    h = hashes.astype(np.int64).view(np.uint64)
    n = len(h)
    if n == 0:
        return h
    width = min(SHINGLE, n)
    out = np.zeros(n - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * _ODD + _mix(h[k:n - width + 1 + k])
        return _mix(out + np.uint64(width))


def _cells(s: np.ndarray) -> list[np.ndarray]:
    return [((s >> np.uint64(20 * r)) & np.uint64((1 << CELLS) - 1)).astype(np.int64) + (r << CELLS)
            for r in range(ROWS)]


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.compress(counts.astype("<i8").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i8")


def document_frequencies(distinct: DataFrame, text: str) -> np.ndarray:
    """The count-min table of shingles over all texts, the number of texts last.

    Tasks emit their non-empty slices of the table, compressed, since those of a small task are nearly empty; slices are
    added in a shuffle, and the sum has a fixed size.
    """
    piece = 4096

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, waiting, queue = np.zeros(ROWS << CELLS, np.int64), 0, 0, []

        def drain():
            if queue:
                rows = held.reshape(ROWS, -1)
                for r, cells in enumerate(_cells(np.concatenate(queue))):
                    rows[r] += np.bincount(cells - (r << CELLS), minlength=1 << CELLS)
                queue.clear()

        for batch in batches:
            for x in _lists(batch.column(0)):
                queue.append(np.unique(shingles(x)))
                waiting += len(x)
                n += 1
                if waiting > 500_000:
                    drain()
                    waiting = 0
        drain()
        if n:
            parts = held.reshape(-1, piece)
            used = np.flatnonzero(parts.any(axis=1))
            yield pa.RecordBatch.from_arrays([
                pa.array([*used.tolist(), -1], pa.int32()),
                pa.array([*(_packed(parts[i]) for i in used), _packed(np.array([n]))], pa.binary())], ["piece", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(_unpacked(b.as_py()) for b in table.column("counts"))
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    rows = distinct.select(word_hashes(col(text)).alias("h")).mapInArrow(count, "piece int, counts binary").groupBy(
        "piece").applyInArrow(add, "piece int, counts binary").collect()  # ROWS * 2^CELLS counters in all
    out = np.zeros((ROWS << CELLS) + 1, np.int64)
    for r in rows:
        got = np.frombuffer(r.counts, "<i8")
        if r.piece < 0:
            out[-1] = got[0]
        else:
            out[r.piece * piece:(r.piece + 1) * piece] = got
    return out.astype(np.int32) if out.max(initial=0) < 1 << 31 else out


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield values[a:b]


def weigh(hashes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text and their TF-IDF weights.

    The idf is 1 up to a frequency of the square root of the number of texts, then falls with the logarithm, to no less
    than ``FLOOR``: without a floor a large group of near copies would make its own text weightless against its edits.
    """
    s, tf = np.unique(shingles(hashes), return_counts=True)
    df = np.minimum.reduce([table[c] for c in _cells(s)]) if len(s) else np.zeros(0)
    idf = 2 * np.log((1.0 + table[-1]) / (1.0 + df)) / np.log(1.0 + max(table[-1], 1))
    return s, tf * np.clip(idf, FLOOR, 1.0)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - low
    return float(low / whole) if whole > 0 else 0.0


def _pools() -> tuple[np.ndarray, ...]:
    """r and c from Gamma(2, 1) and beta from U(0, 1), drawn once; a shingle picks its entry by hash, per sample."""
    g = np.random.default_rng(20240601)
    r = g.gamma(2.0, 1.0, _POOL).astype(np.float32)
    return r, (1 / r).astype(np.float32), np.log(g.gamma(2.0, 1.0, _POOL)).astype(np.float32), g.random(_POOL, np.float32)


def sketches(bags: list[tuple[np.ndarray, np.ndarray]], samples: int = SAMPLES) -> np.ndarray:
    """One row of 32-bit samples per non-empty bag.

    For sample k and weight S: t = floor(ln S / r + beta), ln a = ln c - r (t - beta) - r; the shingle with the least a,
    together with t, is the sample. The 32 bits come from both.
    """
    r, inverse, log_c, beta = _pools()
    keys = (np.random.default_rng(7).integers(0, 1 << 63, samples, np.uint64) << np.uint64(1)) | np.uint64(1)
    out = np.empty((len(bags), samples), np.int32)
    at = 0
    while at < len(bags):  # some ten thousand shingles at a time stay in the processor's cache
        end, n = at, 0
        while end < len(bags) and (end == at or n + len(bags[end][0]) <= 16_000):
            n += len(bags[end][0])
            end += 1
        s = np.concatenate([b[0] for b in bags[at:end]])
        log_s = np.log(np.concatenate([b[1] for b in bags[at:end]])).astype(np.float32)
        starts = np.cumsum([0, *(len(b[0]) for b in bags[at:end - 1])])
        x, i, name = np.empty(n, np.uint64), np.empty(n, np.int64), np.empty(n, np.uint64)
        t, u, g = (np.empty(n, np.float32) for _ in range(3))
        sign, rank = np.empty(n, np.int32), np.empty(n, np.int64)
        for k in range(samples):
            np.multiply(s, keys[k], out=x)
            np.right_shift(x, np.uint64(48), out=i.view(np.uint64))
            np.take(beta, i, out=u, mode="clip")
            np.take(inverse, i, out=t, mode="clip")
            t *= log_s
            t += u
            np.floor(t, out=t)
            np.subtract(t, u, out=u)
            u += np.float32(1)
            np.take(r, i, out=g, mode="clip")
            u *= g
            np.take(log_c, i, out=g, mode="clip")
            g -= u
            bits = g.view(np.int32)  # as an integer that sorts like the float
            np.right_shift(bits, 31, out=sign)
            sign &= np.int32(0x7FFFFFFF)
            sign ^= bits
            rank[:] = sign
            rank <<= 32
            x >>= np.uint64(16)
            np.multiply(t, np.float32(8191), out=t)
            name[:] = t.astype(np.int64).view(np.uint64)
            x += name
            x &= np.uint64(0xFFFFFFFF)
            rank |= x.view(np.int64)
            out[at:end, k] = np.minimum.reduceat(rank, starts).astype(np.uint32).view(np.int32)
        at = end
    return out


def _bands(sketch: np.ndarray) -> np.ndarray:
    """64-bit bucket keys, one per band."""
    out = np.zeros((len(sketch), sketch.shape[1] // BAND), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(out.shape[1]):
            h = np.full(len(sketch), b + 1, np.uint64)
            for k in range(BAND):
                h = _mix(h * _ODD + sketch[:, b * BAND + k].view(np.uint32).astype(np.uint64))
            out[:, b] = h
    return out.view(np.int64)


def sketched(distinct: DataFrame, shared: Broadcast) -> DataFrame:
    """``tid``, sketch and bucket keys of every text that has words; equal texts give equal rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                lists = list(_lists(batch.column(1)))
                full = [i for i, x in enumerate(lists) if len(x)]
                sk = sketches([weigh(lists[i], shared.value) for i in full])
                bands = _bands(sk)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(full, pa.int64())),
                    pa.array([row.tobytes() for row in sk.astype("<i4")], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * bands.shape[1]),
                                             pa.array(bands.reshape(-1)))], ["tid", "sketch", "bands"])

    return distinct.select("tid", word_hashes(F.col("text")).alias("h")).mapInArrow(
        run, "tid string, sketch binary, bands array<bigint>")


def compared(pairs: DataFrame, distinct: DataFrame, shared: Broadcast) -> DataFrame:
    """``pairs`` (a, b) with the weighted Jaccard similarity ``s`` of their whole texts."""
    @F.pandas_udf("double")
    def exact(left: pd.Series, right: pd.Series) -> pd.Series:
        last_key, last = None, None
        out = []
        for x, y in zip(left, right, strict=True):
            key = y.tobytes()
            if key != last_key:
                last_key, last = key, weigh(y, shared.value)
            out.append(similarity(weigh(x, shared.value), last))
        return pd.Series(out, dtype="float64")

    a = distinct.select(F.col("tid").alias("a"), F.col("text").alias("left"))
    b = distinct.select(F.col("tid").alias("b"), F.col("text").alias("right"))
    return pairs.join(a, "a").join(b, "b").select(
        "a", "b", exact(word_hashes(F.col("left")), word_hashes(F.col("right"))).alias("s"))


def _to_roots(df: DataFrame, labels: DataFrame | None, key: str, name: str) -> DataFrame:
    """``df`` with the root of ``key``; what has no label is its own root."""
    if labels is None:
        return df.withColumn(name, F.col(key))
    known = labels.select(F.col("tid").alias(key), F.col("root").alias(f"_{name}"))
    return df.join(known, key, "left").withColumn(name, F.coalesce(f"_{name}", key)).drop(f"_{name}")


def _flattened(parents: DataFrame) -> DataFrame:
    """A forest of ``tid`` and a smaller ``root`` with every path cut short to its end; paths halve twice a step."""
    while True:
        up = parents.select(F.col("tid").alias("root"), F.col("root").alias("up"))
        once = parents.join(up, "root", "left").select("tid", F.coalesce("up", "root").alias("root"))
        far = once.select(F.col("tid").alias("root"), F.col("root").alias("up"))
        parents = settled(once.join(far, "root", "left").select(
            "tid", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
        done = not parents.agg(F.max("moved")).first()[0]
        parents = parents.select("tid", "root")
        if done:
            return parents


def components(edges: DataFrame) -> DataFrame | None:
    """``tid`` and the smallest ``tid`` of its component, for all vertices but the smallest of each; ``None`` if there is
    no edge (a, b).

    Every root hooks on to the smallest root it has an edge to, if that is smaller; the forest is flattened and edges are
    drawn between its roots, until none is left. Two passes at least halve the roots that still have edges.
    """
    labels = None
    while True:
        ends = _to_roots(_to_roots(edges, labels, "a", "ra"), labels, "b", "rb").filter("ra <> rb").select(
            F.greatest("ra", "rb").alias("tid"), F.least("ra", "rb").alias("root"))
        hooks = settled(ends.groupBy("tid").agg(F.min("root").alias("root"),
                                                (F.max("root") > F.min("root")).alias("more")))
        more = hooks.agg(F.max("more")).first()[0]
        if more is None:
            return labels
        flat = _flattened(hooks.select("tid", "root"))
        labels = flat if labels is None else settled(_to_roots(
            labels.withColumnRenamed("root", "was"), flat, "was", "root").select("tid", "root").union(flat))
        if not more:  # every edge is one of the forest
            return labels


def _blocks(members: DataFrame, *carried: str) -> DataFrame:
    """``members`` of each bucket as block pairs (i, j): outsiders against all, ``out`` marks the outsiders.

    Outsiders are not in the class of the bucket's first member (``main``), so members of a large class are never compared
    among themselves.
    """
    counts = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("root") != F.col("main"), 1).otherwise(0)).alias("outside"))
    pieces = counts.filter("outside > 0").select(
        "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("np"), F.ceil(F.col("outside") / BLOCK).cast("int").alias("no"))
    placed = members.join(pieces, "bucket")

    def slot(count: str) -> Column:
        return F.pmod(F.xxhash64("tid"), F.col(count)).cast("int")

    def all_of(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    rest = ["tid", "root", "band", "sketch", *carried]
    left = placed.filter("root <> main").select("bucket", slot("no").alias("i"), all_of("np").alias("j"),
                                                F.lit(True).alias("out"), *rest)
    right = placed.select("bucket", all_of("no").alias("i"), slot("np").alias("j"), F.lit(False).alias("out"), *rest)
    return left.union(right)


def _close(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each outsider of a block, and the members in other classes that it could be linked to.

    A pair that shares several buckets is taken in its first one only.
    """
    out = table.column("out").to_numpy(zero_copy_only=False).astype(bool)
    root = np.array(table.column("root").to_pylist(), object)
    sk = np.frombuffer(b"".join(x.as_py() for x in table.column("sketch")), "<i4").reshape(len(root), -1)
    band = table.column("band")[0].as_py() if len(root) else 0
    m = np.flatnonzero(~out)
    for i in np.flatnonzero(out).tolist():
        same = sk[m] == sk[i]
        good = (same.sum(axis=1) >= MAYBE) & (root[m] != root[i])
        if good.any():
            shared = same[good].reshape(int(good.sum()), -1, BAND).all(axis=2)
            found = m[good][shared.argmax(axis=1) == band]
            if len(found):
                yield i, found


def _cross_links(members: DataFrame, distinct: DataFrame, shared: Broadcast, threshold: float) -> DataFrame:
    """Verified links (a, b) that join the classes ``ra`` and ``rb``, which share a bucket."""
    def flag(block: pa.Table) -> pa.Table:
        tid, found = block.column("tid").to_pylist(), set()
        for i, near in _close(block):
            found.add(tid[i])
            found.update(tid[n] for n in near.tolist())
        return pa.table({"tid": pa.array(sorted(found), pa.string()),
                         "bucket": pa.array([block.column("bucket")[0].as_py()] * len(found), pa.int64())})

    def link(block: pa.Table) -> pa.Table:
        tid, root = block.column("tid").to_pylist(), block.column("root").to_pylist()
        texts = block.column("text")
        bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        above: dict[str, str] = {}

        def top(x: str) -> str:
            while x in above:
                x = above[x]
            return x

        def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in bags:
                bags[i] = weigh(hash_words(texts[i].as_py()), shared.value)
            return bags[i]

        ends = []
        for i, near in _close(block):
            for n in near.tolist():
                x, y = top(root[i]), top(root[n])
                if x != y and similarity(bag(i), bag(n)) >= threshold:
                    above[max(x, y)] = min(x, y)
                    ends.append((tid[i], tid[n], root[i], root[n]))
        return pa.table({name: pa.array([e[k] for e in ends], pa.string()) for k, name in enumerate(("a", "b", "ra", "rb"))})

    flagged = settled(_blocks(members).groupBy("bucket", "i", "j").applyInArrow(
        flag, "tid string, bucket bigint").distinct())
    full = members.join(flagged, ["bucket", "tid"]).join(distinct, "tid")
    return _blocks(full, "text").groupBy("bucket", "i", "j").applyInArrow(
        link, "a string, b string, ra string, rb string")


def _agreement(pairs: DataFrame, sk: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the number of samples in which their sketches agree."""
    @F.pandas_udf("int")
    def same(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="int32")
        u, v = (np.frombuffer(b"".join(s), "<i4").reshape(len(s), -1) for s in (x, y))
        return pd.Series((u == v).sum(axis=1).astype(np.int32))

    left = sk.select(F.col("tid").alias("a"), F.col("sketch").alias("sa"))
    right = sk.select(F.col("tid").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", same("sa", "sb").alias("same"))


def links(texts: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between different texts, and the class root of every linked text that is not one itself.

    ``texts``: ``tid`` and ``text``, one row per document.
    """
    table = texts.sparkSession.sparkContext.broadcast(document_frequencies(texts, "text"))  # one copy for all steps
    sk = settled(sketched(texts, table).groupBy("tid").agg(
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands")))
    buckets = sk.select("tid", F.posexplode("bands").alias("band", "bucket"))
    first = buckets.groupBy("bucket").agg(F.min("tid").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settled(buckets.join(first, "bucket").select("bucket", "band", "tid", "b"))
    stars = settled(_agreement(shared.filter("tid <> b").select(F.col("tid").alias("a"), "b").distinct(), sk)
                    .filter(F.col("same") >= MAYBE))
    involved = sized(settled(shared.select("tid").distinct()))
    distinct = settled(texts.join(involved, "tid", "left_semi").dropDuplicates(["tid"]))
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("same", "b")).alias("b"))
    found = settled(compared(best, distinct, table).filter(F.col("s") >= threshold).select("a", "b"))
    labels = components(found)
    members = _to_roots(_to_roots(shared, labels, "tid", "root"), labels, "b", "main")
    mixed = members.filter("root <> main").select("bucket").distinct()
    members = settled(members.join(mixed, "bucket").join(sk.select("tid", "sketch"), "tid"))
    last = settled(_cross_links(members, distinct, table, threshold))
    above = components(last.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    if labels is None:
        labels = above
    elif above is not None:
        labels = settled(_to_roots(labels.withColumnRenamed("root", "was"), above, "was", "root").select(
            "tid", "root").union(above))
    if labels is None:
        labels = texts.sparkSession.createDataFrame([], "tid string, root string")
    return found.union(last.select("a", "b")), labels


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``id_col``, ``tid`` (digest of the text), ``class_key``, ``class_id``, ``class_size`` and
    ``first`` (the row's id and text represent the class)."""
    rows = settled(docs.select(col(id_col).alias("id"), F.md5(col(text)).alias("tid")))
    texts = docs.filter(col(text).isNotNull()).select(F.md5(col(text)).alias("tid"), col(text).alias("text"))
    _, labels = links(texts, threshold)
    rooted = rows.join(labels, "tid", "left").withColumn("class_key", F.coalesce(
        "root", "tid", F.concat(F.lit("null:"), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    per = rooted.groupBy("class_key").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tid")).alias("rep"))
    out = rooted.join(per, "class_key")
    is_first = out["id"].eqNullSafe(F.col("rep.id")) & out["tid"].eqNullSafe(F.col("rep.tid"))
    return out.select(F.col("id").alias(id_col), "tid", "class_key", "class_id", "class_size", is_first.alias("first"))


def _row_key(id_: Column, tid: Column) -> Column:
    return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), F.coalesce(tid, F.lit("-")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of every class: the one with the smallest id; of rows equal in id and text, one. Rows with a null
    text are in classes by their id.

    Texts move only where rows are equal in id and text, or where the rows to drop are too many to broadcast.
    """
    (key,) = fresh(docs, "near_key")
    judged = settled(classes(docs, id_col, text, threshold).select(
        _row_key(col(id_col), F.col("tid")).alias(key), "first"))
    dropped = sized(settled(judged.filter(~F.col("first")).select(key).distinct()))
    marked = docs.withColumn(key, _row_key(col(id_col), F.md5(col(text)))).join(dropped, key, "left_anti")
    twice = settled(judged.filter("first").groupBy(key).count().filter("count > 1").select(key))
    if twice.limit(1).count():
        again = sized(twice)
        marked = marked.join(again, key, "left_anti").unionByName(
            marked.join(again, key, "left_semi").dropDuplicates([key]))
    return marked.select(*[col(c) for c in docs.columns])
