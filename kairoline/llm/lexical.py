"""Ranked lexical search for a set of items over all documents, scoring every bag of item words once.

Of a document only the words of items matter, with their counts, and its length class ``m``. Documents that agree in
all of these are one class: bags are grouped by hash, the whole bag is compared with it, and the class is scored once for all items.
A task keeps the best classes per item, by score and then by the smallest member; no document outside of an item's ``k``
best classes can be among its ``k`` best documents, since each class ahead holds one that is ahead too. Only these classes
are expanded, by ascending document id.

Items go in blocks of about ``BLOCK_TERMS`` words, so that what a task holds does not grow with the number of items.
A task receives one number per word and class; documents are counted, never collected.

Weights: with ``N`` documents that hold a term, ``L`` terms in all and ``df`` documents with the term, a term weighs
``floor(1000 ln((2N + 2) / (2 df + 1)))``; a document of ``n`` terms has ``m = 10 + (90 n N) div L`` and scores the sum of
``w * ((10^9 tf) div (1000 tf + 8 m))``. Terms are maximal runs of ASCII letters, digits and code points beyond ASCII; only
A-Z are lower-cased.

Defined results: a null or empty text has no terms. Rows are documents, repeated ones too; a null document id comes last.
Rows with one item id are one item with the terms of all, a null item id is an item; items without a known term give no
rows; further columns of either table are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairoline.llm.common import col, settled, sized

#: Words of a block of items, in expectation.
BLOCK_TERMS = 100_000
#: Scores that a task holds at once.
SCORES = 1_000_000
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 22
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8, some at a time; bytes of code points beyond ASCII are 128 and more."""
    clean, at = raw.translate(_TABLE), 0
    while len(clean) - at > PIECE:
        end = clean.find(b" ", at + PIECE)
        if end < 0:
            break
        yield clean[at:end].split()
        at = end
    yield clean[at:].split()


def item_terms(items: DataFrame, item_col: str, text: str) -> DataFrame:
    """Distinct terms (as bytes) of every item."""
    kind = items.schema[item_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for some in terms(raw or b"") for t in some}) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "term"])

    rows = items.select(col(item_col).alias("item"), col(text).cast("binary").alias("raw"))
    return rows.mapInArrow(cut, f"item {kind}, term array<binary>").select("item", F.explode("term").alias("term")).distinct()


def bags(docs: DataFrame, number: dict[bytes, int], id_col: str, text: str) -> DataFrame:
    """Per document ``n`` (terms in all) and its bag: numbers and counts of item words, in order of the numbers."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, found = [], []
            for raw in batch.column(1).to_pylist():
                n, bag = 0, Counter()
                for some in terms(raw or b""):
                    n += len(some)
                    bag.update(filter(known.__contains__, some))
                pairs = np.array(sorted((known[t], c) for t, c in bag.items()), "<i8").reshape(-1, 2)
                sizes.append(n)
                found.append(np.ascontiguousarray(pairs.T).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                                             ["id", "n", "bag"])

    rows = docs.select(col(id_col).alias("id"), col(text).cast("binary").alias("raw"))
    return rows.mapInArrow(count, f"id {kind}, n bigint, bag binary")


def unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(bag, "<i8").reshape(2, -1)
    return both[0], both[1]


def _score(classes: DataFrame, weight: np.ndarray, starts: np.ndarray, items: np.ndarray, n_items: int, k: int) -> DataFrame:
    """The best classes of each item as seen by each task: ``number`` (of the item), ``score`` and the class."""
    shared = classes.sparkSession.sparkContext.broadcast((weight, starts, items))
    kind = classes.schema["first"].dataType.simpleString()

    def heads(number: np.ndarray) -> np.ndarray:
        """The first ``k`` of every run of equal numbers."""
        new = np.concatenate([[True], number[1:] != number[:-1]])
        place = np.arange(len(number))
        return place - np.maximum.accumulate(np.where(new, place, 0)) < k

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, begin, item_of = shared.value
        kept, least = None, np.ones(n_items, np.int64)
        for batch in batches:
            batch = pa.Table.from_batches([batch]).sort_by([("first_missing", "ascending"), ("first", "ascending")])
            for at in range(0, batch.num_rows, max(1, SCORES // n_items)):
                some = batch.slice(at, max(1, SCORES // n_items))
                total = np.zeros((some.num_rows, n_items), np.int64)
                for row, (m, bag) in enumerate(zip(some.column("m").to_pylist(), some.column("bag").to_pylist(), strict=True)):
                    t, tf = unpack(bag)
                    gain = w[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                    size = begin[t + 1] - begin[t]
                    of = np.repeat(begin[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    np.add.at(total[row], item_of[of], np.repeat(gain, size))
                if len(total) > k:
                    least = np.maximum(least, np.partition(total, len(total) - k, axis=0)[len(total) - k])
                row, number = np.nonzero(total >= least)
                if not len(row):
                    continue
                order = np.lexsort((row, -total[row, number], number))
                order = order[heads(number[order])]
                new = some.take(pa.array(row[order])).append_column("number", pa.array(number[order].astype(np.int32))).append_column(
                    "score", pa.array(total[row[order], number[order]]))
                kept = new if kept is None else pa.concat_tables([kept, new])
                kept = kept.sort_by([("number", "ascending"), ("score", "descending"), ("first_missing", "ascending"),
                                     ("first", "ascending")])
                kept = kept.filter(pa.array(heads(kept.column("number").to_numpy()))).combine_chunks()
                number, last = np.unique(kept.column("number").to_numpy()[::-1], return_index=True)
                full = np.bincount(kept.column("number").to_numpy(), minlength=n_items)[number] == k
                least[number[full]] = kept.column("score").to_numpy()[::-1][last[full]]
        if kept is not None:
            yield from kept.select(["number", "score", "m", "bag", "first", "first_missing"]).to_batches()

    return classes.select("m", "bag", "first", F.col("first").isNull().alias("first_missing")).mapInArrow(
        score, f"number int, score bigint, m bigint, bag binary, first {kind}, first_missing boolean")


def _best(rows: DataFrame, by: list[Column], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts every task's share to ``k`` rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
           text: str = "text") -> DataFrame:
    """``item_col``, ``rank`` (from 1), the document's id under ``id_col`` and ``score``."""
    wanted = settled(item_terms(items, item_col, text))
    n_blocks = max(1, math.ceil(wanted.count() / BLOCK_TERMS))
    found = [_search_block(docs, wanted.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b), k, id_col, text)
             for b in range(n_blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _search_block(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text: str) -> DataFrame:
    rows = wanted.orderBy("term").collect()  # about BLOCK_TERMS rows
    names: dict = {}
    number: dict[bytes, int] = {}
    pairs = [(number.setdefault(bytes(r["term"]), len(number)), names.setdefault(r["item"], len(names))) for r in rows]
    of_term = np.array([p[0] for p in pairs], np.int64)
    postings = np.array([p[1] for p in pairs], np.int64)[np.argsort(of_term, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(of_term, minlength=len(number)))]).astype(np.int64)
    own = settled(bags(docs, number, id_col, text))
    n_docs, n_terms = own.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.lit(10) + F.expr(f"(90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    known = own.filter(F.length("bag") > 0).select("id", m.alias("m"), F.xxhash64("bag").alias("hash"), "bag")
    # grouped by hash, length class and the whole bag: equal hashes of different bags stay apart
    classes = settled(known.groupBy("hash", "m", "bag").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("first")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(number), np.int64)
        for batch in batches:
            for bag, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                df[unpack(bag)[0]] += n
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(df[used])], ["term", "n"])

    df = np.zeros(len(number), np.int64)
    for t, n in classes.select("bag", "members").mapInArrow(count, "term int, n bigint").groupBy("term").agg(
            F.sum("n")).collect():  # one row per term of the block
        df[t] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    item_kind = wanted.schema["item"].dataType.simpleString()
    best = settled(_best(_score(classes, weight, starts, postings, len(names), k), [F.col("number")],
                         [F.desc("score"), F.asc_nulls_last("first")], k))
    labels = wanted.sparkSession.createDataFrame([(i, name) for name, i in names.items()], f"number int, item {item_kind}")
    top = sized(settled(best.select(F.xxhash64("bag").alias("hash"), "m", "bag").distinct()), k * BLOCK_TERMS)
    members = _best(known.join(top, ["hash", "m", "bag"]), [F.col("hash"), F.col("m"), F.col("bag")],
                    [F.asc_nulls_last("id")], k).drop("rank")
    out = best.drop("rank").withColumn("hash", F.xxhash64("bag")).join(members, ["hash", "m", "bag"])
    return _best(out, [F.col("number")], [F.desc("score"), F.asc_nulls_last("id")], k).join(
        F.broadcast(labels), "number").select("item", "rank", "id", "score")
