"""Substring dedup: repeated runs of consecutive sentences, and repeated passages that no sentence end bounds.

Every text is cut into sentences. The shortest runs with at least ``SENTENCES`` sentences and ``RUN_WORDS`` words are
taken forwards from each sentence and backwards from each, so every sentence of a longer repeated run lies in a repeated
shortest one. The first place of a run (smallest id, then smallest digest of the text, then position) stays; at every
other place all sentences of the run are removed.

A window of ``PASSAGE`` words is removed, wherever its sentences begin and end, if it stands at an earlier place that it
does not overlap. Windows are compared all, but only near words that can be repeated: in every ``PASSAGE`` words at
least one group of ``GRAM`` words has the smallest hash of its surroundings, whatever stands around the passage, and
only windows whose own smallest group occurs twice are hashed.

Bare hashes travel first: of the shortest run forwards from each sentence and of those groups, counted with map-side
combining, so one that very many documents share is one row per task before the shuffle. What occurs twice goes into a
bitmap of ``BITMAP`` bits, which finds the documents to look at again (every repeated run begins with a repeated
shortest one). The bitmap may let through more than it should, the more the fuller it is, and loses nothing; only the
documents found by it, which a second such map of documents names so that no text has to move, send hashes with their
places: one row per run, or per windows in a row that share their smallest group. Equal windows share it, so rows dealt
by it meet all their equals, and travel once. Copies of a whole text are found by its digest; only the first is
compared further. Spans come back per document and are applied where the text is.

Defined results: sentences end at ``.``, ``!`` or ``?`` before white space, or at a line end; one longer than
``LONGEST`` words counts as several. Comparison ignores case and the kind and amount of white space. A null or empty
text has no sentences and stays as it is; sentences in no run of that length and no such window are left alone; rows
equal in id and text are one document with one result each; rows without an id come last; empty tables stay empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairoline.llm.common import col, fresh, settled, sized

#: Bits of the map of repeated hashes, a power of two: 16 MB at most, whatever the corpus.
BITMAP = 1 << 27
SENTENCES = 2
RUN_WORDS = 20
LONGEST = 40
PASSAGE = 51
GRAM = 36
_REACH = PASSAGE - GRAM + 1  # groups in a passage
_TURN = 0x9E3779B97F4A7C15
_END = re.compile(r"[.!?]+(?=\s)|\n")
_WORD = re.compile(r"\S+")


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """Start, end (code points, white space before it included) and lower-case words of every sentence."""
    out: list[tuple[int, int, list[str]]] = []
    if not text:
        return out
    at = 0
    for m in [*_END.finditer(text), None]:
        end = m.end() if m else len(text)
        part = text[at:end].lower().split()
        if part:
            if len(part) > LONGEST:
                found = [w.start() for w in _WORD.finditer(text, at, end)][::LONGEST // 2]
                cuts = [at, *found[1:], end]
                out += [(a, b, text[a:b].lower().split()) for a, b in zip(cuts, cuts[1:], strict=False)]
            else:
                out.append((at, end, part))
        elif out:
            out[-1] = (out[-1][0], end, out[-1][2])  # white space belongs to the sentence before
        at = end
    return out


def _digest(joined: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(joined).encode("utf-8", "surrogatepass")) - (1 << 63)


def leads(parts: list[tuple[int, int, list[str]]]) -> dict[int, int]:
    """First sentence and hash of every shortest run forwards; each run of ``runs`` begins with one of them."""
    sizes, joined = [len(p[2]) for p in parts], [" ".join(p[2]) for p in parts]
    out, words, j = {}, 0, 0
    for i, size in enumerate(sizes):
        while j < len(parts) and (j - i < SENTENCES or words < RUN_WORDS):
            words += sizes[j]
            j += 1
        if j - i < SENTENCES or words < RUN_WORDS:
            break
        out[i] = _digest(joined[i:j])
        words -= size
    return out


def bounds(parts: list[tuple[int, int, list[str]]]) -> list[tuple[int, int]]:
    """First sentence and sentence after the last of every shortest run from a sentence on or back from one."""
    n, sizes = len(parts), [len(p[2]) for p in parts]
    found = set()
    for i in range(n):
        words, j = 0, i
        while j < n and (j - i < SENTENCES or words < RUN_WORDS):
            words += sizes[j]
            j += 1
        if j - i >= SENTENCES and words >= RUN_WORDS:
            found.add((i, j))
        words, j = 0, i + 1
        while j > 0 and (i + 1 - j < SENTENCES or words < RUN_WORDS):
            j -= 1
            words += sizes[j]
        if i + 1 - j >= SENTENCES and words >= RUN_WORDS:
            found.add((j, i + 1))
    return sorted(found)


def runs(parts: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, int]]:
    """``bounds`` with the hash of every run."""
    joined = [" ".join(p[2]) for p in parts]
    return [(i, j, _digest(joined[i:j])) for i, j in bounds(parts)]


class _Known(dict):
    """Hashes of words; forgets all when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)
        return found


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words; doubles the length and adds up the parts that ``n`` consists of."""
    size = max(len(hashes) - n + 1, 0)
    out, at, power, length = np.zeros(size, np.uint64), 0, hashes, 1
    while size:
        if n & length:
            out = out * np.uint64(pow(_TURN, length, 1 << 64)) + power[at:at + size]
            at += length
        if 2 * length > n:
            break
        power = power[:-length] * np.uint64(pow(_TURN, length, 1 << 64)) + power[length:]
        length *= 2
    return out


def _slide(best: Callable, x: np.ndarray, n: int) -> np.ndarray:
    """Smallest or largest of every ``n`` consecutive values."""
    length = 1
    while length < n:
        step = min(length, n - length)
        x = best(x[:-step], x[step:])
        length += step
    return x


def least_groups(hashes: np.ndarray) -> np.ndarray:
    """Smallest hash of a group of words in every passage."""
    return _slide(np.minimum, grams(hashes, GRAM), _REACH) if len(hashes) >= PASSAGE else np.zeros(0, np.uint64)


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the groups that are smallest in some passage; no word outside of it has a say in that.

    One group is smallest in at most ``_REACH`` passages in a row; in a longer row it occurs again and counts twice.
    """
    least = least_groups(hashes)
    begins = np.flatnonzero(np.concatenate([np.ones(min(len(least), 1), bool), least[1:] != least[:-1]]))
    long = np.diff(begins, append=len(least)) > _REACH
    return np.concatenate([least[begins], least[begins[long]]])


def _hashes(parts: list[tuple[int, int, list[str]]], known: _Known) -> np.ndarray:
    words = [known[w] for p in parts for w in p[2]]
    return np.array(words, np.int64).view(np.uint64)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the hashes of its forward runs and of its anchors."""
    known = _Known()
    for batch in batches:
        keys = []
        for text in batch.column(1):
            parts = sentences(text.as_py())
            own = np.fromiter(leads(parts).values(), np.int64)
            keys.append(np.concatenate([own, anchors(_hashes(parts, known)).view(np.int64)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(keys, pa.int64())], ["place", "keys"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bytes with the bit of every key set; Spark joins the bits, at most ``BITMAP / 32`` words of 32 reach the driver."""
    bit = F.col("key").bitwiseAND(BITMAP - 1)
    words = keys.select(F.shiftright(bit, 5).cast("int").alias("word"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(31).cast("int")).alias("bits")).groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITMAP // 32, "<u4")
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype("<u4")
    return out.view(np.uint8)


def _hit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys.view(np.int64) & (BITMAP - 1)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


#: Added to the number of a run, so that runs are negative and windows, numbered by their first word, are not.
_RUNS = -(1 << 30)


def _details(text: str, bitmap: np.ndarray, known: _Known) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one run whose lead, or of windows in a row whose common smallest group, the bitmap has.

    Returns the key that a stretch is dealt by, the number of its first item, how many items it has, and the hashes of
    all items. Equal items have equal keys.
    """
    parts = sentences(text)
    first = leads(parts)
    held = {i for i, hit in zip(first, _hit(bitmap, np.fromiter(first.values(), np.int64)), strict=True) if hit}
    joined = [" ".join(p[2]) for p in parts] if held else []
    own = [(n + _RUNS, _digest(joined[i:j])) for n, (i, j) in enumerate(bounds(parts) if held else []) if i in held]
    run, number = np.array([h for _, h in own], np.int64), np.array([n for n, _ in own], np.int32)
    words = _hashes(parts, known)
    least = least_groups(words)
    begins = np.flatnonzero(np.concatenate([np.ones(min(len(least), 1), bool), least[1:] != least[:-1]]))
    sizes = np.diff(begins, append=len(least))
    hit = _hit(bitmap, least[begins])
    windows = grams(words, PASSAGE)[np.repeat(hit, sizes)] if hit.any() else np.zeros(0, np.uint64)
    begins, sizes = begins[hit], sizes[hit]
    return (np.concatenate([run, least[begins].view(np.int64)]), np.concatenate([number, begins.astype(np.int32)]),
            np.concatenate([np.ones(len(run), np.int64), sizes]), np.concatenate([run, windows.view(np.int64)]))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def _place(id_col: str, text: str) -> Column:
    """Sorts by id, nulls last, then by the digest of the text; one value per document."""
    k = col(id_col)
    return F.struct(k.isNull().alias("no_id"), k.alias("id"), F.xxhash64(F.md5(col(text))).alias("mark"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per ``place`` of a document with repeats: ``whole`` if it copies an earlier text, else the numbers of its non-first
    ``runs`` and the first words of its non-first ``windows``."""
    spark = docs.sparkSession
    rows = docs.filter(F.length(col(text)) > 0).select(_place(id_col, text).alias("place"), col(text).alias("text"))
    kind = rows.schema["place"].dataType.simpleString()
    found = settled(rows.mapInArrow(_emit, f"place {kind}, keys array<bigint>"))
    copied = sized(settled(found.groupBy(F.col("place.mark").alias("mark")).agg(
        F.min("place").alias("kept"), F.max("place").alias("last")).filter("kept < last").select("mark", "kept")))
    judged = found.join(copied, F.col("place.mark") == F.col("mark"), "left").withColumn(
        "whole", F.coalesce(F.col("place") > F.col("kept"), F.lit(False)))
    single = judged.filter("not whole").select("place", "keys")
    twice = single.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = spark.sparkContext.broadcast(_bitmap(twice))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            hits = np.concatenate([[0], np.cumsum(_hit(shared.value, lists.values.to_numpy()))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(hits[ends[1:]] > hits[ends[:-1]]))], ["place"])

    again = single.mapInArrow(near, f"place {kind}").select(F.xxhash64("place").alias("key"))
    sought = spark.sparkContext.broadcast(_bitmap(again))

    def details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for whole in batches:
            batch = whole.filter(pa.array(_hit(sought.value, whole.column(2).to_numpy())))
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [_details(t.as_py(), shared.value, known) for t in part.column(1)]
                deal, at, sizes, keys = (np.concatenate(x) for x in zip(*found, strict=True))
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(owner)), pa.array(deal, pa.int64()), pa.array(at, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys, pa.int64()))], ["place", "deal", "at", "keys"])

    sent = rows.select("place", "text", F.xxhash64("place").alias("name")).mapInArrow(
        details, f"place {kind}, deal bigint, at int, keys array<bigint>").repartition("deal")
    items = sent.select("place", "deal", "at", F.posexplode("keys").alias("i", "key")).select(
        "place", "deal", "key", (F.col("at") + F.col("i")).alias("at"))
    spots = items.withColumn("first", F.min(F.struct("place", "at")).over(Window.partitionBy("deal", "key")))
    later = (F.col("place") > F.col("first.place")) | F.when(F.col("at") < 0, F.col("at") > F.col("first.at")).otherwise(
        F.col("at") - F.col("first.at") >= PASSAGE)
    marks = spots.filter(later).select("place", "at", F.lit(False).alias("whole"))
    copies = judged.filter("whole").select("place", F.lit(None).cast("int").alias("at"), "whole").distinct()
    # The second bitmap may let a copy through, whose items then change nothing but its own row.
    return marks.unionByName(copies).groupBy("place").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_set(F.when(F.col("at") < 0, F.col("at") - _RUNS))).alias("runs"),
        F.sort_array(F.collect_set(F.when(F.col("at") >= 0, F.col("at")))).alias("windows"))


def _gone(text: str, whole: bool, numbers: list[int], windows: list[int]) -> list[list[int]]:
    """Sorted, disjoint spans of the text that repeat an earlier place; white space before them included."""
    parts = sentences(text)
    found = bounds(parts) if whole or len(numbers) else []
    spans = [(parts[i][0], parts[j - 1][1]) for i, j in (found if whole else [found[n] for n in numbers])]
    if whole or len(windows):
        ends = [0, *(m.end() for m in _WORD.finditer(text))]
        windows = range(len(ends) - PASSAGE) if whole else windows
        spans += [(ends[i], ends[i + PASSAGE]) for i in windows]
    gone: list[list[int]] = []
    for a, b in sorted(spans):
        if gone and a <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], b)
        else:
            gone.append([a, b])
    return gone


def strip(docs: DataFrame, id_col: str = "doc_id", text: str = "text", into: str = "kept_text",
          spans: str = "removed") -> DataFrame:
    """``docs`` with the text that is left and the removed spans (start and end in code points)."""
    place, mark = fresh(docs, "repeat_place", "repeat_marks")
    marks = repeated(docs, id_col, text).select(F.col("place").alias(place), F.struct("whole", "runs", "windows").alias(mark))

    @F.pandas_udf("kept string, spans array<struct<start:int,end:int>>")
    def cut(texts: pd.Series, whole: pd.Series, numbers: pd.Series, windows: pd.Series) -> pd.DataFrame:
        kept, removed = [], []
        for t, *found in zip(texts, whole, numbers, windows, strict=True):
            w, n, p = (bool(found[0]) if found[0] is not None else False), *([] if x is None else x for x in found[1:])
            gone = _gone(t, w, n, p) if t is not None and (w or len(n) or len(p)) else []
            out, at = [], 0
            for a, b in gone:
                out.append(t[at:a])
                at = b
            kept.append("".join([*out, t[at:]]) if gone else t)
            removed.append([{"start": a, "end": b} for a, b in gone])
        return pd.DataFrame({"kept": kept, "spans": removed})

    joined = docs.withColumn(place, _place(id_col, text)).join(marks, place, "left")
    done = joined.withColumn(place, cut(col(text), *(F.col(f"{mark}.{c}") for c in ("whole", "runs", "windows"))))
    return done.select(*[col(c) for c in docs.columns], F.col(f"{place}.kept").alias(into),
                       F.col(f"{place}.spans").alias(spans))
