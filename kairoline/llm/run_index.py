"""Substring dedup by suffix order: bytes that lie in a string of ``length`` bytes which also starts elsewhere go.

The index is that of repetitive corpora. A Burrows-Wheeler transform is kept as runs of equal bytes, with the text
position at the first and at the last place of every run. Only there does the common prefix of two suffixes that are
neighbours in the order have to be measured; everywhere else it is that of the position before, less one. So the longest
match of every position with any other one is streamed from left to right over the samples, and a position with ``length``
or more starts a repeated string.

Spark brings together what can match. The smallest hash among the groups of ``GRAMS[0]`` bytes in a string of ``length`` is
the same wherever the string stands, so every string belongs to one hash; neighbouring strings with the same hash form a
context. Bare hashes are counted first, with map-side combining; of the contexts whose hash occurs twice, one copy of each,
or two where there are more, is cut out of its text and sent to the task that indexes all contexts of that hash. What is found
goes back to all copies. A hash with more than ``CROWD`` different contexts is not kept together: they are cut anew
by longer groups, in the end by whole strings, so no group grows with the number of documents that share a passage.
Whole texts that occur twice are found by digest; one of them stands for all.

Defined results: lengths and positions count UTF-8 bytes; all occurrences go, the first one too, and strings are judged on
the input. A null or empty text, or one below ``length`` bytes, keeps everything (null: empty). Rows equal in id and text
are two occurrences; rows without an id take part; empty tables stay empty; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairoline.llm.common import col, fresh, settled, sized

#: Bytes of a group; each later one splits what crowds together under the one before, and the string itself comes last.
GRAMS = (32, 128)
CROWD = 1000
#: Strings that one context holds at most.
REACH = 1024
#: Contexts per task group, in expectation, and bytes that are sorted at once.
BUCKET_ROWS = 8192
PART_BYTES = 2_000_000
_TURN = 0x9E3779B97F4A7C15
_GAP = 0xFF  # no byte of a UTF-8 text
_POSITION = (1 << 31) - 1


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order: by as many bytes as fit in one number, then by rank pairs of doubled reach while ties are left."""
    n = len(text)
    used = np.flatnonzero(np.bincount(text, minlength=256))
    bits = int(len(used)).bit_length()
    dense = np.zeros(256, np.uint64)
    dense[used] = np.arange(1, len(used) + 1)
    symbols, reach = dense[text], 62 // bits
    key = symbols.copy()
    for j in range(1, reach):
        key <<= np.uint64(bits)
        key[:max(n - j, 0)] |= symbols[j:]
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    slots, found = np.arange(n), order
    while True:
        rank[found] = slots[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        tied = ~(head & np.concatenate([head[1:], [True]]))
        slots, found = slots[tied], found[tied]
        if not len(found):
            return order
        key = (rank[found] << 32) | (rank[np.minimum(found + reach, n)] + 1)
        by = np.argsort(key)
        found, key = found[by], key[by]
        order[slots] = found
        head = np.concatenate([[True], key[1:] != key[:-1]])
        reach *= 2


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b`` (pairwise different), eight bytes a step."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.ndarray(n + 1, "<u8", padded, strides=(1,))
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    while len(open_):
        x, y = a[open_] + out[open_], b[open_] + out[open_]
        differ = eight[x] ^ eight[y]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        out[open_] += np.minimum(same, n - np.maximum(x, y))
        open_ = open_[(same == 8) & (np.maximum(x, y) + 8 < n)]
    return out


@dataclass
class RunIndex:
    """Runs of the transform (byte and length) and the text positions at their first and last places."""

    text: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, text: np.ndarray) -> RunIndex:
        order = suffix_order(text)
        before = text[order - 1].astype(np.int16)
        before[order == 0] = 256  # the whole text follows nothing
        starts = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        ends = np.concatenate([starts[1:], [len(order)]])
        return cls(text, before[starts], ends - starts, order[starts], order[ends - 1])

    def matching(self) -> np.ndarray:
        """Length of the longest match of every position with another one, streamed over the samples at run ends."""
        above, below = self.last[:-1], self.first[1:]
        shared = common_prefix(self.text, above, below)
        upto = np.arange(len(self.text))
        upto[below] = np.maximum(upto[below], below + shared)
        upto[above] = np.maximum(upto[above], above + shared)
        return np.maximum.accumulate(upto) - np.arange(len(self.text))


def repeated_starts(contexts: list[bytes], twice: list[bool], length: int) -> list[np.ndarray]:
    """Per distinct context the starts of strings of ``length`` bytes that occur elsewhere, in it or in another.

    A context that occurs more than once enters the index a second time; further copies would add nothing.
    """
    again = [c for c, more in zip(contexts, twice, strict=True) if more][::-1]
    joined = bytes([_GAP]).join([*contexts, *again])
    matches = RunIndex.build(np.frombuffer(joined, np.uint8)).matching()
    out, at = [], 0
    for c in contexts:
        out.append(np.flatnonzero(matches[at:at + len(c) - length + 1] >= length))
        at += len(c) + 1
    return out


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive values, from hashes of doubled lengths."""
    size = max(len(values) - n + 1, 0)
    out, at, power, length = np.zeros(size, np.uint64), 0, values, 1
    while size:
        factor = np.uint64(pow(_TURN, length, 1 << 64))
        if n & length:
            out = out * factor + power[at:at + size]
            at += length
        if 2 * length > n:
            break
        power = power[:-length] * factor + power[length:]
        length *= 2
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def contexts(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first start, end of starts, and whether the hash stands in it more than once, of every context of a text.

    The place of a string's smallest hash is the leftmost one; what is smallest is told by 33 bits, above the position.
    """
    if len(raw) < length:
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)
    hashes = _spread(grams(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1), gram))
    x = (hashes & ~np.uint64(_POSITION)) | np.arange(len(hashes), dtype=np.uint64)
    size, n = 1, length - gram + 1
    while size < n:
        step = min(size, n - size)
        x = np.minimum(x[:-step], x[step:])
        size += step
    moves = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1])
    own = hashes[(x[moves] & np.uint64(_POSITION)).astype(np.int64)]
    new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    starts, own = moves[new], own[new]
    ends = np.concatenate([starts[1:], [len(x)]])
    many = np.diff(np.concatenate([new, [len(moves)]])) > 1
    parts = -(-(ends - starts) // REACH)
    if parts.max() > 1:  # the same few bytes over and over: cut the stretch
        cut = np.repeat(starts, parts) + REACH * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        starts, ends = cut, np.minimum(cut + REACH, np.repeat(ends, parts))
        own, many = np.repeat(own, parts), np.repeat(many, parts)
    return own.view(np.int64), starts, ends, many


def _binary(column: pa.Array) -> Iterator[bytes]:
    return (b"" if v is None else v for v in column.to_pylist())


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def _place(id_col: str, text: str) -> Column:
    """One value per id and text; a null id has its own."""
    return F.struct(col(id_col).alias("id"), F.xxhash64(F.md5(col(text))).alias("mark"))


def _ranges(at: np.ndarray, length: int) -> list[int]:
    """Starts and ends of the bytes that strings from the given sorted starts cover."""
    if not len(at):
        return []
    apart = np.flatnonzero(np.diff(at) > length)
    return np.stack([at[np.concatenate([[0], apart + 1])], at[np.concatenate([apart, [len(at) - 1]])] + length], 1).ravel().tolist()


def _among(rows: DataFrame, counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Rows whose keys are in the settled ``counts``, with its further columns.

    Keys of more than ``CROWD`` rows are told by a broadcast where a count shows that such keys are few, and are not shuffled.
    """
    crowds = sized(counts.filter(F.col(n) > CROWD).withColumn("crowd", F.lit(True)))
    split = rows.join(crowds, keys, "left")
    often = split.filter("crowd").drop("crowd")
    calm = split.filter("crowd is null").select(*rows.columns).join(counts.filter(F.col(n) <= CROWD), keys)
    return often.unionByName(calm)


def _number(length: int, gram: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, marks = [], []
            for raw in _binary(batch.column(1)):
                found.append(contexts(raw, length, gram))
                marks.append(np.array([_mark(raw[a:b]) for a, b in zip(
                    found[-1][1].tolist(), (found[-1][2] + length - 1).tolist(), strict=True)], np.int64))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(batch.num_columns) if i != 1), _lists([f[0] for f in found], pa.int64()),
                _lists(marks, pa.int64()), _lists([f[1].astype(np.int32) for f in found], pa.int32()),
                _lists([f[3] for f in found], pa.bool_())],
                [*(n for n in batch.schema.names if n != "raw"), "hash", "content", "at", "many"])

    return number


def _mark(part: bytes) -> int:
    return xxhash.xxh3_64_intdigest(part) - (1 << 63)


_NUMBERED = "hash array<bigint>, content array<bigint>, at array<int>, many array<boolean>"


def _indexed(table: pa.Table, length: int) -> pa.Table:
    """Starts and ends (from the context's own start) that lie in strings occurring twice among the given contexts."""
    table = table.sort_by("hash")
    hashes, marks = table.column("hash").to_numpy(), table.column("content").to_numpy()
    parts = table.column("part").to_pylist()
    own, ranges = [], []

    def flush(held: dict[bytes, list[int]]) -> None:
        for rows, at in zip(held.values(), repeated_starts(list(held), [len(r) > 1 for r in held.values()], length), strict=True):
            if len(at):
                own.append(rows[0])
                ranges.append(_ranges(at, length))

    held: dict[bytes, list[int]] = {}
    size = 0
    for r, part in enumerate(parts):
        if size >= PART_BYTES and hashes[r] != hashes[r - 1]:
            flush(held)
            held, size = {}, 0
        rows = held.setdefault(part, [])
        rows.append(r)
        size += len(part) + 1
    if held:
        flush(held)
    return pa.table({"hash": hashes[own], "content": marks[own], "ranges": pa.array(ranges, pa.list_(pa.int32()))})


def _cut(length: int, gram: int):
    """Wanted contexts of each text, with their hashes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, marks, parts = [], [], []
            for raw, wanted in zip(_binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                h, a, b, _ = contexts(raw, length, gram)
                for i in np.searchsorted(a, wanted).tolist():
                    hashes.append(h[i])
                    parts.append(raw[a[i]:b[i] + length - 1])
                    marks.append(_mark(parts[-1]))
                if len(parts) >= 4096:
                    yield packed(hashes, marks, parts)
                    hashes, marks, parts = [], [], []
            yield packed(hashes, marks, parts)

    def packed(hashes, marks, parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(marks, pa.int64()), pa.array(parts, pa.binary())],
                                          ["hash", "content", "part"])

    return cut


def _matched(parts: DataFrame, single: DataFrame, length: int, level: int) -> DataFrame:
    """Per ``owner`` of ``parts`` (``owner``, ``raw``) the ``ranges`` of its repeated strings, in pieces.

    ``single`` holds one row per context: ``owner``, ``hash``, ``content``, ``at``, ``many``.
    """
    gram = ([g for g in GRAMS if g < length] + [length])[level]
    counts = settled(single.groupBy("hash").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).filter("n > 1"))
    near = settled(_among(single.drop("many"), counts, ["hash"]).drop("n"))
    spot = F.struct("owner", "at")
    kinds = settled(near.groupBy("hash", "content").agg(F.min(spot).alias("a"), F.max(spot).alias("b"), F.count(F.lit(1)).alias("n")))
    crowds = settled(kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > CROWD))
    crowded = gram < length and not crowds.isEmpty()
    marked = kinds.join(sized(crowds.select("hash", F.lit(True).alias("crowd"))), "hash", "left") if crowded else kinds.withColumn(
        "crowd", F.lit(None).cast("boolean"))

    def wanted(rows: DataFrame) -> DataFrame:
        at = rows.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("r")).select("r.owner", "r.at")
        return at.groupBy("owner").agg(F.sort_array(F.collect_set("at")).alias("wanted"))

    cut, shape = _cut(length, gram), "hash bigint, content bigint, part binary"
    calm = marked.filter("crowd is null")
    buckets = max(1, (calm.count() if crowded else kinds.count()) // BUCKET_ROWS)
    contexts_of = parts.join(wanted(calm), "owner").select("raw", "wanted").mapInArrow(cut, shape)
    found = contexts_of.groupBy(F.pmod("hash", F.lit(buckets)).alias("bucket")).applyInArrow(
        lambda table: _indexed(table.select(["hash", "content", "part"]), length), "hash bigint, content bigint, ranges array<int>")
    if crowded:
        again = parts.join(sized(settled(wanted(marked.filter("crowd")))), "owner").select("raw", "wanted").mapInArrow(cut, shape)
        again = settled(again.select(F.struct("hash", "content").alias("key"), F.col("part").alias("raw"))
                        .withColumn("owner", F.struct("key", F.monotonically_increasing_id().alias("copy"))).select("owner", "raw"))
        kind = again.schema["owner"].dataType.simpleString()
        below = ([g for g in GRAMS if g < length] + [length])[level + 1]
        numbered = settled(again.mapInArrow(_number(length, below), f"owner {kind}, {_NUMBERED}"))
        deeper = _matched(again, numbered.select("owner", F.inline(F.arrays_zip("hash", "content", "at", "many"))), length, level + 1)
        found = found.unionByName(deeper.select("owner.key.hash", "owner.key.content", "ranges"))
    results = settled(found.groupBy("hash", "content").agg(F.flatten(F.collect_list("ranges")).alias("ranges")).join(
        kinds.select("hash", "content", "n"), ["hash", "content"]))
    return _among(near, results, ["hash", "content"]).select(
        "owner", F.transform("ranges", lambda x: x + F.col("at")).alias("ranges"))


def covered(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per ``place`` of a document with repeats: ``whole`` if all of its text occurs twice, else ``ranges`` (start, end, ...)."""
    rows = docs.filter(F.octet_length(col(text)) >= length).select(
        _place(id_col, text).alias("owner"), col(text).cast("binary").alias("raw"))
    kind = rows.schema["owner"].dataType.simpleString()
    first = min([*GRAMS, length])
    found = settled(rows.withColumn("digest", F.unhex(F.md5("raw"))).mapInArrow(
        _number(length, first), f"owner {kind}, digest binary, {_NUMBERED}"))
    # texts that occur twice: the smallest place stands for all in the index
    copies = sized(settled(found.groupBy("digest").agg(F.min("owner").alias("kept"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("digest", "kept")))
    judged = found.join(copies, "digest", "left")
    whole = judged.filter("kept is not null").select("owner", F.lit(True).alias("whole")).distinct()
    single = judged.filter("kept is null or owner = kept").select("owner", F.inline(F.arrays_zip("hash", "content", "at", "many")))
    parts = _matched(rows, single, length, 0).withColumn("whole", F.lit(False)).unionByName(
        whole.withColumn("ranges", F.array().cast("array<int>")))
    return parts.groupBy(F.col("owner").alias("place")).agg(
        F.max("whole").alias("whole"), F.flatten(F.collect_list("ranges")).alias("ranges"))


def _merged(flat: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint spans that do not touch, from starts and ends in any order."""
    spans = np.asarray(flat).reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    upto = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > upto[:-1]]))
    return list(zip(spans[new, 0].tolist(), upto[np.concatenate([new[1:] - 1, [len(spans) - 1]])].tolist(), strict=True))


def strip(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text: str = "text", into: str = "kept",
          spans: str = "removed") -> DataFrame:
    """``docs`` with the bytes that are left and the removed spans (start and end in bytes)."""
    for name in (into, spans):
        if name.lower() in (c.lower() for c in docs.columns):
            raise ValueError(f"the input has a column {name}; name another one")
    place, mark = fresh(docs, "index_place", "index_mark")
    marks = covered(docs, length, id_col, text).select(F.col("place").alias(place), F.struct("whole", "ranges").alias(mark))

    @F.pandas_udf("kept binary, spans array<struct<start:int,end:int>>")
    def cut(raw: pd.Series, whole: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        kept, removed = [], []
        for t, w, r in zip(raw, whole, ranges, strict=True):
            if t is None:
                kept.append(None)
                removed.append([])
                continue
            gone = [(0, len(t))] if w else _merged(r)
            out, at = [], 0
            for a, b in gone:
                out.append(t[at:a])
                at = b
            kept.append(b"".join([*out, t[at:]]))
            removed.append([{"start": a, "end": b} for a, b in gone])
        return pd.DataFrame({"kept": kept, "spans": removed})

    raw = col(text).cast("binary")
    same = docs.withColumn(place, _place(id_col, text)).join(marks, place, "left")
    done = same.withColumn(place, cut(F.when(F.col(mark).isNotNull(), raw), F.col(f"{mark}.whole"), F.col(f"{mark}.ranges")))
    return done.select(*[col(c) for c in docs.columns], F.coalesce(F.col(f"{place}.kept"), raw, F.lit(b"")).alias(into),
                       F.col(f"{place}.spans").alias(spans))
