"""Byte-level BPE encoding and decoding around a global shuffle of distinct words.

Texts are cut into pre-tokens (a run of non-space with the one space before it, or a run of white space; the finer
pattern of the vocabulary never crosses these cuts, and is applied when a pre-token is encoded). Tasks gather documents
into blocks. A block holds each of its distinct words once and, for every position, the word's place in that list.
Words go to buckets by hash, all blocks' copies of a word to the same one; there each distinct word is encoded once, and
its ids go back to the blocks that asked, where documents are reassembled by position. Decoding joins ids with the
table of token bytes, which is as large as the vocabulary.

The input is read twice, once for the words and once for the positions, so that nothing has to be stored in between. A
block is named by a digest of its content: a lost task that runs again over a stored table makes the same blocks. An
input that changes its order between reads is noticed (words and positions then do not fit) and refused; settle such
an input first.

Blocks and buckets bound memory: a block ends after ``block_chars`` code points, rows counted in (or one longer document), a common word
appears once per block however often it occurs, and the word cache of a task is emptied at ``cache_words``.

Defined results: a null or empty text has no tokens; repeated rows and any further columns pass through unchanged; an
empty table stays empty; a list with an id outside the vocabulary decodes to null, and so does a null list.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kairoline.llm.common import col

#: White space as the vocabulary's pattern understands it (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BLOCK_SCHEMA = T.StructType([T.StructField("block", T.StringType()), T.StructField("bucket", T.IntegerType()),
                              T.StructField("data", T.BinaryType()), T.StructField("rows", T.BinaryType())])


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken vocabulary file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes (small numbers then compress well)."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.astype("<u4")).view(np.uint8).reshape(-1, 4).T
        out.append(len(a).to_bytes(8, "little") + planes.tobytes())
    return zstandard.compress(b"".join(out), 3)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, 4 * n, at + 8).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 8 + 4 * n
    return out


def _pack_words(raw: list[bytes]) -> bytes:
    lens = np.fromiter(map(len, raw), "<u4", len(raw))
    return zstandard.compress(len(raw).to_bytes(8, "little") + lens.tobytes() + b"".join(raw), 3)


def _unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 8).astype(np.int64)) + 8 + 4 * n
    starts = np.concatenate([[8 + 4 * n], ends])[:-1].astype(np.int64)
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


#: What a row counts beside its text, so that rows without one fill a block too.
ROW_CHARS = 32


class _Block:
    def __init__(self) -> None:
        self.words: defaultdict[str, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.places: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []
        self.chars = 0

    def add(self, text: str | None) -> None:
        found = _CHUNK.findall(text) if text else []
        self.places.append(np.fromiter(map(self.words.__getitem__, found), np.uint32, len(found)))
        self.chars += (len(text) if text else 0) + ROW_CHARS

    def flush(self, buckets: int, positions: bool) -> Iterator[tuple]:
        """Either one row with positions and the other columns, or one row of words per bucket in use."""
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.uint32)
        words = [w.encode("utf-8", "surrogatepass") for w in self.words]
        name = xxhash.xxh3_128(places.tobytes())
        name.update(b"\0".join(words))
        block = name.hexdigest()
        order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint32, len(words))[order]
        if positions:
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.rows[0].schema) as writer:
                for batch in self.rows:
                    writer.write_batch(batch)
            lengths = np.fromiter(map(len, self.places), np.uint32, len(self.places))
            yield (block, -1, _pack(lengths, rank[places] if len(places) else places, bucket),
                   zstandard.compress(sink.getvalue().to_pybytes(), 1))
            return
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        for group in np.split(by, cuts) if len(by) else []:
            yield block, int(bucket[group[0]]), _pack_words([words[i] for i in order[group].tolist()]), None


def _blocks(text: int, buckets: int, block_chars: int, positions: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: _Block) -> Iterator[pa.RecordBatch]:
            for row in block.flush(buckets, positions):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                    row, (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                    ["block", "bucket", "data", "rows"])

        block = _Block()
        for batch in batches:
            others = pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != text],
                                                [str(i) for i in range(batch.num_columns - 1)])
            start = 0
            for i, value in enumerate(batch.column(text)):
                block.add(value.as_py())
                if block.chars >= block_chars:
                    block.rows.append(others.slice(start, i + 1 - start))
                    yield from out(block)
                    block, start = _Block(), i + 1
            if start < batch.num_rows:
                block.rows.append(others.slice(start))
        if block.places:
            yield from out(block)
    return run


def _encode_words(vocabulary, pattern: str, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary.value,
                                   special_tokens={}).encode_ordinary
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            packed = []
            for data in batch.column(2):
                words = _unpack_words(data.as_py())
                if len(known) > cache_words:
                    known.clear()
                ids = []
                for w in words:
                    found = known.get(w)
                    if found is None:
                        found = known[w] = encode(w.decode("utf-8", "surrogatepass"))
                    ids.append(found)
                counts = np.fromiter(map(len, ids), np.uint32, len(ids))
                packed.append(_pack(counts, np.array([i for x in ids for i in x], np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), batch.column(3)],
                ["block", "bucket", "data", "rows"])
    return run


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``[start, start + length)`` for each pair, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _reassemble(schema: pa.Schema, slice_places: int = 200_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        bucket = table.column("bucket").to_numpy()
        data, rows = table.column("data"), table.column("rows")
        of = {int(bucket[i]): i for i in np.flatnonzero(bucket >= 0).tolist()}
        heads = np.flatnonzero(bucket < 0).tolist()
        if not heads:
            raise RuntimeError("the input gave other rows when read again; settle it before encoding")
        for head in heads:  # more than one only for blocks of equal content
            lengths, places, home = _unpack(data[head].as_py())
            counts, flat, starts, at = np.zeros(len(home), np.int64), [], np.zeros(len(home), np.int64), 0
            for b in np.unique(home).tolist():
                if b not in of:
                    raise RuntimeError("the input gave other rows when read again; settle it before encoding")
                n, ids = _unpack(data[of[b]].as_py())
                mine = np.flatnonzero(home == b)
                counts[mine] = n
                starts[mine] = at + np.cumsum(n.astype(np.int64)) - n
                flat.append(ids)
                at += len(ids)
            ids = np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32)
            others = pa.ipc.open_stream(zstandard.decompress(rows[head].as_py())).read_all().combine_chunks()
            ends = np.cumsum(np.concatenate([[0], lengths.astype(np.int64)]))
            first = 0
            while first < len(lengths):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + slice_places, "right")) - 1)
                part = places[ends[first]:ends[last]]
                size = counts[part]
                cuts = np.concatenate([[0], np.cumsum(size)])[ends[first:last + 1] - ends[first]]
                listed = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)),
                                                  pa.array(ids[_spans(starts[part], size)], pa.int32()))
                columns = [c.chunk(0) for c in others.slice(first, last - first).columns] if others.num_columns else []
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*columns, listed], schema, strict=True)],
                                                 schema=schema)
                first = last
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", into: str = "ids",
           block_chars: int = 6_000_000, cache_words: int = 250_000, buckets: int | None = None) -> DataFrame:
    """The other columns of ``docs`` and the token ids of the text (array of int)."""
    spark = docs.sparkSession
    buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = [c for c in docs.columns if c != text]
    source = docs.select(*[col(c) for c in others], col(text))
    words, positions = (source.mapInArrow(_blocks(len(others), buckets, block_chars, wanted), _BLOCK_SCHEMA)
                        for wanted in (False, True))
    vocabulary = spark.sparkContext.broadcast(ranks)  # as large as the vocabulary file
    encoded = words.repartition("bucket").mapInArrow(_encode_words(vocabulary, pattern, cache_words), _BLOCK_SCHEMA)
    fields = [docs.schema[c] for c in others]
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)]
                         + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    whole = positions.unionByName(encoded).groupBy("block").applyInArrow(
        _reassemble(to_arrow_schema(plain)), plain)
    return whole.toDF(*others, into)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", into: str = "bytes") -> DataFrame:
    """``df`` with the bytes that its ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    @F.pandas_udf("binary")
    def joined(lists: pd.Series) -> pd.Series:
        table = shared.value

        def one(x):
            try:
                return None if x is None else b"".join(map(table.__getitem__, x.tolist()))
            except KeyError:
                return None
        return lists.map(one)

    return df.withColumn(into, joined(col(ids)))
