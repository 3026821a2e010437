"""Jump consistent hashing in plain column arithmetic.

A key's shard depends on the key and the number of shards only; one more shard takes rows into itself and moves no
other row. The 64-bit recurrence is done in 16- and 32-bit limbs, because the default SQL mode refuses overflow.

Defined results: a null key hashes as -1; a null text has no bytes and check sum 0; equal rows get different slots; an
empty table gives no rows. Slots are gapless from 0 in each shard, ordered by a hash of the key, the key, the check sum
and the size, so they do not depend on how the input is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairoline.llm.common import col, let, settled, sized

#: Fixed values of the published generator: key = key * 2862933555777941757 + 1 (mod 2^64).
_HIGH, _LOW = divmod(2862933555777941757, 1 << 32)
_MASK32 = (1 << 32) - 1


def _next(hi: Column, lo: Column) -> tuple[Column, Column]:
    """High and low half of ``key * multiplier + 1``; no intermediate passes 2^63."""
    l0, l1 = lo.bitwiseAND(0xFFFF), F.shiftright(lo, 16)
    p0 = l0 * _LOW + 1
    p1 = l1 * _LOW + F.shiftright(p0, 16)
    low = p0.bitwiseAND(0xFFFF) + F.shiftleft(p1.bitwiseAND(0xFFFF), 16)
    h0, h1 = hi.bitwiseAND(0xFFFF), F.shiftright(hi, 16)
    product = h0 * _LOW + F.shiftleft((h1 * _LOW).bitwiseAND(0xFFFF), 16)
    return (product + (lo * _HIGH).bitwiseAND(_MASK32) + F.shiftright(p1, 16)).bitwiseAND(_MASK32), low


def jump_hash(key: Column, shards: int) -> Column:
    """Shard in ``[0, shards)`` of a 64-bit key.

    Each step moves to a strictly larger candidate, so ``shards`` steps always suffice; nearly all keys end within the
    first 48, and only the others run the rest.
    """
    if not 0 < shards < 1 << 31:
        raise ValueError("the number of shards must be between 1 and 2^31 - 1")
    k = F.coalesce(key.cast("long"), F.lit(-1).cast("long"))
    start = F.struct(F.shiftrightunsigned(k, 32).alias("hi"), k.bitwiseAND(_MASK32).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        def moved(n: Column) -> Column:
            j = F.floor((acc["j"] + 1) * (F.lit(2147483648.0) / (F.shiftright(n["hi"], 1) + 1))).cast("long")
            return F.struct(n["hi"].alias("hi"), n["lo"].alias("lo"), acc["j"].alias("b"), j.alias("j"))

        hi, lo = _next(acc["hi"], acc["lo"])
        return F.when(acc["j"] >= shards, acc).otherwise(let(F.struct(hi.alias("hi"), lo.alias("lo")), moved))

    first = min(shards, 48)
    out = F.aggregate(F.sequence(F.lit(1), F.lit(first)), start, step)
    if first == shards:
        return out["b"].cast("int")
    return let(out, lambda o: F.when(o["j"] >= shards, o["b"]).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(shards)), o, step)["b"])).cast("int")


def add_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of its key; no shuffle."""
    return df.withColumn(name, jump_hash(col(key), shards))


def write_shards(df: DataFrame, path: str, shard: str = "shard", files: int = 8) -> None:
    """One folder per shard, each written by up to ``files`` tasks."""
    salt = F.pmod(F.xxhash64(*[col(c) for c, t in df.dtypes if not t.startswith(("map", "variant"))]), F.lit(files))
    df.repartition(col(shard), salt).write.mode("errorifexists").partitionBy(shard).parquet(path)


def placed(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", buckets: int = 256,
           chunk: int = 65_536) -> DataFrame:
    """Key, size, check sum, shard, slot and the shard after one more is appended, for every row.

    Equal rows collapse to one counted row before the shuffle, so a key that many rows share stays small. Slots come
    from counts per shard and hash bucket (a bounded table), a running sum inside each bucket, and an expansion of the
    counted rows in chunks. No task ever holds a whole shard.
    """
    k = col(key)
    rows = docs.select(
        k.alias("key"), (F.octet_length(F.coalesce(col(text), F.lit(""))) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(col(text), F.lit(""))).alias("crc"))
    counted = rows.groupBy("key", "size", "crc").agg(F.count(F.lit(1)).alias("n"))
    mark = F.substring(F.md5(F.coalesce(F.col("key").cast("string"), F.lit("null"))), 1, 8)
    bucket = F.floor(F.conv(F.substring("mark", 1, 4), 16, 10).cast("int") * F.lit(buckets) / 65536).cast("int")
    groups = settled(counted.withColumn("mark", mark).withColumn("bucket", bucket).withColumn(
        "shard", jump_hash(F.col("key"), shards)).withColumn("grown", jump_hash(F.col("key"), shards + 1)))
    per = groups.groupBy("shard", "bucket").agg(F.sum("n").alias("m"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("shard", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("mark", "key", "crc", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = groups.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        sized(offsets, shards * buckets), ["shard", "bucket"])
    chunks = starts.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1,
                                                         F.lit(chunk).cast("long")))).hint("rebalance")
    return chunks.select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard",
        F.col("grown").alias("grown_shard"),
        F.explode(F.sequence(F.col("first") + F.col("start") + F.col("c"), F.col("first") + F.col("start")
                             + F.least(F.col("c") + chunk, F.col("n")) - 1)).alias("slot"))
