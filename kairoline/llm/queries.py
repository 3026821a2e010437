"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairoline.llm import (bpe, centroids, lexical, mixing, near_dups, quality, repeats, run_index, secrets, sharding,
                           toxicity, url_rules, vectors)
from kairoline.llm.common import table
from kairoline.llm.sql import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Fixed values of the url query.
URL_RULES = [url_rules.Rule("net", "/", "block"), url_rules.Rule("example.net", "/en/", "allow"),
             url_rules.Rule("example.com", "/de/", "block"), url_rules.Rule("org", "/fr/", "allow")]
SHARDS = 40
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Wanted weights of the mixing query and stage: the hot source is cut to twice the share of any other.
MIX_WEIGHTS = {"src0": 2.0}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality.Rules()
    judged, m, kept = quality.judge(table(spark, sf_dir, "documents"), rules=rules, keep=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(f"{m}.{c}").alias(c) for c in counts],
                         quality.base_failed(F.col(m), rules).alias("base_failed"), F.col(kept).alias("kept"))


@query
def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(table(spark, sf_dir, "documents"), SHARDS)


@query
def op4_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op10_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, copy="copy", order="mix_order")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    base = F.filter(spans, lambda s: s["kind"] != "guess")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets.written(base), 256).alias("base_sha256"),
                        secrets.written(spans).alias("spans"))


@query
def op7_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def remainder(c):
        return F.pmod(F.crc32(c.cast("string")), F.lit(4))

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    models = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda c: remainder(c) != 2)
    out = toxicity.score(docs, models)
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", "first")


@query
def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.strip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.size("removed").cast("long").alias("n_spans"), F.array_join(F.transform(
        "removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        "kept_text")


@query
def op5_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = run_index.strip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", (F.octet_length("kept") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centers = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(assigned, centers).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
