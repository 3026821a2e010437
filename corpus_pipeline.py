"""A training corpus from raw documents: drop bad texts, drop near copies, remove secrets, mix sources, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kairoline.llm import bpe, mixing, near_dups, quality, secrets
from kairoline.llm.common import table
from kairoline.llm.queries import MIX_WEIGHTS, VOCABULARY
from kairoline.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fences of their language and source."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates."""
    return near_dups.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and lengths brought up to date."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to meet the sources' weights, in shuffled order."""
    return mixing.mix(docs, MIX_WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids instead of texts; all other columns stay."""
    return bpe.encode(docs, bpe.load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("secrets", secret_scan), ("mixing", mix_sources),
          ("encoding", encode)]
#: Near-duplicate classes and token ids are beyond SQL; the operators are tested one by one,
#: the whole run is not yet compared with anything.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
