"""Score request streams with a fitted pipeline, keeping invalid rows apart with their reasons."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kairoline.operators.contract import DOCUMENT, Field, split, tag_errors
from kairoline.sources.readers import checked_requests


def request_stream(spark: SparkSession, path: str, features: T.StructType, fmt: str = "text",
                   files_per_batch: int | None = None, **options) -> DataFrame:
    """Stream of request documents (one per line) or of parquet rows with the feature schema.

    Documents carry what is wrong with them, so scoring leaves bad ones out and quarantine keeps their text.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    for name, value in options.items():
        reader = reader.option(name, value)
    if fmt == "text":
        return checked_requests(reader.text(path), "value", features)
    return reader.schema(features).format(fmt).load(path)


def score_rows(df: DataFrame, model: PipelineModel, contract: Sequence[Field], keys: Sequence[str]) -> DataFrame:
    """Valid rows with their prediction; works on batch tables and on streams alike."""
    valid, _ = split(df, contract)
    return model.transform(valid).select(*keys, "prediction")


def score_stream(requests: DataFrame, model: PipelineModel, contract: Sequence[Field], keys: Sequence[str],
                 out: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Stateless scoring into files, exactly once per input file."""
    return (
        score_rows(requests, model, contract, keys).writeStream.format(fmt).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start(out)
    )


def score_with_quarantine(requests: DataFrame, model: PipelineModel | None, contract: Sequence[Field],
                          keys: Sequence[str], out: str, quarantine: str, checkpoint: str,
                          prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Two sinks per micro-batch: predictions, and invalid rows with the rules they broke.

    Each batch replaces its own folder, so a batch that is run again after a failure leaves the
    same files. Pipelines with a neighbour stage, which need joins and counts over a finite table,
    run here as well.
    """

    def run(batch: DataFrame, number: int) -> None:
        tagged = tag_errors(batch, contract).persist()
        try:
            good = tagged.where(F.size("errors") == 0).drop("errors", DOCUMENT)
            if prepare:
                good = prepare(good)
            scored = model.transform(good).select(*keys, "prediction") if model else good.select(*keys)
            scored.write.mode("overwrite").parquet(f"{out}/batch={number}")
            bad = tagged.where(F.size("errors") > 0).select(
                *keys, "errors", *[c for c in (DOCUMENT,) if c in tagged.columns])
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        finally:
            tagged.unpersist()

    return (
        requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
