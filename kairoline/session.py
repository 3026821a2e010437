"""Session defaults, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # settled tables go once unused
}


def get_session(app: str = "kairoline", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for a local master where none is set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="kairoline-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage.

    Used where row positions must not move between jobs when an executor is lost.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
