"""Run records as append-only tables: runs, candidate scores, model versions and aliases.

All four are small (a row per run, candidate or version) and are only ever appended to, so a
failed job leaves earlier rows as they were.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from pathlib import Path
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampNTZType()
_MAP = T.MapType(T.StringType(), T.StringType())
SCHEMAS = {
    "runs": [("run_id", _S), ("created_at", _TS), ("model_type", _S), ("cv_rmse", _D), ("rows", _L), ("is_new", T.BooleanType()),
             ("version", _L), ("path", _S), ("status", _S), ("tags", _MAP)],
    "scores": [("run_id", _S), ("seq", _L), ("model_type", _S), ("cv_rmse", _D), ("params", _MAP)],
    "versions": [("model_name", _S), ("version", _L), ("run_id", _S), ("model_type", _S), ("cv_rmse", _D), ("path", _S), ("created_at", _TS)],
    "aliases": [("model_name", _S), ("alias", _S), ("version", _L), ("event_seq", _L)],
}


def schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, t) for c, t in SCHEMAS[name]])


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema(name)).option("recursiveFileLookup", True).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # anything but "nothing written yet" is an error
                raise
            return self.spark.createDataFrame([], schema(name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Every call writes a folder of its own: appends to one folder at the same time would remove each other's files."""
        columns = [F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in schema(name)]
        rows.select(*columns).write.parquet(f"{self.path(name)}/{uuid.uuid4().hex}")

    def add(self, name: str, **values) -> None:
        fields = [f for f in schema(name)]
        row = tuple(values.get(f.name) for f in fields)
        self.append(name, self.spark.createDataFrame([row], T.StructType(fields)))

    def log_scores(self, run_id: str, board: DataFrame) -> None:
        self.append("scores", board.withColumn("run_id", F.lit(run_id)))

    def claim(self, kind: str, number: int) -> int:
        """The first free number from ``number`` on, taken for this caller alone.

        A number is taken by creating an empty file of that name only if it is absent. HDFS lets one caller do so, and so does
        a local disk; a store without such a promise gives none here.
        """
        folder = f"{self.root}/_claims/{quote(kind, safe='')}"
        while not self._created(f"{folder}/{number}"):
            number += 1
        return number

    def _created(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.getUri().getScheme() == "file":
            local = Path(path.toUri().getPath())
            local.parent.mkdir(parents=True, exist_ok=True)
            try:
                local.touch(exist_ok=False)
                return True
            except FileExistsError:
                return False
        try:
            return files.createNewFile(path)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
                return False
            raise

    def next_version(self, model_name: str) -> int:
        return (self.read("versions").where(F.col("model_name") == model_name).agg(F.max("version")).first()[0] or 0) + 1

    def register(self, model_name: str, run_id: str, model_type: str, cv_rmse: float, path: str,
                 alias: str = "production") -> int:
        """New version; the alias moves to it. Callers at the same time get different versions and one order of moves."""
        version = self.claim(f"version {model_name}", self.next_version(model_name))
        self.add("versions", model_name=model_name, version=version, run_id=run_id, model_type=model_type,
                 cv_rmse=float(cv_rmse), path=path, created_at=now())
        last = self.read("aliases").agg(F.max("event_seq")).first()[0]
        self.add("aliases", model_name=model_name, alias=alias, version=version, event_seq=self.claim("alias", (last or 0) + 1))
        return version

    def production(self, model_name: str, alias: str = "production") -> DataFrame:
        """The version the alias points at, with its score; no row when there is none."""
        return current_version(self.read("versions"), self.read("aliases"), alias).where(F.col("model_name") == model_name)

    def latest_path(self) -> DataFrame:
        return latest_pointer(self.read("runs"))

    def summary(self) -> DataFrame:
        return run_summary(self.read("runs"))


def current_version(versions: DataFrame, aliases: DataFrame, alias: str = "production") -> DataFrame:
    newest = aliases.where(F.col("alias") == alias).groupBy("model_name").agg(F.max_by("version", "event_seq").alias("version"))
    return versions.join(newest, ["model_name", "version"])


def latest_pointer(runs: DataFrame, path: str = "path", created: str = "created_at") -> DataFrame:
    return runs.agg(F.max_by(path, created).alias("path"), F.max(created).alias("created_at")).where(F.col("path").isNotNull())


def upload_decision(best: DataFrame, champion: DataFrame) -> DataFrame:
    """``best`` and ``champion`` hold at most one row each (per shared key). The champion stays on
    an equal or lower error; otherwise the new model is taken and uploaded."""
    on = [c for c in ("model_name", "line") if c in best.columns and c in champion.columns]
    held = champion.select(*on, F.col("model_type").alias("champion_type"), F.col("cv_rmse").alias("champion_rmse"))
    joined = best.join(held, on, "left") if on else best.join(held, F.lit(True), "left")
    keep = F.coalesce(F.col("champion_rmse") <= F.col("cv_rmse"), F.lit(False))
    return joined.select(
        *on, F.when(keep, F.col("champion_type")).otherwise(F.col("model_type")).alias("model_type"),
        F.when(keep, F.col("champion_rmse")).otherwise(F.col("cv_rmse")).alias("cv_rmse"),
        F.when(keep, "keep").otherwise("replace").alias("decision"), (~keep).alias("upload"))


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("executed"), "run_id", "model_type", "cv_rmse", "rows",
        F.when(F.col("is_new"), "new model uploaded").otherwise("existing model kept").alias("outcome"), "status")
