"""Finished stages of a run, so that a run which was stopped goes on at the first unfinished one.

A run is known by its id and the fingerprint of its input files (keys, sizes and times).  Called again with the same id over the
same files, it takes what its finished stages left (tables in its work folder, results in the ledger); over other
files, or after it was finished, it starts anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.plans import sinks

ROW = "run_id string, fingerprint string, attempt int, stage string, result string"


class RunStopped(RuntimeError):
    """Raised where a run was told to stop after a stage."""


def fingerprint(files: DataFrame) -> str:
    """Of a listing (path, length, event_time), whatever its order; zero-byte files are listed without a time of their own."""
    at = F.when(F.col("length") > 0, F.col("event_time").cast("string"))
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", at).cast("decimal(38,0)"))).first()
    return hashlib.md5(f"{n} {total}".encode()).hexdigest()


class Stages:
    def __init__(self, spark: SparkSession, ledger: str, run_id: str, files: DataFrame, stop_after: str | None = None):
        self.spark, self.ledger, self.run_id, self.stop_after = spark, f"{ledger}/stages", run_id, stop_after
        self.fingerprint = fingerprint(files)
        rows = []
        if sinks.table_exists(spark, self.ledger):  # a few rows: the stages of one run
            rows = spark.read.schema(ROW).parquet(self.ledger).where(
                (F.col("run_id") == run_id) & (F.col("fingerprint") == self.fingerprint)).collect()
        self.attempt = sum(r.stage == "finished" for r in rows)
        self.done = {r.stage: json.loads(r.result) for r in rows if r.attempt == self.attempt}
        name = hashlib.md5(run_id.encode()).hexdigest()[:12]
        self.work = f"{ledger}/work/{name}-{self.fingerprint[:12]}-{self.attempt}"

    def _note(self, stage: str, result) -> None:
        self.spark.createDataFrame([(self.run_id, self.fingerprint, self.attempt, stage, json.dumps(result))], ROW).withColumn(
            "finished_at", F.current_timestamp()).write.mode("append").parquet(self.ledger)
        self.done[stage] = result

    def run(self, stage: str, fn: Callable):
        """The result of ``fn`` (something JSON can hold), or that of the time when this stage was finished."""
        if stage not in self.done:
            self._note(stage, fn())
            if stage == self.stop_after:
                raise RunStopped(f"stopped after {stage}")
        return self.done[stage]

    def table(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that a stage leaves in the work folder."""
        path = f"{self.work}/{stage}"

        def write():
            df = build()
            df.write.mode("overwrite").parquet(path)
            return df.schema.json()

        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(self.run(stage, write)))).parquet(path)

    def finish(self) -> None:
        self._note("finished", None)
