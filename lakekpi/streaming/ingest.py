"""Landed batch files as a stream: admitted, de-duplicated by content, validated and run like a batch.

The stream's rows are files, not records: a streaming listing (key, size, content hash) of the landing folder, reduced to
stream CSVs (A1) whose content has not come up in the last 90 days (A4).  The hashes are kept as state under a watermark on
the time of arrival, so no file is ever too late.  Each micro-batch hands its files to ``run_batch`` (validate, quarantine or
curate, aggregate, serve), the same as for a batch, so both ways share file identities, ledgers and tables.

The epoch ledger makes a micro-batch that is replayed after a failure a no-op if it had been finished.  An unfinished one is run
again: its writes replace their own (per-file replace in Silver, dynamic overwrite of days, keyed upserts).  A micro-batch that
fails is tried again, up to two times; then its files go to the failure ledger as dead letters, and the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.operators import admission as A
from lakekpi.plans import sinks
from lakekpi.plans.batch import Layout, new_files, run_batch
from lakekpi.sources.csv_scan import object_key

LISTING = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming listing of the landing folder: object_key, path, length, event_time, etag (md5 of the content), seen_at."""
    r = spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(f"{landing_root.rstrip('/')}/{K.STREAM_ROOT}").select(
        object_key(F.col("path"), landing_root, encoded=False).alias("object_key"), "path", "length",
        F.col("modificationTime").alias("event_time"), F.md5("content").alias("etag"), F.current_timestamp().alias("seen_at"))


def new_contents(files: DataFrame, window_days: int = K.DEDUPE_WINDOW_DAYS) -> DataFrame:
    """A1 + A4 on a stream: stream CSVs, one per content within ``window_days``."""
    return A.admit(files).withWatermark("seen_at", f"{window_days} days").dropDuplicatesWithinWatermark(["etag"])


def epochs_done(spark: SparkSession, layout: Layout, stream: str) -> DataFrame:
    """Epochs of a stream with their outcome (epoch_id, status, error)."""
    path = f"{layout.ledger}/epochs"
    if not sinks.table_exists(spark, path):
        return spark.createDataFrame([], "epoch_id long, status string, error string")
    return spark.read.parquet(path).where(F.col("stream") == stream).select("epoch_id", "status", "error")


def ingest(spark: SparkSession, layout: Layout, checkpoint: str, songs: DataFrame, users: DataFrame,
           max_files_per_trigger: int | None = None, available_now: bool = True, retries: int = K.MAX_RETRY_ATTEMPTS, **run):
    """Start (and, with ``available_now``, finish) the ingest of every file not yet processed; ``run`` goes to ``run_batch``.

    Returns the streaming query and the results of the epochs run by it.
    """
    stream = checkpoint.rstrip("/").rsplit("/", 1)[-1]
    results: list = []

    def note(epoch_id: int, status: str, error: str | None) -> None:
        spark.createDataFrame([(stream, epoch_id, status, error)], "stream string, epoch_id long, status string, error string").withColumn(
            "finished_at", F.current_timestamp()).write.mode("append").parquet(f"{layout.ledger}/epochs")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # the listing is run whole and once, whatever follows, so that the state of its hashes is kept
        listed = sinks.stage(batch.drop("seen_at"), "epoch-files")
        if not epochs_done(spark, layout, stream).where(F.col("epoch_id") == epoch_id).isEmpty():
            return
        run_id = f"{stream}-{epoch_id}"
        files = new_files(spark, layout, listed, run_id)
        if files.isEmpty():  # an epoch that only moves the watermark
            return
        error = None
        for attempt in range(retries + 1):
            try:
                results.append(run_batch(spark, layout, songs, users, files=files, execution_id=run_id, **run))
                return note(epoch_id, "SUCCEEDED", None)
            except Exception as exc:  # noqa: BLE001 - tried again, then recorded
                error = str(exc)
        (files.select("object_key", F.lit(retries + 1).alias("attempts"), "event_time", F.current_timestamp().alias("failed_at"),
                      F.lit(error).alias("error")).write.mode("append").parquet(f"{layout.ledger}/failures"))
        note(epoch_id, "DEAD_LETTER", error)

    w = new_contents(file_stream(spark, layout.landing, max_files_per_trigger)).writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q, results
