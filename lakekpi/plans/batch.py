"""Run a batch of landed files end to end — validate, quarantine or curate, aggregate, serve, archive."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.operators import admission as A
from lakekpi.operators import serve as E
from lakekpi.operators import validate as B
from lakekpi.plans import archive as G
from lakekpi.plans import sinks
from lakekpi.plans.gold import GoldResult, run_gold
from lakekpi.plans.load import LoadResult, run_load, serving_table
from lakekpi.plans.silver import SilverResult, run_silver
from lakekpi.plans.stages import Stages
from lakekpi.session import size_shuffles
from lakekpi.sources.csv_scan import read_batches, typed_streams
from lakekpi.sources.listing import empty_objects, list_objects


@dataclass
class Layout:
    landing: str      # bronze landing root (holds streams/landing_date=.../*.csv)
    silver: str
    gold: str
    serving: str
    quarantine: str
    archive: str
    manifests: str    # manifest documents (JSON)
    ledger: str       # run / file status ledger (Parquet)


@dataclass
class BatchResult:
    valid_keys: list[str]
    invalid_keys: list[str]
    days: list[str]
    silver: object = None
    gold: object = None
    load: object = None
    archived: DataFrame | None = field(default=None, repr=False)


def run_batch(spark: SparkSession, layout: Layout, songs: DataFrame, users: DataFrame, paths=None,
              execution_id: str = "run", **kw) -> BatchResult:
    """Process the given batch files as one run and record its outcome in the run ledger.

    Without ``paths`` the run takes ``files`` (rows of ``admitted``) or else what ``admitted`` finds: stream CSVs, zero-byte ones too,
    one per content, whose content has not started a run in the last 90 days.  Given ``paths`` are processed again whatever the ledger says.
    The ledger row (execution_id, status, valid/invalid file counts, days, error) is appended on success and on
    failure; a run of invalid files alone is FAILED; an exception is re-raised after it is recorded.
    """
    try:
        res = _run_batch(spark, layout, songs, users, paths, execution_id=execution_id, **kw)
    except Exception as exc:
        _ledger(spark, layout, execution_id, "FAILED", None, str(exc))
        raise
    if res.invalid_keys and not res.valid_keys:  # as for a single invalid file: quarantined, and the run failed
        _ledger(spark, layout, execution_id, "FAILED", res, f"all {len(res.invalid_keys)} file(s) are invalid")
    else:
        _ledger(spark, layout, execution_id, "SUCCEEDED", res, None)
    return res


def admitted(spark: SparkSession, layout: Layout, run_id: str | None = None) -> DataFrame:
    """A1 + A4 for a run: landed stream CSVs (object_key, path, length, event_time, etag), the earliest of each content,
    without those whose content is in the file ledger of the last 90 days."""
    return new_files(spark, layout, A.admit(list_objects(spark, layout.landing)), run_id)


def new_files(spark: SparkSession, layout: Layout, files: DataFrame, run_id: str | None = None) -> DataFrame:
    """The listed files and the zero-byte ones (which no scan shows), the earliest of each content, without those whose
    content another run took up in the last 90 days."""
    # the hash of nothing would make all empty files one, and each gets a verdict of its own
    empty = A.admit(empty_objects(spark, layout.landing)).select(
        "object_key", "path", F.lit(0).cast("long").alias("length"), F.current_timestamp().alias("event_time"),
        F.concat(F.lit("empty:"), F.col("object_key")).alias("etag"))
    found = files.where("length > 0").select(*empty.columns).unionByName(empty)
    done = f"{layout.ledger}/files"
    if not sinks.table_exists(spark, done):
        return sinks.stage(A.first_per_content(found), "admitted")
    others = spark.read.parquet(done).where(~F.col("run_id").eqNullSafe(F.lit(run_id)))
    return sinks.stage(A.new_runs(found, others, F.current_timestamp()), "admitted")


def _ledger(spark, layout: Layout, execution_id: str, status: str, res: BatchResult | None, error: str | None) -> None:
    row = (execution_id, status, len(res.valid_keys) if res else None, len(res.invalid_keys) if res else None,
           ",".join(res.days) if res else None, error or None)
    spark.createDataFrame([row], "execution_id string, status string, valid_files int, invalid_files int, days string, "
                                 "error string").withColumn("finished_at", F.current_timestamp()) \
        .write.mode("append").parquet(f"{layout.ledger}/runs")


def _run_batch(spark: SparkSession, layout: Layout, songs: DataFrame, users: DataFrame, paths=None,
              execution_id: str = "run", ingested_at: str | None = None, event_time: str | None = None,
              max_drop_rate: float | None = None, archive_files: bool = True, now: Column | None = None,
              files: DataFrame | None = None, stop_after: str | None = None) -> BatchResult:
    """Validate, quarantine, curate, aggregate, load and archive; an exception of any stage propagates (quarantine of
    invalid files happens before that).  A run that was stopped goes on at its first unfinished stage."""
    if paths is None:
        fresh = admitted(spark, layout, execution_id) if files is None else files
        # file readers take a list of paths, so those of the new files come to the driver
        rows = fresh.select("object_key", "path", "length").collect()
        paths, empty = [r.path for r in rows if r.length], [r.object_key for r in rows if not r.length]
        if not rows:
            return BatchResult([], [], [])
        size_shuffles(spark, sum(r.length for r in rows))
        stages = Stages(spark, layout.ledger, execution_id, fresh, stop_after)
        stages.run("ledger", lambda: fresh.select(
            F.col("etag").alias("execution_id"), "object_key", F.current_timestamp().alias("started_at"),
            F.lit(execution_id).alias("run_id")).write.mode("append").parquet(f"{layout.ledger}/files"))
    else:
        empty = []
        stages = Stages(spark, layout.ledger, execution_id, spark.read.format("binaryFile").load(paths).select(
            "path", "length", F.col("modificationTime").alias("event_time")), stop_after)
    verdicts, records = _validated(spark, layout, stages, paths, empty, execution_id, event_time, now)
    keys = verdicts.select("source_key", "valid").collect()  # one row per batch file
    good = sorted(r.source_key for r in keys if r.valid)
    bad = sorted(r.source_key for r in keys if not r.valid)
    if bad:
        def set_aside():
            ledger = sinks.stage(G.quarantine(spark, layout.landing, layout.quarantine, verdicts.filter(~F.col("valid")), paths), "quarantine")
            ledger.withColumn("execution_id", F.lit(execution_id)).write.mode("append").parquet(f"{layout.ledger}/quarantine")
            return [r.key for r in ledger.filter(~F.col("quarantined")).select("key").collect()]

        if failed := stages.run("quarantine", set_aside):
            print(f"Quarantine copy failed for {failed}")
    result = BatchResult(good, bad, [])
    if good:
        kw = {} if max_drop_rate is None else {"max_drop_rate": max_drop_rate}
        result.silver = SilverResult(**stages.run("silver", lambda: _fields(run_silver(
            spark, typed_streams(B.route(verdicts, records)[0]), songs, users, layout.silver, run_key=good[0], ingested_at=ingested_at,
            execution_id=execution_id, per_file=True, metrics_root=f"{layout.ledger}/metrics", **kw))))
        result.days = result.silver.days
        if result.days:
            def counted(job):
                def run():
                    done = job()
                    done.metrics.write.mode("append").parquet(f"{layout.ledger}/metrics")
                    return _fields(done)
                return run

            result.gold = GoldResult(**stages.run("gold", counted(lambda: run_gold(
                spark, layout.silver, layout.gold, result.days, ingested_at, execution_id))))
            result.load = LoadResult(**stages.run("load", counted(lambda: run_load(
                spark, layout.gold, layout.serving, result.days, ingested_at, execution_id, loaded_at=now))))
        if archive_files:
            done = verdicts.filter("valid").select(F.col("source_key").alias("object_key"))
            result.archived = stages.table("archive", lambda: G.archive(spark, layout.landing, layout.archive, done, paths=paths))
    stages.finish()
    return result


def _fields(result) -> dict:
    """A job's result without its metrics, which are stored."""
    return {k: v for k, v in vars(result).items() if k != "metrics"}


def _validated(spark, layout: Layout, stages: Stages, paths, empty, execution_id, event_time, now) -> tuple[DataFrame, DataFrame]:
    """(verdicts, records): the files read and validated; manifests, tags and reports written."""
    found = []

    def read():
        # parse the CSVs once (staged tagged scan); validation, routing and curation read staged records
        files, records = read_batches(spark, layout.landing, paths, empty_keys=empty)
        found.append(files)
        return records

    records = stages.table("records", read)

    def headers():
        files = found[0] if found else read_batches(spark, layout.landing, paths, empty_keys=empty)[0]
        # each file is a run of its own to reports and manifests, as in the ledger of runs by file
        own_id = F.concat_ws("/", F.lit(execution_id), "source_key")
        return files.withColumn("execution_id", own_id).withColumn(
            "event_time", F.lit(event_time) if event_time else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).withColumn("bucket", F.lit(layout.landing))

    files = stages.table("files", headers)
    verdicts = stages.table("verdicts", lambda: B.validate(files, records))

    def reports():
        (B.manifest_json(verdicts).select("json", "manifest_key").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("manifest_key").text(layout.manifests))
        tags = B.status_tags(verdicts).withColumn("execution_id", F.lit(execution_id))
        tags.write.mode("append").parquet(f"{layout.ledger}/status")
        report = B.dq_report(verdicts, now)
        try:  # B10: a failed DQ-report write is logged, never fatal
            sinks.upsert_partitions(report, serving_table(layout.serving, E.DQ_REPORTS),
                                    [E.DQ_REPORTS.pk, E.DQ_REPORTS.sk], E.DQ_REPORTS.day_col)
        except Exception as exc:  # noqa: BLE001
            print(f"Failed to write DQ report for run {execution_id}: {exc}")

    stages.run("reports", reports)
    return verdicts, records
