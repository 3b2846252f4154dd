"""Batch-file validation: required fields, empty files, schema drift, run date, manifests, DQ reports.

Inputs are two DataFrames:
* ``files``   – one row per batch file: source_key, landing_date, fields (header names, array<string>), and
                optionally bucket, execution_id, event_time, first_row_extra (first data row longer than the header)
* ``records`` – one row per data record: source_key, row_no (file line number, first record = 2) and the
                required fields as text (null when absent from the header)

Everything is per-file aggregation; nothing gathers a whole file into one task.  The manifest's error list is a
top-20 per file (partial ``WindowGroupLimit`` before the shuffle), so its size is bounded whatever the file size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi import schemas as S
from lakekpi.functions.text import manifest_key, strip_ws, truncate_tag
from lakekpi.functions.time import date_string, parse_listen_ts


_MSG_HEAD, _MSG_TAIL = K.MISSING_FIELD_ERROR.split("{n}")


def _blank(c: Column) -> Column:
    return c.isNull() | (strip_ws(c) == "")


def _error_items(records: DataFrame) -> Column:
    return F.array_compact(F.array(*[
        F.when(
            _blank(F.col(f)),
            F.struct(
                F.lit(i).alias("field_idx"),
                F.lit(f).alias("field"),
                F.concat(
                    F.lit(_MSG_HEAD), F.col("row_no").cast("string"), F.lit(_MSG_TAIL.format(f=f))
                ).alias("error"),
            ),
        )
        for i, f in enumerate(S.REQUIRED_FIELDS)
    ]))


def record_errors(records: DataFrame) -> DataFrame:
    """B2: one row per (record, missing field): source_key, row_no, field_idx, field, error."""
    return records.select("source_key", "row_no", F.inline(_error_items(records)))


def file_stats(records: DataFrame) -> DataFrame:
    """B2-B4 + B7 in one aggregate per file: record_count, record-level error count, earliest listen date."""
    return records.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(F.size(_error_items(records))).alias("_errs"),
        F.min(F.to_date(parse_listen_ts("listen_time"))).alias("_first_day"),
    )


def file_counts(files: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """record_count, error_count and verdict per file; a file without records is invalid (1 error)."""
    rc = records.groupBy("source_key").agg(F.count(F.lit(1)).alias("record_count"))
    ec = errors.groupBy("source_key").agg(F.count(F.lit(1)).alias("_errs"))
    out = (
        files.select("source_key").distinct()
        .join(rc, "source_key", "left")
        .join(ec, "source_key", "left")
        .withColumn("record_count", F.coalesce("record_count", F.lit(0)).cast("long"))
    )
    empty = F.col("record_count") == 0
    error_count = F.when(empty, F.lit(1)).otherwise(F.coalesce("_errs", F.lit(0))).cast("long")
    return out.withColumn("error_count", error_count).withColumn("valid", error_count == 0).drop("_errs")


def schema_drift(files: DataFrame, counts: DataFrame) -> DataFrame:
    """Drift map per file from the first record's fields (header names, plus ``_extra`` when the first
    data row is longer than the header).  Empty file -> every required field missing.  Only non-empty entries."""
    observed = F.col("fields")
    if "first_row_extra" in files.columns:
        observed = F.when(F.col("first_row_extra"), F.array_union(observed, F.array(F.lit("_extra")))).otherwise(observed)
    required = F.array(*[F.lit(f) for f in S.REQUIRED_FIELDS])
    optional = F.array(*[F.lit(f) for f in S.OPTIONAL_FIELDS]) if S.OPTIONAL_FIELDS else F.array().cast("array<string>")
    expected = F.array_union(required, optional)
    entries = F.map_from_arrays(
        F.array(F.lit("unknown_fields"), F.lit("missing_required_fields"), F.lit("missing_optional_fields")),
        F.array(
            F.array_sort(F.array_distinct(F.array_except(F.col("_obs"), expected))),
            F.array_sort(F.array_except(required, F.col("_obs"))),
            F.array_sort(F.array_except(optional, F.col("_obs"))),
        ),
    )
    drift = F.when(
        F.col("record_count") == 0, F.create_map(F.lit("missing_required_fields"), required)
    ).otherwise(F.map_filter(entries, lambda k, v: F.size(v) > 0))
    return (
        files.select("source_key", observed.alias("_obs"))
        .join(counts.select("source_key", "record_count"), "source_key")
        .select("source_key", drift.alias("schema_drift"))
    )


def derive_run_date(files: DataFrame, records: DataFrame) -> DataFrame:
    """Earliest parseable listen date of each file, else its landing date (strict Spark pattern)."""
    first = records.groupBy("source_key").agg(F.min(F.to_date(parse_listen_ts("listen_time"))).alias("_d"))
    return (
        files.select("source_key", "landing_date")
        .join(first, "source_key", "left")
        .select("source_key", F.coalesce(date_string("_d"), F.col("landing_date")).alias("run_date"))
    )


def first_errors(errors: DataFrame, files: DataFrame | None = None, n: int = K.MAX_REPORTED_ERRORS) -> DataFrame:
    """First ``n`` errors of each file in file order (rows, then field order); empty files get their one error."""
    w = Window.partitionBy("source_key").orderBy("row_no", "field_idx")
    top = errors.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n)
    lists = top.groupBy("source_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_k", "error"))), lambda x: x["error"]).alias("errors")
    )
    return lists


def validate(files: DataFrame, records: DataFrame) -> DataFrame:
    """One verdict row per file with counts, drift, run date, first errors and manifest key.

    Two passes over the records: one aggregate per file (counts, errors, earliest date) and the bounded
    top-20 error list.
    """
    stats = file_stats(records)
    extra = [c for c in ("bucket", "execution_id", "event_time") if c in files.columns]
    fcols = ["fields", "first_row_extra"] if "first_row_extra" in files.columns else ["fields"]
    base = (
        files.select("source_key", "landing_date", *fcols, *extra)
        .join(stats, "source_key", "left")
        .withColumn("record_count", F.coalesce("record_count", F.lit(0)).cast("long"))
    )
    empty = F.col("record_count") == 0
    error_count = F.when(empty, F.lit(1)).otherwise(F.coalesce("_errs", F.lit(0))).cast("long")
    base = base.withColumn("error_count", error_count).withColumn("valid", error_count == 0)
    drift = schema_drift(base.select("source_key", *fcols), base.select("source_key", "record_count"))
    errs = first_errors(record_errors(records))
    empty_err = F.array(F.lit(K.EMPTY_FILE_ERROR))
    return (
        base.join(drift, "source_key")
        .join(errs, "source_key", "left")
        .withColumn("run_date", F.coalesce(date_string("_first_day"), F.col("landing_date")))
        .withColumn("errors", F.when(empty, empty_err).otherwise(F.col("errors")))
        .withColumn("manifest_key", manifest_key("source_key"))
        .select("source_key", "landing_date", *extra, "record_count", "error_count", "valid", "schema_drift",
                "run_date", "errors", "manifest_key")
    )


def manifest_json(verdicts: DataFrame, validated_at: Column | None = None) -> DataFrame:
    """(manifest_key, json) — the manifest document of each file; ``errors`` only when there are any."""
    at = validated_at if validated_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    doc = F.struct(
        F.col("source_key"),
        F.col("landing_date"),
        F.col("run_date"),
        F.col("valid"),
        F.col("record_count"),
        F.col("error_count"),
        F.col("schema_drift"),
        F.col("execution_id") if "execution_id" in verdicts.columns else F.lit(None).cast("string").alias("execution_id"),
        at.alias("validated_at"),
        F.when(F.col("error_count") > 0, F.col("errors")).alias("errors"),
    )
    return verdicts.select("manifest_key", F.to_json(doc, {"ignoreNullFields": "true"}).alias("json"))


def status_tags(verdicts: DataFrame, execution_id: Column | str | None = None) -> DataFrame:
    """Validated / pipeline_run_id / landing_date tags, each cut to 256 characters."""
    run = F.col("execution_id") if execution_id is None else (F.lit(execution_id) if isinstance(execution_id, str) else execution_id)
    ld = F.col("landing_date")
    return verdicts.select(
        "source_key",
        F.when(F.col("valid"), F.lit("true")).otherwise(F.lit("false")).alias("validated"),
        truncate_tag(run).alias("pipeline_run_id"),
        F.when(ld.isNull() | (ld == ""), F.lit(K.UNKNOWN)).otherwise(truncate_tag(ld)).alias("landing_date"),
    )


def dq_report(verdicts: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """DQ report rows keyed (batch_id, event_date = first 10 chars of event_time), expiring after 30 days."""
    now = processed_at if processed_at is not None else F.current_timestamp()
    return verdicts.select(
        F.col("execution_id").alias("batch_id"),
        F.substring("event_time", 1, 10).alias("event_date"),
        (F.col("bucket") if "bucket" in verdicts.columns else F.lit(None).cast("string")).alias("bucket"),
        F.col("source_key").alias("key"),
        "record_count",
        "error_count",
        "errors",
        "schema_drift",
        now.alias("processed_at"),
        (F.unix_seconds(now) + F.lit(K.TTL_DAYS["dq_reports"] * 86400)).alias("expires_at"),
    )


def route(verdicts: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of valid files, records of invalid files) via semi / anti joins on the small verdict set."""
    good = verdicts.filter(F.col("valid")).select("source_key")
    return records.join(good, "source_key", "left_semi"), records.join(good, "source_key", "left_anti")


def quarantine_ledger(verdicts: DataFrame, execution_id: str | None = None) -> DataFrame:
    """B12 status rows: every invalid file with its quarantine key; a missing key yields an error row."""
    bad = verdicts.filter(~F.col("valid"))
    key = F.col("source_key")
    missing = key.isNull() | (key == "")
    run = F.lit(execution_id) if execution_id else F.col("execution_id")
    return bad.select(
        run.alias("execution_id"),
        key.alias("key"),
        (~missing).alias("quarantined"),
        F.when(~missing, F.concat(F.lit(K.QUARANTINE_PREFIX), key)).alias("quarantine_key"),
        F.when(missing, F.lit(K.MISSING_KEY_ERROR)).alias("error"),
    )


def dq_lookup(reports: DataFrame, batch_id: str, event_date: str) -> DataFrame:
    """One batch's DQ report with its rejection rate."""
    return reports.filter((F.col("batch_id") == batch_id) & (F.col("event_date") == event_date)).withColumn(
        "rejection_rate",
        F.when(F.col("record_count") > 0, F.col("error_count") / F.col("record_count")),
    )


def rejected_inputs(inputs: DataFrame) -> DataFrame:
    """Run inputs without bucket or key are invalid without being read (verdict row keeps every column)."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return inputs.filter(blank("bucket") | blank("key")).select(
        F.col("key").alias("source_key"),
        F.lit(False).alias("valid"),
        F.col("execution_id"),
        F.lit(K.MISSING_COORDINATES_ERROR).alias("error"),
    )


def unreadable_verdicts(unreadable: DataFrame, root: str) -> DataFrame:
    """Files that could not be read are invalid with the read error as reason."""
    from lakekpi.sources.csv_scan import object_key

    return unreadable.select(
        object_key(F.col("path"), root).alias("source_key"), F.lit(False).alias("valid"), "error"
    )
