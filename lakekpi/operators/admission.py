"""Admission of landed objects (A1-A5, A7), archive selection (G1) and retention (G3) on key listings.

A listing is a DataFrame of object keys (plus etag / content hash, event time, size ...), whether it comes from
a ``binaryFile`` scan of the landing folder (``sources.listing``) or from notification records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.functions.text import extract_landing_date, extract_run_date, is_stream_key, strip_quotes
from lakekpi.operators.joins import sized_broadcast


def decode_keys(listing: DataFrame, key_col: str = "object_key") -> DataFrame:
    """A2: URL-decode keys as notifications deliver them (``%xx`` and ``+`` for space)."""
    return listing.withColumn(key_col, F.url_decode(F.col(key_col)))


def admit(listing: DataFrame, key_col: str = "object_key") -> DataFrame:
    """A1: keep stream CSVs only (landing prefix, ``.csv``, not a manifest)."""
    return listing.filter(is_stream_key(F.col(key_col)))


def with_dates(listing: DataFrame, key_col: str = "object_key") -> DataFrame:
    """A3: both date extractions — (a) text after ``landing_date=`` up to ``/`` (or ''), (b) strict pattern or 'unknown'."""
    k = F.col(key_col)
    return listing.withColumn("landing_date", extract_landing_date(k)).withColumn("run_date", extract_run_date(k))


def run_inputs(listing: DataFrame, bucket: str | Column, key_col: str = "object_key", etag_col: str = "etag",
               fallback_id: Column | None = None) -> DataFrame:
    """A5: run input records for admitted keys; execution_id = quote-stripped etag, else a fallback id.
    Rows with a blank bucket or key are rejected (dropped here; ``rejected_inputs`` lists them)."""
    b = F.lit(bucket) if isinstance(bucket, str) else bucket
    etag = strip_quotes(F.col(etag_col))
    fb = fallback_id if fallback_id is not None else F.concat(F.lit("req-"), F.sha1(F.col(key_col)).substr(1, 16))
    out = listing.select(
        b.alias("bucket"),
        F.col(key_col).alias("key"),
        extract_landing_date(F.col(key_col)).alias("landing_date"),
        F.col("event_time"),
        F.when(F.length(etag) > 0, etag).otherwise(fb).alias("execution_id"),
    )
    ok = F.col("bucket").isNotNull() & (F.col("bucket") != "") & F.col("key").isNotNull() & (F.col("key") != "")
    return out.filter(ok)


def first_per_content(listing: DataFrame, hash_col: str = "etag", order: list[str] | None = None) -> DataFrame:
    """A4 (within a listing): one object per content hash — the earliest by ``order`` (default event_time, key).

    Computed as a min over a struct (hash aggregate with map-side combine), so a hash shared by millions of
    copies never lands in one task.
    """
    order = order or ["event_time", "object_key"]
    others = [c for c in listing.columns if c not in (hash_col, *order)]
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others])).alias("_b")
    return listing.groupBy(hash_col).agg(best).select(hash_col, "_b.*").select(*listing.columns)


def new_runs(listing: DataFrame, ledger: DataFrame, now: Column, hash_col: str = "etag",
             window_days: int = K.DEDUPE_WINDOW_DAYS) -> DataFrame:
    """A4: admitted objects whose content has not started a run in the last ``window_days`` days.

    ``ledger`` holds (execution_id, started_at) of earlier runs; older entries no longer block a re-run.
    """
    recent = ledger.filter(F.col("started_at") > now - F.make_dt_interval(days=F.lit(window_days))).select(
        F.col("execution_id").alias(hash_col)
    ).distinct()
    return first_per_content(listing, hash_col).join(recent, hash_col, "left_anti")


def classify_failures(failed: DataFrame, now: Column, max_attempts: int = K.MAX_RETRY_ATTEMPTS,
                      max_age_s: int = K.MAX_EVENT_AGE_SECONDS, keep_days: int = K.DEAD_LETTER_RETENTION_DAYS) -> DataFrame:
    """Failed deliveries (object_key, attempts, event_time, failed_at) -> retry / dead_letter / expired."""
    age = F.unix_seconds(F.col("failed_at").cast("timestamp")) - F.unix_seconds(F.col("event_time").cast("timestamp"))
    dead_age = F.unix_seconds(now) - F.unix_seconds(F.col("failed_at").cast("timestamp"))
    disp = (
        F.when((F.col("attempts") <= max_attempts) & (age <= max_age_s), F.lit("retry"))
        .when(dead_age <= keep_days * 86400, F.lit("dead_letter"))
        .otherwise(F.lit("expired"))
    )
    return failed.withColumn("event_age_s", age).withColumn("disposition", disp)


def replay_set(listing: DataFrame, classified: DataFrame, key_col: str = "object_key") -> DataFrame:
    """A7 replay: admitted listing entries whose delivery sits in the dead-letter set."""
    dead = classified.filter(F.col("disposition") == "dead_letter").select(key_col)
    return admit(listing, key_col).join(sized_broadcast(dead), key_col, "left_semi")


def archive_candidates(listing: DataFrame, keys: DataFrame | None = None, key_col: str = "object_key") -> DataFrame:
    """G1: given keys (semi-join), else every admitted stream key; archivable = A1 predicate and non-blank."""
    base = admit(listing, key_col)
    if keys is not None:
        base = base.join(sized_broadcast(keys.select(key_col).distinct()), key_col, "left_semi")
    return base


def retention_prune(objects: DataFrame, policy: DataFrame, now: Column, key_col: str = "object_key",
                    time_col: str = "event_time") -> DataFrame:
    """Objects older than their storage area's retention -> prune set.

    ``policy`` is (area, days), one row per area (configuration-sized, broadcast); an object's area is the first
    segment of its key, so the match is an equi-join.
    """
    area = F.substring_index(F.col(key_col), "/", 1)
    j = objects.withColumn("area", area).join(F.broadcast(policy), "area")
    age_days = F.datediff(F.to_date(now), F.to_date(F.col(time_col)))
    return j.withColumn("age_days", age_days).filter(F.col("age_days") > F.col("days"))


def retention_policy(spark, days: dict | None = None) -> DataFrame:
    return spark.createDataFrame(sorted((days or K.RETENTION_DAYS).items()), "area string, days int")


def date_spine(start: str, end: Column | str) -> Column:
    """Every day from ``start`` to ``end`` inclusive, as an array column (explode it)."""
    e = F.to_date(F.lit(end)) if isinstance(end, str) else F.to_date(end)
    return F.sequence(F.to_date(F.lit(start)), e, F.expr("INTERVAL 1 DAY"))


def missing_days(present: DataFrame, start: str, end: Column | str, day_col: str = "day") -> DataFrame:
    """Days of the projected range [start, end] without a present partition."""
    spark = present.sparkSession
    spine = spark.range(1).select(F.explode(date_spine(start, end)).alias(day_col))
    have = present.select(F.to_date(F.col(day_col)).alias(day_col)).distinct()
    return spine.join(have, day_col, "left_anti")
