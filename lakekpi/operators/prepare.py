"""Batch preparation (I1-I3): load and trim event files, partition them into daily landing batches, sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import schemas as S
from lakekpi.functions.time import date_string


def load_trimmed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many header CSVs -> (user_id, track_id, listen_time) as trimmed text."""
    df = spark.read.option("header", "true").option("mode", "PERMISSIVE").csv(paths)
    return trim_fields(df)


def trim_fields(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in S.TRIPLET])


def with_landing_date(df: DataFrame, strict: bool = True) -> DataFrame:
    """landing_date = day of listen_time.  ``strict`` raises on a bad timestamp (ANSI ``to_timestamp``),
    as the batch producer does; otherwise bad rows get a null landing date."""
    fmt = F.lit("yyyy-MM-dd HH:mm:ss")
    ts = F.to_timestamp("listen_time", "yyyy-MM-dd HH:mm:ss") if strict else F.try_to_timestamp(F.col("listen_time"), fmt)
    return df.withColumn("landing_date", date_string(ts))


def landing_counts(df: DataFrame) -> DataFrame:
    """Rows per landing batch."""
    return with_landing_date(df).groupBy("landing_date").agg(F.count(F.lit(1)).alias("n_records"))


def write_landing_batches(df: DataFrame, root: str, files_per_day: int | None = None) -> None:
    """One header CSV folder per landing date (``landing_date=YYYY-MM-DD``), fixed column order.

    Rows are rebalanced by day so a heavy day is split across writers instead of one task.
    """
    out = with_landing_date(df).select(*S.TRIPLET, "landing_date")
    out = out.hint("rebalance", "landing_date") if files_per_day is None else out.repartition(files_per_day, "landing_date")
    out.write.mode("overwrite").option("header", "true").partitionBy("landing_date").csv(root)


def sample_rows(df: DataFrame, n: int = 500, seed: int | None = None, order_key: list[Column] | None = None) -> DataFrame:
    """N rows without replacement — a random order (``seed``) or a given deterministic order key.
    Planned as a distributed top-n (each task keeps n rows, the driver merges n x tasks)."""
    key = order_key if order_key is not None else [F.rand(seed)]
    return df.orderBy(*key).limit(n)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """I3 prefix mode."""
    return df.limit(n)
