"""Compaction of day partitions that hold many small files.

Sizes come from a listing alone.  A day is rewritten when its bytes fit into fewer files of the target size; its rows are dealt by hash
into that many bins, so no value makes a bin large, and each bin is one file.  The new files are staged and compared with
the old rows (count and hash by day) before the day folders are swapped; other days are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakekpi.plans.sinks import stage
from lakekpi.plans.small_files import OldCalendar, list_table, read_table

TARGET_BYTES = 256 * 1024 * 1024


class RowsDiffer(RuntimeError):
    pass


def _day(day_col: str):
    return F.regexp_extract("path", f"/{day_col}=([^/]+)/", 1)


def day_sizes(spark: SparkSession, table: str, day_col: str) -> DataFrame:
    """Per day: files, bytes, and files below half the target size in a size histogram of powers of four."""
    files = list_table(spark, table).where(F.col("path").endswith(".parquet")).select(_day(day_col).alias("day"), F.col("length").alias("bytes"))
    return files.groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("smallest"), F.max("bytes").alias("largest"))


def plan(sizes: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Days to rewrite, with ``bins``, the number of files each is to have, and ``first``, the number of its first bin."""
    bins = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target_bytes))).cast("long")
    days = sizes.withColumn("bins", bins).where("files > bins")
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    return days.withColumn("first", F.coalesce(F.sum("bins").over(before), F.lit(0)))


def row_hashes(rows: DataFrame, day_col: str) -> DataFrame:
    """Rows and an order-free hash of all columns, by day."""
    return rows.groupBy(F.col(day_col).cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("row_hash"))


def compact(spark: SparkSession, table: str, day_col: str = "event_date", target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite the days that need it; per rewritten day: files and bytes before, rows, row_hash and the number of bins."""
    days = stage(plan(day_sizes(spark, table, day_col), target_bytes), "compact-plan")
    total = days.agg(F.sum("bins")).first()[0]
    if not total:
        return days.select("day", "files", "bytes", "bins").withColumns({"n_rows": F.lit(0).cast("long"), "row_hash": F.lit(None).cast("decimal(38,0)")})
    small = F.broadcast(days.select(F.col("day").alias("_day"), "bins", "first"))  # one row a day
    writers = max(int(total), 8 * spark.sparkContext.defaultParallelism)  # else each task would stage small files of its own
    files = stage(list_table(spark, table), "compact-files")

    def dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        old = rows.join(small, F.col(day_col).cast("string") == F.col("_day")).drop("_day")
        bins = (F.col("first") + F.pmod(F.xxhash64(*rows.columns), F.col("bins"))).cast("int")
        return old, stage(old.withColumn("_bin", bins).drop("bins", "first").coalesce(writers), "compact"), rows.columns

    try:
        old, staged, columns = dealt(read_table(spark, table, files, writers, files.join(small, _day(day_col) == F.col("_day"), "left_semi")))
    except Exception as exc:  # noqa: BLE001 - of a task, wrapped by the writer
        if OldCalendar.__name__ not in str(exc):
            raise
        old, staged, columns = dealt(spark.read.parquet(table))
    before, after = row_hashes(old.select(columns), day_col), row_hashes(staged.select(columns), day_col)
    checked = stage(days.join(before, "day").join(after.toDF("day", "a_rows", "a_hash"), "day", "left"), "compact-check")
    if not checked.where("not (n_rows <=> a_rows and row_hash <=> a_hash)").isEmpty():
        raise RowsDiffer(f"rows of {table} changed while they were compacted; nothing was replaced")
    (staged.repartitionById(int(total), F.col("_bin")).drop("_bin").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).parquet(table))
    return checked.select("day", "files", "bytes", "bins", "n_rows", "row_hash")
