"""Partitioned Parquet tables: day slices with guards (A11, A12), Gold reads with text dates."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from lakekpi.functions.time import date_string


class PartitionMissing(RuntimeError):
    pass


class PartitionEmpty(ValueError):
    pass


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Whole partitioned table (partition columns discovered from ``key=value`` folders).

    ``merge_schema`` reconciles files written before a column was added (J5): old rows read the new column
    as null.
    """
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(path)


def read_days(spark: SparkSession, path: str, days: list[str], day_col: str = "event_date",
              check: bool = True, merge_schema: bool = False) -> DataFrame:
    """Rows of the given days; the filter on the partition column prunes every other folder.

    Guards: a missing table -> ``PartitionMissing``; no rows for the days -> ``PartitionEmpty``.
    """
    try:
        df = read_table(spark, path, merge_schema)
    except AnalysisException as exc:
        raise PartitionMissing(f"Cannot read {path} for {days}: {exc}") from exc
    # one IN-set over the partition column's text form: evaluated against partition values (pruning)
    out = df.filter(F.col(day_col).cast("string").isin([str(d) for d in days]))
    if check and out.isEmpty():
        raise PartitionEmpty(f"No rows for {day_col} in {days} at {path}")
    return out


def with_text_day(df: DataFrame, day_col: str = "date") -> DataFrame:
    """A discovered date partition column back to its ``yyyy-MM-dd`` text (data columns keep priority)."""
    if isinstance(df.schema[day_col].dataType, DateType):
        return df.withColumn(day_col, date_string(day_col))
    return df


def present_days(spark: SparkSession, path: str, day_col: str = "event_date") -> DataFrame:
    """Distinct partition values present in a table (metadata-only aggregate over the partition column)."""
    return read_table(spark, path).select(day_col).distinct()
