"""CSV scans of stream batches and reference data.

* ``read_streams`` / ``read_songs`` / ``read_users``: header CSV with the fixed schema, by position (A8/A9).
* ``read_batches``: header-by-name reading of many batch files at once (B1, P1).  Every record is parsed
  into all-text columns, as many as the widest header line has; the first record of each
  file is its header; data fields are looked up by header name
  per row, so files with reordered, missing or extra columns are read correctly.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakekpi import constants as K
from lakekpi import schemas as S
from lakekpi.functions.text import extract_landing_date
from lakekpi.sources.balance import balance
from lakekpi.operators.joins import sized_broadcast
from lakekpi.sources.csv_records import read_records


class ReferenceDataMissing(ValueError):
    pass


def _csv(spark: SparkSession, schema, multi_line: bool = False):
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
        .option("escape", '"')
    )


def read_streams(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Raw stream CSV(s) with the fixed schema; ``source_file`` = each row's file."""
    df = _csv(spark, S.STREAMS, multi_line).csv(path)
    return balance(df.select(*S.TRIPLET, F.col("_metadata.file_path").alias("source_file")))


def read_songs(spark: SparkSession, path) -> DataFrame:
    """Songs reference folder (header CSVs)."""
    return _csv(spark, S.SONGS).csv(path)


def read_users(spark: SparkSession, path) -> DataFrame:
    return _csv(spark, S.USERS).csv(path)


def guard_reference(songs: DataFrame, users: DataFrame, songs_path: str = "songs", users_path: str = "users") -> None:
    """A10: empty or missing reference data fails the run before any join."""
    if songs.isEmpty():
        raise ReferenceDataMissing(K.REFERENCE_MISSING_ERROR.format(name="songs", path=songs_path))
    if users.isEmpty():
        raise ReferenceDataMissing(K.REFERENCE_MISSING_ERROR.format(name="users", path=users_path))


def object_key(path_col, root: str, encoded: bool = True):
    """Object key of a file = its path below ``root`` (scheme-insensitive).

    Scans report percent-encoded paths, listings plain ones (``encoded=False``); the key is always plain.
    """
    tail = re.sub(r"^\w+:(//[^/]*)?", "", root).strip("/")
    path = F.url_decode(F.regexp_replace(path_col, r"\+", "%2B")) if encoded else path_col
    return F.regexp_extract(path, re.escape(tail) + r"/(.*)$", 1)


def _trailing_len(arr):
    """Number of fields up to the last non-null one."""
    idx = F.filter(F.transform(arr, lambda x, i: F.when(x.isNotNull(), i + 1)), lambda v: v.isNotNull())
    return F.coalesce(F.array_max(idx), F.lit(0))


def read_batches(spark: SparkSession, root: str, paths=None, materialize=None,
                 empty_keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """B1: (files, records) for every batch CSV under ``root`` (or the given ``paths``).

    files:   source_key, landing_date, fields (header names), first_row_extra
    records: source_key, row_no (header = line 1), user_id, track_id, listen_time (text; null when the
             header lacks the column).

    Line breaks inside quotes are text, and files of any size are read in byte ranges by many tasks (``csv_records``).
    ``materialize`` is the staging write that holds their lines (by default in the shared folder).  ``empty_keys`` names
    zero-byte files, which scans do not see; they get a row in ``files`` with no fields.
    """
    where = paths if paths is not None else root
    none = spark.createDataFrame([(k, []) for k in empty_keys or []], "source_key string, fields array<string>").select(
        "source_key", extract_landing_date(F.col("source_key")).alias("landing_date"), "fields", F.lit(False).alias("first_row_extra"))
    if paths is not None and not paths:  # nothing but zero-byte files
        return none, spark.createDataFrame([], StructType([StructField("source_key", StringType()), StructField("row_no", IntegerType()),
                                                           *[StructField(f, StringType()) for f in S.REQUIRED_FIELDS]]))
    from lakekpi.plans.sinks import stage

    found = read_records(spark, where, materialize or (lambda df: stage(df, "lines")))
    # the first two records of each file, which four of the steps below need; all others are read by one
    first = stage(found.where("rn <= 2"), "first-records")
    # fields of the widest header (an upper bound where names hold commas), and one for rows longer than their header
    width = max(len(S.REQUIRED_FIELDS), first.where("rn = 1").agg(F.max(F.size(F.split("record", ",")))).first()[0] or 0) + 1
    wide = StructType([StructField(f"_c{i}", StringType(), True) for i in range(width)])
    row = F.from_csv("record", wide.simpleString()[len("struct<"):-1].replace(":", " "),
                     {"mode": "PERMISSIVE", "multiLine": "true", "quote": '"', "escape": '"'})

    def parsed(rows):
        return rows.select(object_key(F.col("path"), root).alias("source_key"), F.col("rn").cast("int").alias("rn"), row.alias("row")).select(
            "source_key", "rn", F.array(*[F.col(f"row._c{i}") for i in range(width)]).alias("vals"))

    hdr = parsed(first.where("rn = 1")).select(
        "source_key",
        F.slice(F.transform("vals", lambda x: F.coalesce(x, F.lit(""))), 1, _trailing_len(F.col("vals"))).alias("fields"),
    )
    data = parsed(found.where("rn > 1"))
    first_len = parsed(first.where("rn = 2")).select("source_key", _trailing_len(F.col("vals")).alias("_first_len"))
    files = (
        hdr.join(first_len, "source_key", "left")
        .select(
            "source_key",
            extract_landing_date(F.col("source_key")).alias("landing_date"),
            "fields",
            (F.coalesce(F.col("_first_len"), F.lit(0)) > F.size("fields")).alias("first_row_extra"),
        )
    )
    by_name = data.join(sized_broadcast(hdr), "source_key")
    zipped = F.arrays_zip(F.col("fields").alias("h"), F.col("vals").alias("v"))

    def field(name):
        hits = F.filter(zipped, lambda z: z["h"] == name)
        return F.when(F.size(hits) > 0, F.element_at(hits, -1)["v"])

    records = by_name.select(
        "source_key", F.col("rn").alias("row_no"), *[field(f).alias(f) for f in S.REQUIRED_FIELDS]
    )
    return files.unionByName(none) if empty_keys else files, records


def typed_streams(records: DataFrame) -> DataFrame:
    """Records read by name -> the fixed stream schema (user_id int; junk -> null as a PERMISSIVE scan does)."""
    return records.select(
        F.expr("try_cast(user_id as int)").alias("user_id"),
        "track_id",
        "listen_time",
        F.col("source_key").alias("source_file"),
    )
