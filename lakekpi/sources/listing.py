"""File listings of a landing folder (A1, A4, A6 input): keys, sizes, times and content hashes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.sources.csv_scan import object_key


def list_objects(spark: SparkSession, root: str, with_hash: bool = True, glob: str | None = None) -> DataFrame:
    """object_key, path, length, event_time (modification time), etag (md5 of the bytes when ``with_hash``).

    Without the hash the content column is pruned and no file bytes are read.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    cols = [
        object_key(F.col("path"), root, encoded=False).alias("object_key"),
        "path",
        "length",
        F.col("modificationTime").alias("event_time"),
    ]
    if with_hash:
        cols.append(F.md5("content").alias("etag"))
    else:
        cols.append(F.lit(None).cast("string").alias("etag"))
    return df.select(*cols)


def empty_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key, path) of the zero-byte files under ``root``.  Spark's scans pass these over, but its file index, which it
    lists on its own, names them: they are the indexed files that the listing lacks."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        listed = r.load(root)
        names = spark.createDataFrame([(p,) for p in listed.inputFiles()], "path string")
    except AnalysisException:  # no such folder
        names, listed = spark.createDataFrame([], "path string"), spark.createDataFrame([], "path string")
    key = object_key(F.col("path"), root).alias("object_key")
    full = listed.select(object_key(F.col("path"), root, encoded=False).alias("object_key"))
    plain = F.concat(F.lit(root.rstrip("/") + "/"), "object_key").alias("path")
    return names.select(key).join(full, "object_key", "left_anti").select("object_key", plain)
