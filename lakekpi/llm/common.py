"""Helpers the corpus operators share: tables, staging in the shared folder, word hashing, components."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.session import scratch_dir

MULT = np.uint64(0x9E3779B97F4A7C15)
MULT2 = np.uint64(0xC2B2AE3D27D4EB4F)

# Shuffle files of a finished query are of no use once its result is staged; Spark can drop them at once.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on: moderate Arrow batches (texts can be long), and no stale shuffle files."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set(CLEANUP_CONF, "true")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Lineage ends there, so a lost executor never makes earlier steps run again.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_keys(docs: DataFrame, id_col: str, text_col: str, null_id: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(``docs`` with ``_key``, names): the key is the id as a long; if unlike texts share an id anywhere, it is a number of (id, text)
    in order of id and text hash, and ``names`` holds each number's id (_key, id).

    A null id is ``null_id``, or has a null key.
    """
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.withColumn("_key", own if null_id is None else F.coalesce(own, F.lit(null_id)))
    text = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    held = rows.where("_key is not null").select("_key", text.alias("_text"))
    shared = held.groupBy("_key").agg(F.min("_text").alias("lo"), F.max("_text").alias("hi")).where("lo < hi")
    if shared.isEmpty():
        return rows, None
    names = stage(held.distinct().toDF("_id", "_text").repartitionByRange("_id", "_text").sortWithinPartitions("_id", "_text")
                  .select("_id", "_text", F.monotonically_increasing_id().alias("_name")), "row-keys")
    named = rows.withColumn("_text", text).join(names, (F.col("_key") == F.col("_id")) & (names["_text"] == text), "left")
    return (named.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_name").alias("_key")),
            names.select(F.col("_name").alias("_key"), F.col("_id").alias("id")))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def split_words(texts: list[bytes], lower: bool) -> tuple[list[bytes], np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in one list, and the offsets where each text's words begin.

    ``bytes.split()`` and ``bytes.lower()`` know only ASCII blanks and A-Z, which is the wanted definition.
    """
    lists = [(t.lower() if lower else t).split() for t in texts]
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return list(itertools.chain.from_iterable(lists)), offsets


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of each word, the same on every executor."""
    if not words:
        return np.zeros(0, np.uint64)
    a = np.empty(len(words), object)
    a[:] = words
    return pd.util.hash_array(a, categorize=False)


def window_hashes(h: np.ndarray, width: int, mult: np.uint64 = MULT) -> np.ndarray:
    """Polynomial hash of each run of ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for k in range(1, width):
        acc *= mult
        acc += h[k:n + k]
    return acc


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (id, comp), comp the smallest id reachable.

    Contraction: every node takes its smallest neighbour's name, edges are renamed and made distinct, until no edge
    is left; then the renamings are put together.  Each round is a few joins and pre-aggregated group-bys on staged
    tables; nothing is collected.
    """
    hooks = []
    edges = stage(edges.select("a", "b").where("a <> b").distinct(), name)
    while not hooks or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("comp")), name)
        hooks.append(hook)
        left, right = hook.toDF("a", "a2"), hook.toDF("b", "b2")
        edges = stage(edges.join(left, "a").join(right, "b").where("a2 <> b2")
                      .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), name)
    labels = hooks[0]
    for hook in hooks[1:]:
        labels = labels.join(hook.toDF("comp", "next"), "comp", "left").select("id", F.coalesce("next", "comp").alias("comp"))
    return stage(labels, name) if len(hooks) > 1 else labels


def relabel(comp: DataFrame | None, edges: DataFrame, name: str = "components") -> DataFrame:
    """Components (id, comp) after ``edges`` are added to those already known; only components are joined anew."""
    if comp is None:
        return components(edges, name)
    ends = edges
    for c in "ab":  # nodes not met before are components of their own
        ends = ends.join(comp.toDF(c, f"c{c}"), c, "left").withColumn(c, F.coalesce(f"c{c}", c)).drop(f"c{c}")
    joined = components(ends, name)
    moved = comp.join(joined.toDF("comp", "next"), "comp", "left").select("id", F.coalesce("next", "comp").alias("comp"))
    return stage(moved.union(joined.join(comp.select("id"), "id", "left_anti")), name)
