"""Partitioned Parquet sinks (C17, D6, J7) and keyed upserts into them (E5)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakekpi.operators.joins import sized_broadcast
from lakekpi.session import scratch_path
from lakekpi.sources.files import open_fs


def write_partitions(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet",
                     max_records_per_file: int | None = None, observe: bool = True, n_values: int | None = None,
                     spread: int = 1) -> int | None:
    """Replace only the partitions present in ``df`` (dynamic overwrite, set on the writer itself).

    Files: normally rows are rebalanced on the partition columns, so each partition gets files of about the
    adaptive advisory size and a heavy day is split over several writers (no ``coalesce(1)``).  When a job
    writes many more partitions than there are cores (``n_values``, e.g. a backfill over years of days), the
    rows are hash-partitioned by day over a bounded number of writers instead, so the many small day folders
    are written in parallel; ``spread`` > 1 additionally splits every day over that many writers.
    Returns the number of rows written (observed during the write) when ``observe``.
    """
    obs = Observation("written") if observe else None
    out = df.observe(obs, F.count(F.lit(1)).alias("n")) if obs else df
    par = df.sparkSession.sparkContext.defaultParallelism
    if n_values is not None and n_values > 4 * par:
        keys = [F.col(c) for c in partition_cols]
        if spread > 1:
            keys.append(F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread)))
        out = out.repartition(min(n_values * spread, 8 * par), *keys)
    else:
        out = out.hint("rebalance", *partition_cols)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.format(fmt).save(path)
    return int(obs.get["n"]) if obs else None


def _small_files(batches: Iterator[pa.RecordBatch], path: str, day_col: str, n_rows: int) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyspark import TaskContext

    fs, root = open_fs(path)
    task, made, files, rows = TaskContext.get().partitionId(), set(), 0, 0

    def write(t: pa.Table) -> None:
        nonlocal files, rows
        day = t[day_col][0].as_py()
        folder = f"{root}/{day_col}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
        if folder not in made:
            fs.create_dir(folder, recursive=True)
            made.add(folder)
        pq.write_table(t.drop_columns(day_col), f"{folder}/part-{task:05d}-{files:08d}.parquet", filesystem=fs, store_schema=False)
        files, rows = files + 1, rows + len(t)

    left = None  # rows of the last day seen that do not fill a file yet
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([left, t]).combine_chunks() if left is not None and len(left) else t
        runs = pc.run_end_encode(t[day_col].combine_chunks()).run_ends.to_pylist() if len(t) else []
        at = 0
        for end in runs:
            while end - at >= n_rows or (at < end < len(t)):
                write(t.slice(at, min(n_rows, end - at)))
                at = min(at + n_rows, end)
        left = t.slice(at)
    if left is not None and len(left):
        write(left)
    yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64()), "rows": pa.array([rows], pa.int64())})


def write_small_files(df: DataFrame, path: str, day_col: str, n_rows: int) -> tuple[int, int]:
    """``df`` as Parquet files of at most ``n_rows`` rows in day folders, as its partitions are; returns files and rows.

    For tables of very many small files: each task writes its own with Arrow, as Spark's writer takes up to 20 ms a file on
    a local file system.  Rows are sorted and files numbered within the task, so a repeated task writes the same files again.
    """
    done = df.sortWithinPartitions(day_col, *[c for c in df.columns if c != day_col]).mapInArrow(
        lambda batches: _small_files(batches, path, day_col, n_rows), "files long, rows long")
    return tuple(int(x or 0) for x in done.agg(F.sum("files"), F.sum("rows")).first())


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage is cut, results are fixed.
    Staged data is always read whole, so it is not partitioned (no per-day folders to create)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # read back with the known schema: partition values keep their types, an empty result stays readable
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark, path: str) -> bool:
    """Whether a table folder exists (local paths are checked directly; others by resolving the file index)."""
    if path.startswith("/") or path.startswith("file:"):
        import os

        return os.path.exists("/" + path.split(":", 1)[-1].lstrip("/") if path.startswith("file:") else path)
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018 - lists the folder only
        return True
    except Exception:  # noqa: BLE001
        return False


def table_exists(spark, path: str) -> bool:
    return path_exists(spark, path)


def upsert_partitions(batch: DataFrame, path: str, keys: list[str], day_col: str, replace_days: bool = False,
                      n_values: int | None = None) -> tuple[int, int]:
    """E5 on a Parquet table: merge ``batch`` into the days it touches (last writer wins per key).

    The merge is staged in the scratch folder first, so the table is never read and overwritten by the same
    tasks; only the touched day folders are replaced.  Returns (batch rows, rows now in the touched days).
    """
    spark = batch.sparkSession
    obs = Observation("upsert-batch")
    batch = batch.dropDuplicates(keys)  # one item per key, as in any keyed store
    batch = batch.observe(obs, F.count(F.lit(1)).alias("n"))  # batch size, counted during the staging write
    if table_exists(spark, path) and not replace_days:
        existing = spark.read.parquet(path)
        if existing.schema[day_col].dataType != batch.schema[day_col].dataType:
            existing = existing.withColumn(day_col, F.col(day_col).cast(batch.schema[day_col].dataType))
        days = batch.select(day_col).distinct()
        touched = existing.join(sized_broadcast(days), day_col, "left_semi")
        kept = touched.join(batch.select(*keys), keys, "left_anti")
        merged = kept.unionByName(batch, allowMissingColumns=True)
    else:
        merged = batch
    staged = stage(merged, "upsert")
    return int(obs.get["n"]), write_partitions(staged, path, [day_col], n_values=n_values)
