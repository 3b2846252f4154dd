"""Row numbers within groups without funnelling a group through one task.

``row_number().over(partitionBy(g).orderBy(o))`` sorts each group inside a single task; a batch file that holds
a third of all rows would then be numbered by one task.  Here the rows are range-partitioned on (g, o), so a
large group is spread over many tasks, each task numbers its slice locally, and a per-slice table (at most one
row per task and group) supplies the offset of every slice.  Only that small table is windowed.

For file scans the natural order is the file order: ``number_in_file_order`` uses the scan's split offset and
the position inside the split instead of a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekpi.operators.joins import sized_broadcast
from lakekpi.session import scratch_dir

_SLICE_MAX_ROWS = 2_000_000


def _apply_offsets(tagged: DataFrame, group: list[str], slice_col: str, out: str, start: int) -> DataFrame:
    """``tagged`` has ``_mid`` increasing in order inside each (group, slice); slices are ordered by ``slice_col``."""
    slices = tagged.groupBy(*group, slice_col).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*group).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = tagged.join(sized_broadcast(slices, _SLICE_MAX_ROWS), on=[*group, slice_col])
    rn = (F.col("_base") + (F.col("_mid") - F.col("_first")) + F.lit(start)).cast("int")
    return numbered.withColumn(out, rn).drop("_mid", "_first", "_base", slice_col)


def number_within(df: DataFrame, group: list[str], order: list[str], out: str = "rn", start: int = 1,
                  num_partitions: int | None = None) -> DataFrame:
    """Dense row numbers ``start, start+1, ...`` per ``group`` in ``order`` (order must be unique per group).

    The range-partitioned, sorted slice is written to the checkpoint folder before the numbering, so the
    per-task positions stay fixed even if tasks are re-run after an executor loss.
    """
    scratch_dir(df.sparkSession)
    keys = [*group, *order]
    parts = [num_partitions] if num_partitions else []
    ranged = df.repartitionByRange(*parts, *keys).sortWithinPartitions(*keys)
    tagged = (
        ranged.withColumn("_slice", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    return _apply_offsets(tagged, group, "_slice", out, start)


def number_in_file_order(df: DataFrame, file_col: str = "_file", out: str = "rn", start: int = 1,
                         materialize=None) -> DataFrame:
    """Row numbers in file order for a file scan.

    ``df`` must come straight from a scan that exposes ``_metadata`` (CSV/text/parquet).  Splits of one file are
    ordered by their byte offset; inside a split the scan order is the file order.  ``materialize`` (e.g. a
    staging write) is applied to the tagged scan so the files are parsed once for the slice table and the rows.
    """
    tagged = (
        df.withColumn(file_col, F.col("_metadata.file_path"))
        .withColumn("_split", F.col("_metadata.file_block_start"))
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    if materialize is not None:
        tagged = materialize(tagged)
    return _apply_offsets(tagged, [file_col], "_split", out, start)
