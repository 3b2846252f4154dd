"""Spread scans that arrive in too few splits (single row-group files, gzip CSVs) over the cluster's cores.

A scan with at least as many splits as the default parallelism is returned unchanged, so on large inputs this
adds nothing; an under-split scan gets one round-robin shuffle so the per-row work after it runs in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def balance(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()  # planning only: the scan's split count
    return df.repartition(want) if have < want else df
