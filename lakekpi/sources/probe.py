"""Per-file readability probes, run on executors.

File paths are distributed as a DataFrame (a ``binaryFile`` listing with the content column pruned) and each
task opens its own files with pyarrow, yielding (path, error) for every file that fails.  All failures are
collected before the job fails, so the error names every bad file, not just the first one a scan trips on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.sources.files import open_fs

PROBE_SCHEMA = "path string, error string"


class PoisonPartition(RuntimeError):
    pass


def _probe_parquet(batches: Iterator[pd.DataFrame], deep: bool) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for pdf in batches:
        bad = []
        for path in pdf["path"]:
            try:
                fs, p = open_fs(path)
                with fs.open_input_file(p) as fh:
                    f = pq.ParquetFile(fh)
                    if deep:
                        for _ in f.iter_batches(batch_size=65536):
                            pass
                    else:
                        _ = f.schema_arrow
            except Exception as exc:  # noqa: BLE001 - every failure is reported
                bad.append((path, f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(bad, columns=["path", "error"])


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Paths under ``root`` matching ``glob`` (recursive), without reading their bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def probe_parquet(paths: DataFrame, deep: bool = False) -> DataFrame:
    """(path, error) of every unreadable Parquet file; ``deep`` also decodes all pages."""
    return paths.select("path").mapInPandas(lambda it: _probe_parquet(it, deep), PROBE_SCHEMA)


def assert_readable(spark: SparkSession, root: str, deep: bool = False, partition_col: str | None = None,
                    values: list[str] | None = None, glob: str = "*.parquet") -> int:
    """Fail naming every unreadable file under ``root`` (optionally only inside the folders
    ``partition_col=value`` for the given values)."""
    files = list_files(spark, root, glob)
    if partition_col and values is not None:
        folder = F.regexp_extract("path", f"/{partition_col}=([^/]+)/", 1)
        files = files.filter(folder.isin(list(values)))
    bad = probe_parquet(files, deep)
    # only the failures (normally none) come back to the driver, ordered and bounded by the number of files
    failures = bad.orderBy("path").collect()
    if failures:
        names = [r.path for r in failures]
        raise PoisonPartition(K.POISON_ERROR.format(n=len(names), paths=names))
    return len(failures)


def _probe_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import codecs

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            try:
                fs, p = open_fs(path)
                dec = codecs.getincrementaldecoder("utf-8")()
                with fs.open_input_stream(p) as fh:
                    while True:
                        chunk = fh.read(1 << 20)
                        if not chunk:
                            break
                        dec.decode(bytes(chunk), final=False)
                dec.decode(b"", final=True)
            except Exception as exc:  # noqa: BLE001 - every failure is reported
                out.append((path, K.READ_FAILED_ERROR.format(exc=exc)))
        yield pd.DataFrame(out, columns=["path", "error"])


def unreadable_text(paths: DataFrame) -> DataFrame:
    """(path, error) of every listed file that cannot be opened or is not UTF-8 text."""
    return paths.select("path").mapInPandas(_probe_text, PROBE_SCHEMA)
