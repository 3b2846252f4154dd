"""Tables of very many small files, listed and read by tasks.

Spark's own scan keeps several records of every file in the driver.  Here tasks list the table's folders and read the files with Arrow;
the driver knows the folders and one file of each, from which Spark takes the schema.  Stores, types and settings that only
Spark's reader knows are left to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekpi.sources.files import open_fs
from lakekpi.sources.probe import list_files

# with these both readers give the same rows; Spark's reader honours others
SETTINGS = {"spark.sql.parquet.mergeSchema": "false", "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
            "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED", "spark.sql.parquet.int96TimestampConversion": "false",
            "spark.sql.files.ignoreCorruptFiles": "false", "spark.sql.files.ignoreMissingFiles": "false"}
PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType,
         T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
BATCH_ROWS, BATCH_BYTES = 16_384, 8 * 1024 * 1024  # rows of small files go on together
CALENDAR_DAY = -25_566  # 1900-01-02: from here on both calendars and all zones agree


class OldCalendar(ValueError):
    pass


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def by_tasks(spark: SparkSession, root: str) -> bool:
    """Whether tasks can list and read the table."""
    import pyarrow.fs as pafs

    try:
        fs, base = open_fs(root)
        found = fs.get_file_info(base).type == pafs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False
    return found and all(spark.conf.get(k).lower() == v.lower() for k, v in SETTINGS.items())


def _base(root: str):
    fs, base = open_fs(root)
    return fs, fs.normalize_path(base).rstrip("/")


def _listed(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs as pafs

    fs, base = _base(root)
    for b in batches:
        for top in fs.get_file_info([f"{base}/{t}" for t in b.column("top").to_pylist()]):
            found = [top] if top.is_file else fs.get_file_info(pafs.FileSelector(top.path, recursive=True))
            files = [f for f in found if f.is_file and f.size and not any(map(_hidden, f.path[len(base) + 1:].split("/")))]
            yield pa.RecordBatch.from_pydict({"path": pa.array([f.path for f in files], pa.string()), "length": pa.array([f.size for f in files], pa.int64())})


def list_table(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of the table's files, each of its folders listed by a task."""
    import pyarrow.fs as pafs

    if not by_tasks(spark, root):
        return list_files(spark, root, "*").select("path", "length")
    fs, base = _base(root)
    tops = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(base)) if not _hidden(f.base_name))
    return spark.createDataFrame([(t,) for t in tops], "top string").mapInArrow(lambda batches: _listed(batches, root), "path string, length long")


def _plain(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_plain(f.dataType) for f in t)
    if isinstance(t, T.ArrayType):
        return _plain(t.elementType)
    return _plain(t.keyType) and _plain(t.valueType) if isinstance(t, T.MapType) else type(t) in PLAIN


def _values(path: str) -> dict[str, str | None]:
    """Values of the partition columns, as in the names of a file's folders."""
    pairs = (s.split("=", 1) for s in path.split("/")[:-1] if "=" in s)
    plain = lambda s: re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), s)  # noqa: E731 - as Spark writes them
    return {plain(k): None if v == NO_VALUE else plain(v) for k, v in pairs}


def _check_calendar(meta: dict, t: pa.Table, path: str) -> None:
    """Spark's reader shifts old dates in files that it wrote in the old calendar; these are not read otherwise."""
    import pyarrow.compute as pc

    version = meta.get(b"org.apache.spark.version", b"9").decode()
    if int(version.split(".")[0]) >= 3 and not version.startswith("3.0.") and not any(b"org.apache.spark.legacy" + k in meta for k in (b"DateTime", b"INT96")):
        return
    for c in t.columns:
        dated = pa.types.is_date(c.type) or pa.types.is_timestamp(c.type)
        if pa.types.is_nested(c.type) or (dated and pc.any(pc.less(c.cast(pa.date32()).cast(pa.int32()), CALENDAR_DAY)).as_py()):
            raise OldCalendar(f"{path} may hold dates of the old calendar, which Spark's reader shifts")


def _rows(batches: Iterator[pa.RecordBatch], root: str, inside: pa.Schema, parts: list[str]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    fs, base = _base(root)
    want = pa.schema([*inside, *(pa.field(p, pa.string()) for p in parts)])
    held, rows, size = [], 0, 0
    for path in (p for b in batches for p in b.column("path").to_pylist()):
        values = _values(path[len(base) + 1:])
        with fs.open_input_file(path) as fh, pq.ParquetFile(fh, coerce_int96_timestamp_unit="us") as f:
            meta = f.metadata.metadata or {}
            for b in f.iter_batches(batch_size=BATCH_ROWS // 4, use_threads=False):
                t = pa.Table.from_batches([b])
                _check_calendar(meta, t, path)
                at = {name.lower(): i for i, name in reversed([*enumerate(t.column_names)])}
                at |= {name: i for i, name in enumerate(t.column_names)}
                i = [at.get(c.name, at.get(c.name.lower())) for c in inside]
                cols = [pa.nulls(len(t), c.type) if k is None else t.column(k).cast(c.type) for c, k in zip(inside, i, strict=True)]
                held.append(pa.Table.from_arrays([*cols, *(pa.repeat(pa.scalar(values.get(p), pa.string()), len(t)) for p in parts)], schema=want))
                rows, size = rows + len(t), size + t.nbytes
                if rows >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield from pa.concat_tables(held).combine_chunks().to_batches()
                    held, rows, size = [], 0, 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def read_table(spark: SparkSession, root: str, files: DataFrame, tasks: int, some: DataFrame | None = None) -> DataFrame:
    """The table's rows, as Spark's reader gives them, by ``tasks`` tasks.  ``files`` are all files of the table (from ``list_table``, staged);
    with ``some`` of them only these are read."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not by_tasks(spark, root):
        return spark.read.parquet(root)
    base = _base(root)[1]
    first = files.groupBy(F.regexp_replace("path", "[^/]*$", "")).agg(F.min("path").alias("path")).collect()  # one row a folder
    if not first:
        return spark.read.parquet(root)
    schema = spark.read.option("basePath", root).parquet(*[root.rstrip("/") + r.path[len(base):] for r in first]).schema
    parts = [c for c in schema.names if c in _values(first[0].path[len(base) + 1:])]
    inside = T.StructType([f for f in schema if f.name not in parts])
    if not _plain(inside):
        return spark.read.parquet(root)
    out, arrow = T.StructType([*inside, *(T.StructField(p, T.StringType()) for p in parts)]), to_arrow_schema(inside)
    rows = (files if some is None else some).select("path").repartition(tasks).mapInArrow(lambda batches: _rows(batches, root, arrow, parts), out)
    return rows.select([F.col(f"`{f.name}`").cast(f.dataType) if f.name in parts else F.col(f"`{f.name}`") for f in schema])
