"""A scan of a day-partitioned Parquet table by projection: partitions are computed from the day filter, never listed.

``spark.read.format("projected")`` takes ``path``, ``day`` (the partition column), ``start`` and ``end`` (the projected range; the end is
today unless given).  Comparisons of the day column with constants are taken over from the query, and only folders of days that
satisfy them are opened; days without a folder hold no rows.  All other conditions stay with Spark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)
from pyspark.sql.types import DateType, StructType

from lakekpi import constants as K

_TESTS = {EqualTo: lambda d, v: d == v, GreaterThan: lambda d, v: d > v, GreaterThanOrEqual: lambda d, v: d >= v,
          LessThan: lambda d, v: d < v, LessThanOrEqual: lambda d, v: d <= v, In: lambda d, v: d in v}
TASK_DAYS = 16  # days of a task


class Days(InputPartition):
    def __init__(self, days: list[str]):
        super().__init__(days)
        self.days = days


def _text(value) -> str:
    return value.isoformat() if isinstance(value, dt.date) else str(value)


class ProjectedReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.day, self.schema = options["path"].rstrip("/"), options["day"], schema
        self.as_date = isinstance(schema[self.day].dataType, DateType)
        start = dt.date.fromisoformat(options.get("start", K.PARTITION_PROJECTION_START))
        end = dt.date.fromisoformat(options.get("end", dt.date.today().isoformat()))
        self.days = [(start + dt.timedelta(n)).isoformat() for n in range((end - start).days + 1)]

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            test = _TESTS.get(type(f))
            if test is None or f.attribute != (self.day,):
                yield f
                continue
            value = tuple(map(_text, f.value)) if isinstance(f, In) else _text(f.value)
            self.days = [d for d in self.days if test(d, value)]

    def partitions(self) -> list[Days]:
        return [Days(self.days[i:i + TASK_DAYS]) for i in range(0, len(self.days), TASK_DAYS)] or [Days([])]

    def read(self, partition: Days) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds
        import pyarrow.fs as pafs
        from pyspark.sql.pandas.types import to_arrow_schema

        from lakekpi.sources.files import open_fs

        fs, base = open_fs(self.path)
        want = to_arrow_schema(self.schema)
        inside = pa.schema([f for f in want if f.name != self.day])
        for day in partition.days:
            folder = f"{base}/{self.day}={day}"
            if fs.get_file_info(folder).type != pafs.FileType.Directory:
                continue
            value = dt.date.fromisoformat(day) if self.as_date else day
            for b in ds.dataset(folder, schema=inside, format="parquet", filesystem=fs).to_batches(batch_size=65536):
                cols = [pa.array([value] * b.num_rows, f.type) if f.name == self.day else b.column(f.name).cast(f.type) for f in want]
                yield pa.RecordBatch.from_arrays(cols, schema=want)


class ProjectedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "projected"

    def reader(self, schema: StructType) -> ProjectedReader:
        return ProjectedReader(dict(self.options), schema)


def read_projected(spark: SparkSession, path: str, schema, day: str = "date", start: str | None = None, end: str | None = None) -> DataFrame:
    spark.dataSource.register(ProjectedTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    r = spark.read.format("projected").schema(schema).option("day", day)
    for name, value in (("start", start), ("end", end)):
        r = r if value is None else r.option(name, value)
    return r.load(path)
