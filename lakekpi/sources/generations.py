"""Tables whose files were written under several schemas.

The schemas are read from the files' footers by tasks and come to the driver as distinct generations, a few whatever the number
of files.  They resolve to one schema: columns in order of their first appearance, each of the widest type it ever had.  Widenings
that Spark's Parquet reader makes on its own are read in one scan; files of a generation with another one are read as they
are, and cast.  Columns that a generation lacks are null.  Types without a common wider one are an error that names them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekpi.sources.probe import list_files

# each type with the wider ones it may become, in order; ``native`` ones need no cast
WIDER = {"tinyint": ["smallint", "int", "bigint", "double"], "smallint": ["int", "bigint", "double"], "int": ["bigint", "double"],
         "bigint": ["double"], "float": ["double"], "date": ["timestamp_ntz"]}
NATIVE = {("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"), ("smallint", "bigint"), ("int", "bigint"), ("int", "double"),
          ("float", "double"), ("date", "timestamp_ntz"), ("tinyint", "double"), ("smallint", "double"), ("tinyint", "smallint")}


class SchemaConflict(ValueError):
    pass


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    from lakekpi.sources.files import open_fs

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            fs, p = open_fs(path)
            with fs.open_input_file(p) as fh:
                schema = from_arrow_schema(pq.ParquetFile(fh).schema_arrow)
            out.append((path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)))
        yield pd.DataFrame(out, columns=["path", "ddl"])


def generations(spark: SparkSession, root: str) -> DataFrame:
    """(ddl, files, since): the distinct schemas of the table's files, the oldest first."""
    files = list_files(spark, root)
    found = files.select("path").mapInPandas(_footers, "path string, ddl string").join(files.select("path", "modificationTime"), "path")
    return found.groupBy("ddl").agg(F.count(F.lit(1)).alias("files"), F.min("modificationTime").alias("since")).orderBy("since", "ddl")


def _wider(name: str, a: str, b: str) -> str:
    if a == b or b in WIDER.get(a, []):
        return b
    if a in WIDER.get(b, []):
        return a
    both = [t for t in WIDER.get(a, []) if t in WIDER.get(b, [])]
    if not both:
        raise SchemaConflict(f"column {name} is {a} in some files and {b} in others")
    return both[0]


def _types(ddl: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl)}


def resolve(ddls: list[str]) -> dict[str, str]:
    """Column -> type for all generations, oldest first."""
    def merge(a: dict, b: dict) -> dict:
        return {**a, **{c: _wider(c, a[c], t) if c in a else t for c, t in b.items()}}

    return reduce(merge, map(_types, ddls), {})


def read_generations(spark: SparkSession, root: str) -> DataFrame:
    """The whole table under its resolved schema (partition columns as Spark finds them)."""
    ddls = [r.ddl for r in generations(spark, root).collect()]  # one row a generation
    final = resolve(ddls)
    apart = [d for d in ddls if any(t != final[c] and (t, final[c]) not in NATIVE for c, t in _types(d).items())]
    schema = ", ".join(f"`{c}` {t}" for c, t in final.items())
    days = [f for f in spark.read.parquet(root).schema if f.name not in final]  # partition columns
    full = ", ".join([schema, *(f"`{f.name}` {f.dataType.simpleString()}" for f in days)])
    if not apart:
        return spark.read.schema(full).parquet(root)
    files = list_files(spark, root).select("path").mapInPandas(_footers, "path string, ddl string")
    parts = []
    for group in [[d for d in ddls if d not in apart], *[[d] for d in apart]]:
        paths = [r.path for r in files.where(F.col("ddl").isin(group)).select("path").collect()]  # readers take paths
        if not paths:
            continue
        types = final if group[0] not in apart else {c: t for c, t in _types(group[0]).items()}
        ddl = ", ".join([*(f"`{c}` {t}" for c, t in types.items()), *(f"`{f.name}` {f.dataType.simpleString()}" for f in days)])
        rows = spark.read.schema(ddl).option("basePath", root).parquet(*paths)
        parts.append(rows.select(*[(F.col(c) if c in types else F.lit(None)).cast(t).alias(c) for c, t in final.items()], *[f.name for f in days]))
    return reduce(DataFrame.unionByName, parts)
