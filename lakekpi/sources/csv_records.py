"""Quoted CSV read in byte ranges: records of many files, whatever their size, with line breaks inside quotes (B1).

A byte range of a file cannot know whether it begins inside a quoted field.  So the lines of every range are marked twice, as
if the range began outside quotes and as if it began inside: for either case each line's own state and its record's
number within the range.  A range's effect on the quote state is one of four (leave, turn round, open, close), so a
running composition over the ranges of a file, one row each, settles how each began.  Records of one line are then
ready; lines of the others are put together by record.

Record ends are ``\\n`` and ``\\r\\n`` (a single ``\\r`` is text); empty lines between records are no records; a quote opens a
field only at its start and a doubled one stands for itself; what follows a closing quote up to the comma is text; a
quote that is never closed takes in the rest of the file.  A record of several lines with more than ``MAX_RECORD_BYTES``
reads as a record without fields (and thus fails validation) and is never put together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakekpi.operators.joins import sized_broadcast

MAX_RECORD_BYTES = 16 * 1024 * 1024

# complete fields with their commas, then a quote that this line does not close
_OPENS = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+),)*+"[^"]*+(?:""[^"]*+)*+$'
# from inside quotes: the line goes on to its end, or closes the quote and the rest of that field follows
_STAYS = r'^[^"]*+(?:""[^"]*+)*+$'
_CLOSED = r'^[^"]*+(?:""[^"]*+)*+"[^,]*+,?'

_MARKED = ("path string, split long, pos long, value binary, state0 boolean, state1 boolean, after0 boolean, after1 boolean, "
           "rec0 long, rec1 long")


def _after(value: Column) -> tuple[Column, Column]:
    """Whether the line after ``value`` begins inside quotes, for a line that began outside and for one inside."""
    quoted = F.contains(value, F.lit('"'))
    outside = quoted & F.rlike(value, F.lit(_OPENS))
    rest = F.regexp_replace(value, _CLOSED, "")
    inside = ~quoted | F.rlike(value, F.lit(_STAYS)) | F.rlike(rest, F.lit(_OPENS))
    return outside, inside


def _mark(batches):
    """Lines in scan order with their state and record number, for ranges that begin outside (0) and inside (1) quotes."""
    at = None  # (path, split), then per case: state, records so far; and the lines so far
    for b in batches:
        path, split = b.column("path"), b.column("split").to_numpy()
        n = b.num_rows
        if not n:
            continue
        codes = path.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (split[1:] != split[:-1])) + 1).tolist(), n]
        effect = [b.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("outside", "inside")]
        blank = b.column("blank").to_numpy(zero_copy_only=False).astype(bool)
        pos = np.zeros(n, np.int64)
        state, after, rec = (np.zeros((2, n), t) for t in (bool, bool, np.int64))
        for s, e in zip(cuts[:-1], cuts[1:]):
            key = (path[s].as_py(), int(split[s]))
            if at is None or at[0] != key:
                at = [key, [False, True], [0, 0], 0]
            pos[s:e] = at[3] + np.arange(e - s)
            at[3] += e - s
            turns = np.flatnonzero(effect[0][s:e] | ~effect[1][s:e])  # other lines leave the state as it is
            for case in (0, 1):
                now, last = at[1][case], s
                for t in (turns + s).tolist():
                    state[case, last:t + 1] = now
                    now = bool(effect[int(now)][t])
                    last = t + 1
                state[case, last:e] = now
                after[case, s:e - 1], after[case, e - 1] = state[case, s + 1:e], now
                rec[case, s:e] = at[2][case] + np.cumsum(~state[case, s:e] & ~blank[s:e])
                at[1][case], at[2][case] = now, int(rec[case, e - 1])
        yield pa.RecordBatch.from_arrays(
            [path, b.column("split"), pa.array(pos), b.column("value"), *map(pa.array, (*state, *after, *rec))],
            names=["path", "split", "pos", "value", "state0", "state1", "after0", "after1", "rec0", "rec1"])


def range_starts(marked: DataFrame) -> DataFrame:
    """Per range (path, split): ``inside``, its state at the start, and ``base``, the records that begin before it."""
    ends = marked.groupBy("path", "split").agg(
        F.max_by(F.struct("after0", "after1"), "pos").alias("e"), F.max("rec0").alias("n0"), F.max("rec1").alias("n1"))
    # e = (False, True) leaves the state, (True, False) turns it round, equal values set it
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    through = before.rowsBetween(Window.unboundedPreceding, 0)
    turn = F.when(F.col("e.after0") & ~F.col("e.after1"), 1).otherwise(0)
    ends = ends.withColumn("turns", F.sum(turn).over(through))
    known = F.when(F.col("e.after0") == F.col("e.after1"), F.struct(F.col("e.after0").cast("long").alias("v"), "turns"))
    known, turns = F.last(known, ignorenulls=True).over(before), F.coalesce(F.max("turns").over(before), F.lit(0))
    inside = F.when(known.isNull(), turns % 2).otherwise((known["v"] + turns - known["turns"]) % 2) == 1
    ends = ends.select("path", "split", "n0", "n1", inside.alias("inside"))
    return ends.select("path", "split", "inside", F.coalesce(
        F.sum(F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))).over(before), F.lit(0)).alias("base"))


def read_records(spark: SparkSession, paths, materialize) -> DataFrame:
    """Records (path, rn from 1 in file order, record text; null if over-long) of CSV files.

    ``materialize`` (a staging write) holds the marked lines, so that the files are read once.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    outside, inside = _after(F.col("value"))
    marked = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                          F.col("value").cast("binary").alias("value"), outside.alias("outside"), inside.alias("inside"),
                          F.col("value").isin("", "\r").alias("blank")).mapInArrow(_mark, _MARKED)
    marked = materialize(marked)
    starts = sized_broadcast(range_starts(marked))  # one row for every 128 MB or file
    own = marked.join(starts, ["path", "split"])
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    own = own.select("path", "split", "pos", "value", pick("state").alias("state"), pick("after").alias("after"),
                     (F.col("base") + pick("rec")).alias("rn"))
    text = F.col("value").cast("string")
    alone = own.where("not state and not after").where(~text.isin("", "\r")).select("path", "rn", text.alias("record"))
    parts = own.where("state or after")
    size = parts.groupBy("path", "rn").agg(F.sum(F.length("value") + 1).alias("bytes"))
    fine, long = size.where(F.col("bytes") <= MAX_RECORD_BYTES), size.where(F.col("bytes") > MAX_RECORD_BYTES)
    joined = parts.join(fine, ["path", "rn"], "left_semi").groupBy("path", "rn").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("split", "pos", text.alias("t")))), lambda x: x["t"]), "\n").alias("record"))
    records = alone.unionByName(joined).unionByName(long.select("path", "rn", F.lit(None).cast("string").alias("record")))
    # by bytes: a regular expression would alter what is not UTF-8
    cut = F.expr("cast(substring(cast(record as binary), 1, octet_length(record) - 1) as string)")
    return records.withColumn("record", F.when(F.endswith("record", F.lit("\r")), cut).otherwise(F.col("record")))
