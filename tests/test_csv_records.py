"""Quoted CSV in byte ranges against a one-pass reader: line breaks and quotes at range edges, malformed quotes."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from lakekpi.plans.sinks import stage
from lakekpi.session import scratch_path
from lakekpi.sources import csv_records as R
from lakekpi.sources.csv_scan import read_batches

SPLIT = "spark.sql.files.maxPartitionBytes"


def _in_ranges(spark, size=64):
    """Makes the files' scan take ranges of ``size`` bytes, and later scans their usual size."""
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, str(size))

    def keep(df):
        try:
            df.write.mode("overwrite").parquet(keep.path)
        finally:
            spark.conf.set(SPLIT, before)
        keep.lines = spark.read.schema(df.schema).parquet(keep.path)
        return keep.lines

    keep.path = scratch_path(spark, "ranges")
    return keep


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data if isinstance(data, bytes) else data.encode())


def _field(rng):
    text = "".join(rng.choice(['a', 'b', ' ', ',', '"', '\n', '\r\n', 'é', "x" * 9]) for _ in range(rng.randrange(7)))
    return '"' + text.replace('"', '""') + '"' if rng.random() < 0.4 or set(text) & set('",\r\n') else text


def _file(rng, end):
    rows = [",".join([_field(rng) or "q", _field(rng) or "q", "z"]) for _ in range(rng.randrange(1, 25))]
    rows.insert(rng.randrange(len(rows) + 1), "")  # an empty line is no record
    return end.join(["user_id,track_id,listen_time", *rows]) + end * rng.randrange(2)


def test_equals_a_one_pass_reader(spark, tmp):
    rng, want = random.Random(1), {}
    for i in range(8):
        text = _file(rng, "\r\n" if i % 3 == 0 else "\n")
        _write(f"{tmp}/streams/landing_date=2024-06-01/f{i}.csv", text)
        want[f"f{i}.csv"] = [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    files, records = read_batches(spark, tmp, materialize=_in_ranges(spark, 160))
    assert {tuple(r.fields) for r in files.collect()} <= {("user_id", "track_id", "listen_time")} and files.count() == 8
    got = {}
    for r in records.orderBy("row_no").collect():
        got.setdefault(r.source_key.split("/")[-1], []).append((r.row_no, [r.user_id, r.track_id, r.listen_time]))
    for name, rows in want.items():
        assert [n for n, _ in got[name]] == list(range(2, len(rows) + 2))
        assert [[x or "" for x in v] for _, v in got[name]] == rows, name


def test_one_file_takes_many_tasks(spark, tmp):
    text = "user_id,track_id,listen_time\n" + "".join(f'{i},"T\n{i}",2024-06-01\n' for i in range(400))
    _write(f"{tmp}/a.csv", text)
    keep = _in_ranges(spark, 200)
    found = R.read_records(spark, tmp, keep)
    assert keep.lines.select("split").distinct().count() > 30
    starts = R.range_starts(keep.lines).collect()
    assert {r.inside for r in starts} == {True, False}
    rows = found.orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(1, 402))
    assert rows[7].record == '6,"T\n6",2024-06-01'


@pytest.mark.parametrize("text", [
    'h\na"b\n"c""\nd"x,1\n', 'h\n"never closed\n1\n2\n', 'h\n""\n"",""\n"a\n""\nb"\n', 'h\n a,"b\n c"y"z,"\n,"\n1\n', '"h\n1"\n2\n',
    'h\n1,"",2\n"""x\n""",3\n\n\r\n"a\r\n\r\nb"\r\n4'])
def test_records_of_odd_quotes(spark, tmp, text):
    _write(f"{tmp}/a.csv", text)
    rows = R.read_records(spark, tmp, _in_ranges(spark, 4)).orderBy("rn").collect()
    want = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    assert [r.rn for r in rows] == list(range(1, len(want) + 1))
    # a record's text, read on its own, is that record
    own = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in rows]
    assert [[x.replace("\r", "").rstrip("\n") for x in r] for r in own] == [[x.replace("\r", "").rstrip("\n") for x in r] for r in want]


def test_over_long_records_have_no_fields(spark, tmp, monkeypatch):
    monkeypatch.setattr(R, "MAX_RECORD_BYTES", 100)
    _write(f"{tmp}/streams/landing_date=2024-06-01/a.csv", 'user_id,track_id,listen_time\n1,T1,x\n2,"' + "line\n" * 40)
    _, records = read_batches(spark, tmp)
    assert [tuple(r)[1:] for r in records.orderBy("row_no").collect()] == [(2, "1", "T1", "x"), (3, None, None, None)]


def test_scan_and_stages_survive_odd_bytes(spark, tmp):
    _write(f"{tmp}/a.csv", b"user_id,track_id,listen_time\n1,\xff\xfe,x\n2,\xc3\xa9,y\n")
    rows = R.read_records(spark, tmp, lambda df: stage(df, "lines")).select(F.col("record").cast("binary")).collect()
    assert sorted(bytes(r[0]) for r in rows)[:2] == [b"1,\xff\xfe,x", b"2,\xc3\xa9,y"]


def test_records_of_a_batch_are_put_together_twice(spark, tmp):
    """Once for the first two of each file, once for all: headers, widths and records do not each read the lines again."""
    with open(f"{tmp}/a.csv", "w") as f:
        f.write("user_id,track_id,listen_time\n" + "".join(f"{i},T{i},x\n" for i in range(50)))
    files, records = read_batches(spark, tmp)
    plan = lambda df: str(df._jdf.queryExecution().optimizedPlan().toString())
    assert files.count() == 1 and records.count() == 50
    assert "state0" not in plan(files) and "state0" in plan(records)
