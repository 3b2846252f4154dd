"""Deliveries and alarms as streaming state: the same changes however the rows fall into micro-batches."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakekpi.operators import metrics as H
from lakekpi.streaming import alarms as ALM
from lakekpi.streaming import deliveries as DLV

T0 = pd.Timestamp("2024-01-01 00:00:00")


def _at(seconds):
    return T0 + pd.Timedelta(seconds=seconds)


def _stream(spark, parts, schema, path):
    """A stream with a micro-batch for each part."""
    for i, rows in enumerate(parts):
        pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
        spark.createDataFrame(pdf, schema).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            if f.endswith(".parquet") and not f.startswith("seen"):
                os.rename(f"{path}/{f}", f"{path}/seen-{i}.parquet")
                os.utime(f"{path}/seen-{i}.parquet", (time.time() - 1000 + i, time.time() - 1000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


ATTEMPTS = "delivery_id string, attempt_id long, event_time timestamp, attempted_at timestamp, ok boolean"
ROWS = [("a", 1, _at(0), _at(0), False), ("b", 2, _at(5), _at(5), True), ("c", 3, _at(6), _at(6), None), ("d", 4, _at(7), _at(7), False),
        ("a", 5, _at(0), _at(60), False), ("a", 6, _at(0), _at(120), True), ("c", 7, _at(6), _at(130), False), ("c", 8, _at(6), _at(140), False),
        ("c", 9, _at(6), _at(150), True), ("e", 10, _at(200), _at(5000), False), ("d", 11, _at(7), _at(5001), True), ("f", 12, _at(5002), _at(5002), False),
        ("z", 13, _at(15 * 86400), _at(15 * 86400), True)]
WANT = {("a", "retry", 1, 0), ("a", "retry", 2, 60), ("a", "delivered", 3, 120), ("b", "delivered", 1, 5), ("c", "retry", 1, 6), ("c", "retry", 2, 130),
        ("c", "dead_letter", 3, 140), ("c", "expired", 3, 140 + 14 * 86400), ("d", "retry", 1, 7), ("d", "dead_letter", 1, 3607),
        ("d", "expired", 1, 3607 + 14 * 86400), ("e", "dead_letter", 1, 5000), ("e", "expired", 1, 5000 + 14 * 86400), ("f", "retry", 1, 5002),
        ("f", "dead_letter", 1, 8602), ("f", "expired", 1, 8602 + 14 * 86400), ("z", "delivered", 1, 15 * 86400)}


@pytest.mark.parametrize("cuts", [[], [5, 9, 12]])
def test_delivery_changes(spark, tmp, cuts):
    ends = [0, *cuts, len(ROWS)]
    stream = _stream(spark, [ROWS[s:e] for s, e in zip(ends[:-1], ends[1:])], ATTEMPTS, tmp + "/in")
    done = DLV.run_deliveries(stream, tmp + "/out", tmp + "/ckpt")
    got = {(r.delivery_id, r.state, r.attempts, int((pd.Timestamp(r.changed_at) - T0).total_seconds())) for r in done.collect()}
    assert got == WANT and done.count() == len(WANT)
    assert {r.delivery_id: r.state for r in DLV.latest(done).collect()} == {
        "a": "delivered", "b": "delivered", "c": "expired", "d": "expired", "e": "expired", "f": "expired", "z": "delivered"}


@pytest.mark.parametrize("buckets", [1, 2, 4096])
def test_deliveries_of_a_bucket_are_apart(spark, tmp, buckets):
    stream = _stream(spark, [ROWS[:5], ROWS[5:9], ROWS[9:]], ATTEMPTS, tmp + "/in")
    done = DLV.run_deliveries(stream, tmp + "/out", tmp + "/ckpt", buckets=buckets)
    got = {(r.delivery_id, r.state, r.attempts, int((pd.Timestamp(r.changed_at) - T0).total_seconds())) for r in done.collect()}
    assert got == WANT and done.count() == len(WANT)


def test_calls_do_not_grow_with_deliveries():
    """Many deliveries of one bucket, a null outcome and a null id among them, take one call."""
    from types import SimpleNamespace

    kept = {}
    group = SimpleNamespace(exists=False, hasTimedOut=False, getCurrentWatermarkMs=lambda: 0, update=lambda v: kept.update(v=v),
                            setTimeoutTimestamp=lambda t: kept.update(t=t), remove=lambda: kept.update(v=None))
    n = 1000
    rows = pd.DataFrame({"delivery_id": [None, *map(str, range(1, n))], "attempt_id": range(n), "event_time": [_at(i) for i in range(n)],
                         "attempted_at": [_at(i) for i in range(n)], "ok": [None if i % 3 == 0 else i % 3 == 1 for i in range(n)]})
    (out,) = DLV._step(2, 3600, 14)((0,), iter([rows[:400], rows[400:]]), group)
    assert out.state.tolist() == ["delivered" if i % 3 == 1 else "retry" for i in range(n)] and out.delivery_id.tolist() == rows.delivery_id.tolist()
    assert [len(x) for x in kept["v"]] == [n] * 5 and kept["t"] == _at(3600).value // 10**6


RULES = [("busy", "M", "Sum", 300, ">", 10.0, "notBreaching", None), ("quiet", "M", "SampleCount", 600, "<", 1.0, "breaching", None),
         ("peak", "M", "Maximum", 60, ">", 6.0, "missing", None), ("mean", "M", "Average", 300, ">", 4.0, "notBreaching", None),
         ("never", "N", "Sum", 300, "<", 1.0, "missing", None)]
SAMPLES = "ts timestamp, metric_name string, value double"


@pytest.mark.parametrize("cuts", [[], [4, 7]])
def test_alarm_changes_equal_the_batch_form(spark, tmp, cuts):
    at = [10, 20, 290, 310, 1500, 1505, 2000, 5000, 5010, 7203]
    rows = [(_at(t), "M", float(v)) for t, v in zip(at, [3, 8, 1, 2, 7, 5, 9, 1, 20, 0])]
    rules = H.rules_frame(spark, RULES)
    batch = H.evaluate_alarms(spark.createDataFrame(pd.DataFrame(rows, columns=["ts", "metric_name", "value"]), SAMPLES), rules,
                              str(T0), str(_at(7200)))
    want = {tuple(r) for r in ALM.state_changes(batch).collect()}
    start = spark.createDataFrame([(r[0],) for r in RULES], "rule_name string")
    ends = [0, *cuts, len(rows)]
    out = None
    parts = [rows[s:e] for s, e in zip(ends[:-1], ends[1:])]
    tagged = ALM.minutes(_stream(spark, parts, SAMPLES, tmp + "/in"), rules, lateness="0 seconds")
    tagged.writeStream.format("parquet").option("path", tmp + "/min").option("checkpointLocation", tmp + "/c1").outputMode("append").trigger(
        availableNow=True).start().awaitTermination()
    minutes = spark.read.schema(ALM.MINUTES).parquet(tmp + "/min")
    assert minutes.where("n > 0").groupBy("rule_name").agg(F.sum("n").alias("n")).where("rule_name = 'busy'").first().n == len(rows) - 1
    ticks = ALM.starters(start, str(T0)).unionByName(ALM.starters(start, str(_at(7200))))
    lines = [[tuple(r) for r in ticks.where(F.col("minute") == F.lit(str(T0)).cast("timestamp")).collect()]]
    lines += [[tuple(r) for r in minutes.orderBy("minute").collect()], [tuple(r) for r in ticks.where(F.col("minute") > F.lit(str(T0)).cast("timestamp")).collect()]]
    lines = lines if cuts else [sum(lines, [])]
    out = ALM.changes(_stream(spark, lines, ALM.MINUTES, tmp + "/rows"), rules, str(T0))
    out.writeStream.format("parquet").option("path", tmp + "/out").option("checkpointLocation", tmp + "/c2").outputMode("append").trigger(
        availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in spark.read.schema(ALM.CHANGES).parquet(tmp + "/out").collect()} == want
