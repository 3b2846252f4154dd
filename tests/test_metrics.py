"""Gates, breaker, long-form metrics, roll-ups and alarms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakekpi.operators import gates as G
from lakekpi.operators import metrics as M
from lakekpi.sources import fixtures as X

EXPECTED = {  # FIXTURES.md gate counts at sf0.001
    "RawCount": 1020, "AfterDropNaCount": 991, "AfterDedupCount": 972, "AfterTimestampParseCount": 963,
    "AfterSongsJoinCount": 936, "UnmatchedSongsCount": 27,
}


def test_gate_counts_relational(spark, sf):
    r = G.gate_counts(X.raw(spark, sf), X.songs(spark, sf)).collect()[0].asDict()
    assert {k: r[k] for k in EXPECTED} == EXPECTED


def test_gate_counts_observed_in_one_pass(spark, sf):
    joined, obs = G.observe_gates(X.raw(spark, sf), X.songs(spark, sf))
    joined.write.format("noop").mode("overwrite").save()
    assert G.observed_counts(obs) == EXPECTED


def test_breaker(spark):
    c = {"RawCount": 100, "AfterSongsJoinCount": 91}
    assert G.check_drop_rate(c, 0.10) == pytest.approx(0.09)
    with pytest.raises(G.DropRateExceeded):
        G.check_drop_rate(c, 0.05)
    assert G.check_drop_rate({"RawCount": 0, "AfterSongsJoinCount": 0}) == 0.0


def test_fan_out_can_make_unmatched_negative(spark):
    raw = spark.createDataFrame([(1, "T1", "2024-06-01 10:00:00")], "user_id int, track_id string, listen_time string")
    songs = spark.createDataFrame([("T1",), ("T1",)], "track_id string")
    r = G.gate_counts(raw, songs).collect()[0]
    assert r.AfterSongsJoinCount == 2 and r.UnmatchedSongsCount == -1 and r.DuplicateSongKeys == 1


def test_metrics_long_dimensions(spark, sf):
    g = G.gate_counts(X.raw(spark, sf), X.songs(spark, sf))
    rows = {r.metric_name: r for r in M.gates_to_metrics(g, "2024-06-01").collect()}
    assert rows["RawCount"].dimensions == {"Job": "silver_etl", "RunDate": "2024-06-01"}
    assert rows["DropRatePct"].dimensions == {"Job": "silver_etl"} and rows["DropRatePct"].unit == "Percent"
    assert rows["DropRatePct"].value == pytest.approx(100 * (1020 - 936) / 1020)


def test_rollup_and_alarms(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    s = spark.createDataFrame([(t0 + dt.timedelta(seconds=x), "m", float(v)) for x, v in [(10, 1), (20, 5), (400, 2)]],
                              "ts timestamp, metric_name string, value double")
    r = {str(x.period_start): x for x in M.rollup(s, 300, exact_scale=2).collect()}
    assert r["2024-01-01 00:00:00"].sum == 6.0 and r["2024-01-01 00:00:00"].maximum == 5.0
    rules = M.rules_frame(spark, [("hi", "m", "Maximum", 300, ">", 4.0, "notBreaching"),
                                  ("fresh", "m", "SampleCount", 300, "<", 1.0, "breaching"),
                                  ("none", "m", "Sum", 300, "<", 1.0, "missing")])
    st = {(x.rule_name, str(x.period_start)): x.state for x in M.evaluate_alarms(s, rules, "2024-01-01 00:00:00", "2024-01-01 00:15:00").collect()}
    assert st[("hi", "2024-01-01 00:00:00")] == "ALARM" and st[("hi", "2024-01-01 00:05:00")] == "OK"
    assert st[("hi", "2024-01-01 00:10:00")] == "OK"
    assert st[("fresh", "2024-01-01 00:10:00")] == "ALARM" and st[("fresh", "2024-01-01 00:00:00")] == "OK"
    assert st[("none", "2024-01-01 00:10:00")] == "INSUFFICIENT_DATA"
    assert len(st) == 9


def test_rollup_on_a_stream_with_watermark(spark, tmp):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(t0 + dt.timedelta(seconds=s), "m", float(v)) for s, v in [(10, 1), (20, 5), (400, 2), (4000, 3)]]
    spark.createDataFrame(rows, "ts timestamp, metric_name string, value double").write.parquet(tmp + "/in")
    stream = spark.readStream.schema("ts timestamp, metric_name string, value double").parquet(tmp + "/in")
    q = (M.rollup_stream(stream, 300, watermark="1 minute").writeStream.outputMode("append")
         .option("checkpointLocation", tmp + "/ckpt").trigger(availableNow=True).format("parquet")
         .option("path", tmp + "/out").start())
    q.awaitTermination()
    out = {str(r.period_start): r.sum for r in spark.read.parquet(tmp + "/out").collect()}
    assert out["2024-01-01 00:00:00"] == 6.0 and out["2024-01-01 00:05:00"] == 2.0


def test_rules_watch_their_own_series(spark):
    """The load job emits each count by job, and by job and day; only the first series is the alarm's."""
    s = M.counts_to_metrics(spark, {"GenreKpisLoaded": 10}, "ddb_etl", "2024-01-01", both_granularities=True, ts=dt.datetime(2024, 1, 1, 1))
    rules = M.rules_frame(spark)
    assert rules.where("rule_name like 'job-%' or rule_name like 'handler-%'").count() == 7
    st = {r.rule_name: r for r in M.evaluate_alarms(s, rules, "2024-01-01 00:00:00", "2024-01-02 00:00:00").where("period_start = '2024-01-01 00:00:00'").collect()}
    assert st["genre-kpis-zero"].value == 10.0 and st["genre-kpis-zero"].state == "OK"
    assert st["top-songs-zero"].state == "OK" and st["no-ingest"].state == "INSUFFICIENT_DATA"
