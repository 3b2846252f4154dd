"""Serving items, decimal conversion, upsert, TTL and lookups."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakekpi.functions.decimal import to_decimal
from lakekpi.operators import serve as E
from lakekpi.plans import sinks

GOLD = ("genre string, listen_count long, unique_listeners long, total_listen_seconds double, "
        "avg_listen_seconds_per_user double, date string")


def test_to_decimal_zero_tokens_and_exact(spark):
    df = spark.createDataFrame([(None,), ("nan",), (" INF ",), ("-inf",), ("None",), ("null",), ("",), ("12.5",)], "v string")
    assert [r[0] for r in df.select(to_decimal("v")).collect()] == [Decimal(0)] * 7 + [Decimal("12.5")]
    d = spark.createDataFrame([(float("nan"),), (float("inf"),), (0.1,)], "v double")
    assert [r[0] for r in d.select(to_decimal("v", d.schema["v"].dataType)).collect()] == [Decimal(0), Decimal(0), Decimal("0.1")]


def test_to_decimal_junk_raises(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception):
        df.select(to_decimal("v")).collect()


def test_items_types_and_ttl(spark):
    g = spark.createDataFrame([("pop", 3, 2, 300.5, 100.16666666666667, "2024-06-25")], GOLD)
    r = E.genre_kpi_items(g, "t0", "e1", F.lit("2024-06-25 00:00:00").cast("timestamp")).collect()[0]
    assert isinstance(r.listen_count, int) and r.total_listen_seconds == Decimal("300.5")
    assert r.avg_listen_seconds_per_user == Decimal("100.16666666666667")
    assert (r.ingested_at, r.source_execution_id) == ("t0", "e1")
    assert r.expires_at == 1719273600 + 90 * 86400


def test_upsert_last_writer_wins_and_untouched_days(spark):
    old = spark.createDataFrame([("a", "d1", 1), ("b", "d1", 1), ("a", "d2", 1)], "genre string, date string, v int")
    new = spark.createDataFrame([("a", "d1", 2), ("c", "d1", 2)], "genre string, date string, v int")
    t = E.ServingTable("t", "genre", "date", "date", 1)
    got = sorted(tuple(r) for r in E.merged_view(old, new, t).collect())
    assert got == [("a", "d1", 2), ("a", "d2", 1), ("b", "d1", 1), ("c", "d1", 2)]
    assert sorted(tuple(r) for r in E.merged_view(old, new, t, replace_days=True).collect()) == [
        ("a", "d1", 2), ("a", "d2", 1), ("c", "d1", 2)]


def test_upsert_on_parquet_is_idempotent(spark, tmp):
    path = tmp + "/serving"
    b1 = spark.createDataFrame([("a", "d1", 1), ("b", "d1", 1), ("a", "d2", 1)], "genre string, date string, v int")
    sinks.upsert_partitions(b1, path, ["genre", "date"], "date")
    b2 = spark.createDataFrame([("a", "d1", 2)], "genre string, date string, v int")
    sinks.upsert_partitions(b2, path, ["genre", "date"], "date")
    sinks.upsert_partitions(b2, path, ["genre", "date"], "date")
    got = sorted((r.genre, str(r.date), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", "d1", 2), ("a", "d2", 1), ("b", "d1", 1)]


def test_prune_expired(spark):
    df = spark.createDataFrame([(1, 100), (2, 200)], "k int, expires_at long")
    assert [r.k for r in E.prune_expired(df, F.timestamp_seconds(F.lit(150))).collect()] == [2]


def test_lookups(spark):
    items = spark.createDataFrame([("pop#d1", 2, "T2"), ("pop#d1", 1, "T1"), ("rock#d1", 1, "T3")],
                                  "genre_date string, rank int, track_id string")
    assert [r.track_id for r in E.songs_of_genre_date(items, "pop#d1").collect()] == ["T1", "T2"]
