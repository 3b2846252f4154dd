"""Catalog tables (A15), schema evolution (J5), batch preparation files (I1/I2), file sizing."""

import os

from pyspark.sql import functions as F

from lakekpi.operators import prepare as P
from lakekpi.plans import sinks
from lakekpi.sources.catalog import register_tables
from lakekpi.sources.partitions import read_table


def test_landing_batches_roundtrip(spark, tmp):
    df = spark.createDataFrame([(" 1 ", "T1 ", "2024-06-01 10:00:00"), ("2", "T2", "2024-06-02 10:00:00")],
                               "user_id string, track_id string, listen_time string")
    P.write_landing_batches(P.trim_fields(df), tmp + "/streams")
    days = sorted(d for d in os.listdir(tmp + "/streams") if d.startswith("landing_date="))
    assert days == ["landing_date=2024-06-01", "landing_date=2024-06-02"]
    back = P.load_trimmed(spark, [tmp + "/streams/landing_date=2024-06-01"]).collect()
    assert [tuple(r) for r in back] == [("1", "T1", "2024-06-01 10:00:00")]
    first = open([os.path.join(tmp + "/streams/landing_date=2024-06-01", f) for f in os.listdir(tmp + "/streams/landing_date=2024-06-01") if f.endswith(".csv")][0]).readline()
    assert first.strip() == "user_id,track_id,listen_time"


def test_strict_landing_date_raises_on_bad_time(spark):
    import pytest

    df = spark.createDataFrame([("1", "T1", "garbage")], "user_id string, track_id string, listen_time string")
    with pytest.raises(Exception):
        P.with_landing_date(df).collect()
    assert P.with_landing_date(df, strict=False).collect()[0].landing_date is None


def test_schema_evolution_merge(spark, tmp):
    spark.createDataFrame([(1, "2024-06-01")], "v int, d string").write.partitionBy("d").parquet(tmp + "/t")
    spark.createDataFrame([(2, "x", "2024-06-02")], "v int, w string, d string").write.mode("append").partitionBy("d").parquet(tmp + "/t")
    rows = {r.v: r.w for r in read_table(spark, tmp + "/t", merge_schema=True).collect()}
    assert rows == {1: None, 2: "x"}


def test_max_records_per_file(spark, tmp):
    df = spark.range(10).withColumn("d", F.lit("a"))
    sinks.write_partitions(df, tmp + "/t", ["d"], max_records_per_file=3)
    files = [f for f in os.listdir(tmp + "/t/d=a") if f.endswith(".parquet")]
    assert len(files) >= 4


def test_catalog_tables_and_views(spark, tmp):
    gold = tmp + "/gold"
    kpis = spark.createDataFrame([("pop", 3, 2, 7200.0, 2400.0, "u", "e", "2024-06-01")],
                                 "genre string, listen_count long, unique_listeners long, total_listen_seconds double, "
                                 "avg_listen_seconds_per_user double, ingested_at string, source_execution_id string, date string")
    kpis.write.partitionBy("date").parquet(gold + "/genre_kpis_daily")
    names = register_tables(spark, tmp + "/bronze", tmp + "/silver", gold, prefix="t15_")
    assert "t15_gold.genre_kpis_daily" in names
    r = spark.sql("select genre, date, total_listen_hours from v_genre_kpis").collect()[0]
    assert (r.genre, r.date, r.total_listen_hours) == ("pop", "2024-06-01", 2.0)


def test_size_shuffles_only_raises(spark):
    from lakekpi.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        assert size_shuffles(spark, 100 * 1024 ** 4) == 1_638_402  # 100 TB: two partitions for every 128 MB
        assert size_shuffles(spark, 10 * 1024 ** 2) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(key) == "1638402"
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_star_queries_size_their_shuffles_by_the_input(spark, sf, monkeypatch):
    """Partitions of at most 32 MB, and as many of them as the large batch's tables call for."""
    from lakekpi import registry, session

    asked = []
    monkeypatch.setattr(registry, "size_shuffles", lambda s, n: asked.append(n))
    n_bytes = sum(os.path.getsize(f"{sf}/{t}.parquet") for t in ("lineitem", "orders"))
    for name in ("star_genre_kpis_daily", "star_top_songs_by_genre_daily", "star_dq_gates"):
        registry.QUERIES[name](spark, sf)
    assert asked == [4 * n_bytes] * 3
    assert int(session.SCALE_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) <= 32 * 1024 * 1024
