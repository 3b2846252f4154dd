"""Silver curation (C1-C13), modelled on the reference's example tests."""

from pyspark.sql import functions as F

from lakekpi import schemas as S
from lakekpi.operators import curate as C

SONGS = "track_id string, artists string, album_name string, track_name string, duration_ms long, track_genre string"
USERS = "user_id int, user_country string"


def _streams(spark, rows):
    return spark.createDataFrame(rows, S.STREAMS)


def test_drop_rows_missing_required_fields(spark):
    df = _streams(spark, [(1, "T1", "2024-06-01 10:00:00"), (None, "T1", "2024-06-01 10:00:00"),
                          (1, None, "2024-06-01 10:00:00"), (1, "T1", None)])
    assert C.clean_streams(df).count() == 1


def test_dedup_on_triplet(spark):
    df = _streams(spark, [(1, "T1", "2024-06-01 10:00:00"), (1, "T1", "2024-06-01 10:00:00"),
                          (1, "T1", "2024-06-01 11:00:00")])
    assert C.clean_streams(df).count() == 2


def test_bad_timestamps_dropped_without_raising(spark):
    df = _streams(spark, [(1, "T1", "not-a-date"), (1, "T1", "2024/06/01"), (1, "T1", "2024-06-01 10:00:00")])
    out = C.clean_streams(df).collect()
    assert len(out) == 1 and out[0].listen_ts is not None


def test_dedup_scope_per_file(spark):
    rows = [(1, "T1", "2024-06-01 10:00:00", "a.csv"), (1, "T1", "2024-06-01 10:00:00", "b.csv")]
    df = spark.createDataFrame(rows, "user_id int, track_id string, listen_time string, source_file string")
    assert C.clean_streams(df).count() == 1
    assert C.clean_streams(df, scope=["source_file"]).count() == 2


def _curated(spark, streams, songs, users):
    return C.build_curated(C.clean_streams(_streams(spark, streams)), spark.createDataFrame(songs, SONGS),
                           spark.createDataFrame(users, USERS))


def test_inner_join_drops_unknown_tracks(spark):
    out = _curated(spark, [(1, "T1", "2024-06-01 10:00:00"), (1, "T_MISSING", "2024-06-01 10:00:00")],
                   [("T1", "A", "Al", "Song1", 180000, "Pop")], [(1, "GH")])
    assert [r.track_id for r in out.collect()] == ["T1"]


def test_left_join_keeps_unknown_users(spark):
    out = _curated(spark, [(9, "T1", "2024-06-01 10:00:00")], [("T1", "A", "Al", "Song1", 180000, "Pop")], [])
    r = out.collect()[0]
    assert r.user_id == 9 and r.user_country is None


def test_duplicate_song_keys_fan_out(spark):
    out = _curated(spark, [(1, "T1", "2024-06-01 10:00:00")],
                   [("T1", "A", "Al", "Song1", 180000, "Pop"), ("T1", "B", "Bl", "Song1b", 1000, "Rock")], [(1, "GH")])
    assert out.count() == 2


def test_genre_normalised_and_seconds(spark):
    out = _curated(spark, [(1, "T1", "2024-06-01 23:59:59")], [("T1", "A", "Al", "S", 180500, "  Hip Hop  ")], [(1, "GH")])
    r = out.collect()[0]
    assert r.genre == "hip hop"
    assert r.listen_seconds == 180.5
    assert str(r.event_date) == "2024-06-01"
    assert out.columns == S.CURATED_COLUMNS


def test_lineage_columns(spark):
    cleaned = C.clean_streams(_streams(spark, [(1, "T1", "2024-06-01 10:00:00")]))
    out = C.build_curated(cleaned, spark.createDataFrame([("T1", "A", "Al", "S", 1000, "Pop")], SONGS),
                          spark.createDataFrame([(1, "GH")], USERS), lineage=True, source_file="s3://b/k.csv",
                          execution_id="e1")
    r = out.collect()[0]
    assert (r.source_file, r.ingested_at, r.source_execution_id) == ("s3://b/k.csv", "unknown", "e1")


def test_song_join_is_broadcast_only_behind_size_check(spark):
    from lakekpi.operators.joins import fits_broadcast

    songs = spark.createDataFrame([("T1", "A", "Al", "S", 1000, "Pop")] * 3, SONGS)
    assert fits_broadcast(songs, 3)
    assert not fits_broadcast(songs, 2)
    streams = C.clean_streams(_streams(spark, [(1, "T1", "2024-06-01 10:00:00")]))
    plan = C.join_songs(streams, songs, max_rows=2)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_skew_split_join_matches_plain_join(spark):
    from lakekpi.operators.joins import hot_keys, join_dimension

    fact = spark.range(20000).selectExpr("case when id % 3 = 0 then 7 when id % 97 = 0 then null else cast(id % 500 as int) end as user_id", "id")
    dim = spark.range(0, 400).selectExpr("cast(id as int) as user_id", "concat('c', cast(id as string)) as user_country")
    assert 7 in hot_keys(fact, "user_id", share=0.05, sample_fraction=0.2)
    for how in ("inner", "left"):
        got = join_dimension(fact, dim, "user_id", how, max_rows=10, skew_share=0.05)
        plain = fact.join(dim, "user_id", how)
        assert sorted(map(tuple, got.select("id", "user_id", "user_country").collect())) == sorted(
            map(tuple, plain.select("id", "user_id", "user_country").collect()))


def test_a_fact_beyond_the_bound_is_computed_once_and_its_hot_key_is_shared(spark, tmp):
    from lakekpi.operators.joins import join_dimension

    # joined to two dimensions, neither of which fits; key 7 has a third of the rows
    spark.range(60000).selectExpr("case when id % 3 = 0 then 7 else cast(id % 500 as int) end as user_id", "cast(id % 300 as int) as song", "id",
                                  "sha2(cast(id as string), 512) as text").write.parquet(tmp + "/fact")
    fact = spark.read.parquet(tmp + "/fact")
    users = spark.range(0, 400).selectExpr("cast(id as int) as user_id", "concat('c', cast(id as string)) as user_country")
    songs = spark.range(0, 290).selectExpr("cast(id as int) as song", "id * 2 as length")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "262144",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.files.maxPartitionBytes": "1000000"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = join_dimension(join_dimension(fact, songs, "song", "inner", max_rows=10), users, "user_id", "left", max_rows=10)
        out = got.groupBy("user_country").agg(F.count(F.lit(1)), F.max("text"))
        rows = {r[0]: r[1] for r in out.collect()}
        plan = out._jdf.queryExecution()
        assert str(plan.optimizedPlan().toString()).count("parquet") == 1  # four times for each dimension before
        assert "skew=true" in str(plan.executedPlan().toString())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    want = {}
    for i in range(60000):
        u = 7 if i % 3 == 0 else i % 500
        if i % 300 < 290:
            want[f"c{u}" if u < 400 else None] = want.get(f"c{u}" if u < 400 else None, 0) + 1
    assert rows == want
