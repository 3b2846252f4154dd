"""File-based jobs: Silver/Gold/load, guards, poison probe, overwrite scope, quarantine, archive, streaming."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lakekpi.operators import gates as G
from lakekpi.operators import prepare as P
from lakekpi.plans import archive as AR
from lakekpi.plans import sinks
from lakekpi.plans.batch import Layout, run_batch
from lakekpi.plans.gold import read_gold, run_gold
from lakekpi.plans.load import prune_serving, run_load, serving_table
from lakekpi.plans.silver import run_silver, silver_table
from lakekpi.sources import fixtures as X
from lakekpi.sources.partitions import PartitionEmpty, PartitionMissing, read_days
from lakekpi.sources.probe import PoisonPartition, assert_readable


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_silver_breaker_blocks_publish(spark, sf, tmp):
    raw = X.raw(spark, sf)
    with pytest.raises(G.DropRateExceeded):
        run_silver(spark, raw, X.songs(spark, sf), X.users(spark, sf), tmp, max_drop_rate=0.05)
    assert not os.path.exists(silver_table(tmp))
    res = run_silver(spark, raw, X.songs(spark, sf), X.users(spark, sf), tmp, run_key="streams/landing_date=2024-01-02/x.csv")
    assert res.counts["AfterSongsJoinCount"] == 936 and res.rows_written == 936
    assert spark.read.parquet(silver_table(tmp)).count() == 936
    m = {r.metric_name: r for r in res.metrics.collect()}
    assert m["RawCount"].dimensions["RunDate"] == "2024-01-02"


def test_reference_guard(spark, sf, tmp):
    from lakekpi.sources.csv_scan import ReferenceDataMissing

    empty = X.songs(spark, sf).limit(0)
    with pytest.raises(ReferenceDataMissing):
        run_silver(spark, X.raw(spark, sf), empty, X.users(spark, sf), tmp)


def test_partition_guards(spark, tmp):
    with pytest.raises(PartitionMissing):
        read_days(spark, tmp + "/nope", ["2024-01-01"])
    spark.createDataFrame([(1, "2024-01-01")], "v int, event_date string").withColumn(
        "event_date", F.to_date("event_date")).write.partitionBy("event_date").parquet(tmp + "/t")
    assert read_days(spark, tmp + "/t", ["2024-01-01"]).count() == 1
    with pytest.raises(PartitionEmpty):
        read_days(spark, tmp + "/t", ["2024-01-02"])


def test_dynamic_overwrite_replaces_only_present_days(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string")
    sinks.write_partitions(df, tmp + "/t", ["d"])
    sinks.write_partitions(spark.createDataFrame([(3, "a")], "v int, d string"), tmp + "/t", ["d"])
    assert sorted((r.v, r.d) for r in spark.read.parquet(tmp + "/t").collect()) == [(2, "b"), (3, "a")]


def test_poison_probe_names_every_bad_file(spark, tmp):
    root = tmp + "/gold/date=2024-06-25"
    spark.createDataFrame([("Pop", 3, 2)], "genre string, listen_count long, unique_listeners long").write.parquet(root)
    _write(root + "/bad-1.parquet", "junk")
    _write(root + "/bad-2.parquet", "more junk")
    with pytest.raises(PoisonPartition) as e:
        assert_readable(spark, root)
    assert "2 unreadable Parquet file(s)" in str(e.value) and "bad-1.parquet" in str(e.value) and "bad-2.parquet" in str(e.value)


def test_gold_and_load_idempotent(spark, sf, tmp):
    s = run_silver(spark, X.raw(spark, sf), X.songs(spark, sf), X.users(spark, sf), tmp + "/silver")
    days = s.days[:3]
    g = run_gold(spark, tmp + "/silver", tmp + "/gold", days)
    assert g.counts["TopGenresRows"] == 15
    k = read_gold(spark, tmp + "/gold", "genre_kpis_daily", days)
    assert k.schema["date"].dataType.simpleString() == "string"
    run_load(spark, tmp + "/gold", tmp + "/serving", days)
    run_load(spark, tmp + "/gold", tmp + "/serving", days)
    from lakekpi.operators import serve as E

    items = spark.read.parquet(serving_table(tmp + "/serving", E.GENRE_KPIS))
    assert items.count() == g.counts["GenreKpisRows"]
    assert items.groupBy("genre", "date").count().filter("count > 1").count() == 0
    pruned = prune_serving(spark, tmp + "/serving", F.lit("2100-01-01 00:00:00").cast("timestamp"))
    assert pruned["genre_kpis_daily"]["emptied"] == 3
    assert not os.path.exists(serving_table(tmp + "/serving", E.GENRE_KPIS) + f"/date={days[0]}")


def test_archive_verifies_before_delete(spark, tmp):
    land = tmp + "/landing"
    _write(land + "/streams/landing_date=2024-06-01/a.csv", "user_id,track_id,listen_time\n1,T1,2024-06-01 10:00:00\n")
    _write(land + "/streams/landing_date=2024-06-01/b.csv", "user_id,track_id,listen_time\n2,T2,2024-06-01 10:00:00\n")
    keys = spark.createDataFrame([("streams/landing_date=2024-06-01/a.csv",), ("streams/landing_date=2024-06-01/b.csv",)], "object_key string")
    st = AR.archive(spark, land, tmp + "/archive", keys)
    assert sorted(r.status for r in st.collect()) == ["archived", "archived"]
    deleted = AR.delete_sources(spark, land, st).collect()
    assert len(deleted) == 2 and not os.path.exists(land + "/streams/landing_date=2024-06-01/a.csv")
    missing = spark.createDataFrame([("streams/landing_date=2024-06-01/zzz.csv",)], "object_key string")
    _write(land + "/streams/landing_date=2024-06-02/c.csv", "x\n")
    with pytest.raises(AR.ArchiveFailed) as e:
        AR.archive(spark, land, tmp + "/archive2", missing)
    assert "zzz.csv" in str(e.value)


def test_batch_run_quarantines_invalid_files(spark, sf, tmp):
    land = tmp + "/landing"
    _write(land + "/streams/landing_date=2024-01-02/good.csv",
           "listen_time,user_id,track_id\n2024-01-02 10:00:00,1,T14\n2024-01-02 11:00:00,2,T21\n")
    _write(land + "/streams/landing_date=2024-01-02/bad.csv", "user_id,track_id,listen_time\n1,,2024-01-02 10:00:00\n")
    L = Layout(*(tmp + "/" + x for x in ["landing", "silver", "gold", "serving", "quarantine", "archive", "manifests", "ledger"]))
    res = run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e1", event_time="2024-01-03T00:00:00Z",
                    max_drop_rate=1.0)
    assert res.invalid_keys == ["streams/landing_date=2024-01-02/bad.csv"]
    assert res.days == ["2024-01-02"]
    q = spark.read.text(L.quarantine + "/bronze").collect()
    assert len(q) == 2
    row = spark.read.parquet(L.ledger + "/quarantine").collect()[0]
    assert row.key == "streams/landing_date=2024-01-02/bad.csv" and os.path.isdir(f"{L.quarantine}/{row.quarantine_key}")
    assert spark.read.text(L.manifests).count() == 2


def test_streaming_ingest_exactly_once(spark, sf, tmp):
    from lakekpi.streaming.ingest import epochs_done, ingest

    L = _layout(tmp)
    raw = X.raw(spark, sf).filter(F.try_to_timestamp("listen_time", F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()).dropna()
    days = ["2024-01-01", "2024-01-02"]
    songs, users = X.songs(spark, sf), X.users(spark, sf)
    for i, d in enumerate(days):
        part = raw.filter(F.substring("listen_time", 1, 10) == d)
        P.write_landing_batches(part, f"{L.landing}/streams_tmp_{i}")
        src = f"{L.landing}/streams_tmp_{i}/landing_date={d}"
        for f in os.listdir(src):
            if f.endswith(".csv"):
                for name in (f, "again-" + f):  # the same content twice
                    _write(f"{L.landing}/streams/landing_date={d}/{name}", open(f"{src}/{f}").read())
        ingest(spark, L, tmp + "/ckpt", songs, users, max_drop_rate=1.0, archive_files=False)
    q, results = ingest(spark, L, tmp + "/ckpt", songs, users, max_drop_rate=1.0)  # nothing new
    assert results == []
    assert [r.status for r in epochs_done(spark, L, "ckpt").collect()] == ["SUCCEEDED"] * 2
    from lakekpi.operators import curate as C
    from lakekpi.operators import aggregate as D

    batch = raw.filter(F.substring("listen_time", 1, 10).isin(days))
    expect = {tuple(r) for r in D.genre_kpis(C.curate(batch, songs, users)).select("genre", "date", "listen_count").collect()}
    got = {tuple(r) for r in read_gold(spark, L.gold, "genre_kpis_daily").select("genre", "date", "listen_count").collect()}
    assert got == expect
    assert spark.read.parquet(tmp + "/silver/streams_curated").count() == C.curate(batch, songs, users).count()


def test_late_file_merges_into_its_day(spark, sf, tmp):
    land = tmp + "/landing"
    _write(land + "/streams/landing_date=2024-01-02/a.csv", "user_id,track_id,listen_time\n1,T14,2024-01-02 10:00:00\n")
    L = Layout(*(tmp + "/" + x for x in ["landing", "silver", "gold", "serving", "quarantine", "archive", "manifests", "ledger"]))
    songs, users = X.songs(spark, sf), X.users(spark, sf)
    run_batch(spark, L, songs, users, execution_id="e1", max_drop_rate=1.0, archive_files=False)
    _write(land + "/streams/landing_date=2024-01-02/b.csv", "user_id,track_id,listen_time\n2,T14,2024-01-02 11:00:00\n")
    b = [land + "/streams/landing_date=2024-01-02/b.csv"]
    run_batch(spark, L, songs, users, paths=b, execution_id="e2", max_drop_rate=1.0, archive_files=False)
    run_batch(spark, L, songs, users, paths=b, execution_id="e3", max_drop_rate=1.0, archive_files=False)  # replay
    silver = spark.read.parquet(L.silver + "/streams_curated")
    assert sorted(r.user_id for r in silver.collect()) == [1, 2]
    k = read_gold(spark, L.gold, "genre_kpis_daily").collect()
    assert len(k) == 1 and k[0].listen_count == 2 and k[0].unique_listeners == 2
    runs = spark.read.parquet(L.ledger + "/runs").collect()
    assert sorted(r.status for r in runs) == ["SUCCEEDED"] * 3


def test_day_read_prunes_partitions_and_columns(spark, tmp):
    df = spark.createDataFrame([(1, "a", "x", "2024-01-01"), (2, "b", "y", "2024-01-02")],
                               "user_id int, genre string, other string, event_date string")
    df.withColumn("event_date", F.to_date("event_date")).write.partitionBy("event_date").parquet(tmp + "/silver")
    out = read_days(spark, tmp + "/silver", ["2024-01-02"]).select("user_id", "genre")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "ReadSchema: struct<user_id:int,genre:string>" in plan
    assert [tuple(r) for r in out.collect()] == [(2, "b")]


def _layout(tmp):
    return Layout(*(tmp + "/" + x for x in ["landing", "silver", "gold", "serving", "quarantine", "archive", "manifests", "ledger"]))


def test_run_admits_deduplicates_and_repeats_nothing(spark, sf, tmp):
    L, songs, users = _layout(tmp), X.songs(spark, sf), X.users(spark, sf)
    text = "user_id,track_id,listen_time\n1,T14,2024-01-02 10:00:00\n"
    day = L.landing + "/streams/landing_date=2024-01-02"
    _write(day + "/a b+c.csv", text)  # a key that paths encode
    _write(day + "/copy.csv", text)  # the same bytes again
    _write(day + "/x.csv.tmp", text.replace("T14", "T21"))
    _write(L.landing + "/other/y.csv", text.replace("T14", "T28"))
    res = run_batch(spark, L, songs, users, execution_id="e1")
    assert len(res.valid_keys) == 1 and res.valid_keys[0] in ("streams/landing_date=2024-01-02/a b+c.csv", "streams/landing_date=2024-01-02/copy.csv")
    again = run_batch(spark, L, songs, users, execution_id="e2")
    assert again.valid_keys == [] and spark.read.parquet(L.silver + "/streams_curated").count() == 1
    for r in res.archived.collect():
        assert r.status == "archived" and os.path.isdir(f"{L.archive}/{r.archive_key}")
    # the same files by stream replace themselves
    from lakekpi.streaming.ingest import ingest

    os.remove(day + "/" + ("copy.csv" if "b+c" in res.valid_keys[0] else "a b+c.csv"))
    ingest(spark, L, tmp + "/ckpt", songs, users)
    assert spark.read.parquet(L.silver + "/streams_curated").count() == 1
    m = spark.read.parquet(L.ledger + "/metrics")
    assert {"RawCount", "DropRatePct", "GenreKpisRows", "GenreKpisLoaded"} <= {r.metric_name for r in m.collect()}


def test_empty_and_invalid_files_fail_the_run(spark, sf, tmp):
    L = _layout(tmp)
    _write(L.landing + "/streams/landing_date=2024-01-02/none.csv", "")
    res = run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e1", event_time="2024-01-03T00:00:00Z")
    assert res.invalid_keys == ["streams/landing_date=2024-01-02/none.csv"]
    run = spark.read.parquet(L.ledger + "/runs").collect()[0]
    assert run.status == "FAILED" and run.invalid_files == 1
    _write(L.landing + "/streams/landing_date=2024-01-02/bad.csv", "user_id,track_id,listen_time\n1,,2024-01-02 10:00:00\n")
    _write(L.landing + "/streams/landing_date=2024-01-02/bad2.csv", "user_id,track_id,listen_time\n2,,2024-01-02 10:00:00\n")
    run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e2", event_time="2024-01-03T00:00:00Z")
    from lakekpi.operators import serve as E

    reports = spark.read.parquet(serving_table(L.serving, E.DQ_REPORTS))
    assert reports.count() == 3 == reports.select("batch_id", "event_date").distinct().count()


def test_wide_files_keep_all_fields(spark, sf, tmp):
    from lakekpi.sources.csv_scan import read_batches

    names = [f"c{i}" for i in range(97)] + ["user_id", "track_id", "listen_time"]
    _write(tmp + "/l/streams/landing_date=2024-01-02/w.csv", ",".join(names) + "\n" + ",".join(["v"] * 97 + ["1", "T14", "2024-01-02 10:00:00"]) + "\n")
    files, records = read_batches(spark, tmp + "/l")
    assert files.collect()[0].fields == names
    assert tuple(records.select("user_id", "track_id", "listen_time").collect()[0]) == ("1", "T14", "2024-01-02 10:00:00")


def test_one_bad_file_trips_the_breaker(spark, sf, tmp):
    L = _layout(tmp)
    good = "".join(f"{i},T{14 + 7 * (i % 20)},2024-01-02 10:{i % 60:02d}:00\n" for i in range(1, 900))
    bad = "".join(f"{i},T_NONE,2024-01-02 11:{i:02d}:00\n" for i in range(1, 21))
    for name, rows in (("good", good), ("bad", bad)):
        _write(f"{L.landing}/streams/landing_date=2024-01-02/{name}.csv", "user_id,track_id,listen_time\n" + rows)
    with pytest.raises(G.DropRateExceeded) as e:
        run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e1")
    assert "bad.csv" in str(e.value) and not os.path.exists(silver_table(L.silver))
    assert spark.read.parquet(L.ledger + "/metrics").where("metric_name = 'DropRatePct'").count() == 1


def test_rerun_without_a_key_replaces_itself(spark, sf, tmp):
    for _ in range(2):
        run_silver(spark, X.raw(spark, sf), X.songs(spark, sf), X.users(spark, sf), tmp)
    assert spark.read.parquet(silver_table(tmp)).count() == 936


def test_archive_keeps_line_order(spark, tmp):
    lines = ["header"] + [f"line {i % 7}" for i in range(500)]
    _write(tmp + "/l/streams/landing_date=2024-06-01/a.csv", "\n".join(lines) + "\n")
    keys = spark.createDataFrame([("streams/landing_date=2024-06-01/a.csv",)], "object_key string")
    st = AR.archive(spark, tmp + "/l", tmp + "/archive", keys).collect()[0]
    assert copy_bytes(f"{tmp}/archive/{st.archive_key}") == ("\n".join(lines) + "\n").encode()


def copy_bytes(folder):
    """A copy's bytes: its files in the order of their paths."""
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-"))
    return b"".join(open(f, "rb").read() for f in files)


def test_copies_keep_every_byte(spark, sf, tmp):
    data = {"crlf": b"h\r\n1\r\n2\r\n", "open": b"h\n1\n22", "open-crlf": b"h\r\n1\r", "latin": b"h\n\xe9\xff\n\xe9", "blank": b"\n\n \n",
            "one": b"x", "zero byte": b"a\x00b\n\x00", "large": b"".join(b"%d,%d\r\n" % (i, i * i) for i in range(30_000)) + b"end\xc3"}
    for name, text in data.items():
        _write(f"{tmp}/l/streams/landing_date=2024-06-01/{name}.csv", "")
        with open(f"{tmp}/l/streams/landing_date=2024-06-01/{name}.csv", "wb") as fh:
            fh.write(text)
    keys = spark.createDataFrame([(f"streams/landing_date=2024-06-01/{n}.csv",) for n in data], "object_key string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "70000")
    try:
        lines = AR.raw_lines(spark, tmp + "/l", keys)
        for _ in range(2):  # a later copy leaves the earlier one alone
            st = AR.archive(spark, tmp + "/l", tmp + "/archive", keys).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    want = {f"streams/landing_date=2024-06-01/{n}.csv": text for n, text in data.items()}
    assert {r.object_key: (r.status, r.bytes) for r in st} == {k: ("archived", len(v)) for k, v in want.items()}
    assert {r.object_key: copy_bytes(f"{tmp}/archive/{r.archive_key}") for r in st} == want
    md5 = {k: hashlib.md5(v).hexdigest() for k, v in want.items()}
    copy = st[0].archive_key.split("/")[0].removeprefix("copy=")
    for rows in (AR.content_digests(lines), AR.content_digests(AR.copied(spark, tmp + "/archive", copy))):
        assert {r.object_key: r.md5 for r in rows.collect()} == md5


def test_an_altered_copy_is_no_archive(spark, tmp, monkeypatch):
    _write(tmp + "/l/streams/landing_date=2024-06-01/a.csv", "h\r\n1\r\n")
    keys = spark.createDataFrame([("streams/landing_date=2024-06-01/a.csv",)], "object_key string")
    write = AR._write
    monkeypatch.setattr(AR, "_write", lambda rows, *a: write(rows.withColumn("value", F.rtrim("value", F.lit("\r"))), *a))
    with pytest.raises(AR.ArchiveFailed):
        AR.archive(spark, tmp + "/l", tmp + "/archive", keys)


def test_a_relanded_archived_file_is_known(spark, sf, tmp):
    L = _layout(tmp)
    text = "user_id,track_id,listen_time\r\n" + "".join(f"{i},T{14 + 7 * (i % 20)},2024-01-02 10:{i % 60:02d}:00\r\n" for i in range(1, 50))
    _write(L.landing + "/streams/landing_date=2024-01-02/a.csv", text.replace("\r\n", "\n"))
    with open(L.landing + "/streams/landing_date=2024-01-02/a.csv", "wb") as fh:
        fh.write(text[:-2].encode())
    done = run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e1").archived
    AR.delete_sources(spark, L.landing, done).collect()
    assert not os.path.exists(L.landing + "/streams/landing_date=2024-01-02/a.csv")
    with open(L.landing + "/streams/landing_date=2024-01-02/again.csv", "wb") as fh:
        fh.write(copy_bytes(f"{L.archive}/{done.collect()[0].archive_key}"))
    assert run_batch(spark, L, X.songs(spark, sf), X.users(spark, sf), execution_id="e2").valid_keys == []


def _clean(n, day="2024-01-02"):
    return "user_id,track_id,listen_time\n" + "".join(f"{i},T{14 + 7 * (i % 20)},{day} 10:{i % 60:02d}:00\n" for i in range(n, n + 30))


def test_replayed_and_failing_epochs(spark, sf, tmp, monkeypatch):
    import shutil

    from lakekpi.streaming import ingest as ST

    L, songs, users = _layout(tmp), X.songs(spark, sf), X.users(spark, sf)
    _write(L.landing + "/streams/landing_date=2024-01-02/a.csv", _clean(1))
    ST.ingest(spark, L, tmp + "/ckpt", songs, users, archive_files=False)
    rows = spark.read.parquet(silver_table(L.silver)).count()
    def forget():
        """As if Spark had stopped before it noted the end of the first epoch."""
        for name in [f"commits/{f}" for f in os.listdir(tmp + "/ckpt/commits")] + [f"offsets/{f}" for f in os.listdir(tmp + "/ckpt/offsets")]:
            if not name.strip(".crc").endswith("offsets/0") and name != "offsets/.0.crc":
                os.remove(f"{tmp}/ckpt/{name}")

    forget()
    calls, run = [], ST.run_batch
    monkeypatch.setattr(ST, "run_batch", lambda *a, **kw: calls.append(kw["execution_id"]) or run(*a, **kw))
    ST.ingest(spark, L, tmp + "/ckpt", songs, users, archive_files=False)
    assert calls == [] and spark.read.parquet(silver_table(L.silver)).count() == rows
    # an epoch that stopped half-way runs again, though its files are in the ledger already
    shutil.rmtree(L.ledger + "/epochs")
    forget()
    ST.ingest(spark, L, tmp + "/ckpt", songs, users, archive_files=False)
    assert calls == ["ckpt-0"] and spark.read.parquet(silver_table(L.silver)).count() == rows

    def fail(*a, **kw):
        calls.append("failed")
        raise RuntimeError("no luck")

    monkeypatch.setattr(ST, "run_batch", fail)
    _write(L.landing + "/streams/landing_date=2024-01-02/b.csv", _clean(100))
    ST.ingest(spark, L, tmp + "/ckpt", songs, users, archive_files=False)
    assert calls.count("failed") == 3
    dead = spark.read.parquet(L.ledger + "/failures").collect()
    assert [(r.object_key, r.attempts, r.error) for r in dead] == [("streams/landing_date=2024-01-02/b.csv", 3, "no luck")]
    assert sorted(r.status for r in ST.epochs_done(spark, L, "ckpt").collect()) == ["DEAD_LETTER", "SUCCEEDED"]
