"""Resumed runs, compaction, projected scans, schema generations, catalog pruning."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, StringContains
from pyspark.sql.types import StructType

from lakekpi.plans import compact as CP
from lakekpi.plans import sinks
from lakekpi.plans import small_files as SF
from lakekpi.plans import stages as SG
from lakekpi.sources import generations as GN
from lakekpi.sources.files import open_fs
from lakekpi.sources.projected import ProjectedReader, read_projected


def _files(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, length long, event_time string")


def test_stages_run_once(spark, tmp):
    files, calls = _files(spark, ("a", 1, "t"), ("b", 2, "t")), []

    def run(files, run_id="r", stop=None, broken=False):
        st = SG.Stages(spark, tmp, run_id, files, stop)
        t = st.table("one", lambda: calls.append("one") or spark.range(3))

        def two():
            calls.append("two")
            if broken:
                raise ValueError
            return {"n": t.count()}

        out = st.run("two", two)
        st.finish()
        return out

    with pytest.raises(SG.RunStopped):
        run(files, stop="one")
    with pytest.raises(ValueError):
        run(files, broken=True)
    assert calls == ["one", "two"]
    assert run(files.orderBy(F.desc("path"))) == {"n": 3} and calls == ["one", "two", "two"]
    assert run(files) == {"n": 3} and calls[3:] == ["one", "two"]  # a finished run starts anew
    run(_files(spark, ("a", 1, "later"), ("b", 2, "t")))
    run(files, run_id="other")
    assert len(calls) == 9


def test_compaction_plan_and_swap(spark, tmp):
    sizes = spark.createDataFrame([("a", 5, 100), ("b", 3, 250), ("c", 1, 10), ("d", 2, 199)], "day string, files long, bytes long")
    got = {r.day: (r.bins, r.first) for r in CP.plan(sizes, 100).collect()}
    assert got == {"a": (1, 0)}
    assert {r.day: (r.bins, r.first) for r in CP.plan(sizes, 200).collect()} == {"a": (1, 0), "b": (2, 1), "d": (1, 3)}
    df = spark.range(4000).select("id", F.lit(7).alias("same"), F.when(F.col("id") < 3900, "d1").otherwise("d2").alias("d"))
    df.repartition(8).write.partitionBy("d").parquet(tmp + "/t")
    spark.range(5).select("id", F.lit(1).alias("same"), F.lit("d3").alias("d")).coalesce(1).write.mode("append").partitionBy("d").parquet(tmp + "/t")
    before = {r.day: r for r in CP.day_sizes(spark, tmp + "/t", "d").collect()}
    untouched = os.listdir(tmp + "/t/d=d3")
    target = before["d1"].bytes // 2 + 1
    done = {r.day: r for r in CP.compact(spark, tmp + "/t", "d", target).collect()}
    assert set(done) == {"d1", "d2"} and done["d1"].bins == 2 and done["d1"].n_rows == 3900
    after = {r.day: r.files for r in CP.day_sizes(spark, tmp + "/t", "d").collect()}
    assert after == {"d1": 2, "d2": 1, "d3": 1} and os.listdir(tmp + "/t/d=d3") == untouched
    assert sorted(r.id for r in spark.read.parquet(tmp + "/t").where("d <> 'd3'").collect()) == list(range(4000))
    assert CP.compact(spark, tmp + "/t", "d", target).count() == 0


def test_small_files_hold_all_rows_and_a_repeated_task_writes_the_same(spark, tmp):
    rows = spark.range(25_000).select(
        F.when(F.col("id") % 11 > 0, F.col("id").cast("int")).alias("i"), F.concat(F.lit("é"), (F.col("id") % 7).cast("string")).alias("s"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id + 0.000001)").alias("ts"),
        F.when(F.col("id") < 24_990, F.expr("date_add(date'2024-01-01', cast(id * id % 3 as int))")).alias("d"), (F.col("id") / 3).alias("x"))
    dealt = rows.repartition(2, "d").cache()
    per_task = [r[0] for r in dealt.groupBy(F.spark_partition_id(), "d").count().select("count").collect()]

    def contents():
        return {p: open(os.path.join(at, p), "rb").read() for at, _, names in os.walk(tmp + "/s") for p in names}

    want = sum(-(-n // 50) for n in per_task), 25_000
    assert sinks.write_small_files(dealt, tmp + "/s", "d", 50) == want
    first = contents()
    back = spark.read.parquet(tmp + "/s")
    assert back.exceptAll(rows.select(back.columns)).isEmpty() and back.count() == 25_000
    assert [f.dataType for f in back.schema] == [f.dataType for f in rows.select(back.columns).schema]
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 50
    assert sinks.write_small_files(dealt, tmp + "/s", "d", 50) == want and contents() == first
    assert sinks.write_small_files(dealt.where("i < 0"), tmp + "/none", "d", 50) == (0, 0)
    dealt.unpersist()


def test_compaction_keeps_the_table_if_rows_differ(spark, tmp, monkeypatch):
    spark.range(50).withColumn("d", F.lit("a")).repartition(4).write.partitionBy("d").parquet(tmp + "/t")
    stage = CP.stage
    monkeypatch.setattr(CP, "stage", lambda df, name: stage(df.where("id <> 3") if name == "compact" else df, name))
    with pytest.raises(CP.RowsDiffer):
        CP.compact(spark, tmp + "/t", "d")
    assert spark.read.parquet(tmp + "/t").count() == 50


def test_compaction_stages_few_files(spark, tmp, monkeypatch):
    stage, parts = CP.stage, {}
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 1)
    monkeypatch.setattr(CP, "stage", lambda df, name: parts.setdefault(name, df.rdd.getNumPartitions()) and stage(df, name))
    spark.range(50).withColumn("d", F.lit("a")).repartition(20).write.partitionBy("d").parquet(tmp + "/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        done = CP.compact(spark, tmp + "/t", "d").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert done[0].n_rows == 50 and parts["compact"] == 8
    assert sorted(r.id for r in spark.read.parquet(tmp + "/t").collect()) == list(range(50))


def test_compaction_keeps_no_record_of_each_file_in_the_driver(spark, tmp, monkeypatch):
    stage, held = CP.stage, {}
    inside = lambda df: [f for f in df.inputFiles() if f"{tmp}/t/" in f]  # noqa: E731 - files of the table that the plan names
    monkeypatch.setattr(CP, "stage", lambda df, name: held.update({name: inside(df)}) or stage(df, name))
    rows = spark.range(400).select("id", (F.col("id") % 3).cast("string").alias("d"))
    rows.repartition(20).write.partitionBy("d").parquet(tmp + "/t")
    sizes = CP.day_sizes(spark, tmp + "/t", "d")
    assert inside(sizes) == [] and sizes.agg(F.sum("files")).first()[0] == 60
    assert sorted((r.day, r.n_rows) for r in CP.compact(spark, tmp + "/t", "d").collect()) == [("0", 134), ("1", 133), ("2", 133)]
    assert {"compact-plan", "compact", "compact-check"} <= set(held) and not any(held.values())
    assert sorted(r.id for r in spark.read.parquet(tmp + "/t").collect()) == list(range(400))


def _read(spark, path):
    return SF.read_table(spark, path, sinks.stage(SF.list_table(spark, path), "files"), 3)


def _same(spark, path):
    got, want = _read(spark, path), spark.read.parquet(path)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    text = lambda df: df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))  # noqa: E731 - maps cannot be compared
    assert text(got).exceptAll(text(want)).isEmpty() and text(want).exceptAll(text(got)).isEmpty()
    return got.count()


@pytest.mark.parametrize("times", ["INT96", "TIMESTAMP_MICROS"])
def test_rows_of_small_files_are_those_of_sparks_reader(spark, tmp, times):
    odd = F.when(F.col("id") % 5 > 0, F.col("id"))
    at = F.expr("timestamp'1650-01-01 00:00:00.000001' + make_dt_interval(cast(id as int) * 4000)")
    rows = spark.range(60).select(
        "id", (odd > 9).alias("ok"), odd.cast("byte").alias("b"), odd.cast("short").alias("s"), (odd / 7).cast("float").alias("f"),
        (odd / 7).alias("dotted.name"), odd.cast("decimal(9,2)").alias("m"), odd.cast("decimal(38,4)").alias("w"), odd.cast("string").alias("é"),
        odd.cast("string").cast("binary").alias("raw"), at.alias("at"), at.cast("timestamp_ntz").alias("ntz"), at.cast("date").alias("on"),
        F.array(odd, F.lit(None)).alias("list"), F.struct(odd.alias("x"), F.array(F.struct(at.alias("y"))).alias("z")).alias("both"),
        F.create_map(F.lit("k"), F.struct(odd.alias("v"))).alias("map"),
        F.when(F.col("id") % 4 == 0, "a b=c/d%").when(F.col("id") % 4 == 1, "7").when(F.col("id") % 4 == 2, "x").alias("d"),
        (F.col("id") % 2).cast("int").alias("n"))
    spark.conf.set("spark.sql.parquet.outputTimestampType", times)
    try:
        rows.repartition(6).write.partitionBy("d", "n").parquet(tmp + "/t")
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    for name in ("_note.parquet", ".part.parquet", "zero.parquet"):
        open(f"{tmp}/t/d=7/n=1/{name}", "w").write("" if name[0] == "z" else "not read")
    assert _same(spark, tmp + "/t") == 60
    assert _same(spark, f"file://{tmp}/t") == 60


def test_small_files_with_other_columns_and_large_batches(spark, tmp):
    wide = spark.range(70_000).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("B"), F.expr("date_add(date'2024-01-01', cast(id % 2 as int))").alias("d"))
    wide.coalesce(2).write.partitionBy("d").parquet(tmp + "/t")
    for i, some in enumerate((wide.select("d", "a"), wide.select(F.lit(1).alias("more"), F.lit("y").alias("b"), "d"), wide.where("a < 0"))):
        some.limit(9).coalesce(1).write.partitionBy("d").parquet(f"{tmp}/more{i}")
        for at, _, names in os.walk(f"{tmp}/more{i}"):
            for name in names:
                if name.startswith("part") and "d=" in at:
                    os.rename(f"{at}/{name}", f"{tmp}/t/{os.path.basename(at)}/zz-{i}-{name}")
    assert _same(spark, tmp + "/t") == 70_018
    spark.conf.set("spark.sql.parquet.mergeSchema", "true")
    try:
        assert "more" in _read(spark, tmp + "/t").columns and not SF.by_tasks(spark, tmp + "/t")
    finally:
        spark.conf.unset("spark.sql.parquet.mergeSchema")
    assert not SF.by_tasks(spark, "viewfs://store/t") and not SF.by_tasks(spark, tmp + "/none")


def test_old_dates_are_not_read_otherwise(spark, tmp):
    spark.conf.set("spark.sql.parquet.datetimeRebaseModeInWrite", "LEGACY")
    try:
        for name, day in (("new", "2024-01-01"), ("old", "1500-01-01")):
            spark.range(3).select(F.lit(day).cast("date").alias("on"), F.lit("a").alias("d")).write.partitionBy("d").parquet(f"{tmp}/{name}")
    finally:
        spark.conf.unset("spark.sql.parquet.datetimeRebaseModeInWrite")
    assert _same(spark, tmp + "/new") == 3
    with pytest.raises(Exception, match="OldCalendar"):
        _read(spark, tmp + "/old").collect()
    spark.read.parquet(tmp + "/old").repartition(3).write.partitionBy("d").parquet(tmp + "/many")
    os.makedirs(tmp + "/many/d=b")
    for at, _, names in os.walk(tmp + "/old/d=a"):
        for name in names:
            os.link(f"{at}/{name}", f"{tmp}/many/d=b/{name}")
    assert sorted((r.day, r.n_rows) for r in CP.compact(spark, tmp + "/many", "d").collect()) == [("a", 3), ("b", 3)]
    assert {str(r.on) for r in spark.read.parquet(tmp + "/many").collect()} == {"1500-01-01"}


def test_projection_takes_day_filters():
    schema = StructType.fromDDL("v int, date string")

    def left(*filters):
        r = ProjectedReader({"path": "/t", "day": "date", "start": "2024-01-01", "end": "2024-03-31"}, schema)
        rest = list(r.pushFilters(list(filters)))
        return sum((p.days for p in r.partitions()), []), rest

    days, rest = left(GreaterThanOrEqual(("date",), "2024-01-30"), LessThan(("date",), "2024-02-02"), EqualTo(("v",), 3), StringContains(("date",), "1"))
    assert days == ["2024-01-30", "2024-01-31", "2024-02-01"] and len(rest) == 2
    assert left(In(("date",), ("2024-02-29", "2025-01-01")))[0] == ["2024-02-29"]
    assert left(EqualTo(("date",), dt.date(2024, 3, 1)))[0] == ["2024-03-01"]
    assert len(left()[0]) == 91


def test_projected_scan(spark, tmp, capfd):
    rows = [(i, f"2024-01-{1 + i % 28:02d}") for i in range(100)]
    spark.createDataFrame(rows, "v int, date string").write.partitionBy("date").parquet(tmp + "/t")
    with open(tmp + "/t/date=2024-01-02/part-bad.parquet", "w") as fh:
        fh.write("not read")
    t = read_projected(spark, tmp + "/t", "v int, date string", end="2024-12-31").where("date > '2024-01-26' and v > 40")
    assert sorted(map(tuple, t.collect())) == sorted(r for r in rows if r[1] > "2024-01-26" and r[0] > 40)
    t.explain("formatted")
    assert "GreaterThan(date,2024-01-26)" in capfd.readouterr()[0].replace(", ", ",")
    d = read_projected(spark, tmp + "/t", "v int, date date", end="2024-12-31").where("date = date'2024-01-05'")
    assert sorted(map(tuple, d.collect())) == [(i, dt.date(2024, 1, 5)) for i, s in rows if s == "2024-01-05"]


def test_generations(spark, tmp):
    one = spark.createDataFrame([(1, 2, 0.5)], "a int, b bigint, c float")
    two = spark.createDataFrame([(3, 4, 1.5, "x")], "a bigint, b bigint, c double, e string")
    three = spark.createDataFrame([(5, 6.25)], "a bigint, b double")
    for i, df in enumerate((one, two, three, one)):
        df.withColumn("day", F.lit(i)).coalesce(1).write.mode("append").partitionBy("day").parquet(tmp + "/t")
    gens = GN.generations(spark, tmp + "/t").collect()
    assert [r.files for r in gens] == [2, 1, 1]
    got = GN.read_generations(spark, tmp + "/t")
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("a", "bigint"), ("b", "double"), ("c", "double"), ("e", "string"), ("day", "int")]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2.0, 0.5, None, 0), (1, 2.0, 0.5, None, 3), (3, 4.0, 1.5, "x", 1), (5, 6.25, None, None, 2)]
    assert GN.resolve(["a tinyint, b float", "a bigint, c date", "a int, b double, c timestamp_ntz"]) == {"a": "bigint", "b": "double", "c": "timestamp_ntz"}
    with pytest.raises(GN.SchemaConflict, match="column a"):
        GN.resolve(["a int", "a string"])


def test_paths():
    for p in ("/x/y", "file:/x/y", "file:///x/y"):
        assert open_fs(p)[1] == "/x/y"


def test_catalog_prunes_by_join(spark, tmp, capfd):
    spark.sql("create database if not exists t15p")
    rows = spark.range(2000).select((F.col("id") % 40).cast("int").alias("day"), "id")
    rows.write.partitionBy("day").parquet(tmp + "/f")
    spark.sql(f"create table t15p.f (id bigint, day int) using parquet partitioned by (day) location '{tmp}/f'")
    spark.sql("msck repair table t15p.f")
    spark.range(40).select(F.col("id").cast("int").alias("d"), (F.col("id") % 10).alias("k")).write.mode("overwrite").parquet(tmp + "/d")
    spark.sql(f"create table t15p.d (d int, k bigint) using parquet location '{tmp}/d'")
    for t in ("f", "d"):
        spark.sql(f"analyze table t15p.{t} compute statistics noscan")
    q = spark.sql("select count(*) as n from t15p.f join t15p.d on day = d where k = 3")
    assert q.collect()[0].n == 200
    q.explain("formatted")
    assert "dynamicpruning" in capfd.readouterr()[0].lower()
