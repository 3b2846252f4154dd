"""Registered queries over files and written tables: copies, resumed runs, compaction, projection, schema generations, the
catalog, reference scans, guards, lineage and job metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi import oracle as O
from lakekpi import schemas as S
from lakekpi.operators import admission as A
from lakekpi.operators import aggregate as D
from lakekpi.operators import validate as B
from lakekpi.registry import (_CUR_CTE, _LANDED, _LANDED_CTES, DIRTY_LIMIT, _cur, _land, _layout, curated, register)
from lakekpi.session import scratch_path
from lakekpi.sources import fixtures as X
from lakekpi.sources import probe

KPI_COLUMNS = ["genre", "listen_count", "unique_listeners", "total_listen_seconds", "avg_listen_seconds_per_user", "date"]


def _day(c: str = "ts"):
    return F.substring(F.col(c).cast("string"), 1, 10)


# ---------------------------------------------------------------------------------------------------
# copies
# ---------------------------------------------------------------------------------------------------

_LINE = "concat_ws(',', cast(event_id as varchar), cast(user_id as varchar), event_type)"


@register("archived_bytes", f"""
with l as (select substr(cast(ts as varchar), 1, 10) as day, day(ts) % 3 as kind, event_id, {_LINE} as line from events)
select day, sum(octet_length(encode(line)) + case kind when 0 then 2 when 1 then 2 else 2 end) as n_bytes, true as same_bytes,
       case kind when 0 then md5(string_agg(line || chr(13) || chr(10), '' order by event_id))
                 when 1 then md5(string_agg(line || chr(10) || '#', '' order by event_id)) end as content_md5, 'archived' as status
from l group by day, kind""".replace("sum(octet", "cast(sum(octet").replace("else 2 end) as n_bytes", "else 2 end) as bigint) as n_bytes"))
def q_archived_bytes(spark, sf_dir):
    """Daily files with carriage returns, without a last line end, and with bytes that are no UTF-8: hashes of the
    landed bytes and of the archived copies (of the UTF-8 ones shown)."""
    from lakekpi.plans import archive as G
    from lakekpi.sources.listing import list_objects

    root = scratch_path(spark, "archived-bytes")
    ev = X.table(spark, sf_dir, "events")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type")
    rows = ev.select(_day().alias("landing_date"), (F.dayofmonth("ts") % 3).alias("kind"), "event_id", line.alias("line"))
    rows = rows.repartition("landing_date").sortWithinPartitions("landing_date", "event_id")
    latin = F.concat(F.col("line").cast("binary"), F.unhex(F.lit("E9"))).cast("string")  # a letter of another encoding
    for kind, value, end in ((0, F.col("line"), "\r\n"), (1, F.col("line"), "\n#"), (2, latin, "\n")):
        (rows.where(F.col("kind") == kind).select(value.alias("value"), "landing_date").write.mode("append").option("lineSep", end)
         .partitionBy("landing_date").text(f"{root}/landing/streams"))
    landed = list_objects(spark, f"{root}/landing")
    status = G.archive(spark, f"{root}/landing", f"{root}/archive", landed.select("object_key"))
    copy = status.select(F.regexp_extract("archive_key", "copy=([^/]+)", 1)).first()[0]
    copies = G.content_digests(G.copied(spark, f"{root}/archive", copy)).withColumnRenamed("md5", "copy_md5")
    j = landed.join(status, "object_key").join(copies, "object_key", "left")
    day = F.regexp_extract("object_key", K.LANDING_DATE_PATTERN, 1)
    return j.select(day.alias("day"), F.col("bytes").alias("n_bytes"), F.expr("etag <=> copy_md5").alias("same_bytes"),
                    F.when(F.substring(day, 9, 2).cast("int") % 3 != 2, F.col("copy_md5")).alias("content_md5"), "status")


# ---------------------------------------------------------------------------------------------------
# A run that was stopped
# ---------------------------------------------------------------------------------------------------


@register("resumed_run_kpis", O.with_ctes(O.GENRE_KPIS_SQL.replace("strftime(event_date, '%Y-%m-%d') as date", "strftime(event_date, '%Y-%m-%d') as date, cast(0 as bigint) as silver_files_changed", 1),
                                          *_LANDED_CTES, extra=_LANDED))
def q_resumed_run(spark, sf_dir):
    """J1 + J2: a run stops after Silver and is called again: Gold is that of a whole run, Silver is not written again."""
    from lakekpi.plans.batch import run_batch
    from lakekpi.plans.gold import read_gold
    from lakekpi.plans.silver import silver_table
    from lakekpi.plans.stages import RunStopped

    layout = _layout(scratch_path(spark, "resumed"))
    _land(spark, sf_dir, layout.landing)
    run = dict(execution_id="resumed", max_drop_rate=DIRTY_LIMIT, archive_files=False)
    try:
        run_batch(spark, layout, X.songs(spark, sf_dir), X.users(spark, sf_dir), stop_after="silver", **run)
    except RunStopped:
        pass
    files = lambda: probe.list_files(spark, silver_table(layout.silver)).select("path", "modificationTime")
    before = _kept(files())
    run_batch(spark, layout, X.songs(spark, sf_dir), X.users(spark, sf_dir), **run)
    now = _kept(files())
    changed = before.exceptAll(now).union(now.exceptAll(before)).agg(F.count(F.lit(1)).alias("silver_files_changed"))
    return read_gold(spark, layout.gold, "genre_kpis_daily").select(KPI_COLUMNS).crossJoin(F.broadcast(changed))  # one row


def _kept(df: DataFrame) -> DataFrame:
    from lakekpi.plans.sinks import stage

    return stage(df, "kept")


# ---------------------------------------------------------------------------------------------------
# compaction
# ---------------------------------------------------------------------------------------------------


@register("compacted_days", _cur("""
select strftime(event_date, '%Y-%m-%d') as day, count(*) as n_rows, true as same_rows, true as fewer_files, true as as_planned
from curated group by event_date having count(*) >= 60"""))
def q_compacted_days(spark, sf_dir):
    """Silver written in many small files per day, compacted: rows and hashes stay, files are as planned (days of 60 rows or more)."""
    from lakekpi.plans import compact as CP
    from lakekpi.plans.sinks import write_small_files
    from lakekpi.plans.small_files import list_table, read_table

    path = f"{scratch_path(spark, 'compact')}/silver"
    cur = curated(spark, sf_dir)
    write_small_files(cur.withColumn("_n", F.pmod(F.xxhash64(*cur.columns), F.lit(6))).repartition("event_date", "_n").drop("_n"),
                      path, "event_date", 50)
    written = read_table(spark, path, _kept(list_table(spark, path)), 8 * spark.sparkContext.defaultParallelism)
    before = _kept(CP.row_hashes(written, "event_date"))
    done = CP.compact(spark, path, "event_date")
    after = CP.row_hashes(spark.read.parquet(path), "event_date").join(CP.day_sizes(spark, path, "event_date").select(
        "day", F.col("files").alias("files_after")), "day")
    j = before.where("n_rows >= 60").join(after.toDF("day", "a_rows", "a_hash", "files_after"), "day").join(done.select("day", "files", "bins"), "day")
    return j.select("day", "n_rows", F.expr("n_rows = a_rows and row_hash = a_hash").alias("same_rows"),
                    F.expr("files_after < files").alias("fewer_files"), F.expr("files_after <= bins").alias("as_planned"))


# ---------------------------------------------------------------------------------------------------
# projection
# ---------------------------------------------------------------------------------------------------


@register("projected_days", _cur(f"""
select * from ({O.GENRE_KPIS_SQL}) k where date >= '2024-01-05' and date < '2024-01-20' and listen_count > 1"""))
def q_projected_days(spark, sf_dir):
    """A day range of a written table by projected partitions, nothing listed."""
    from lakekpi.sources.projected import read_projected

    path = f"{scratch_path(spark, 'projected')}/kpis"
    kpis = D.genre_kpis(curated(spark, sf_dir)).select(KPI_COLUMNS)
    kpis.write.partitionBy("date").parquet(path)
    t = read_projected(spark, path, kpis.schema, "date", end="2026-12-31")
    return t.where("date >= '2024-01-05' and date < '2024-01-20' and listen_count > 1")


# ---------------------------------------------------------------------------------------------------
# Schema generations
# ---------------------------------------------------------------------------------------------------


@register("schema_generations", """
select event_id, cast(user_id as bigint) as user_id, cast(floor(value) as double) as score, case when day(ts) > 10 then event_type end as event_type,
       case when day(ts) > 20 then substr(cast(ts as varchar), 1, 10) end as since, day(ts) as day
from events""")
def q_schema_generations(spark, sf_dir):
    """One table written under three schemas (columns added, types widened), read as one."""
    from lakekpi.sources.generations import read_generations

    path = f"{scratch_path(spark, 'generations')}/t"
    ev = X.table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    score = F.floor("value")
    first = ev.where("day <= 10").select("event_id", F.col("user_id").cast("int"), score.cast("int").alias("score"), "day")
    second = ev.where("day between 11 and 20").select("event_id", F.col("user_id").cast("bigint"), score.cast("bigint").alias("score"), "event_type", "day")
    third = ev.where("day > 20").select("event_id", F.col("user_id").cast("bigint"), score.cast("double").alias("score"), "event_type", _day().alias("since"), "day")
    for part in (first, second, third):
        part.write.mode("append").partitionBy("day").parquet(path)
    return read_generations(spark, path).select("event_id", "user_id", "score", "event_type", "since", F.col("day").cast("bigint").alias("day"))


# ---------------------------------------------------------------------------------------------------
# The catalog
# ---------------------------------------------------------------------------------------------------


@register("catalog_tables", O.with_ctes(f"""
select g.date, sum(g.listen_count) as listens, max(s.n) as silver_rows, max(b.n) as landed_rows, max(t.n) as top_songs, max(tg.n) as top_genres,
       (select count(*) from songs) as songs, (select count(*) from users) as users
from ({O.GENRE_KPIS_SQL}) g
join (select strftime(event_date, '%Y-%m-%d') as date, count(*) as n from curated group by 1) s on s.date = g.date
join (select landing_date as date, count(*) as n from (select * from stream_records union all select * from stream_records
        where cast(substr(landing_date, 9, 2) as int) % 6 = 2) r group by 1) b on b.date = g.date
join (select date, count(*) as n from ({O.TOP_SONGS_SQL.format(n=3)}) x group by 1) t on t.date = g.date
join (select date, count(*) as n from ({O.TOP_GENRES_SQL.format(n=5)}) x group by 1) tg on tg.date = g.date
where g.date > '2024-01-10' group by g.date""".replace("select g.date, sum(g.listen_count) as listens", "select g.date, cast(sum(g.listen_count) as bigint) as listens"), *_LANDED_CTES, extra=_LANDED))
def q_catalog_tables(spark, sf_dir):
    """All seven registered tables in one query by name, after a run that filled them; a day filter prunes each table."""
    from lakekpi.plans.batch import run_batch
    from lakekpi.sources.catalog import register_tables

    layout = _layout(scratch_path(spark, "catalog"))
    songs, users = X.songs(spark, sf_dir), X.users(spark, sf_dir)
    _land(spark, sf_dir, layout.landing)
    for name, df in (("songs", songs), ("users", users)):
        _reference(df, getattr(S, name.upper())).write.option("header", "true").csv(f"{layout.landing}/reference/{name}")
    run_batch(spark, layout, songs, users, execution_id="catalog", max_drop_rate=DIRTY_LIMIT, archive_files=False)
    p = f"q{uuid.uuid4().hex[:8]}_"
    register_tables(spark, layout.landing, layout.silver, layout.gold, prefix=p, views=False, statistics=True)
    return spark.sql(f"""
with g as (select date, sum(listen_count) as listens from {p}gold.genre_kpis_daily where date > '2024-01-10' group by date),
s as (select cast(event_date as string) as date, count(*) as n from {p}silver.streams_curated where event_date > date'2024-01-10' group by event_date),
b as (select landing_date as date, count(*) as n from {p}bronze.streams where landing_date > '2024-01-10' group by landing_date),
t as (select date, count(*) as n from {p}gold.top_songs_by_genre_daily where date > '2024-01-10' group by date),
tg as (select date, count(*) as n from {p}gold.top_genres_daily where date > '2024-01-10' group by date)
select g.date, listens, s.n as silver_rows, b.n as landed_rows, t.n as top_songs, tg.n as top_genres,
       (select count(*) from {p}bronze.songs) as songs, (select count(*) from {p}bronze.users) as users
from g join s on s.date = g.date join b on b.date = g.date join t on t.date = g.date join tg on tg.date = g.date""")


def _reference(df: DataFrame, schema) -> DataFrame:
    """A dimension in the columns of its landed file."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


# ---------------------------------------------------------------------------------------------------
# Scans and guards
# ---------------------------------------------------------------------------------------------------


def _landed_reference(spark, sf_dir) -> str:
    root = scratch_path(spark, "reference")
    for name in ("songs", "users"):
        (_reference(getattr(X, name)(spark, sf_dir), getattr(S, name.upper())).write.option("header", "true")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/{name}"))
    return root


@register("songs_scan", O.with_ctes("select track_id, artists, album_name, track_name, duration_ms, track_genre from songs", "songs"))
def q_songs_scan(spark, sf_dir):
    """The songs reference CSV with its fixed schema."""
    from lakekpi.sources.csv_scan import read_songs

    return read_songs(spark, f"{_landed_reference(spark, sf_dir)}/songs").select(*S.SONG_COLUMNS)


@register("users_scan", O.with_ctes("select user_id, user_country from users", "users"))
def q_users_scan(spark, sf_dir):
    """The users reference CSV with its fixed schema."""
    from lakekpi.sources.csv_scan import read_users

    return read_users(spark, f"{_landed_reference(spark, sf_dir)}/users").select(*S.USER_COLUMNS)


@register("reference_guard", O.with_ctes("""
select 'both' as given, 'ok' as verdict, (select count(*) from songs) as n_songs, (select count(*) from users) as n_users
union all select 'no songs', 'songs', 0, (select count(*) from users) union all select 'no users', 'users', (select count(*) from songs), 0""",
                                         "songs", "users"))
def q_reference_guard(spark, sf_dir):
    """A10: what the guard says of the scanned reference data, and of either side empty."""
    from lakekpi.sources.csv_scan import ReferenceDataMissing, guard_reference, read_songs, read_users

    root, rows = _landed_reference(spark, sf_dir), []
    songs, users = read_songs(spark, f"{root}/songs"), read_users(spark, f"{root}/users")
    for given, s, u in (("both", songs, users), ("no songs", songs.limit(0), users), ("no users", songs, users.limit(0))):
        try:
            guard_reference(s, u)
            verdict = "ok"
        except ReferenceDataMissing as exc:
            verdict = next(name for name in ("songs", "users") if f"data {name} " in str(exc))
        rows.append(s.agg(F.count(F.lit(1)).alias("n_songs")).crossJoin(F.broadcast(u.agg(F.count(F.lit(1)).alias("n_users")))).select(  # one row each
            F.lit(given).alias("given"), F.lit(verdict).alias("verdict"), "n_songs", "n_users"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register("partition_guards", _cur("""
select d.day, coalesce(c.n, 0) as n_rows, case when c.n is null then 'empty' else 'ok' end as verdict
from (select strftime(unnest(generate_series(timestamp '2024-01-10', timestamp '2024-02-05', interval 1 day)), '%Y-%m-%d') as day) d
left join (select strftime(event_date, '%Y-%m-%d') as day, count(*) as n from curated group by 1) c on c.day = d.day
union all select 'no table', 0, 'missing'"""))
def q_partition_guards(spark, sf_dir):
    """The guards of day reads: days with rows, days without, and a table that does not exist."""
    from lakekpi.sources.partitions import PartitionEmpty, PartitionMissing, read_days

    path = f"{scratch_path(spark, 'guards')}/silver"
    curated(spark, sf_dir).write.partitionBy("event_date").parquet(path)
    present = {r.day: r.n for r in spark.read.parquet(path).groupBy(F.col("event_date").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row a day
    rows = []
    for day in [r.day.isoformat() for r in spark.range(1).select(F.explode(A.date_spine("2024-01-10", "2024-02-05")).alias("day")).collect()]:
        try:
            read_days(spark, path, [day])
            rows.append((day, present[day], "ok"))
        except PartitionEmpty:
            rows.append((day, 0, "empty"))
    try:
        read_days(spark, path + "-none", ["2024-01-10"])
    except PartitionMissing:
        rows.append(("no table", 0, "missing"))
    return spark.createDataFrame(rows, "day string, n_rows long, verdict string")


@register("poison_files", _cur("""
select strftime(event_date, '%Y-%m-%d') as day, true as named from curated where day(event_date) % 6 = 1 group by event_date"""))
def q_poison_files(spark, sf_dir):
    """A Silver table with a damaged file in some days: the probe finds exactly these, and the guard names each."""
    root = scratch_path(spark, "poison")
    cur = curated(spark, sf_dir)
    cur.write.partitionBy("event_date").parquet(f"{root}/silver")
    bad = cur.where(F.dayofmonth("event_date") % 6 == 1).select("event_date").distinct()
    bad.select(F.lit("PAR1 cut short").alias("value"), "event_date").write.mode("append").option("lineSep", ".parquet\n").partitionBy(
        "event_date").text(f"{root}/silver")
    found = probe.probe_parquet(probe.list_files(spark, f"{root}/silver", "part-*"))
    try:
        probe.assert_readable(spark, f"{root}/silver", glob="part-*")
        named = ""
    except probe.PoisonPartition as exc:
        named = str(exc)
    return found.select(F.regexp_extract("path", "event_date=([^/]+)", 1).alias("day"), F.contains(F.lit(named), F.col("path")).alias("named"))


@register("unreadable_files", """
select concat('streams/landing_date=', substr(cast(ts as varchar), 1, 10)) as folder, false as valid, true as reason_given,
       count(*) as n from events where day(ts) % 3 = 2 group by 1""".replace("count(*) as n ", "cast(1 as bigint) as n "))
def q_unreadable_files(spark, sf_dir):
    """Landed files that are not UTF-8 text are invalid with the read error as reason."""
    root = f"{scratch_path(spark, 'unreadable')}/landing"
    rows = X.table(spark, sf_dir, "events").select(_day().alias("landing_date"), F.dayofmonth("ts").alias("d"), F.col("event_type").alias("value"))
    latin = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("E9"))).cast("string")
    (rows.withColumn("value", F.when(F.col("d") % 3 == 2, latin).otherwise(F.col("value"))).drop("d").repartition("landing_date")
     .write.partitionBy("landing_date").text(f"{root}/streams"))
    bad = B.unreadable_verdicts(probe.unreadable_text(probe.list_files(spark, root, "part-*")), root)
    folder = F.regexp_extract("source_key", "^(.*)/[^/]*$", 1)
    return bad.groupBy(folder.alias("folder"), "valid", F.startswith("error", F.lit(K.READ_FAILED_ERROR.split("{")[0])).alias("reason_given")).agg(
        F.count(F.lit(1)).alias("n"))


@register("rejected_inputs", """
select case when event_id % 5 = 1 then null else concat('streams/', cast(event_id as varchar), '.csv') end as source_key, false as valid,
       cast(event_id as varchar) as execution_id, 'Missing bucket or key' as error
from events where event_id % 5 in (1, 2)""")
def q_rejected_inputs(spark, sf_dir):
    """Run inputs without bucket or key are invalid without being read."""
    no = F.col("event_id") % 5
    key = F.when(no != 1, F.concat(F.lit("streams/"), F.col("event_id").cast("string"), F.lit(".csv")))
    inputs = X.table(spark, sf_dir, "events").select(F.when(no == 2, "").otherwise("bronze").alias("bucket"), key.alias("key"),
                                                     F.col("event_id").cast("string").alias("execution_id"))
    return B.rejected_inputs(inputs)


@register("encoded_keys", """
select concat('streams/landing_date=', day, '/batch ', cast(n as varchar), '+é%.csv') as object_key, day as landing_date, n
from (select substr(cast(ts as varchar), 1, 10) as day, count(*) as n from events group by 1) d where cast(substr(day, 9, 2) as int) % 4 <> 0""")
def q_encoded_keys(spark, sf_dir):
    """A1 + A2: keys as notifications encode them (blanks, plus signs, letters beyond ASCII), decoded, admitted, dated."""
    per_day = X.table(spark, sf_dir, "events").groupBy(_day().alias("day")).agg(F.count(F.lit(1)).alias("n"))
    prefix = F.when(F.substring("day", 9, 2).cast("int") % 4 == 0, "streams/manifests/landing_date=").otherwise(K.STREAM_PREFIX)
    plain = F.concat(prefix, F.col("day"), F.lit("/batch "), F.col("n").cast("string"), F.lit("+é%.csv"))
    keys = per_day.select(F.replace(F.url_encode(plain), F.lit("%2F"), F.lit("/")).alias("object_key"), "n")
    return A.with_dates(A.admit(A.decode_keys(keys))).select("object_key", "landing_date", "n")


# ---------------------------------------------------------------------------------------------------
# C12, D5, C16 / D7 / E6, B3
# ---------------------------------------------------------------------------------------------------

_LINEAGE_SQL = """'2024-02-01T00:00:00Z' as ingested_at, 'exec-7' as source_execution_id"""


@register("silver_lineage", O.with_ctes(f"""
select user_id, track_id, listen_time, genre, concat('streams/landing_date=', landing_date, '/batch.csv') as source_file, {_LINEAGE_SQL}
from (select distinct c.user_id, c.track_id, c.listen_time, c.genre, r.landing_date from curated c
      join stream_records r on try_cast(r.user_id as int) = c.user_id and r.track_id = c.track_id and r.listen_time = c.listen_time) x""",
                                        *_LANDED_CTES[:-2], "raw_ok", "curated", extra={**_LANDED, "raw_ok": """
select try_cast(user_id as int) as user_id, nullif(track_id, '') as track_id, listen_time from stream_records"""}))
def q_silver_lineage(spark, sf_dir):
    """Each Silver row's file, ingest time and run."""
    from lakekpi.operators import curate as C

    r = X.stream_records(spark, sf_dir).select(F.expr("try_cast(user_id as int)").alias("user_id"), F.expr("nullif(track_id, '')").alias("track_id"),
                                               "listen_time", F.col("source_key").alias("source_file"))
    cur = C.curate(r, X.songs(spark, sf_dir), X.users(spark, sf_dir), scope=["source_file"], lineage=True,
                   ingested_at="2024-02-01T00:00:00Z", execution_id="exec-7")
    return cur.select("user_id", "track_id", "listen_time", "genre", "source_file", "ingested_at", "source_execution_id")


@register("gold_lineage", _cur(f"select *, {_LINEAGE_SQL} from ({O.GENRE_KPIS_SQL}) k"))
def q_gold_lineage(spark, sf_dir):
    """Gold rows with their run's lineage, as the Gold job writes them."""
    from lakekpi.plans.gold import read_gold, run_gold
    from lakekpi.plans.silver import run_silver

    root = scratch_path(spark, "gold-lineage")
    s = run_silver(spark, X.raw(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir), f"{root}/silver", run_key="k")
    run_gold(spark, f"{root}/silver", f"{root}/gold", s.days, ingested_at="2024-02-01T00:00:00Z", execution_id="exec-7")
    return read_gold(spark, f"{root}/gold", "genre_kpis_daily").select(*KPI_COLUMNS, "ingested_at", "source_execution_id")


@register("job_metrics", O.with_ctes(f"""
, k as ({O.GENRE_KPIS_SQL}), t as ({O.TOP_SONGS_SQL.format(n=3)}), g as ({O.TOP_GENRES_SQL.format(n=5)}),
m as (select (select count(*) from k) as nk, (select count(*) from t) as nt, (select count(*) from g) as ng, (select min(date) from k) as d)
select metric_name, cast(value as double) as value, job, run_date from m, lateral (values
  ('GenreKpisRows', nk, 'gold_etl', d), ('TopSongsRows', nt, 'gold_etl', d), ('TopGenresRows', ng, 'gold_etl', d),
  ('GenreKpisLoaded', nk, 'ddb_etl', d), ('TopSongsLoaded', nt, 'ddb_etl', d), ('TopGenresLoaded', ng, 'ddb_etl', d),
  ('GenreKpisLoaded', nk, 'ddb_etl', null), ('TopSongsLoaded', nt, 'ddb_etl', null), ('TopGenresLoaded', ng, 'ddb_etl', null)) v(metric_name, value, job, run_date)""",
                                     "raw", "songs", "users", "curated", extra=_CUR_CTE).replace("\n\n, k as", ",\nk as", 1))
def q_job_metrics(spark, sf_dir):
    """D7 + E6: the metrics that the Gold and load jobs put out: rows written, rows loaded, with and without the run's day."""
    from lakekpi.plans.gold import run_gold
    from lakekpi.plans.load import run_load
    from lakekpi.plans.silver import run_silver

    root = scratch_path(spark, "job-metrics")
    s = run_silver(spark, X.raw(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir), f"{root}/silver", run_key="k")
    g = run_gold(spark, f"{root}/silver", f"{root}/gold", s.days)
    m = g.metrics.unionByName(run_load(spark, f"{root}/gold", f"{root}/serving", s.days).metrics)
    return m.select("metric_name", "value", F.col("dimensions")["Job"].alias("job"), F.col("dimensions")["RunDate"].alias("run_date"))


@register("landed_verdicts", O.with_ctes("""
select landing_date, record_count, error_count, valid, n_files from (
select f.landing_date, v.record_count, v.error_count, v.valid, case when cast(substr(f.landing_date, 9, 2) as int) % 6 = 2 then 2 else 1 end as n_files
from verdict v join files f on f.source_key = v.source_key union all select '2024-01-01', 0, 1, false, 1) x""",
                                         "stream_records", "stream_headers", "records", "errors", "verdict", "files")
          .replace("else 1 end as n_files", "else 1 end::bigint as n_files").replace("false, 1)", "false, 1::bigint)"))
def q_landed_verdicts(spark, sf_dir):
    """B1-B4 over landed files, read by header name in byte ranges: a verdict per file, the empty one included."""
    from lakekpi.sources.csv_scan import read_batches
    from lakekpi.sources.listing import empty_objects

    root = scratch_path(spark, "landed-verdicts")
    _land(spark, sf_dir, root)
    empty = [r.object_key for r in A.admit(empty_objects(spark, root)).select("object_key").collect()]  # readers take names
    files, records = read_batches(spark, root, empty_keys=empty)
    v = B.validate(_kept(files), _kept(records))
    return v.groupBy("landing_date", "record_count", "error_count", "valid").agg(F.count(F.lit(1)).alias("n_files"))
