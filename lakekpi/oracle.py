"""DuckDB SQL for every registered query: an independent statement of each result over the driver tables.

The fixture CTEs restate ``sources.fixtures`` in SQL; each query's SQL restates the operator.  Column names
and types match the Spark output (row numbers cast to INTEGER, counts to BIGINT).
"""

from __future__ import annotations

PARSE = "try_strptime(listen_time, '%Y-%m-%d %H:%M:%S')"

FIXTURES = {
    "raw": """
select case when event_id % 101 = 0 then null else cast(case when event_id % 97 = 0 then user_id + 1000000000 else user_id end as int) end as user_id,
       case when event_id % 103 = 0 then null
            when event_id % 37 = 0 then 'T_MISSING'
            else concat('T', cast((event_id * 7) % 200 as varchar)) end as track_id,
       case when event_id % 107 = 0 then null
            when event_id % 109 = 0 then 'not-a-date'
            else substr(cast(ts as varchar), 1, 19) end as listen_time
from (select * from events union all select * from events where event_id % 50 = 0) e""",
    "songs": """
select concat('T', cast(p_partkey as varchar)) as track_id, p_brand as artists,
       concat(p_brand, ' album') as album_name, p_name as track_name,
       cast(p_size as bigint) * 6000 + (p_partkey % 7) * 137 as duration_ms,
       concat('  ', p_type, ' ') as track_genre
from part""",
    "users": """
select cast(c_custkey as int) as user_id, n_name as user_country
from customer join nation on c_nationkey = n_nationkey""",
    "star": """
select cast(o_custkey as int) as user_id, concat('T', cast(l_partkey as varchar)) as track_id,
       substr(cast(o_orderdate as varchar), 1, 19) as listen_time
from lineitem join orders on l_orderkey = o_orderkey""",
    "listing": """
select case when day_no % 7 = 0 then concat('streams/manifests/landing_date=', d, '/batch.csv.json')
            when day_no % 7 = 1 then concat('streams/landing_date=', d, '/batch.csv.tmp')
            when day_no % 7 = 2 then concat('reference/songs/', d, '.csv')
            else concat('streams/landing_date=', d, '/batch.csv') end as object_key,
       concat('h', cast(day_no % 20 as varchar)) as etag,
       first_ts as event_time, n_records
from (select substr(cast(ts as varchar), 1, 10) as d,
             cast(substr(cast(ts as varchar), 9, 2) as int) as day_no,
             min(ts) as first_ts, count(*) as n_records
      from events group by 1, 2) x""",
    "metric_samples": """
select ts, event_type as metric_name, value, user_id from events""",
}


def curated_sql(raw: str = "raw", songs: str = "songs") -> str:
    return f"""
select t.user_id, t.track_id, track_name, artists, album_name, lower(trim(track_genre)) as genre,
       listen_time, listen_ts, cast(listen_ts as date) as event_date, duration_ms,
       duration_ms / cast(1000 as double) as listen_seconds, user_country
from (select *, {PARSE} as listen_ts
      from (select distinct user_id, track_id, listen_time from {raw}
            where user_id is not null and track_id is not null and listen_time is not null) c) t
join {songs} on t.track_id = {songs}.track_id
left join users on t.user_id = users.user_id
where listen_ts is not null"""


GENRE_KPIS_SQL = """
select genre, listen_count, unique_listeners, total_listen_seconds, avg_listen_seconds_per_user,
       strftime(event_date, '%Y-%m-%d') as date
from (select genre, event_date, count(*) as listen_count, count(distinct user_id) as unique_listeners,
             sum(duration_ms) / cast(1000 as double) as total_listen_seconds,
             sum(duration_ms) / cast(1000 as double) / count(duration_ms) as avg_listen_seconds_per_user
      from curated group by genre, event_date) g"""

TOP_SONGS_SQL = """
select genre, track_id, track_name, play_count, rank, date, concat_ws('#', genre, date) as genre_date
from (select genre, track_id, track_name, play_count, strftime(event_date, '%Y-%m-%d') as date,
             cast(row_number() over (partition by genre, event_date
                                     order by play_count desc, track_id asc nulls first) as integer) as rank
      from (select genre, event_date, track_id, track_name, count(*) as play_count
            from curated group by genre, event_date, track_id, track_name) a) r
where rank <= {n}"""

TOP_GENRES_SQL = """
select genre, listen_count, rank, date
from (select genre, listen_count, strftime(event_date, '%Y-%m-%d') as date,
             cast(row_number() over (partition by event_date
                                     order by listen_count desc, genre asc nulls first) as integer) as rank
      from (select event_date, genre, count(*) as listen_count from curated group by event_date, genre) a) r
where rank <= {n}"""


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it uses (in dependency order)."""
    defs = {**FIXTURES, **(extra or {})}
    parts = [f"{n} as ({defs[n]})" for n in names]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body

FIXTURES["stream_records"] = """
select concat('streams/landing_date=', d, '/batch.csv') as source_key, d as landing_date, event_id, copy_no,
       case when day_no % 4 <> 0 and event_id % 101 = 0 then null
            when day_no % 4 <> 0 and event_id % 113 = 0 then '  '
            else cast(case when event_id % 97 = 0 then user_id + 1000000000 else user_id end as varchar) end as user_id,
       case when day_no % 4 <> 0 and event_id % 103 = 0 then '' when event_id % 37 = 0 then 'T_MISSING'
            else concat('T', cast((event_id * 7) % 200 as varchar)) end as track_id,
       case when day_no % 7 = 3 and day_no % 5 <> 0 then null
            when day_no % 4 <> 0 and event_id % 107 = 0 then ' ' || chr(9)
            when event_id % 109 = 0 then 'not-a-date'
            else substr(cast(ts as varchar), 1, 19) end as listen_time
from (select *, substr(cast(ts as varchar), 1, 10) as d, cast(substr(cast(ts as varchar), 9, 2) as int) as day_no
      from (select *, 0 as copy_no from events union all select *, 1 as copy_no from events where event_id % 50 = 0) u) e"""

FIXTURES["stream_headers"] = """
select concat('streams/landing_date=', d, '/batch.csv') as source_key, d as landing_date,
       case when day_no % 5 = 0 then ['user_id', 'track_id', 'listen_time', 'device']
            when day_no % 7 = 3 then ['user_id', 'track_id']
            else ['user_id', 'track_id', 'listen_time'] end as fields
from (select distinct substr(cast(ts as varchar), 1, 10) as d, cast(substr(cast(ts as varchar), 9, 2) as int) as day_no
      from events) x"""

FIXTURES["records"] = """
select *, cast(row_number() over (partition by source_key order by event_id, copy_no) + 1 as integer) as row_no
from stream_records"""

BLANK = "({c} is null or regexp_replace({c}, '^\\s+|\\s+$', '', 'g') = '')"

FIXTURES["errors"] = " union all ".join(
    f"""select source_key, row_no, {i} as field_idx, '{f}' as field,
              concat('Row ', cast(row_no as varchar), ': missing required field ''{f}''') as error
       from records where {BLANK.format(c=f)}"""
    for i, f in enumerate(["user_id", "track_id", "listen_time"])
)

FIXTURES["verdict"] = """
select h.source_key, coalesce(r.n, 0) as record_count,
       case when coalesce(r.n, 0) = 0 then 1 else coalesce(e.n, 0) end as error_count,
       (case when coalesce(r.n, 0) = 0 then 1 else coalesce(e.n, 0) end) = 0 as valid
from stream_headers h
left join (select source_key, count(*) as n from records group by 1) r on r.source_key = h.source_key
left join (select source_key, count(*) as n from errors group by 1) e on e.source_key = h.source_key"""

FIXTURES["files"] = """
select source_key, landing_date, fields, 'bronze' as bucket, concat('exec-', landing_date) as execution_id,
       concat(landing_date, 'T06:00:00Z') as event_time
from stream_headers"""

VALIDATION_CTES = ("stream_records", "stream_headers", "records", "errors", "verdict", "files")
