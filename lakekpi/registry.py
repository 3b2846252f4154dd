"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator, plus its DuckDB oracle."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi import oracle as O
from lakekpi import schemas as S
from lakekpi.operators import admission as A
from lakekpi.operators import aggregate as D
from lakekpi.operators import curate as C
from lakekpi.operators import gates as G
from lakekpi.operators import metrics as H
from lakekpi.operators import numbering as NUM
from lakekpi.operators import prepare as P
from lakekpi.operators import serve as E
from lakekpi.operators import validate as B
from lakekpi.plans import backfill as J
from lakekpi.plans import views as V
from lakekpi.session import configure, scratch_path, size_shuffles
from lakekpi.sources import fixtures as X
from lakekpi.sources.probe import list_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------------------------------


def curated(spark, sf_dir) -> DataFrame:
    return C.curate(X.raw(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir))


def star(spark, sf_dir) -> DataFrame:
    """The large batch, with shuffles of as many partitions as its tables' bytes call for."""
    files = [list_files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("lineitem", "orders")]
    n_bytes = files[0].unionByName(files[1]).agg(F.sum("length")).first()[0] or 0
    size_shuffles(spark, 4 * n_bytes)  # the joined rows are shuffled at about that size in all, in partitions of 32 MB at most
    return X.star(spark, sf_dir)


def curated_star(spark, sf_dir) -> DataFrame:
    return C.curate(star(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir))


_CUR = ("raw", "songs", "users")
_CUR_CTE = {"curated": O.curated_sql()}
_STAR_CTE = {"curated": O.curated_sql("star")}


def _cur(body: str) -> str:
    return O.with_ctes(body, *_CUR, "curated", extra=_CUR_CTE)


# ---------------------------------------------------------------------------------------------------
# C: curate
# ---------------------------------------------------------------------------------------------------


@register("clean_streams", O.with_ctes(
    f"""select user_id, track_id, listen_time, {O.PARSE} as listen_ts
        from (select distinct user_id, track_id, listen_time from raw
              where user_id is not null and track_id is not null and listen_time is not null) c
        where {O.PARSE} is not null""", "raw"))
def q_clean_streams(spark, sf_dir):
    """C1-C4 on the raw batch."""
    return C.clean_streams(X.raw(spark, sf_dir))


@register("drop_missing", O.with_ctes(
    "select * from raw where user_id is not null and track_id is not null and listen_time is not null", "raw"))
def q_drop_missing(spark, sf_dir):
    """C1."""
    return C.drop_missing(X.raw(spark, sf_dir))


@register("dedup_streams", O.with_ctes(
    """select distinct user_id, track_id, listen_time from raw
       where user_id is not null and track_id is not null and listen_time is not null""", "raw"))
def q_dedup_streams(spark, sf_dir):
    """C1 + C2."""
    return C.dedup_triplet(C.drop_missing(X.raw(spark, sf_dir)))


@register("parse_listen_ts", O.with_ctes(
    f"select user_id, track_id, listen_time, {O.PARSE} as listen_ts from raw where {O.PARSE} is not null", "raw"))
def q_parse_listen_ts(spark, sf_dir):
    """C3 alone (rows with unparseable or missing times dropped)."""
    return C.parse_times(X.raw(spark, sf_dir))


@register("curated_streams", _cur("select * from curated"))
def q_curated(spark, sf_dir):
    """The Silver rows."""
    return curated(spark, sf_dir)


# ---------------------------------------------------------------------------------------------------
# D: aggregate, F: views
# ---------------------------------------------------------------------------------------------------


@register("genre_kpis_daily", _cur(O.GENRE_KPIS_SQL))
def q_genre_kpis(spark, sf_dir):
    """Listens, unique listeners and listening time per genre per day."""
    return D.genre_kpis(curated(spark, sf_dir))


@register("top_songs_by_genre_daily", _cur(O.TOP_SONGS_SQL.format(n=3)))
def q_top_songs(spark, sf_dir):
    """D2 + D4."""
    return D.top_songs(curated(spark, sf_dir))


@register("top_genres_daily", _cur(O.TOP_GENRES_SQL.format(n=5)))
def q_top_genres(spark, sf_dir):
    """D3."""
    return D.top_genres(curated(spark, sf_dir))


@register("top_genres_from_kpis", _cur(O.TOP_GENRES_SQL.format(n=5)))
def q_top_genres_from_kpis(spark, sf_dir):
    """D3 derived from the D1 output (the Gold job's single-scan plan)."""
    return D.top_genres_from_counts(D.genre_kpis(curated(spark, sf_dir))).select("genre", "listen_count", "rank", "date")


@register("v_genre_kpis", _cur(
    f"""select genre, date, listen_count, unique_listeners,
               round(total_listen_seconds / 3600.0, 2) as total_listen_hours,
               round(avg_listen_seconds_per_user, 1) as avg_listen_secs_per_user
        from ({O.GENRE_KPIS_SQL}) k"""))
def q_v_genre_kpis(spark, sf_dir):
    """F1."""
    return V.view("v_genre_kpis", D.genre_kpis(curated(spark, sf_dir)))


@register("v_top_songs", _cur(
    f"select genre, date, rank, track_id, track_name, play_count from ({O.TOP_SONGS_SQL.format(n=3)}) s"))
def q_v_top_songs(spark, sf_dir):
    """F2."""
    return V.view("v_top_songs", D.top_songs(curated(spark, sf_dir)))


@register("v_top_genres", _cur(f"select date, rank, genre, listen_count from ({O.TOP_GENRES_SQL.format(n=5)}) s"))
def q_v_top_genres(spark, sf_dir):
    """F3."""
    return V.view("v_top_genres", D.top_genres(curated(spark, sf_dir)))


@register("star_genre_kpis_daily", O.with_ctes(O.GENRE_KPIS_SQL, "star", "songs", "users", "curated", extra=_STAR_CTE))
def q_star_genre_kpis(spark, sf_dir):
    """D1 over the large batch (one listen per line item)."""
    return D.genre_kpis(curated_star(spark, sf_dir))


@register("star_top_songs_by_genre_daily", O.with_ctes(
    O.TOP_SONGS_SQL.format(n=3), "star", "songs", "users", "curated", extra=_STAR_CTE))
def q_star_top_songs(spark, sf_dir):
    """D2 over the large batch."""
    return D.top_songs(curated_star(spark, sf_dir))


# ---------------------------------------------------------------------------------------------------
# B: validate
# ---------------------------------------------------------------------------------------------------


PROCESSED_AT = "2024-02-01 00:00:00"


def batch_files(spark, sf_dir) -> DataFrame:
    h = X.stream_headers(spark, sf_dir)
    return h.select(
        "source_key",
        "landing_date",
        "fields",
        F.lit("bronze").alias("bucket"),
        F.concat(F.lit("exec-"), F.col("landing_date")).alias("execution_id"),
        F.concat(F.col("landing_date"), F.lit("T06:00:00Z")).alias("event_time"),
    )


def batch_records(spark, sf_dir) -> DataFrame:
    r = X.stream_records(spark, sf_dir)
    return NUM.number_within(r, ["source_key"], ["event_id", "copy_no"], out="row_no", start=K.FIRST_DATA_ROW)


def _val(body: str) -> str:
    return O.with_ctes(body, *O.VALIDATION_CTES)


@register("record_numbers", _val("select source_key, event_id, copy_no, row_no from records"))
def q_record_numbers(spark, sf_dir):
    """File line numbers of the records (skew-safe numbering)."""
    return batch_records(spark, sf_dir).select("source_key", "event_id", "copy_no", "row_no")


@register("validation_errors", _val("select source_key, row_no, field, error from errors"))
def q_validation_errors(spark, sf_dir):
    """B2: one error per (record, missing or blank required field)."""
    return B.record_errors(batch_records(spark, sf_dir)).select("source_key", "row_no", "field", "error")


@register("file_verdict", _val("select * from verdict"))
def q_file_verdict(spark, sf_dir):
    """B3/B4."""
    rec = batch_records(spark, sf_dir)
    return B.file_counts(batch_files(spark, sf_dir), rec, B.record_errors(rec))


_DRIFT_SQL = """
select source_key,
       nullif(array_to_string(list_sort(list_filter(fields, lambda x: x not in ('user_id', 'track_id', 'listen_time'))), ','), '') as unknown_fields,
       nullif(array_to_string(list_sort(list_filter(['user_id', 'track_id', 'listen_time'], lambda x: not list_contains(fields, x))), ','), '') as missing_required_fields,
       cast(null as varchar) as missing_optional_fields
from stream_headers"""


def _flat_drift(df: DataFrame) -> DataFrame:
    m = F.col("schema_drift")
    return df.select(
        "source_key",
        *[F.array_join(m[k], ",").alias(k) for k in ("unknown_fields", "missing_required_fields", "missing_optional_fields")],
    )


@register("schema_drift", _val(_DRIFT_SQL))
def q_schema_drift(spark, sf_dir):
    """B6 (map flattened to one text column per entry)."""
    rec = batch_records(spark, sf_dir)
    files = batch_files(spark, sf_dir)
    return _flat_drift(B.schema_drift(files, B.file_counts(files, rec, B.record_errors(rec))))


@register("derive_run_date", _val(f"""
select h.source_key, coalesce(strftime(min(cast({O.PARSE} as date)), '%Y-%m-%d'), h.landing_date) as run_date
from stream_headers h left join stream_records r on r.source_key = h.source_key
group by h.source_key, h.landing_date"""))
def q_derive_run_date(spark, sf_dir):
    """B7."""
    return B.derive_run_date(batch_files(spark, sf_dir), X.stream_records(spark, sf_dir))


@register("manifest", _val("""
select v.source_key, concat('streams/manifests/', substr(v.source_key, 9), '.json') as manifest_key,
       v.record_count, v.error_count, v.valid, fe.first_errors
from verdict v left join (
    select source_key, string_agg(error, '|' order by row_no, field_idx) as first_errors
    from (select *, row_number() over (partition by source_key order by row_no, field_idx) as k from errors) t
    where k <= 20 group by source_key) fe on fe.source_key = v.source_key"""))
def q_manifest(spark, sf_dir):
    """Manifest key, counts, verdict and the first 20 errors of each file."""
    v = B.validate(batch_files(spark, sf_dir), batch_records(spark, sf_dir))
    return v.select(
        "source_key", "manifest_key", "record_count", "error_count", "valid",
        F.array_join("errors", "|").alias("first_errors"),
    )


@register("status_tags", _val("""
select source_key, case when valid then 'true' else 'false' end as validated,
       substr(concat('exec-', substr(source_key, 22, 10)), 1, 256) as pipeline_run_id,
       substr(substr(source_key, 22, 10), 1, 256) as landing_date
from verdict"""))
def q_status_tags(spark, sf_dir):
    """B9."""
    return B.status_tags(B.validate(batch_files(spark, sf_dir), batch_records(spark, sf_dir)))


@register("dq_report", _val(f"""
select f.execution_id as batch_id, substr(f.event_time, 1, 10) as event_date, f.bucket, f.source_key as key,
       v.record_count, v.error_count, timestamp '{PROCESSED_AT}' as processed_at,
       cast(epoch(timestamp '{PROCESSED_AT}') as bigint) + 2592000 as expires_at
from files f join verdict v on v.source_key = f.source_key"""))
def q_dq_report(spark, sf_dir):
    """B10 (errors and drift columns omitted from the compared projection)."""
    v = B.validate(batch_files(spark, sf_dir), batch_records(spark, sf_dir))
    r = B.dq_report(v, F.lit(PROCESSED_AT).cast("timestamp"))
    return r.select("batch_id", "event_date", "bucket", "key", "record_count", "error_count", "processed_at", "expires_at")


@register("quarantine_ledger", _val("""
select f.execution_id, f.source_key as key, true as quarantined, concat('bronze/', f.source_key) as quarantine_key,
       cast(null as varchar) as error
from files f join verdict v on v.source_key = f.source_key where not v.valid"""))
def q_quarantine_ledger(spark, sf_dir):
    """B11 + B12: invalid files and their quarantine keys."""
    v = B.validate(batch_files(spark, sf_dir), batch_records(spark, sf_dir))
    return B.quarantine_ledger(v)


@register("valid_records", _val("""
select r.source_key, r.row_no, r.user_id, r.track_id, r.listen_time
from records r join verdict v on v.source_key = r.source_key where v.valid"""))
def q_valid_records(spark, sf_dir):
    """Records of valid files only (semi-join on the verdict set)."""
    rec = batch_records(spark, sf_dir)
    v = B.validate(batch_files(spark, sf_dir), rec)
    good, _ = B.route(v, rec)
    return good.select("source_key", "row_no", "user_id", "track_id", "listen_time")


@register("dq_lookup", _val(f"""
select f.execution_id as batch_id, substr(f.event_time, 1, 10) as event_date, v.record_count, v.error_count,
       v.error_count / v.record_count as rejection_rate
from files f join verdict v on v.source_key = f.source_key
where f.execution_id = 'exec-2024-01-07' and substr(f.event_time, 1, 10) = '2024-01-07'"""))
def q_dq_lookup(spark, sf_dir):
    """One batch's report and rejection rate."""
    v = B.validate(batch_files(spark, sf_dir), batch_records(spark, sf_dir))
    r = B.dq_lookup(B.dq_report(v, F.lit(PROCESSED_AT).cast("timestamp")), "exec-2024-01-07", "2024-01-07")
    return r.select("batch_id", "event_date", "record_count", "error_count", "rejection_rate")


# ---------------------------------------------------------------------------------------------------
# C14-C16 gates, H metrics and alarms
# ---------------------------------------------------------------------------------------------------


_GATES_SQL = f"""
select count(*) as "RawCount",
       count(*) filter (where user_id is not null and track_id is not null and listen_time is not null) as "AfterDropNaCount",
       (select count(*) from (select distinct user_id, track_id, listen_time from raw
         where user_id is not null and track_id is not null and listen_time is not null) d) as "AfterDedupCount",
       (select count(*) from (select distinct user_id, track_id, listen_time from raw
         where user_id is not null and track_id is not null and listen_time is not null) d
         where {O.PARSE} is not null) as "AfterTimestampParseCount",
       (select count(*) from (select distinct user_id, track_id, listen_time from raw
         where user_id is not null and track_id is not null and listen_time is not null) d
         join songs s on s.track_id = d.track_id where {O.PARSE} is not null) as "AfterSongsJoinCount",
       (select count(*) from (select track_id from songs group by track_id having count(*) > 1) x) as "DuplicateSongKeys"
from raw"""

_GATES_FULL = f"""select *, "AfterTimestampParseCount" - "AfterSongsJoinCount" as "UnmatchedSongsCount",
       case when "RawCount" > 0 then ("RawCount" - "AfterSongsJoinCount") / cast("RawCount" as double) else 0.0 end
       as drop_rate
from ({_GATES_SQL}) g"""


@register("dq_gates", O.with_ctes(_GATES_FULL, "raw", "songs"))
def q_dq_gates(spark, sf_dir):
    """C14 + C15: gate counts and drop rate in one row."""
    return G.with_drop_rate(G.gate_counts(X.raw(spark, sf_dir), X.songs(spark, sf_dir)))


@register("star_dq_gates", O.with_ctes(
    _GATES_FULL.replace("from raw", "from star"),
    "star", "songs"))
def q_star_dq_gates(spark, sf_dir):
    """C14 + C15 over the large batch."""
    return G.with_drop_rate(G.gate_counts(star(spark, sf_dir), X.songs(spark, sf_dir)))


RUN_KEY = "streams/landing_date=2024-01-05/batch.csv"
_GATE_NAMES = ["RawCount", "AfterDropNaCount", "AfterDedupCount", "AfterTimestampParseCount",
               "AfterSongsJoinCount", "UnmatchedSongsCount"]


@register("dq_metrics_long")
def q_dq_metrics_long(spark, sf_dir):
    """Gate counts as long-form metric rows (dimension map flattened to job / run_date)."""
    from lakekpi.functions.text import extract_run_date

    g = G.gate_counts(X.raw(spark, sf_dir), X.songs(spark, sf_dir))
    m = H.gates_to_metrics(g, extract_run_date(F.lit(RUN_KEY)))
    return m.select(
        "namespace", "metric_name", "value", "unit",
        F.col("dimensions")["Job"].alias("job"), F.col("dimensions")["RunDate"].alias("run_date"),
    )


ORACLES["dq_metrics_long"] = O.with_ctes(
    " union all ".join(
        f"""select 'lakekpi/DQ' as namespace, '{m}' as metric_name, cast("{m}" as double) as value,
                   'Count' as unit, 'silver_etl' as job, '2024-01-05' as run_date from g"""
        for m in _GATE_NAMES
    )
    + """ union all select 'lakekpi/DQ', 'DropRatePct', drop_rate * 100.0, 'Percent', 'silver_etl',
                           cast(null as varchar) from g""",
    "raw", "songs", "g", extra={"g": _GATES_FULL},
)

ROLLUP_PERIOD = 300


@register("metric_rollup", O.with_ctes(f"""
select time_bucket(interval {ROLLUP_PERIOD} second, ts) as period_start, metric_name,
       cast(sum(cast(value as decimal(18,6))) as double) as sum,
       cast(sum(cast(value as decimal(18,6))) as double) / count(value) as average,
       max(value) as maximum, count(value) as sample_count
from metric_samples group by 1, 2""", "metric_samples"))
def q_metric_rollup(spark, sf_dir):
    """H1: 5-minute Sum / Average / Maximum / SampleCount per metric."""
    return H.rollup(X.metric_samples(spark, sf_dir), ROLLUP_PERIOD, exact_scale=6)


# Alarm rules over the sample metrics: threshold, freshness (H3) and zero-load (H4) shapes.
SAMPLE_RULES = [
    ("error-value-high", "error", "Sum", 3600, ">", 60.0, "notBreaching"),
    ("signup-freshness", "signup", "SampleCount", 90000, "<", 1.0, "breaching"),
    ("purchase-zero-load", "purchase", "SampleCount", 86400, "<", 1.0, "missing"),
    ("click-max-high", "click", "Maximum", 300, ">", 40.0, "notBreaching"),
    ("view-avg-low", "view", "Average", 21600, "<", 20.0, "missing"),
]
ALARM_START, ALARM_END = "2024-01-01 00:00:00", "2024-02-02 00:00:00"


def _rules_sql() -> str:
    vals = ", ".join(f"('{a}', '{b}', '{c}', {d}, '{e}', {f}, '{g}')" for a, b, c, d, e, f, g in SAMPLE_RULES)
    return f"select * from (values {vals}) r(rule_name, metric_name, statistic, period_seconds, comparator, threshold, missing)"


def _ps(expr: str, p: str) -> str:
    return f"make_timestamp(cast(floor(epoch({expr}) / {p}) * {p} as bigint) * 1000000)"


ORACLES_ALARMS = O.with_ctes(f"""
, agg as (
  select rule_name, {_ps('s.ts', 'r.period_seconds')} as period_start,
         cast(sum(cast(value as decimal(18,6))) as double) as _sum, max(value) as _max, count(value) as _cnt
  from metric_samples s join rules r on r.metric_name = s.metric_name group by 1, 2),
spine as (
  select r.*, unnest(generate_series({_ps(f"timestamp '{ALARM_START}'", 'r.period_seconds')},
                                     timestamp '{ALARM_END}' - interval 1 second,
                                     to_seconds(r.period_seconds))) as period_start
  from rules r),
j as (
  select s.rule_name, s.period_start, s.comparator, s.threshold, s.missing,
         case when a._cnt > 0 then case s.statistic when 'Sum' then a._sum when 'Average' then a._sum / a._cnt
              when 'Maximum' then a._max when 'SampleCount' then cast(a._cnt as double) end end as value
  from spine s left join agg a on a.rule_name = s.rule_name and a.period_start = s.period_start)
select rule_name, period_start, value,
       case when value is null and missing = 'breaching' then 'ALARM'
            when value is null and missing = 'notBreaching' then 'OK'
            when value is null then 'INSUFFICIENT_DATA'
            when (comparator = '>' and value > threshold) or (comparator <> '>' and value < threshold) then 'ALARM'
            else 'OK' end as state
from j""", "metric_samples", extra={}).replace("\n, agg as", f",\nrules as ({_rules_sql()}),\nagg as", 1)


@register("alarm_states", ORACLES_ALARMS)
def q_alarm_states(spark, sf_dir):
    """H2-H4: alarm state per rule and period over the full period spine."""
    rules = H.rules_frame(spark, SAMPLE_RULES)
    return H.evaluate_alarms(X.metric_samples(spark, sf_dir), rules, ALARM_START, ALARM_END, exact_scale=6)


# Samples of the pipeline's own metrics, spread over its rules: an event's number says which metric it is a sample of.
_OWN = [("ExecutionsFailed", "StateMachineArn", "{pipeline}"), ("ExecutionsSucceeded", "StateMachineArn", "{pipeline}"),
        ("FailedRuns", "JobName", K.GOLD_JOB), ("Errors", "FunctionName", "event_router"), ("Invocations", "RuleName", "{trigger}"),
        ("ApproximateNumberOfMessagesVisible", "QueueName", "{dead-letters}"), ("DropRatePct", "Job", K.SILVER_JOB),
        ("GenreKpisLoaded", "Job", K.LOAD_JOB), ("TopSongsLoaded", "Job", "another_job"), ("Unwatched", "Job", K.LOAD_JOB)]


def pipeline_metrics(spark, sf_dir) -> DataFrame:
    """Metric samples (ts, metric_name, value, dimensions) from events: values 0 and up, silent days for some metrics."""
    ev = X.table(spark, sf_dir, "events")
    no = (F.col("event_id") % 10).cast("int")
    own = F.array(*[F.struct(F.lit(m).alias("m"), F.create_map(F.lit(d), F.lit(v)).alias("d")) for m, d, v in _OWN])
    rows = ev.withColumn("own", own[no]).where((no != 1) | (F.dayofmonth("ts") % 9 < 7)).where((no != 4) | (F.dayofmonth("ts") % 5 != 2))
    value = F.when(F.col("value") < 20, 0.0).otherwise(F.col("value"))
    return rows.select(F.col("ts").cast("timestamp").alias("ts"), F.col("own.m").alias("metric_name"), value.alias("value"), F.col("own.d").alias("dimensions"))


_OWN_SQL = "select ts, event_id % 10 as no, case when value < 20 then 0.0 else value end as value from events " \
    "where (event_id % 10 <> 1 or day(ts) % 9 < 7) and (event_id % 10 <> 4 or day(ts) % 5 <> 2)"


def _pipeline_rules_sql() -> str:
    """Each rule with the number of the metric it watches (null if none is sampled)."""
    watch = {(m, d, v): i for i, (m, d, v) in enumerate(_OWN)}
    rows = []
    for name, metric, stat, period, op, limit, missing, dims in H.PIPELINE_RULES:
        (d, v), = dims.items()
        no = watch.get((metric, d, v))
        rows.append(f"('{name}', {'null' if no is None else no}, '{stat}', {period}, '{op}', {limit}, '{missing}')")
    return ("select * from (values " + ", ".join(rows) +
            ") r(rule_name, no, statistic, period_seconds, comparator, threshold, missing)")


# periods closed by the stream are those that end before the last complete minute
_CLOSED_SQL = "(select epoch_us(date_trunc('minute', max(ts))) from events)"
_PIPELINE_STATES_SQL = f"""
with own as ({_OWN_SQL}), rules as ({_pipeline_rules_sql()}),
agg as (select rule_name, {_ps('s.ts', 'r.period_seconds')} as period_start, cast(sum(cast(value as decimal(18,6))) as double) as _sum,
               max(value) as _max, count(value) as _cnt from own s join rules r on r.no = s.no group by 1, 2),
spine as (select r.*, unnest(generate_series({_ps(f"timestamp '{ALARM_START}'", 'r.period_seconds')}, timestamp '{ALARM_END}' - interval 1 second,
                                             to_seconds(r.period_seconds))) as period_start from rules r),
j as (select s.*, case when a._cnt > 0 then case s.statistic when 'Sum' then a._sum when 'Maximum' then a._max end end as value
      from spine s left join agg a on a.rule_name = s.rule_name and a.period_start = s.period_start),
st as (select rule_name, period_start, period_seconds, value,
              case when value is null and missing = 'breaching' then 'ALARM' when value is null and missing = 'notBreaching' then 'OK'
                   when value is null then 'INSUFFICIENT_DATA'
                   when (comparator = '>' and value > threshold) or (comparator <> '>' and value < threshold) then 'ALARM' else 'OK' end as state
       from j),
ch as (select *, lag(state) over (partition by rule_name order by period_start) as before from st)
select rule_name, period_start, value, state from ch where (before is null or before <> state)"""


@register("pipeline_alarm_changes", _PIPELINE_STATES_SQL)
def q_pipeline_alarm_changes(spark, sf_dir):
    """H2-H4 with the pipeline's own rules (freshness and zero-load among them): state changes over the full period spine."""
    from lakekpi.streaming import alarms as ALM

    states = H.evaluate_alarms(pipeline_metrics(spark, sf_dir), H.rules_frame(spark), ALARM_START, ALARM_END, exact_scale=6)
    return ALM.state_changes(states)


def _stream_of(df: DataFrame, path: str) -> DataFrame:
    """``df`` written under ``path``, as a stream."""
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@register("alarm_changes_stream", _PIPELINE_STATES_SQL + f" and epoch_us(period_start) + cast(period_seconds as bigint) * 1000000 <= {_CLOSED_SQL}")
def q_alarm_changes_stream(spark, sf_dir):
    """H2-H4 as a running evaluator: samples as a stream, rolled up by rule and minute, then state changes by timers."""
    from lakekpi.streaming import alarms as ALM

    root, rules = scratch_path(spark, "alarm-stream"), H.rules_frame(spark)
    samples = _stream_of(pipeline_metrics(spark, sf_dir).unionByName(_last_minute(spark, sf_dir)), f"{root}/samples")
    q = ALM.minutes(samples, rules, lateness="0 seconds", exact_scale=6).writeStream.format("parquet").option("path", f"{root}/minutes").option(
        "checkpointLocation", f"{root}/c1").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    by_minute = spark.read.schema(ALM.MINUTES).parquet(f"{root}/minutes")
    last = _last_minute(spark, sf_dir).select("ts")  # the clock: every rule's row shows that time has come so far
    rows = by_minute.unionByName(ALM.starters(rules, ALARM_START)).unionByName(
        ALM.starters(rules.crossJoin(F.broadcast(last)), F.date_trunc("minute", "ts")))
    q = ALM.changes(_stream_of(rows, f"{root}/rows"), rules, ALARM_START).writeStream.format("parquet").option("path", f"{root}/changes").option(
        "checkpointLocation", f"{root}/c2").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(ALM.CHANGES).parquet(f"{root}/changes")


def _last_minute(spark, sf_dir) -> DataFrame:
    """A sample that no rule watches, at the time of the last event: the stream's clock."""
    return X.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp").alias("ts")).select(
        "ts", F.lit("Clock").alias("metric_name"), F.lit(0.0).alias("value"), F.lit(None).cast("map<string,string>").alias("dimensions"))


@register("metric_rollup_stream", O.with_ctes("""
select time_bucket(interval 1 hour, ts) as period_start, metric_name, cast(sum(cast(value as decimal(18,6))) as double) as sum,
       cast(sum(cast(value as decimal(18,6))) as double) / count(value) as average, max(value) as maximum, count(value) as sample_count
from metric_samples group by 1, 2 having time_bucket(interval 1 hour, max(ts)) + interval 1 hour <= (select max(ts) - interval 10 minute from metric_samples)""",
                                              "metric_samples"))
def q_metric_rollup_stream(spark, sf_dir):
    """H1 on a stream: hourly roll-ups, each put out once the watermark has passed its end."""
    root = scratch_path(spark, "rollup-stream")
    samples = X.metric_samples(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "metric_name", "value")
    samples = _stream_of(samples, f"{root}/samples")
    out = H.rollup_stream(samples, 3600, exact_scale=6)
    q = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/c").outputMode("append").trigger(
        availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


# ---------------------------------------------------------------------------------------------------
# deliveries
# ---------------------------------------------------------------------------------------------------

# Four events in a row are the attempts of a delivery, drawn apart in time; every seventh attempt succeeds.
_ATTEMPTS_SQL = """
select event_id // 4 as delivery_id, event_id as attempt_id, event_id % 7 = 3 as ok, first_ts as event_time,
       first_ts + to_microseconds(12 * (epoch_us(ts) - epoch_us(first_ts))) as attempted_at
from (select *, min(ts) over (partition by event_id // 4) as first_ts from events) e"""

_DELIVERIES_SQL = f"""
with a as ({_ATTEMPTS_SQL}),
w as (select epoch_ms(max(attempted_at)) as now_ms from a),
n as (select *, row_number() over (partition by delivery_id order by attempted_at, attempt_id) as n,
             attempted_at <= event_time + interval {K.MAX_EVENT_AGE_SECONDS} second as young from a),
d as (select delivery_id, min(event_time) as event_time, min(case when ok and young then n end) as k,
             count(*) filter (where young) as tries, max(case when n = 3 and young then attempted_at end) as third,
             max(case when young then attempted_at end) as last_try from n group by delivery_id),
s as (select d.*, ok_at.attempted_at as ok_at, now_ms from d cross join w
      left join n ok_at on ok_at.delivery_id = d.delivery_id and ok_at.n = d.k),
f as (select delivery_id, now_ms,
             case when k <= {K.MAX_RETRY_ATTEMPTS + 1} then 'delivered' when tries > {K.MAX_RETRY_ATTEMPTS} then 'dead_letter'
                  when epoch_ms(event_time) + {K.MAX_EVENT_AGE_SECONDS * 1000} < now_ms then 'dead_letter' else 'retry' end as state,
             least(case when k <= {K.MAX_RETRY_ATTEMPTS + 1} then k else tries end, {K.MAX_RETRY_ATTEMPTS + 1}) as attempts,
             case when k <= {K.MAX_RETRY_ATTEMPTS + 1} then ok_at when tries > {K.MAX_RETRY_ATTEMPTS} then third
                  when epoch_ms(event_time) + {K.MAX_EVENT_AGE_SECONDS * 1000} < now_ms then event_time + interval {K.MAX_EVENT_AGE_SECONDS} second
                  else last_try end as changed_at from s)
select cast(delivery_id as varchar) as delivery_id,
       case when state = 'dead_letter' and epoch_ms(changed_at) + {K.DEAD_LETTER_RETENTION_DAYS * 86400000} < now_ms then 'expired' else state end as state,
       cast(attempts as integer) as attempts,
       case when state = 'dead_letter' and epoch_ms(changed_at) + {K.DEAD_LETTER_RETENTION_DAYS * 86400000} < now_ms
            then changed_at + interval {K.DEAD_LETTER_RETENTION_DAYS} day else changed_at end as changed_at
from f"""


@register("delivery_states", _DELIVERIES_SQL)
def q_delivery_states(spark, sf_dir):
    """The last state of every delivery, after a stream of attempts: delivered, waiting, dead letter or expired."""
    from pyspark.sql import Window

    from lakekpi.streaming import deliveries as DLV

    ev = X.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("delivery_id", F.expr("event_id div 4"))
    first = F.min("ts").over(Window.partitionBy("delivery_id"))
    ev = ev.withColumn("event_time", first)
    late = F.timestamp_micros(F.unix_micros("event_time") + 12 * (F.unix_micros("ts") - F.unix_micros("event_time")))
    attempts = ev.select("delivery_id", F.col("event_id").alias("attempt_id"), "event_time", late.alias("attempted_at"),
                         (F.col("event_id") % 7 == 3).alias("ok"))
    root = scratch_path(spark, "deliveries")
    done = DLV.run_deliveries(_stream_of(attempts, f"{root}/attempts"), f"{root}/changes", f"{root}/checkpoint")
    return DLV.latest(done)


# ---------------------------------------------------------------------------------------------------
# E: serve
# ---------------------------------------------------------------------------------------------------


LOADED_AT = "2024-02-01 00:00:00"


def _loaded():
    return F.lit(LOADED_AT).cast("timestamp")


def _dec(x: str) -> str:
    return (f"case when {x} is null or isnan({x}) or isinf({x}) then cast(0 as decimal(38,18)) "
            f"else cast(cast({x} as varchar) as decimal(38,18)) end")


_EXP = "cast(epoch(timestamp '2024-02-01 00:00:00') as bigint) + {d} * 86400"

_GENRE_ITEMS_SQL = f"""
select genre, date, cast(listen_count as integer) as listen_count, cast(unique_listeners as integer) as unique_listeners,
       {_dec('total_listen_seconds')} as total_listen_seconds,
       {_dec('avg_listen_seconds_per_user')} as avg_listen_seconds_per_user,
       'unknown' as ingested_at, 'unknown' as source_execution_id, {_EXP.format(d=90)} as expires_at
from ({O.GENRE_KPIS_SQL}) k"""

_SONG_ITEMS_SQL = f"""
select genre_date, rank, track_id, track_name, cast(play_count as integer) as play_count,
       'unknown' as ingested_at, 'unknown' as source_execution_id, {_EXP.format(d=365)} as expires_at, date
from ({O.TOP_SONGS_SQL.format(n=3)}) s"""

_GENRE_RANK_ITEMS_SQL = f"""
select date, rank, genre, cast(listen_count as integer) as listen_count,
       'unknown' as ingested_at, 'unknown' as source_execution_id, {_EXP.format(d=365)} as expires_at
from ({O.TOP_GENRES_SQL.format(n=5)}) s"""


def serving_genre_kpis(spark, sf_dir, cur=None):
    return E.genre_kpi_items(D.genre_kpis(cur if cur is not None else curated(spark, sf_dir)), loaded_at=_loaded())


@register("serving_genre_kpis", _cur(_GENRE_ITEMS_SQL))
def q_serving_genre_kpis(spark, sf_dir):
    """E1 + E4 + E8: genre KPI items with exact decimals and expiry."""
    return serving_genre_kpis(spark, sf_dir)


@register("serving_top_songs", _cur(_SONG_ITEMS_SQL))
def q_serving_top_songs(spark, sf_dir):
    """E2."""
    return E.top_song_items(D.top_songs(curated(spark, sf_dir)), loaded_at=_loaded())


@register("serving_top_genres", _cur(_GENRE_RANK_ITEMS_SQL))
def q_serving_top_genres(spark, sf_dir):
    """E3."""
    return E.top_genre_items(D.top_genres(curated(spark, sf_dir)), loaded_at=_loaded())


# Upsert scenario: the table holds KPIs of an earlier, partial run (even user ids only, every day); the new
# batch carries the full KPIs of the first 15 days.
UPSERT_CUTOFF = "2024-01-15"

_UPSERT_SQL = O.with_ctes(f"""
, old_cur as (select * from curated where user_id % 2 = 0),
old_items as ({_GENRE_ITEMS_SQL.replace('from curated', 'from old_cur')}),
new_items as (select * from ({_GENRE_ITEMS_SQL}) n where date <= '{UPSERT_CUTOFF}')
select * from old_items o where not exists (select 1 from new_items n where n.date = o.date)
union all
select * from old_items o where exists (select 1 from new_items n where n.date = o.date)
  and not exists (select 1 from new_items n where n.genre = o.genre and n.date = o.date)
union all
select * from new_items""", *_CUR, "curated", extra=_CUR_CTE).replace("\n, old_cur", ",\nold_cur", 1)


@register("serving_upsert", _UPSERT_SQL)
def q_serving_upsert(spark, sf_dir):
    """E5: the genre-KPI table after upserting a batch over an older version."""
    from lakekpi.plans import sinks

    cur = sinks.stage(curated(spark, sf_dir).select("user_id", "genre", "event_date", "duration_ms"), "upsert-curated")
    path = _served(spark, E.GENRE_KPIS, serving_genre_kpis(spark, sf_dir, cur.filter(F.col("user_id") % 2 == 0)))
    new = serving_genre_kpis(spark, sf_dir, cur.filter(F.col("event_date") <= F.to_date(F.lit(UPSERT_CUTOFF))))
    sinks.upsert_partitions(new, path, [E.GENRE_KPIS.pk, E.GENRE_KPIS.sk], E.GENRE_KPIS.day_col)
    return _read_served(spark, E.GENRE_KPIS, path).select(*new.columns)


def _served(spark, table, items) -> str:
    """The items written as a serving table; its path."""
    from lakekpi.plans import sinks

    path = scratch_path(spark, f"served-{table.name}")
    sinks.write_partitions(items, path, [table.day_col], observe=False)
    return path


def _read_served(spark, table, path):
    from lakekpi.sources.partitions import with_text_day

    return with_text_day(spark.read.parquet(path), table.day_col)


def _lookup(spark, table, items, find):
    """A lookup on the written table, so its keys are pruned and pushed into the scan."""
    return find(_read_served(spark, table, _served(spark, table, items))).select(*items.columns)


TTL_NOW = "2024-04-20 00:00:00"


@register("ttl_prune", _cur(f"""
select * from ({_GENRE_ITEMS_SQL.replace(_EXP.format(d=90), "cast(epoch(cast(date as timestamp)) as bigint) + 90 * 86400")}) i
where expires_at > cast(epoch(timestamp '{TTL_NOW}') as bigint)"""))
def q_ttl_prune(spark, sf_dir):
    """Items loaded at their day's midnight expire 90 days later; expired rows are pruned."""
    k = D.genre_kpis(curated(spark, sf_dir))
    items = E.genre_kpi_items(k, loaded_at=F.to_timestamp("date"))
    return E.prune_expired(items, F.lit(TTL_NOW).cast("timestamp"))


LOOKUP_GENRE, LOOKUP_DATE = "promo", "2024-01-09"


@register("lookup_genre_days", _cur(f"select * from ({_GENRE_ITEMS_SQL}) i where genre = '{LOOKUP_GENRE}'"))
def q_lookup_genre_days(spark, sf_dir):
    """All days of one genre."""
    return _lookup(spark, E.GENRE_KPIS, serving_genre_kpis(spark, sf_dir), lambda t: E.genre_days(t, LOOKUP_GENRE))


@register("lookup_genre_day", _cur(
    f"select * from ({_GENRE_ITEMS_SQL}) i where genre = '{LOOKUP_GENRE}' and date = '{LOOKUP_DATE}'"))
def q_lookup_genre_day(spark, sf_dir):
    """One genre on one day."""
    return _lookup(spark, E.GENRE_KPIS, serving_genre_kpis(spark, sf_dir), lambda t: E.genre_day(t, LOOKUP_GENRE, LOOKUP_DATE))


@register("lookup_songs_of_genre_date", _cur(
    f"select * from ({_SONG_ITEMS_SQL}) i where genre_date = '{LOOKUP_GENRE}#{LOOKUP_DATE}'"))
def q_lookup_songs(spark, sf_dir):
    """The ranked songs of one genre#date."""
    items = E.top_song_items(D.top_songs(curated(spark, sf_dir)), loaded_at=_loaded())
    return _lookup(spark, E.TOP_SONGS, items, lambda t: E.songs_of_genre_date(t, f"{LOOKUP_GENRE}#{LOOKUP_DATE}"))


@register("lookup_genres_of_date", _cur(f"select * from ({_GENRE_RANK_ITEMS_SQL}) i where date = '{LOOKUP_DATE}'"))
def q_lookup_genres(spark, sf_dir):
    """The ranked genres of one day."""
    items = E.top_genre_items(D.top_genres(curated(spark, sf_dir)), loaded_at=_loaded())
    return _lookup(spark, E.TOP_GENRES, items, lambda t: E.genres_of_date(t, LOOKUP_DATE))


# ---------------------------------------------------------------------------------------------------
# A: admission, G: archive / retention, A16: partition spine
# ---------------------------------------------------------------------------------------------------


NOW_ADMIT = "2024-02-01 00:00:00"
NOW_REPLAY = "2024-01-20 00:00:00"
NOW_RETAIN = "2025-01-15 00:00:00"


def _ts(s):
    return F.lit(s).cast("timestamp")


def run_ledger(listing: DataFrame) -> DataFrame:
    """Earlier runs: contents seen 10 days before (blocking) or 100 days before (outside the window)."""
    m = F.col("n_records") % 3
    days = F.when(m == 1, F.lit(10)).when(m == 2, F.lit(100))
    return listing.filter(m != 0).select(
        F.col("etag").alias("execution_id"), (F.col("event_time") - F.make_dt_interval(days=days)).alias("started_at")
    )


def failed_deliveries(listing: DataFrame) -> DataFrame:
    adm = A.admit(listing)
    return adm.select(
        "object_key",
        (F.col("n_records") % 4).alias("attempts"),
        "event_time",
        (F.col("event_time") + F.make_dt_interval(secs=(F.col("n_records") % 5) * 1000)).alias("failed_at"),
    )


_LEDGER_SQL = """
select etag as execution_id,
       event_time - case when n_records % 3 = 1 then interval 10 day else interval 100 day end as started_at
from listing where n_records % 3 <> 0"""

_ADMIT_WHERE = ("object_key like 'streams/landing_date=%' and object_key like '%.csv' "
                "and object_key not like 'streams/manifests/%'")

_FAILED_SQL = f"""
select object_key, n_records % 4 as attempts, event_time,
       event_time + to_seconds((n_records % 5) * 1000) as failed_at
from listing where {_ADMIT_WHERE}"""

_CLASSIFIED_SQL = f"""
select object_key, attempts, event_time, failed_at,
       cast(epoch(failed_at) - epoch(event_time) as bigint) as event_age_s,
       case when attempts <= 2 and epoch(failed_at) - epoch(event_time) <= 3600 then 'retry'
            when epoch(timestamp '{NOW_REPLAY}') - epoch(failed_at) <= 14 * 86400 then 'dead_letter'
            else 'expired' end as disposition
from failed"""


def _lst(body, *more, extra=None):
    return O.with_ctes(body, "listing", *more, extra=extra)


@register("admit_files", _lst(f"""
select 'bronze' as bucket, object_key as key,
       case when object_key like '%landing_date=%' then split_part(split_part(object_key, 'landing_date=', 2), '/', 1)
            else '' end as landing_date,
       event_time, etag as execution_id
from listing where {_ADMIT_WHERE}"""))
def q_admit_files(spark, sf_dir):
    """A1 + A2 + A5: decoded, admitted keys as run inputs."""
    lst = A.decode_keys(X.listing(spark, sf_dir))
    return A.run_inputs(A.admit(lst), "bronze")


@register("landing_date", _lst("""
select object_key, etag, event_time, n_records,
       case when object_key like '%landing_date=%' then split_part(split_part(object_key, 'landing_date=', 2), '/', 1)
            else '' end as landing_date,
       coalesce(nullif(regexp_extract(object_key, 'landing_date=(\\d{4}-\\d{2}-\\d{2})', 1), ''), 'unknown') as run_date
from listing"""))
def q_landing_date(spark, sf_dir):
    """A3 (a) and (b) on every listed key."""
    return A.with_dates(X.listing(spark, sf_dir))


@register("dedupe_files", _lst(f"""
, firsts as (
  select etag, arg_min(object_key, (event_time, object_key)) as object_key, min(event_time) as event_time,
         arg_min(n_records, (event_time, object_key)) as n_records
  from listing where {_ADMIT_WHERE} group by etag)
select f.object_key, f.etag, f.event_time, f.n_records from firsts f
where f.etag not in (select execution_id from ledger where started_at > timestamp '{NOW_ADMIT}' - interval 90 day)""",
    "ledger", extra={"ledger": _LEDGER_SQL}).replace("\n, firsts", ",\nfirsts", 1))
def q_dedupe_files(spark, sf_dir):
    """A4: first object per content hash, minus contents that started a run in the last 90 days."""
    lst = X.listing(spark, sf_dir)
    return A.new_runs(A.admit(lst), run_ledger(lst), _ts(NOW_ADMIT))


@register("replay_selection", _lst(_CLASSIFIED_SQL, "failed", extra={"failed": _FAILED_SQL}))
def q_replay_selection(spark, sf_dir):
    """Failed deliveries classified retry / dead_letter / expired."""
    return A.classify_failures(failed_deliveries(X.listing(spark, sf_dir)), _ts(NOW_REPLAY))


@register("replay_keys", _lst(f"""
select * from listing where {_ADMIT_WHERE}
  and object_key in (select object_key from classified where disposition = 'dead_letter')""",
    "failed", "classified", extra={"failed": _FAILED_SQL, "classified": _CLASSIFIED_SQL}))
def q_replay_keys(spark, sf_dir):
    """Listing entries to replay (dead-lettered deliveries)."""
    lst = X.listing(spark, sf_dir)
    return A.replay_set(lst, A.classify_failures(failed_deliveries(lst), _ts(NOW_REPLAY)))


@register("archive_candidates", _lst(f"""
select * from listing where {_ADMIT_WHERE} and length(object_key) > 0
  and object_key in (select object_key from listing where n_records % 2 = 0)"""))
def q_archive_candidates(spark, sf_dir):
    """G1: of the given keys (every key with an even record count), the archivable stream files."""
    lst = X.listing(spark, sf_dir)
    return A.archive_candidates(lst, lst.filter(F.col("n_records") % 2 == 0))


@register("retention_prune", _lst(f"""
select l.object_key, l.etag, l.event_time, l.n_records, p.area, p.days,
       cast(date_diff('day', cast(l.event_time as date), date '{NOW_RETAIN[:10]}') as integer) as age_days
from listing l join (values ('archive', 2555), ('quarantine', 90), ('results', 14), ('streams', 365)) p(area, days)
  on split_part(l.object_key, '/', 1) = p.area
where date_diff('day', cast(l.event_time as date), date '{NOW_RETAIN[:10]}') > p.days"""))
def q_retention_prune(spark, sf_dir):
    """Listed objects past their area's retention."""
    return A.retention_prune(X.listing(spark, sf_dir), A.retention_policy(spark), _ts(NOW_RETAIN))


SPINE_END = "2024-02-15"


@register("missing_days", O.with_ctes(f"""
select cast(d as date) as day from generate_series(date '2024-01-01', date '{SPINE_END}', interval 1 day) g(d)
where cast(d as date) not in (select distinct cast(ts as date) from events)"""))
def q_missing_days(spark, sf_dir):
    """Days of the projected partition range without data."""
    ev = X.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return A.missing_days(ev, K.PARTITION_PROJECTION_START, SPINE_END)


# ---------------------------------------------------------------------------------------------------
# I: prepare, J: backfill / late rebuild
# ---------------------------------------------------------------------------------------------------



@register("load_trim", O.with_ctes(
    "select trim(cast(user_id as varchar)) as user_id, trim(track_id) as track_id, trim(listen_time) as listen_time from raw",
    "raw"))
def q_load_trim(spark, sf_dir):
    """Trimmed text fields."""
    return P.trim_fields(X.raw(spark, sf_dir))


@register("landing_partitions", O.with_ctes(f"""
select strftime(cast({O.PARSE} as date), '%Y-%m-%d') as landing_date, count(*) as n_records
from raw where {O.PARSE} is not null group by 1""", "raw"))
def q_landing_partitions(spark, sf_dir):
    """Rows per landing batch (rows with a parseable listen time)."""
    clean = X.raw(spark, sf_dir).filter(F.try_to_timestamp("listen_time", F.lit(K.LISTEN_TIME_FORMAT)).isNotNull())
    return P.landing_counts(clean)


SAMPLE_N = 500


@register("bounded_sample", O.with_ctes(f"""
select source_key, event_id, copy_no, user_id, track_id, listen_time from stream_records
order by (event_id * 2654435761) % 1000003, event_id, copy_no limit {SAMPLE_N}""", "stream_records"))
def q_bounded_sample(spark, sf_dir):
    """A 500-row sample by a deterministic pseudo-random order."""
    r = X.stream_records(spark, sf_dir).select("source_key", "event_id", "copy_no", "user_id", "track_id", "listen_time")
    key = [(F.col("event_id") * F.lit(2654435761)) % F.lit(1000003), F.col("event_id"), F.col("copy_no")]
    return P.sample_rows(r, SAMPLE_N, order_key=key)


BACKFILL_START, BACKFILL_END = "2024-01-05", "2024-01-12"


@register("backfill_range", _cur(f"""select * from ({O.GENRE_KPIS_SQL}) k
where date between '{BACKFILL_START}' and '{BACKFILL_END}'"""))
def q_backfill_range(spark, sf_dir):
    """Genre KPIs of a date range in one job."""
    return J.backfill_kpis(curated(spark, sf_dir), BACKFILL_START, BACKFILL_END)["genre_kpis_daily"]


LATE_DAYS = ("2024-01-03", "2024-01-17")


def _late_filter():
    return F.substring("listen_time", 1, 10).isin(*LATE_DAYS) & (F.substring("listen_time", 12, 2) == "23")


@register("late_rebuild", O.with_ctes(f"""
select * from ({O.GENRE_KPIS_SQL}) k
where date in (select distinct strftime(event_date, '%Y-%m-%d') from late_cur)""",
    *_CUR, "curated", "late_raw", "late_cur",
    extra={**_CUR_CTE,
           "late_raw": "select * from raw where substr(listen_time, 1, 10) in "
                       f"('{LATE_DAYS[0]}', '{LATE_DAYS[1]}') and substr(listen_time, 12, 2) = '23'",
           "late_cur": O.curated_sql("late_raw")}))
def q_late_rebuild(spark, sf_dir):
    """A late batch arrives; every day it touches is rebuilt from all rows of that day."""
    raw = X.raw(spark, sf_dir)
    songs, users = X.songs(spark, sf_dir), X.users(spark, sf_dir)
    late = C.curate(raw.filter(_late_filter()), songs, users)
    everything = C.curate(raw, songs, users)
    return D.genre_kpis(J.rebuild_days(everything, J.affected_days(late)))


# ---------------------------------------------------------------------------------------------------
# File-driven flows — landing CSVs written from the raw batch, then ingested
# ---------------------------------------------------------------------------------------------------



# Small files hold a few rows of unknown tracks or junk times: up to a quarter of one.
DIRTY_LIMIT = 0.25


def _land(spark, sf_dir, root: str) -> None:
    """The stream records as landed CSVs, one file per event day, every row: clean and dirty files, junk times, files with
    another order of columns and quotes, an unknown column or a missing one, files landed twice, and an empty one."""
    r = X.stream_records(spark, sf_dir)
    day = F.substring("landing_date", 9, 2).cast("int")
    r = r.withColumn("device", F.lit("phone")).withColumn("kind", F.when(day % 5 == 0, "device").when(day % 7 == 3, "short").when(
        day % 8 == 4, "turned").otherwise("plain")).repartition("landing_date").sortWithinPartitions("landing_date", "event_id", "copy_no")
    shapes = [("device", [*S.TRIPLET, "device"], False), ("short", ["user_id", "track_id"], False),
              ("turned", ["listen_time", "track_id", "user_id"], True), ("plain", list(S.TRIPLET), False)]
    for kind, columns, quoted in shapes:
        rows = r.where(F.col("kind") == kind).select(*columns, "landing_date")
        for part in (rows, rows.where(day % 6 == 2)):  # the second is landed again
            (part.write.mode("append").option("header", "true").option("quoteAll", str(quoted).lower())
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
             .partitionBy("landing_date").csv(f"{root}/streams"))
    spark.createDataFrame([], "x string").coalesce(1).write.csv(f"{root}/streams/landing_date=2024-01-01/none")


_LANDED = {
    "raw_ok": """select try_cast(user_id as int) as user_id, nullif(track_id, '') as track_id, listen_time from stream_records
                 where source_key in (select source_key from verdict where valid)""",
    "curated": O.curated_sql("raw_ok"),
}
_LANDED_CTES = ("songs", "users", "stream_records", "stream_headers", "records", "errors", "verdict", "raw_ok", "curated")
_ITEMS = ["genre", "date", "listen_count", "unique_listeners", "total_listen_seconds", "avg_listen_seconds_per_user",
          "ingested_at", "source_execution_id", "expires_at"]


def _layout(root: str):
    from lakekpi.plans.batch import Layout

    return Layout(*(f"{root}/{x}" for x in ("landing", "silver", "gold", "serving", "quarantine", "archive", "manifests", "ledger")))


@register("stream_ingest_kpis", O.with_ctes(O.GENRE_KPIS_SQL, *_LANDED_CTES, extra=_LANDED))
def q_stream_ingest(spark, sf_dir):
    """The landed files as a stream in several micro-batches, each admitted, validated and run; Gold read back."""
    from lakekpi.plans.gold import read_gold
    from lakekpi.streaming.ingest import ingest

    layout = _layout(scratch_path(spark, "stream-ingest"))
    _land(spark, sf_dir, layout.landing)
    ingest(spark, layout, f"{layout.ledger}-checkpoint", X.songs(spark, sf_dir), X.users(spark, sf_dir), max_files_per_trigger=20,
           max_drop_rate=DIRTY_LIMIT, archive_files=False)
    g = read_gold(spark, layout.gold, "genre_kpis_daily")
    return g.select("genre", "listen_count", "unique_listeners", "total_listen_seconds",
                    "avg_listen_seconds_per_user", "date")


@register("batch_run_serving", O.with_ctes(
    _GENRE_ITEMS_SQL.replace("'unknown' as source_execution_id", "'exec-batch' as source_execution_id"), *_LANDED_CTES, extra=_LANDED))
def q_batch_run(spark, sf_dir):
    """One run over all landed files (validate -> quarantine | curate -> aggregate -> serve); serving items."""
    from lakekpi.plans.batch import run_batch
    from lakekpi.plans.load import serving_table

    layout = _layout(scratch_path(spark, "batch-run"))
    _land(spark, sf_dir, layout.landing)
    run_batch(spark, layout, X.songs(spark, sf_dir), X.users(spark, sf_dir), execution_id="exec-batch",
              event_time="2024-02-01T00:00:00Z", now=_loaded(), max_drop_rate=DIRTY_LIMIT)
    return spark.read.parquet(serving_table(layout.serving, E.GENRE_KPIS)).select(_ITEMS)


_SILVER_COLUMNS = ["user_id", "track_id", "listen_time", "genre", "event_date", "duration_ms", "user_country"]


@register("repeated_runs_silver", O.with_ctes(f"select {', '.join(_SILVER_COLUMNS)} from curated", *_LANDED_CTES, extra=_LANDED))
def q_repeated_runs(spark, sf_dir):
    """J2 + A6: the landed files by a run, by a second run, by a run over the taken paths again, and by stream: Silver stays the same."""
    from lakekpi.plans.batch import admitted, run_batch
    from lakekpi.plans.silver import silver_table
    from lakekpi.streaming.ingest import ingest

    layout, songs, users = _layout(scratch_path(spark, "repeated")), X.songs(spark, sf_dir), X.users(spark, sf_dir)
    _land(spark, sf_dir, layout.landing)
    taken = [r.path for r in admitted(spark, layout).where("length > 0").select("path").collect()]
    for run, paths in (("first", None), ("second", None), ("again", taken)):
        run_batch(spark, layout, songs, users, paths=paths, execution_id=run, archive_files=False, max_drop_rate=DIRTY_LIMIT)
    ingest(spark, layout, f"{layout.ledger}-checkpoint", songs, users, archive_files=False, max_drop_rate=DIRTY_LIMIT)
    return spark.read.parquet(silver_table(layout.silver)).select(_SILVER_COLUMNS)


@register("recompute_from_bronze", O.with_ctes(O.GENRE_KPIS_SQL, *_LANDED_CTES, extra=_LANDED))
def q_recompute(spark, sf_dir):
    """Silver and Gold rebuilt from all landed files."""
    from lakekpi.plans.backfill import recompute
    from lakekpi.plans.gold import read_gold

    root = scratch_path(spark, "recompute")
    _land(spark, sf_dir, f"{root}/landing")
    recompute(spark, f"{root}/landing", f"{root}/silver", f"{root}/gold", X.songs(spark, sf_dir), X.users(spark, sf_dir),
              max_drop_rate=DIRTY_LIMIT)
    return read_gold(spark, f"{root}/gold", "genre_kpis_daily").select(
        "genre", "listen_count", "unique_listeners", "total_listen_seconds", "avg_listen_seconds_per_user", "date")


# ---------------------------------------------------------------------------------------------------
# C14/C15 per file and breaker states
# ---------------------------------------------------------------------------------------------------

_GATES_BY_FILE_SQL = f"""
with t as (select source_key, user_id, track_id, listen_time, count(*) as n
           from (select source_key, try_cast(user_id as int) as user_id, nullif(track_id, '') as track_id,
                        listen_time from stream_records) r
           group by all),
m as (select track_id, count(*) as mlt from songs group by track_id),
j as (select t.*, m.mlt,
             (t.user_id is not null and t.track_id is not null and t.listen_time is not null) as nonnull
      from t left join m on m.track_id = t.track_id)
select source_key, sum(n) as "RawCount",
       coalesce(sum(case when nonnull then n end), 0) as "AfterDropNaCount",
       count(case when nonnull then 1 end) as "AfterDedupCount",
       count(case when nonnull and {O.PARSE} is not null then 1 end) as "AfterTimestampParseCount",
       coalesce(sum(case when nonnull and {O.PARSE} is not null then mlt end), 0) as "AfterSongsJoinCount",
       count(case when nonnull and {O.PARSE} is not null then 1 end)
         - coalesce(sum(case when nonnull and {O.PARSE} is not null then mlt end), 0) as "UnmatchedSongsCount",
       case when sum(n) > 0 then (sum(n) - coalesce(sum(case when nonnull and {O.PARSE} is not null then mlt end), 0))
            / cast(sum(n) as double) else 0.0 end as drop_rate
from j group by source_key"""


def _file_streams(spark, sf_dir):
    r = X.stream_records(spark, sf_dir)
    return r.select(
        "source_key",
        F.expr("try_cast(user_id as int)").alias("user_id"),
        F.when(F.col("track_id") != "", F.col("track_id")).alias("track_id"),
        "listen_time",
    )


@register("gates_by_file", O.with_ctes(_GATES_BY_FILE_SQL.replace("with t as", ", t as", 1), "stream_records", "songs")
          .replace("\n, t as", ",\nt as", 1))
def q_gates_by_file(spark, sf_dir):
    """C14 + C15 per batch file (each daily file of the stream records), one aggregate."""
    return G.gate_counts_by(_file_streams(spark, sf_dir), X.songs(spark, sf_dir), ["source_key"])


@register("drop_rate", O.with_ctes(f"""
select "RawCount", "AfterSongsJoinCount", drop_rate, max_drop_rate,
       ("RawCount" > 0 and drop_rate > max_drop_rate) as trips
from ({_GATES_FULL}) g, (values (0.10), (0.05)) l(max_drop_rate)""", "raw", "songs"))
def q_drop_rate(spark, sf_dir):
    """The drop rate of the raw batch and the breaker's verdict at the default limit (0.10) and at 0.05."""
    g = G.gate_counts(X.raw(spark, sf_dir), X.songs(spark, sf_dir))
    return G.breaker_states(g, [0.10, 0.05]).select("RawCount", "AfterSongsJoinCount", "drop_rate", "max_drop_rate", "trips")


@register("silver_gold_jobs", _cur(O.GENRE_KPIS_SQL))
def q_silver_gold_jobs(spark, sf_dir):
    """The Silver job (observed gates, breaker, staged publish) then the Gold job over every Silver day;
    the Gold genre-KPI table is read back."""
    from lakekpi.plans.gold import read_gold, run_gold
    from lakekpi.plans.silver import run_silver

    root = scratch_path(spark, "silver-gold")
    s = run_silver(spark, X.raw(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir), f"{root}/silver",
                   run_key="streams/landing_date=2024-01-01/batch.csv")
    run_gold(spark, f"{root}/silver", f"{root}/gold", s.days)
    return read_gold(spark, f"{root}/gold", "genre_kpis_daily").select(
        "genre", "listen_count", "unique_listeners", "total_listen_seconds", "avg_listen_seconds_per_user", "date"
    )


@register("star_silver_gold_jobs", O.with_ctes(O.TOP_SONGS_SQL.format(n=3), "star", "songs", "users", "curated",
                                               extra=_STAR_CTE))
def q_star_silver_gold_jobs(spark, sf_dir):
    """Both jobs over the large batch; the Gold top-songs table is read back."""
    from lakekpi.plans.gold import read_gold, run_gold
    from lakekpi.plans.silver import run_silver

    root = scratch_path(spark, "star-silver-gold")
    s = run_silver(spark, star(spark, sf_dir), X.songs(spark, sf_dir), X.users(spark, sf_dir),
                   f"{root}/silver", run_key="streams/landing_date=1995-01-01/batch.csv")
    run_gold(spark, f"{root}/silver", f"{root}/gold", s.days)
    return read_gold(spark, f"{root}/gold", "top_songs_by_genre_daily").select(
        "genre", "track_id", "track_name", "play_count", "rank", "date", "genre_date"
    )


from lakekpi import registry_tables  # noqa: E402,F401 - more queries, which use this module
