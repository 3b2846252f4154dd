"""Metrics as data: long-form samples (C16, D7, E6), period roll-ups (H1) and alarm evaluation (H2-H4).

A metric sample row: ts, namespace, metric_name, value, unit, dimensions map<string,string>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi import schemas as S


def _dims(**kv) -> Column:
    args = []
    for k, v in kv.items():
        args += [F.lit(k), v if isinstance(v, Column) else F.lit(v)]
    return F.create_map(*args)


def gates_to_metrics(gates: DataFrame, run_date: Column | str, ts: Column | None = None) -> DataFrame:
    """Each gate count with dims {Job, RunDate}; DropRatePct with {Job} only (one stable alarm series)."""
    rd = run_date if isinstance(run_date, Column) else F.lit(run_date)
    now = ts if ts is not None else F.current_timestamp()
    stack = ", ".join(f"'{m}', cast(`{m}` as double)" for m in K.GATE_METRICS)
    counts = gates.select(F.expr(f"stack({len(K.GATE_METRICS)}, {stack}) as (metric_name, value)")).select(
        now.alias("ts"), F.lit(K.METRIC_NAMESPACE).alias("namespace"), "metric_name", "value",
        F.lit("Count").alias("unit"), _dims(Job=K.SILVER_JOB, RunDate=rd).alias("dimensions"),
    )
    rate = gates.select(
        now.alias("ts"), F.lit(K.METRIC_NAMESPACE).alias("namespace"), F.lit(K.DROP_RATE_METRIC).alias("metric_name"),
        (F.when(F.col("RawCount") > 0, (F.col("RawCount") - F.col("AfterSongsJoinCount")) / F.col("RawCount").cast("double"))
         .otherwise(F.lit(0.0)) * F.lit(100.0)).alias("value"),
        F.lit("Percent").alias("unit"), _dims(Job=K.SILVER_JOB).alias("dimensions"),
    )
    return counts.unionByName(rate)


def counts_to_metrics(spark: SparkSession, counts: dict, job: str, run_date: str, both_granularities: bool = False,
                      ts=None) -> DataFrame:
    """Driver-side counts (from observations) as metric rows; E6 emits {Job,RunDate} and {Job}."""
    rows = []
    for name, v in counts.items():
        rows.append((ts, K.METRIC_NAMESPACE, name, float(v), "Count", {"Job": job, "RunDate": run_date}))
        if both_granularities:
            rows.append((ts, K.METRIC_NAMESPACE, name, float(v), "Count", {"Job": job}))
    df = spark.createDataFrame(rows, S.METRICS)
    return df.withColumn("ts", F.coalesce("ts", F.current_timestamp()))


def rollup(samples: DataFrame, period_seconds: int, group: list[str] | None = None, exact_scale: int | None = None,
           ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """H1: Sum / Average / Maximum / SampleCount per tumbling period and metric (+ dimension columns).

    ``exact_scale`` sums the values as decimals of that scale, which makes the sums independent of the
    order in which partial sums are merged (values must have at most that many decimals).
    """
    keys = ["metric_name", *(group or [])]
    v = F.col(value_col)
    total = F.sum(v.cast(f"decimal(18,{exact_scale})")) if exact_scale is not None else F.sum(v)
    period = F.window(ts_col, f"{period_seconds} seconds")
    g = samples.groupBy(period.alias("_w"), *keys).agg(
        total.alias("_sum"), F.max(v).alias("maximum"), F.count(v).alias("sample_count")
    )
    return g.select(
        F.col("_w.start").alias("period_start"),
        *keys,
        F.col("_sum").cast("double").alias("sum"),
        (F.col("_sum").cast("double") / F.col("sample_count")).alias("average"),
        "maximum",
        "sample_count",
    )


def rollup_stream(samples: DataFrame, period_seconds: int, watermark: str = "10 minutes",
                  group: list[str] | None = None, ts_col: str = "ts", value_col: str = "value",
                  exact_scale: int | None = None) -> DataFrame:
    """H1 on a stream: the same roll-up with a watermark, so each period is emitted once it is complete
    (append mode) and its state is dropped."""
    keys = ["metric_name", *(group or [])]
    v = F.col(value_col)
    total = F.sum(v.cast(f"decimal(18,{exact_scale})")).cast("double") if exact_scale is not None else F.sum(v)
    g = samples.withWatermark(ts_col, watermark).groupBy(F.window(ts_col, f"{period_seconds} seconds").alias("_w"), *keys).agg(
        total.alias("sum"), F.max(v).alias("maximum"), F.count(v).alias("sample_count")
    )
    return g.select(F.col("_w.start").alias("period_start"), *keys, "sum", (F.col("sum") / F.col("sample_count")).alias("average"),
                    "maximum", "sample_count")


# ---------------------------------------------------------------------------------------------------
# alarms
# ---------------------------------------------------------------------------------------------------

RULE_SCHEMA = (
    "rule_name string, metric_name string, statistic string, period_seconds long, comparator string, "
    "threshold double, missing string, dimensions map<string,string>"
)

# The pipeline's alarm rules (name, metric, statistic, period s, comparator, threshold, missing data).
# JobName and FunctionName rules hold once for each job and handler; dimension values in braces are deployment names.
_JOBS = [K.SILVER_JOB, K.GOLD_JOB, K.LOAD_JOB]
_HANDLERS = ["event_router", "event_validator", "quarantine_handler", "stream_archiver"]
PIPELINE_RULES = [
    ("runs-failed", "ExecutionsFailed", "Sum", 300, ">", 0.0, "notBreaching", {"StateMachineArn": "{pipeline}"}),
    *((f"job-{x}-failed", "FailedRuns", "Sum", 300, ">", 0.0, "notBreaching", {"JobName": x}) for x in _JOBS),
    *((f"handler-{x}-errors", "Errors", "Sum", 300, ">", 0.0, "notBreaching", {"FunctionName": x}) for x in _HANDLERS),
    ("no-ingest", "Invocations", "Sum", 86400, "<", 1.0, "missing", {"RuleName": "{trigger}"}),
    ("dead-letter-depth", "ApproximateNumberOfMessagesVisible", "Maximum", 60, ">", 0.0, "notBreaching", {"QueueName": "{dead-letters}"}),
    ("sla-breach", "ExecutionsSucceeded", "Sum", 90000, "<", 1.0, "breaching", {"StateMachineArn": "{pipeline}"}),
    ("drop-rate-high", "DropRatePct", "Maximum", 300, ">", 10.0, "notBreaching", {"Job": K.SILVER_JOB}),
    ("genre-kpis-zero", "GenreKpisLoaded", "Sum", 86400, "<", 1.0, "notBreaching", {"Job": K.LOAD_JOB}),
    ("top-songs-zero", "TopSongsLoaded", "Sum", 86400, "<", 1.0, "notBreaching", {"Job": K.LOAD_JOB}),
    ("top-genres-zero", "TopGenresLoaded", "Sum", 86400, "<", 1.0, "notBreaching", {"Job": K.LOAD_JOB}),
]


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    """Rules as rows; a rule without dimensions watches every series of its metric."""
    return spark.createDataFrame([(*r, None)[:8] for r in rules or PIPELINE_RULES], RULE_SCHEMA)


def _series(dimensions) -> Column:
    """A dimension map as a comparable value."""
    return F.array_sort(F.map_entries(dimensions))


def _period_start(ts: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds) * seconds)


def watched_samples(samples: DataFrame, rules: DataFrame) -> DataFrame:
    """Samples with each rule that watches them: by metric and, where the rule names dimensions, by exactly those."""
    r = F.broadcast(rules)  # configuration
    has = "dimensions" in samples.columns
    own = r.withColumnRenamed("dimensions", "_watched") if "dimensions" in r.columns else r.withColumn("_watched", F.lit(None).cast("map<string,string>"))
    watched = F.col("_watched").isNull()
    return samples.join(own, "metric_name").where(watched | (_series("dimensions") == _series("_watched")) if has else watched)


def evaluate_alarms(samples: DataFrame, rules: DataFrame, start: str, end: str, exact_scale: int | None = None,
                    ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """H2-H4: one state per (rule, period) over the complete period spine [start, end).

    Samples are joined to the (configuration-sized, broadcast) rule table on the metric and, where the rule names
    dimensions, on exactly those, so rules with different periods share one aggregate.  Periods without samples take the rule's missing-data policy:
    breaching -> ALARM, notBreaching -> OK, missing -> INSUFFICIENT_DATA.
    """
    r = F.broadcast(rules)
    v = F.col(value_col)
    tagged = watched_samples(samples, rules).withColumn("period_start", _period_start(F.col(ts_col), F.col("period_seconds")))
    total = F.sum(v.cast(f"decimal(18,{exact_scale})")) if exact_scale is not None else F.sum(v)
    agg = tagged.groupBy("rule_name", "period_start").agg(
        total.cast("double").alias("_sum"), F.max(v).alias("_max"), F.count(v).alias("_cnt")
    )
    lo = F.to_timestamp(F.lit(start))
    hi = F.to_timestamp(F.lit(end))
    spine = r.select(
        "rule_name", "statistic", "comparator", "threshold", "missing",
        F.explode(
            F.sequence(
                _period_start(lo, F.col("period_seconds")),
                F.timestamp_seconds(F.unix_seconds(hi) - 1),
                F.make_dt_interval(secs=F.col("period_seconds")),
            )
        ).alias("period_start"),
    )
    spine = spine.withColumn("period_start", _period_start(F.col("period_start"), F.lit(1)))
    j = spine.join(agg, ["rule_name", "period_start"], "left")
    stat = F.col("statistic")
    value = (
        F.when(stat == "Sum", F.col("_sum"))
        .when(stat == "Average", F.col("_sum") / F.col("_cnt"))
        .when(stat == "Maximum", F.col("_max"))
        .when(stat == "SampleCount", F.col("_cnt").cast("double"))
    )
    value = F.when(F.col("_cnt") > 0, value)
    breach = F.when(F.col("comparator") == ">", F.col("value") > F.col("threshold")).otherwise(
        F.col("value") < F.col("threshold")
    )
    state = (
        F.when(F.col("value").isNull() & (F.col("missing") == "breaching"), F.lit("ALARM"))
        .when(F.col("value").isNull() & (F.col("missing") == "notBreaching"), F.lit("OK"))
        .when(F.col("value").isNull(), F.lit("INSUFFICIENT_DATA"))
        .when(breach, F.lit("ALARM"))
        .otherwise(F.lit("OK"))
    )
    return j.withColumn("value", value).select("rule_name", "period_start", "value", state.alias("state"))
