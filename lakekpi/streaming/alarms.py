"""H2-H4 as a running evaluator: alarm state changes from a stream of metric samples, silent periods included.

Samples are first rolled up by rule and minute (``minutes``, a windowed aggregation that ends a minute with the watermark), so the
evaluator gets a few rows a rule and minute however many samples there are.  Each rule then has a state with a timer at the end
of its current period: when the watermark passes it, the period is closed, by its samples or, if there are none, by the rule's
policy for missing data, and a change of state is put out.  Every rule is started by a row of its own, so that rules without a
single sample are evaluated too.  The changes equal those of the batch form ``metrics.evaluate_alarms``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakekpi.operators.metrics import watched_samples

MINUTE = 60  # every rule's period is a multiple of it
US = 1_000_000
CHANGES = "rule_name string, period_start timestamp, value double, state string"
_STATE = "period_us long, total double, most double, n long, last string"
MINUTES = "rule_name string, minute timestamp, total double, most double, n long"


def minutes(samples: DataFrame, rules: DataFrame, lateness: str = "10 minutes", exact_scale: int | None = None) -> DataFrame:
    """Sum, maximum and count of a stream's samples by rule and minute."""
    v = F.col("value")
    total = F.sum(v.cast(f"decimal(18,{exact_scale})")).cast("double") if exact_scale is not None else F.sum(v)
    g = watched_samples(samples.withWatermark("ts", lateness), rules).groupBy("rule_name", F.window("ts", f"{MINUTE} seconds").alias("w"))
    return g.agg(total.alias("total"), F.max(v).alias("most"), F.count(v).alias("n")).select(
        "rule_name", F.col("w.start").alias("minute"), "total", "most", "n")


def _step(rules: dict, start_us: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        statistic, seconds, comparator, threshold, missing = rules[key[0]]
        length = seconds * US
        period, total, most, n, last = group.get if group.exists else (start_us // length * length, 0.0, 0.0, 0, "")
        out = []

        def close() -> None:
            nonlocal period, total, most, n, last
            value = None
            if n:
                value = {"Sum": total, "Average": total / n, "Maximum": most, "SampleCount": float(n)}[statistic]
                state = "ALARM" if (value > threshold if comparator == ">" else value < threshold) else "OK"
            else:
                state = {"breaching": "ALARM", "notBreaching": "OK"}.get(missing, "INSUFFICIENT_DATA")
            if state != last:
                out.append((key[0], pd.Timestamp(period, unit="us"), value, state))
            period, total, most, n, last = period + length, 0.0, 0.0, 0, state

        def close_until(now_us: int) -> None:
            """Close the periods that end by ``now_us``; after the first silent one, others cannot change the state."""
            nonlocal period
            while period + length <= now_us:
                silent = not n
                close()
                if silent:
                    period += max(0, now_us - period) // length * length

        if not group.hasTimedOut:
            rows = pd.concat(list(frames)).sort_values("minute")
            for at, t, m, c in zip(rows.minute.astype("datetime64[us]").astype("int64"), rows.total, rows.most, rows.n):
                if not c:
                    continue  # the row that starts a rule
                close_until(int(at))
                total, most, n = total + t, max(most, m) if n else m, n + int(c)
        # a minute is complete when the watermark has passed its end, and later ones come after it
        close_until(max(0, group.getCurrentWatermarkMs() * 1000 // (MINUTE * US) * MINUTE * US))
        group.update((period, total, most, n, last))
        group.setTimeoutTimestamp(max((period + length) // 1000, group.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["rule_name", "period_start", "value", "state"]).astype({"value": "float64"})

    return step


def changes(by_minute: DataFrame, rules: DataFrame, start: str) -> DataFrame:
    """State changes (rule_name, period_start, value, state) from a stream of ``minutes`` rows in order of time, evaluated from
    ``start`` on.  ``rules`` is configuration."""
    table = {r.rule_name: (r.statistic, r.period_seconds, r.comparator, r.threshold, r.missing) for r in rules.collect()}
    start_us = int(pd.Timestamp(start).value // 1000)
    return by_minute.withWatermark("minute", "0 seconds").groupBy("rule_name").applyInPandasWithState(
        _step(table, start_us), CHANGES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def starters(rules: DataFrame, start: str | Column) -> DataFrame:
    """One row of ``minutes`` without samples for each rule."""
    at = F.lit(start) if isinstance(start, str) else start
    return rules.select("rule_name", at.cast("timestamp").alias("minute"), F.lit(0.0).alias("total"), F.lit(0.0).alias("most"),
                        F.lit(0).cast("long").alias("n"))


def state_changes(states: DataFrame) -> DataFrame:
    """The rows of ``metrics.evaluate_alarms`` at which a rule's state changes (its first counts)."""
    before = F.lag("state").over(Window.partitionBy("rule_name").orderBy("period_start"))
    return states.withColumn("_before", before).where("_before is null or _before <> state").drop("_before")
