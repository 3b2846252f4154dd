"""Deliveries with retries, dead letters and expiry, as keyed streaming state with timers.

A delivery that fails is tried again, up to two times and while its event is at most an hour old; then it is a dead letter, kept for
14 days.  Rows are attempts; the state of a delivery is what it is waiting for.  Timers on the event time end the wait: for the
next attempt when the event is too old, for a dead letter when its time is up.  Attempts are taken in order of time, and a
timer that lies between two of them is kept in between, so the transitions do not depend on how the rows fall into micro-batches.

Deliveries are kept in buckets by the hash of their id: each call of Python costs milliseconds, a delivery within one microseconds.
A bucket's timer is that of its delivery that is due first.

Defined results: attempts after delivery or dead letter are ignored while the delivery is known; a null outcome is a failure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakekpi import constants as K

US = 1_000_000
TRANSITIONS = "delivery_id string, state string, attempts int, changed_at timestamp"
_STATE = "ids array<string>, states array<string>, attempts array<int>, event_us array<long>, since_us array<long>"
BUCKETS = 4096
RETRY, DELIVERED, DEAD, EXPIRED = "retry", "delivered", "dead_letter", "expired"


def _due(state: str, event_us: int, since_us: int, max_age_s: int, keep_days: int) -> tuple[int, str]:
    """When the wait in ``state`` ends, and in what."""
    if state == RETRY:
        return event_us + max_age_s * US, DEAD
    if state == DEAD:
        return since_us + keep_days * 86400 * US, EXPIRED
    return event_us + keep_days * 86400 * US, ""  # a delivery that is done is forgotten then


def _step(max_attempts: int, max_age_s: int, keep_days: int):
    def step(key: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        # the deliveries of a bucket by id: state, attempts, event_us, since_us
        known = {i: list(rest) for i, *rest in zip(*group.get)} if group.exists else {}
        ids, states, numbers, times = [], [], [], []

        def to(i, d: list, new: str, at_us: int) -> None:
            d[0], d[3] = new, at_us
            if new:
                ids.append(i)
                states.append(new)
                numbers.append(d[1])
                times.append(at_us)

        def wait_until(i, d: list, now_us: int) -> None:
            """Keep every timer of a delivery that is due before ``now_us``."""
            while d[0] and d[0] != EXPIRED:
                at, then = _due(d[0], d[2], d[3], max_age_s, keep_days)
                if at >= now_us:
                    return
                to(i, d, then, at)

        if not group.hasTimedOut:
            rows = pd.concat(list(frames)).sort_values(["attempted_at", "attempt_id"])
            at = rows.attempted_at.astype("datetime64[us]").astype("int64").tolist()
            first = rows.event_time.astype("datetime64[us]").astype("int64").tolist()
            for i, t, e, ok in zip(rows.delivery_id.tolist(), at, first, rows.ok.tolist()):
                d = known.setdefault(i, ["", 0, 0, 0])
                wait_until(i, d, t)
                if d[0] in (DELIVERED, DEAD, EXPIRED):
                    continue
                if not d[0]:
                    d[1], d[2] = 0, e
                d[1] += 1
                if ok is not None and ok == True:  # noqa: E712 - whatever kind of boolean
                    to(i, d, DELIVERED, t)
                elif d[1] <= max_attempts and t - d[2] <= max_age_s * US:
                    to(i, d, RETRY, t)
                else:
                    to(i, d, DEAD, t)
        watermark = group.getCurrentWatermarkMs()
        for i, d in known.items():
            wait_until(i, d, watermark * 1000)
        kept = [(i, *d) for i, d in known.items() if d[0] not in ("", EXPIRED)]
        if kept:
            group.update(tuple(map(list, zip(*kept))))
            due = min(_due(*d[1:2], *d[3:], max_age_s, keep_days)[0] for d in kept)
            group.setTimeoutTimestamp(max(due // 1000, watermark + 1))
        else:
            group.remove()
        if ids:
            yield pd.DataFrame({"delivery_id": ids, "state": states, "attempts": numbers,
                                "changed_at": np.array(times, "int64").view("datetime64[us]")})

    return step


def transitions(attempts: DataFrame, lateness: str = "0 seconds", max_attempts: int = K.MAX_RETRY_ATTEMPTS,
                max_age_s: int = K.MAX_EVENT_AGE_SECONDS, keep_days: int = K.DEAD_LETTER_RETENTION_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """State changes (delivery_id, state, attempts, changed_at) of a stream of attempts (delivery_id, attempt_id, event_time,
    attempted_at, ok); rows more than ``lateness`` behind the newest are too late.  ``buckets`` must not change over a checkpoint."""
    rows = attempts.select(F.col("delivery_id").cast("string").alias("delivery_id"), "attempt_id", "event_time", "attempted_at", "ok")
    bucket = F.pmod(F.xxhash64("delivery_id"), F.lit(buckets)).cast("int")
    return rows.withWatermark("attempted_at", lateness).withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        _step(max_attempts, max_age_s, keep_days), TRANSITIONS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def latest(changes: DataFrame) -> DataFrame:
    """The last state of each delivery; of changes at one time the further one counts."""
    rank = F.element_at(F.create_map(*[x for i, s in enumerate([RETRY, DELIVERED, DEAD, EXPIRED]) for x in (F.lit(s), F.lit(i))]), F.col("state"))
    best = F.max_by(F.struct("state", "attempts", "changed_at"), F.struct("changed_at", "attempts", rank))
    return changes.groupBy("delivery_id").agg(best.alias("b")).select("delivery_id", "b.*")


def run_deliveries(attempts: DataFrame, path: str, checkpoint: str, **kw) -> DataFrame:
    """All available attempts through the state, transitions kept under ``path``."""
    q = transitions(attempts, **kw).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append").trigger(availableNow=True).start()
    q.awaitTermination()
    return attempts.sparkSession.read.schema(TRANSITIONS).parquet(path)
