"""Silver data-quality gates (C14), drop rate (C15) and their long-form metrics.

Two forms of the same counts:
* ``observe_gates`` attaches ``DataFrame.observe`` at each stage of the curate plan, so the counts are
  collected during the one action that writes Silver (no cache / count round trips);
* ``gate_counts`` computes them relationally as a one-row DataFrame: one aggregate by triplet (map-side
  combine collapses copies before the shuffle) joined with the per-track song multiplicity (fan-out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi import schemas as S
from lakekpi.functions.time import parse_listen_ts
from lakekpi.operators import curate as C
from lakekpi.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, sized_broadcast


class DropRateExceeded(ValueError):
    pass


def gate_counts(raw: DataFrame, songs: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """One row: RawCount, AfterDropNaCount, AfterDedupCount, AfterTimestampParseCount, AfterSongsJoinCount,
    UnmatchedSongsCount, DuplicateSongKeys."""
    by_triplet = raw.groupBy(*S.TRIPLET).agg(F.count(F.lit(1)).alias("_n"))
    mult = songs.groupBy("track_id").agg(F.count(F.lit(1)).alias("_m"))
    j = by_triplet.join(sized_broadcast(mult, max_rows), "track_id", "left")
    nonnull = F.col("user_id").isNotNull() & F.col("track_id").isNotNull() & F.col("listen_time").isNotNull()
    ts_ok = nonnull & parse_listen_ts("listen_time").isNotNull()
    z = F.lit(0).cast("long")
    g = j.agg(
        F.coalesce(F.sum("_n"), z).alias("RawCount"),
        F.coalesce(F.sum(F.when(nonnull, F.col("_n"))), z).alias("AfterDropNaCount"),
        F.count(F.when(nonnull, F.lit(1))).alias("AfterDedupCount"),
        F.count(F.when(ts_ok, F.lit(1))).alias("AfterTimestampParseCount"),
        F.coalesce(F.sum(F.when(ts_ok, F.col("_m"))), z).alias("AfterSongsJoinCount"),
    )
    dup = mult.agg(F.count(F.when(F.col("_m") > 1, F.lit(1))).alias("DuplicateSongKeys"))
    # two single-row aggregates side by side: union them and take the non-null value of every column
    names = [*g.columns, "DuplicateSongKeys"]
    none = F.lit(None).cast("long")
    both = g.select(*g.columns, none.alias("DuplicateSongKeys")).unionByName(
        dup.select(*[none.alias(c) for c in g.columns], "DuplicateSongKeys")
    )
    row = both.agg(*[F.max(c).alias(c) for c in names])
    return row.withColumn("UnmatchedSongsCount", F.col("AfterTimestampParseCount") - F.col("AfterSongsJoinCount"))


def gate_counts_by(raw: DataFrame, songs: DataFrame, group: list[str],
                   max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """C14 per batch file (or any grouping): the gate counts and drop rate of every group in one aggregate."""
    by_triplet = raw.groupBy(*group, *S.TRIPLET).agg(F.count(F.lit(1)).alias("_n"))
    mult = songs.groupBy("track_id").agg(F.count(F.lit(1)).alias("_m"))
    j = by_triplet.join(sized_broadcast(mult, max_rows), "track_id", "left")
    nonnull = F.col("user_id").isNotNull() & F.col("track_id").isNotNull() & F.col("listen_time").isNotNull()
    ts_ok = nonnull & parse_listen_ts("listen_time").isNotNull()
    z = F.lit(0).cast("long")
    g = j.groupBy(*group).agg(
        F.sum("_n").alias("RawCount"),
        F.coalesce(F.sum(F.when(nonnull, F.col("_n"))), z).alias("AfterDropNaCount"),
        F.count(F.when(nonnull, F.lit(1))).alias("AfterDedupCount"),
        F.count(F.when(ts_ok, F.lit(1))).alias("AfterTimestampParseCount"),
        F.coalesce(F.sum(F.when(ts_ok, F.col("_m"))), z).alias("AfterSongsJoinCount"),
    )
    g = g.withColumn("UnmatchedSongsCount", F.col("AfterTimestampParseCount") - F.col("AfterSongsJoinCount"))
    return with_drop_rate(g)


def breaker_states(gates: DataFrame, limits: list[float]) -> DataFrame:
    """C15 as data: one row per (gate row, limit) telling whether the breaker trips at that limit
    (rate strictly above the limit, raw > 0).  The limits are a literal array exploded per row (no join)."""
    rated = with_drop_rate(gates) if "drop_rate" not in gates.columns else gates
    trips = lambda x: (F.col("RawCount") > 0) & (F.col("drop_rate") > F.lit(float(x)))
    cases = F.array(*[F.struct(F.lit(float(x)).alias("max_drop_rate"), trips(x).alias("trips")) for x in limits])
    return rated.select("*", F.inline(cases))


def drop_rate(col_raw: Column, col_join: Column) -> Column:
    """(raw - joined) / raw, 0 when there are no raw rows."""
    return F.when(col_raw > 0, (col_raw - col_join) / col_raw.cast("double")).otherwise(F.lit(0.0))


def with_drop_rate(gates: DataFrame) -> DataFrame:
    return gates.withColumn("drop_rate", drop_rate(F.col("RawCount"), F.col("AfterSongsJoinCount")))


def check_drop_rate(counts: dict, max_drop_rate: float = K.MAX_DROP_RATE) -> float:
    """C15 breaker on driver-side scalars: raise when the rate is strictly above the limit."""
    raw, joined = int(counts["RawCount"]), int(counts["AfterSongsJoinCount"])
    rate = (raw - joined) / raw if raw > 0 else 0.0
    if raw > 0 and rate > max_drop_rate:
        raise DropRateExceeded(K.DROP_RATE_ERROR.format(rate=rate, limit=max_drop_rate, raw=raw, final=joined))
    return rate


def check_each_file(raw: DataFrame, songs: DataFrame, max_drop_rate: float = K.MAX_DROP_RATE) -> None:
    """C15 for each ``source_file`` of a batch: raise for the file that lost the largest share, if that is too much."""
    if max_drop_rate >= 1:
        return  # no share can be above it
    worst = (gate_counts_by(raw, songs, ["source_file"]).where(F.col("drop_rate") > F.lit(float(max_drop_rate)))
             .orderBy(F.desc("drop_rate"), "source_file").limit(1).collect())
    for r in worst:
        text = K.DROP_RATE_ERROR.format(rate=r["drop_rate"], limit=max_drop_rate, raw=r["RawCount"], final=r["AfterSongsJoinCount"])
        raise DropRateExceeded(f"{r['source_file']}: {text}")


def observe_gates(raw: DataFrame, songs: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  scope: list[str] | None = None):
    """The curate pipeline up to the song join with an ``Observation`` at each gate.

    Returns (joined DataFrame, {gate name: Observation}).  Values are available after an action on a plan
    that contains ``joined``.
    """
    obs = {name: Observation(name) for name in K.GATE_METRICS[:5]}
    one = F.count(F.lit(1))
    r = raw.observe(obs["RawCount"], one.alias("n"))
    d = C.drop_missing(r).observe(obs["AfterDropNaCount"], one.alias("n"))
    u = C.dedup_triplet(d, scope).observe(obs["AfterDedupCount"], one.alias("n"))
    t = C.parse_times(u).observe(obs["AfterTimestampParseCount"], one.alias("n"))
    j = C.join_songs(t, songs, max_rows).observe(obs["AfterSongsJoinCount"], one.alias("n"))
    return j, obs


def observed_counts(obs: dict) -> dict:
    counts = {k: int(o.get["n"]) for k, o in obs.items()}
    counts["UnmatchedSongsCount"] = counts["AfterTimestampParseCount"] - counts["AfterSongsJoinCount"]
    return counts
