"""The load job: Gold days -> keyed serving tables with idempotent upserts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.operators import metrics as M
from lakekpi.operators import serve as E
from lakekpi.plans import sinks
from lakekpi.plans.gold import gold_table, read_gold
from lakekpi.sources.files import open_fs
from lakekpi.sources.partitions import with_text_day
from lakekpi.sources.probe import assert_readable


@dataclass
class LoadResult:
    counts: dict
    metrics: DataFrame | None = field(default=None, repr=False)


def serving_table(serving_root: str, t: E.ServingTable) -> str:
    return f"{serving_root.rstrip('/')}/{t.name}"


def run_load(spark: SparkSession, gold_root: str, serving_root: str, days: list[str], ingested_at: str | None = None,
             execution_id: str | None = None, loaded_at: Column | None = None, replace_days: bool = False,
             run_date: str | None = None) -> LoadResult:
    """Probe the Gold day folders (naming every unreadable file), then upsert the three serving tables."""
    if sinks.path_exists(spark, gold_root):
        assert_readable(spark, gold_root, partition_col="date", values=days)  # one probe over all three tables
    plan = [
        (E.GENRE_KPIS, E.genre_kpi_items, "genre_kpis_daily", "GenreKpisLoaded"),
        (E.TOP_SONGS, E.top_song_items, "top_songs_by_genre_daily", "TopSongsLoaded"),
        (E.TOP_GENRES, E.top_genre_items, "top_genres_daily", "TopGenresLoaded"),
    ]
    counts = {}
    for table, build, gold_name, metric in plan:
        items = build(read_gold(spark, gold_root, gold_name, days), ingested_at, execution_id, loaded_at)
        n_batch, _ = sinks.upsert_partitions(items, serving_table(serving_root, table), [table.pk, table.sk],
                                             table.day_col, replace_days, n_values=len(days))
        counts[metric] = n_batch
    label = run_date or (min(days) if days else "unknown")
    return LoadResult(counts, M.counts_to_metrics(spark, counts, K.LOAD_JOB, label, both_granularities=True))


def _drop_day_folders(path: str, day_col: str, days: list[str]) -> None:
    """Remove day folders that no longer hold any row (dynamic overwrite cannot replace a day with nothing)."""
    fs, base = open_fs(path)
    for d in days:
        try:
            fs.delete_dir(f"{base}/{day_col}={d}")
        except FileNotFoundError:
            pass


def prune_serving(spark: SparkSession, serving_root: str, now: Column | None = None) -> dict:
    """Drop expired rows of every serving table; only days holding expired rows are rewritten."""
    out = {}
    t_now = now if now is not None else F.current_timestamp()
    for t in (E.GENRE_KPIS, E.TOP_SONGS, E.TOP_GENRES, E.DQ_REPORTS):
        path = serving_table(serving_root, t)
        if not sinks.table_exists(spark, path):
            continue
        df = with_text_day(spark.read.parquet(path), t.day_col)
        stale = df.filter(F.col("expires_at") <= F.unix_seconds(t_now)).select(t.day_col).distinct()
        stale_days = [r[0] for r in stale.collect()]  # one row per day
        if not stale_days:
            continue
        keep = sinks.stage(E.prune_expired(df.filter(F.col(t.day_col).isin(stale_days)), t_now), "prune")
        kept_days = {r[0] for r in with_text_day(keep, t.day_col).select(t.day_col).distinct().collect()}
        if kept_days:
            sinks.write_partitions(keep, path, [t.day_col], observe=False, n_values=len(stale_days))
        emptied = [d for d in stale_days if d not in kept_days]
        _drop_day_folders(path, t.day_col, emptied)
        out[t.name] = {"days": len(stale_days), "emptied": len(emptied)}
    return out
