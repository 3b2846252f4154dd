"""The Gold job: three KPI tables for the given days."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.operators import aggregate as D
from lakekpi.operators import metrics as M
from lakekpi.plans import sinks
from lakekpi.plans.silver import silver_table
from lakekpi.sources.partitions import read_days, with_text_day

GOLD_TABLES = ("genre_kpis_daily", "top_songs_by_genre_daily", "top_genres_daily")


@dataclass
class GoldResult:
    counts: dict
    metrics: DataFrame | None = field(default=None, repr=False)


def gold_table(gold_root: str, name: str) -> str:
    return f"{gold_root.rstrip('/')}/{name}"


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, days: list[str], ingested_at: str | None = None,
             execution_id: str | None = None, run_date: str | None = None) -> GoldResult:
    """Aggregate every given day (a batch may span several days) and replace those day partitions.

    Silver is scanned twice with column pruning (KPIs; top songs); the top genres are ranked from the
    KPI table just written, so the third ranking never rescans Silver.
    """
    silver = read_days(spark, silver_table(silver_root), days)
    kpis = D.with_run_lineage(D.genre_kpis(silver), ingested_at, execution_id)
    n_kpis = sinks.write_partitions(kpis, gold_table(gold_root, "genre_kpis_daily"), ["date"], n_values=len(days))
    songs = D.with_run_lineage(D.top_songs(silver), ingested_at, execution_id)
    n_songs = sinks.write_partitions(songs, gold_table(gold_root, "top_songs_by_genre_daily"), ["date"],
                                     n_values=len(days))
    written = with_text_day(read_days(spark, gold_table(gold_root, "genre_kpis_daily"), days, "date", check=False))
    genres = D.with_run_lineage(D.top_genres_from_counts(written), ingested_at, execution_id)
    n_genres = sinks.write_partitions(genres, gold_table(gold_root, "top_genres_daily"), ["date"], n_values=len(days))
    counts = dict(zip(K.GOLD_METRICS, (n_kpis, n_songs, n_genres)))
    label = run_date or (min(days) if days else "unknown")
    return GoldResult(counts, M.counts_to_metrics(spark, counts, K.GOLD_JOB, label))


def read_gold(spark: SparkSession, gold_root: str, name: str, days: list[str] | None = None) -> DataFrame:
    path = gold_table(gold_root, name)
    df = read_days(spark, path, days, "date", check=False) if days else spark.read.parquet(path)
    return with_text_day(df)
