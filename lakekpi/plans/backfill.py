"""Backfill (J3), late-data rebuild (J4) and full recompute (J6) as single Spark jobs over date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.operators import aggregate as D
from lakekpi.operators.admission import admit, first_per_content
from lakekpi.operators.joins import sized_broadcast
from lakekpi.operators.validate import route, validate
from lakekpi.plans.gold import run_gold
from lakekpi.plans.silver import run_silver
from lakekpi.plans.sinks import stage
from lakekpi.sources.csv_scan import read_batches, typed_streams
from lakekpi.sources.listing import list_objects


def in_range(silver: DataFrame, start: str, end: str, day_col: str = "event_date") -> DataFrame:
    """Silver rows of [start, end]; on a partitioned Silver table this is partition pruning."""
    d = F.col(day_col)
    return silver.filter((d >= F.to_date(F.lit(start))) & (d <= F.to_date(F.lit(end))))


def backfill_kpis(silver: DataFrame, start: str, end: str) -> dict[str, DataFrame]:
    """The three Gold tables for every day of the range in one pass per table."""
    s = in_range(silver, start, end)
    kpis = D.genre_kpis(s)
    return {
        "genre_kpis_daily": kpis,
        "top_songs_by_genre_daily": D.top_songs(s),
        "top_genres_daily": D.top_genres(s),
    }


def recompute(spark: SparkSession, landing: str, silver: str, gold: str, songs: DataFrame, users: DataFrame,
              execution_id: str = "recompute", max_drop_rate: float = K.MAX_DROP_RATE) -> list[str]:
    """Rebuild Silver and Gold (new, empty folders) from every landed stream file, one per content, read and validated as
    in a run, so that files which a run would not take are left out; the days written."""
    files = first_per_content(admit(list_objects(spark, landing))).select("path").collect()  # readers take paths
    found, records = read_batches(spark, landing, [r.path for r in files])
    records = stage(records, "records")
    good, _ = route(validate(stage(found, "files"), records), records)
    days = run_silver(spark, typed_streams(good), songs, users, silver, execution_id=execution_id, max_drop_rate=max_drop_rate).days
    run_gold(spark, silver, gold, days, execution_id=execution_id)
    return days


def affected_days(late_curated: DataFrame, day_col: str = "event_date") -> DataFrame:
    return late_curated.select(day_col).distinct()


def rebuild_days(all_curated: DataFrame, days: DataFrame, day_col: str = "event_date") -> DataFrame:
    """Silver rows of the days a late batch touched (all files of those days, re-curated together)."""
    return all_curated.join(sized_broadcast(days), day_col, "left_semi")
