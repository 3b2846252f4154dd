"""Keyed serving tables built from the Gold outputs.

A serving table is a Parquet table partitioned by its day column, keyed by (partition key, sort key).  Loading
is an idempotent upsert: for the days present in a batch, existing rows whose key is not in the batch are kept,
batch rows replace the rest (last writer wins); other days are not touched.  The merge reads only the affected
day partitions (partition pruning through a semi-join on the batch's small day list).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi import constants as K
from lakekpi.functions.decimal import to_decimal
from lakekpi.functions.time import expires_at
from lakekpi.operators.joins import sized_broadcast


@dataclass(frozen=True)
class ServingTable:
    name: str
    pk: str
    sk: str
    day_col: str
    ttl_days: int


GENRE_KPIS = ServingTable("genre_kpis_daily", "genre", "date", "date", K.TTL_DAYS["genre_kpis_daily"])
TOP_SONGS = ServingTable("top_songs_by_genre_daily", "genre_date", "rank", "date", K.TTL_DAYS["top_songs_by_genre_daily"])
TOP_GENRES = ServingTable("top_genres_daily", "date", "rank", "date", K.TTL_DAYS["top_genres_daily"])
DQ_REPORTS = ServingTable("dq_reports", "batch_id", "event_date", "event_date", K.TTL_DAYS["dq_reports"])


def _lineage(ingested_at, execution_id):
    return [
        F.lit(ingested_at or "unknown").alias("ingested_at"),
        F.lit(execution_id or "unknown").alias("source_execution_id"),
    ]


def _ttl(loaded_at: Column | None, table: ServingTable) -> Column:
    at = loaded_at if loaded_at is not None else F.current_timestamp()
    return expires_at(at, table.ttl_days).alias("expires_at")


def genre_kpi_items(gold: DataFrame, ingested_at=None, execution_id=None, loaded_at: Column | None = None) -> DataFrame:
    """Key (genre, date); counts as int; totals as exact decimals; the load run's lineage; TTL 90 days."""
    types = dict((f.name, f.dataType) for f in gold.schema.fields)
    return gold.select(
        "genre",
        "date",
        F.col("listen_count").cast("int").alias("listen_count"),
        F.col("unique_listeners").cast("int").alias("unique_listeners"),
        to_decimal("total_listen_seconds", types.get("total_listen_seconds")).alias("total_listen_seconds"),
        to_decimal("avg_listen_seconds_per_user", types.get("avg_listen_seconds_per_user")).alias("avg_listen_seconds_per_user"),
        *_lineage(ingested_at, execution_id),
        _ttl(loaded_at, GENRE_KPIS),
    )


def top_song_items(gold: DataFrame, ingested_at=None, execution_id=None, loaded_at: Column | None = None) -> DataFrame:
    """Key (genre_date, rank)."""
    return gold.select(
        "genre_date",
        F.col("rank").cast("int").alias("rank"),
        "track_id",
        "track_name",
        F.col("play_count").cast("int").alias("play_count"),
        *_lineage(ingested_at, execution_id),
        _ttl(loaded_at, TOP_SONGS),
        "date",
    )


def top_genre_items(gold: DataFrame, ingested_at=None, execution_id=None, loaded_at: Column | None = None) -> DataFrame:
    """Key (date, rank)."""
    return gold.select(
        "date",
        F.col("rank").cast("int").alias("rank"),
        "genre",
        F.col("listen_count").cast("int").alias("listen_count"),
        *_lineage(ingested_at, execution_id),
        _ttl(loaded_at, TOP_GENRES),
    )


def upsert(existing: DataFrame, batch: DataFrame, table: ServingTable, replace_days: bool = False) -> DataFrame:
    """E5: merged rows of the days present in ``batch``.

    Last writer wins per (pk, sk); keys absent from the batch are kept unless ``replace_days`` (then the
    batch's days are replaced whole, dropping stale ranks).  The result holds only the affected days, ready for
    a dynamic partition overwrite.
    """
    days = batch.select(table.day_col).distinct()
    touched = existing.join(sized_broadcast(days), table.day_col, "left_semi")
    if replace_days:
        return batch
    kept = touched.join(batch.select(table.pk, table.sk), [table.pk, table.sk], "left_anti")
    return kept.unionByName(batch).select(*batch.columns)


def merged_view(existing: DataFrame, batch: DataFrame, table: ServingTable, replace_days: bool = False) -> DataFrame:
    """The whole table after the upsert (untouched days + merged days)."""
    days = batch.select(table.day_col).distinct()
    untouched = existing.join(sized_broadcast(days), table.day_col, "left_anti")
    return untouched.unionByName(upsert(existing, batch, table, replace_days)).select(*batch.columns)


def prune_expired(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows whose ``expires_at`` (epoch seconds) is still in the future."""
    t = now if now is not None else F.current_timestamp()
    return df.filter(F.col("expires_at") > F.unix_seconds(t))


# E7 key lookups ------------------------------------------------------------------------------------


def genre_days(items: DataFrame, genre: str) -> DataFrame:
    """All days of one genre (partition-key query)."""
    return items.filter(F.col("genre") == genre).orderBy("date")


def genre_day(items: DataFrame, genre: str, date: str) -> DataFrame:
    return items.filter((F.col("genre") == genre) & (F.col("date") == date))


def songs_of_genre_date(items: DataFrame, genre_date: str) -> DataFrame:
    return items.filter(F.col("genre_date") == genre_date).orderBy("rank")


def genres_of_date(items: DataFrame, date: str) -> DataFrame:
    return items.filter(F.col("date") == date).orderBy("rank")
