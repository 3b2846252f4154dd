"""The pipeline's tables registered in Spark's catalog (bronze CSV, silver / gold Parquet)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakekpi import schemas as S
from lakekpi.plans.views import register_views

_STREAMS_DDL = "user_id INT, track_id STRING, listen_time STRING, landing_date STRING"
_SILVER_DDL = (
    "user_id INT, track_id STRING, track_name STRING, artists STRING, album_name STRING, genre STRING, "
    "listen_time STRING, listen_ts TIMESTAMP, duration_ms BIGINT, listen_seconds DOUBLE, user_country STRING, "
    "source_file STRING, ingested_at STRING, source_execution_id STRING, event_date DATE"
)
_GOLD_DDL = {
    "genre_kpis_daily": "genre STRING, listen_count BIGINT, unique_listeners BIGINT, total_listen_seconds DOUBLE, "
    "avg_listen_seconds_per_user DOUBLE, ingested_at STRING, source_execution_id STRING, date STRING",
    "top_songs_by_genre_daily": "genre STRING, track_id STRING, track_name STRING, play_count BIGINT, rank INT, "
    "genre_date STRING, ingested_at STRING, source_execution_id STRING, date STRING",
    "top_genres_daily": "genre STRING, listen_count BIGINT, rank INT, ingested_at STRING, source_execution_id STRING, "
    "date STRING",
}


def register_tables(spark: SparkSession, bronze: str, silver: str, gold: str, prefix: str = "", views: bool = True,
                    statistics: bool = False) -> list[str]:
    """Create databases and external tables over the lake folders (landed streams, the songs and users reference files,
    Silver and Gold) and the views on them; partitions are discovered by listing.  ``statistics`` stores each table's size, which the
    optimizer uses for join strategies."""
    names = []
    for db in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{db}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {prefix}bronze.streams ({_STREAMS_DDL}) USING CSV "
        f"OPTIONS (header 'true') PARTITIONED BY (landing_date) LOCATION '{bronze}/streams'"
    )
    names.append(f"{prefix}bronze.streams")
    for t, schema in (("songs", S.SONGS), ("users", S.USERS)):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}bronze.{t} ({ddl}) USING CSV OPTIONS (header 'true') LOCATION '{bronze}/reference/{t}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {prefix}silver.streams_curated ({_SILVER_DDL}) USING PARQUET "
        f"PARTITIONED BY (event_date) LOCATION '{silver}/streams_curated'"
    )
    names.append(f"{prefix}silver.streams_curated")
    for t, ddl in _GOLD_DDL.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}gold.{t} ({ddl}) USING PARQUET PARTITIONED BY (date) "
            f"LOCATION '{gold}/{t}'"
        )
        names.append(f"{prefix}gold.{t}")
    from lakekpi.plans.sinks import path_exists

    locations = [f"{bronze}/streams", f"{silver}/streams_curated", *[f"{gold}/{t}" for t in _GOLD_DDL]]
    for n, loc in zip(names, locations):
        if path_exists(spark, loc):  # discover the partitions already on storage
            spark.sql(f"MSCK REPAIR TABLE {n}")
    names += [f"{prefix}bronze.songs", f"{prefix}bronze.users"]
    if statistics:
        for n in names:
            spark.sql(f"ANALYZE TABLE {n} COMPUTE STATISTICS NOSCAN")
    if views:
        register_views(spark, {t: f"{prefix}gold.{t}" for t in _GOLD_DDL})
    return names
