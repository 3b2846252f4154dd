"""Analyst views over the Gold tables (lineage and internal keys hidden)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_SQL = {
    "v_genre_kpis": (
        "SELECT genre, date, listen_count, unique_listeners, "
        "round(total_listen_seconds / 3600.0, 2) AS total_listen_hours, "
        "round(avg_listen_seconds_per_user, 1) AS avg_listen_secs_per_user FROM {genre_kpis_daily}"
    ),
    "v_top_songs": "SELECT genre, date, rank, track_id, track_name, play_count FROM {top_songs_by_genre_daily}",
    "v_top_genres": "SELECT date, rank, genre, listen_count FROM {top_genres_daily}",
}


_TABLE_OF = {"v_genre_kpis": "genre_kpis_daily", "v_top_songs": "top_songs_by_genre_daily", "v_top_genres": "top_genres_daily"}


def view(name: str, gold: DataFrame) -> DataFrame:
    """The view's SQL over a Gold table given as a DataFrame."""
    return gold.sparkSession.sql(VIEW_SQL[name].format(**{_TABLE_OF[name]: "{gold}"}), gold=gold)


def register_views(spark: SparkSession, tables: dict[str, str] | None = None) -> list[str]:
    """Create the three views as SQL views over the named Gold tables (catalog tables or temp views)."""
    names = {
        "genre_kpis_daily": "genre_kpis_daily",
        "top_songs_by_genre_daily": "top_songs_by_genre_daily",
        "top_genres_daily": "top_genres_daily",
        **(tables or {}),
    }
    for view, sql in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS " + sql.format(**names))
    return list(VIEW_SQL)
