"""Silver curation: clean, de-duplicate, parse, enrich with the song and user dimensions.

Scale notes: the de-duplication is a hash aggregate with map-side combine, so a batch where one triplet is
copied millions of times collapses before the shuffle.  The song join (inner) and user join (left) are
dimension joins; see ``operators.joins`` for the broadcast bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi import schemas as S
from lakekpi.functions.time import parse_listen_ts
from lakekpi.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_dimension


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows with a null user_id, track_id or listen_time are dropped."""
    return df.dropna(subset=S.TRIPLET)


def dedup_triplet(df: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """One row per (user_id, track_id, listen_time) — per ``scope`` (e.g. ``["source_file"]`` to keep the
    de-duplication inside each batch file when several files are curated together)."""
    return df.dropDuplicates([*(scope or []), *S.TRIPLET])


def parse_times(df: DataFrame) -> DataFrame:
    """``listen_ts`` from the strict format; unparseable rows dropped."""
    return df.withColumn("listen_ts", parse_listen_ts("listen_time")).dropna(subset=["listen_ts"])


def clean_streams(df: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """C4 = C1 then C2 then C3."""
    return parse_times(dedup_triplet(drop_missing(df), scope))


def select_songs(df: DataFrame) -> DataFrame:
    """C5."""
    return df.select(*S.SONG_COLUMNS)


def select_users(df: DataFrame) -> DataFrame:
    """C6."""
    return df.select(*S.USER_COLUMNS)


def join_songs(streams: DataFrame, songs: DataFrame, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join on track_id; unmatched listens dropped, duplicate song keys fan out."""
    return join_dimension(streams, select_songs(songs), "track_id", "inner", max_rows)


def join_users(streams: DataFrame, users: DataFrame, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join on user_id; unknown users kept with a null country."""
    return join_dimension(streams, select_users(users), "user_id", "left", max_rows)


def _derived() -> dict[str, Column]:
    """C9-C11 by name: the listen's day, the genre in one spelling, the track length in seconds."""
    return {"event_date": F.col("listen_ts").cast("date"), "genre": F.lower(F.trim("track_genre")),
            "listen_seconds": F.col("duration_ms") / F.lit(1000.0)}


def enrich(df: DataFrame) -> DataFrame:
    """C9-C11 added to the joined listens."""
    return df.withColumns(_derived())


def with_lineage(df: DataFrame, source_file=None, ingested_at=None, execution_id=None) -> DataFrame:
    """Lineage columns; ``source_file=None`` takes each row's input file when the scan exposes it."""
    if source_file is not None:
        src = F.lit(source_file)
    elif "source_file" in df.columns:
        src = F.col("source_file")
    else:
        src = F.lit(None).cast("string")
    return (
        df.withColumn("source_file", src)
        .withColumn("ingested_at", F.lit(ingested_at or "unknown"))
        .withColumn("source_execution_id", F.lit(execution_id or "unknown"))
    )


def build_curated(
    cleaned: DataFrame,
    songs: DataFrame,
    users: DataFrame,
    lineage: bool = False,
    source_file=None,
    ingested_at=None,
    execution_id=None,
    max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Song join, user join, derived columns and the fixed Silver projection (+ lineage when asked)."""
    derived = _derived()
    joined = join_users(join_songs(cleaned, songs, max_rows), users, max_rows)
    if lineage:
        joined = with_lineage(joined, source_file, ingested_at, execution_id)
    # the whole projection in one select: derived columns by formula, the others by name
    return joined.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in S.CURATED_COLUMNS + S.LINEAGE_COLUMNS * lineage])


def curate(raw: DataFrame, songs: DataFrame, users: DataFrame, scope: list[str] | None = None, **kw) -> DataFrame:
    """Raw batch -> Silver rows (C4 + C13)."""
    return build_curated(clean_streams(raw, scope), songs, users, **kw)
