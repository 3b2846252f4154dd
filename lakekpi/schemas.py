"""Fixed schemas of the pipeline tables (file-based sources are read with these, never inferred)."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

REQUIRED_FIELDS = ["user_id", "track_id", "listen_time"]
OPTIONAL_FIELDS: list[str] = []
TRIPLET = REQUIRED_FIELDS

STREAMS = StructType(
    [
        StructField("user_id", IntegerType(), True),
        StructField("track_id", StringType(), True),
        StructField("listen_time", StringType(), True),
    ]
)

_SONG_TEXT = [
    "explicit", "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "time_signature", "track_genre",
]
SONGS = StructType(
    [
        StructField("id", IntegerType(), True),
        StructField("track_id", StringType(), False),
        StructField("artists", StringType(), True),
        StructField("album_name", StringType(), True),
        StructField("track_name", StringType(), True),
        StructField("popularity", IntegerType(), True),
        StructField("duration_ms", LongType(), True),
    ]
    + [StructField(c, StringType(), True) for c in _SONG_TEXT]
)

USERS = StructType(
    [
        StructField("user_id", IntegerType(), False),
        StructField("user_name", StringType(), True),
        StructField("user_age", IntegerType(), True),
        StructField("user_country", StringType(), True),
        StructField("created_at", StringType(), True),
    ]
)

SONG_COLUMNS = ["track_id", "artists", "album_name", "track_name", "duration_ms", "track_genre"]
USER_COLUMNS = ["user_id", "user_country"]

CURATED_COLUMNS = [
    "user_id", "track_id", "track_name", "artists", "album_name", "genre", "listen_time", "listen_ts",
    "event_date", "duration_ms", "listen_seconds", "user_country",
]
LINEAGE_COLUMNS = ["source_file", "ingested_at", "source_execution_id"]

# Long-form metric samples (one row per emitted value).
METRICS = StructType(
    [
        StructField("ts", TimestampType(), True),
        StructField("namespace", StringType(), True),
        StructField("metric_name", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("unit", StringType(), True),
        StructField("dimensions", MapType(StringType(), StringType()), True),
    ]
)

DRIFT = MapType(StringType(), ArrayType(StringType()))
