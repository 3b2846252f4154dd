"""Fixed values that must equal the reference pipeline's for identical results.

Fixed values (kept together, in natural order):
"""

# --- fixed values: object-key layout -------------------------------------------------------------
STREAM_PREFIX = "streams/landing_date="
MANIFEST_PREFIX = "streams/manifests/"
STREAM_ROOT = "streams/"
STREAM_SUFFIX = ".csv"
LANDING_MARKER = "landing_date="
LANDING_DATE_PATTERN = r"landing_date=(\d{4}-\d{2}-\d{2})"
QUARANTINE_PREFIX = "bronze/"
UNKNOWN = "unknown"
TAG_MAX_LEN = 256

# --- fixed values: parsing -----------------------------------------------------------------------
LISTEN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
KEY_SEPARATOR = "#"
DECIMAL_ZERO_TOKENS = ["", "nan", "inf", "-inf", "none", "null"]
EMPTY_FILE_ERROR = "CSV contains no data rows"
MISSING_FIELD_ERROR = "Row {n}: missing required field '{f}'"
FIRST_DATA_ROW = 2
MAX_REPORTED_ERRORS = 20

# --- fixed values: messages ---------------------------------------------------------------------
MISSING_COORDINATES_ERROR = "Missing bucket or key"
MISSING_KEY_ERROR = "Missing key"
READ_FAILED_ERROR = "Failed to read object: {exc}"
REFERENCE_MISSING_ERROR = "Reference data {name} is empty or missing at {path}"

# --- fixed values: thresholds and defaults -------------------------------------------------------
MAX_DROP_RATE = 0.10
TOP_SONGS_N = 3
TOP_GENRES_N = 5
DEDUPE_WINDOW_DAYS = 90
MAX_RETRY_ATTEMPTS = 2
MAX_EVENT_AGE_SECONDS = 3600
DEAD_LETTER_RETENTION_DAYS = 14
PARTITION_PROJECTION_START = "2024-01-01"

# --- fixed values: serving-table time-to-live in days ---------------------------------------------
TTL_DAYS = {
    "genre_kpis_daily": 90,
    "top_songs_by_genre_daily": 365,
    "top_genres_daily": 365,
    "dq_reports": 30,
}

# --- fixed values: storage retention in days ------------------------------------------------------
RETENTION_DAYS = {
    "streams": 365,
    "quarantine": 90,
    "archive": 2555,
    "results": 14,
}

# Our own texts and labels (not fixed values; change freely).
DROP_RATE_ERROR = "{raw} raw rows became {final}: {rate:.1%} were lost, {limit:.1%} is allowed"
POISON_ERROR = "{n} unreadable Parquet file(s) in the partitions to read: {paths}"
ARCHIVE_ERROR = "copies of {n} file(s) differ from their sources: {keys}"
METRIC_NAMESPACE = "lakekpi/DQ"

# --- fixed values: metric names -------------------------------------------------------------------
SILVER_JOB = "silver_etl"
GOLD_JOB = "gold_etl"
LOAD_JOB = "ddb_etl"
GATE_METRICS = [
    "RawCount",
    "AfterDropNaCount",
    "AfterDedupCount",
    "AfterTimestampParseCount",
    "AfterSongsJoinCount",
    "UnmatchedSongsCount",
]
DROP_RATE_METRIC = "DropRatePct"
GOLD_METRICS = ["GenreKpisRows", "TopSongsRows", "TopGenresRows"]
LOAD_METRICS = ["GenreKpisLoaded", "TopSongsLoaded", "TopGenresLoaded"]
