"""Time parsing and formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakekpi import constants as K


def parse_listen_ts(col) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` parse; null for anything else (never raises under ANSI)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(K.LISTEN_TIME_FORMAT))


def date_string(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, K.DATE_FORMAT)


def expires_at(loaded_at, days: int | Column) -> Column:
    """Epoch seconds ``days`` after ``loaded_at`` (a timestamp column)."""
    c = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
    d = days if isinstance(days, Column) else F.lit(days)
    return F.unix_seconds(c) + d.cast("long") * F.lit(86400)
