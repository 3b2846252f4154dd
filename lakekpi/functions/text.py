"""String helpers for object keys, tags and composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakekpi import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Strip leading/trailing whitespace of every kind, Unicode blanks too (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def strip_quotes(col) -> Column:
    """Remove surrounding double quotes (an eTag arrives as ``"abc"``)."""
    return F.btrim(_c(col), F.lit('"'))


def is_stream_key(col) -> Column:
    """Admission predicate: a CSV under the stream landing prefix, never a manifest sidecar."""
    k = _c(col)
    return (
        k.isNotNull()
        & (F.length(k) > 0)
        & k.startswith(K.STREAM_PREFIX)
        & k.endswith(K.STREAM_SUFFIX)
        & ~k.startswith(K.MANIFEST_PREFIX)
    )


def extract_landing_date(col) -> Column:
    """Text between the first ``landing_date=`` and the next ``/``; empty string when the marker is absent."""
    return F.regexp_extract(_c(col), f"^.*?{K.LANDING_MARKER}([^/]*)", 1)


def extract_run_date(col) -> Column:
    """``YYYY-MM-DD`` after ``landing_date=``, or ``unknown``."""
    d = F.regexp_extract(_c(col), K.LANDING_DATE_PATTERN, 1)
    return F.when(d == "", F.lit(K.UNKNOWN)).otherwise(d)


def manifest_key(col) -> Column:
    """``streams/x`` -> ``streams/manifests/x.json``; any other key is prefixed as a whole."""
    k = _c(col)
    rest = F.when(k.startswith(K.STREAM_ROOT), F.substring(k, len(K.STREAM_ROOT) + 1, 1 << 30)).otherwise(k)
    return F.concat(F.lit(K.MANIFEST_PREFIX), rest, F.lit(".json"))


def truncate_tag(col) -> Column:
    return F.substring(_c(col), 1, K.TAG_MAX_LEN)


def composite_key(*cols) -> Column:
    """``a#b``; null parts are skipped (``concat_ws`` semantics)."""
    return F.concat_ws(K.KEY_SEPARATOR, *[_c(c) for c in cols])
