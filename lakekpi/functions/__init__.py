"""Column helpers built only from ``pyspark.sql.functions`` (JVM-side, codegen-friendly)."""

from lakekpi.functions.text import (  # noqa: F401
    composite_key,
    extract_landing_date,
    extract_run_date,
    is_stream_key,
    manifest_key,
    strip_quotes,
    strip_ws,
    truncate_tag,
)
from lakekpi.functions.time import date_string, parse_listen_ts, expires_at  # noqa: F401
from lakekpi.functions.decimal import to_decimal  # noqa: F401
