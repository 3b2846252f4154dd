"""Exact decimal conversion for the serving tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lakekpi import constants as K

SERVING_DECIMAL = "decimal(38,18)"


def to_decimal(col, dtype=None, default: str = "0") -> Column:
    """Null, NaN, +-Infinity and the text tokens '', nan, inf, -inf, none, null (any case, stripped) -> default;
    anything else is the exact decimal of its text form.  Junk text raises (ANSI cast), as the reference does.

    ``dtype`` is the input column's Spark type when known; floating input is checked for non-finite values
    before the text conversion.
    """
    c = F.col(col) if isinstance(col, str) else col
    zero = F.lit(default).cast(SERVING_DECIMAL)
    text = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    is_token = F.lower(text).isin(K.DECIMAL_ZERO_TOKENS)
    out = F.when(c.isNull() | is_token, zero)
    if isinstance(dtype, (DoubleType, FloatType)):
        out = out.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), zero)
    return out.otherwise(text.cast(SERVING_DECIMAL))
