"""Dimension joins with a checked broadcast.

A dimension side is broadcast only after a bounded probe proved it has at most ``max_rows`` rows
(``limit(max_rows + 1).count()`` stops as soon as the bound is exceeded).  Beyond the bound the join stays a
shuffle join; adaptive execution then splits skewed fact partitions (one hot key may carry a third of the
rows) and may still switch to a broadcast from the measured shuffle size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension row here is a handful of short strings (< 200 bytes), so 1M rows stays well under 200 MB.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


_PROBED: dict[tuple[int, int], bool] = {}


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, remember: bool = True) -> bool:
    """Bounded row-count probe.  Answers are remembered per (plan, bound) for the life of the process, so a
    dimension used by several steps of one run is probed once; call ``forget_probes`` when inputs change."""
    key = (df.semanticHash(), max_rows)
    if remember and key in _PROBED:
        return _PROBED[key]
    ok = df.limit(max_rows + 1).count() <= max_rows
    if remember:
        _PROBED[key] = ok
    return ok


def forget_probes() -> None:
    _PROBED.clear()


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it provably holds at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def hot_keys(fact: DataFrame, key: str, share: float = 0.01, sample_fraction: float = 0.01, limit: int = 100,
             seed: int = 7) -> list:
    """Key values holding at least ``share`` of the fact rows, estimated on a sample (at most ``limit`` keys,
    so the list is bounded whatever the data size)."""
    sample = fact.select(key).sample(fraction=sample_fraction, seed=seed)
    total = sample.count()
    if total == 0:
        return []
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    top = counts.filter(F.col(key).isNotNull() & (F.col("_c") >= F.lit(max(1.0, share * total))))
    return [r[0] for r in top.orderBy(F.desc("_c")).limit(limit).collect()]  # distributed top-k, <= limit rows


def skew_split_join(fact: DataFrame, dim: DataFrame, key: str, how: str, hot: list) -> DataFrame:
    """Equi-join where the hot keys' fact rows meet a broadcast of only those keys' dimension rows, and all
    other rows take the shuffle join.  The hot dimension slice is bounded by the number of hot keys (each key
    is unique in a dimension), so its broadcast is safe; no task receives a hot key's rows through a shuffle."""
    if not hot:
        return fact.join(dim, on=key, how=how)
    k = F.col(key)
    is_hot = k.isin(hot)
    hot_part = fact.filter(is_hot).join(F.broadcast(dim.filter(is_hot)), on=key, how=how)
    cold_part = fact.filter(~is_hot | k.isNull()).join(dim.filter(~is_hot), on=key, how=how)
    return hot_part.unionByName(cold_part)


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str, max_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
                   skew_share: float | None = None) -> DataFrame:
    """Equi-join a fact to a dimension; the dimension is broadcast only behind the size check.

    Beyond the bound it is one shuffle join, whose skewed partitions adaptive execution splits by their measured sizes.  With
    ``skew_share``, keys carrying at least that share of the fact rows are split off and joined to a broadcast of their own
    dimension rows (``skew_split_join``): for facts that are cheap to read, as the fact is then computed four times (twice in
    search of hot keys, and for either branch).  ``max_rows=None`` skips the probe and leaves the strategy to the optimizer.
    """
    if max_rows is None:
        return fact.join(dim, on=on, how=how)
    if fits_broadcast(dim, max_rows):
        return fact.join(F.broadcast(dim), on=on, how=how)
    if skew_share is not None and isinstance(on, str):
        return skew_split_join(fact, dim, on, how, hot_keys(fact, on, skew_share))
    return fact.join(dim, on=on, how=how)
