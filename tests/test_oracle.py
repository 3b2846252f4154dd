"""Registered queries vs their DuckDB oracles at sf0.001 (a representative subset; tools/compare.py runs all)."""

import math

import duckdb
import pytest

from tests.conftest import SF

SUBSET = ["curated_streams", "genre_kpis_daily", "top_songs_by_genre_daily", "top_genres_daily", "dq_gates",
          "validation_errors", "manifest", "serving_upsert", "alarm_states", "dedupe_files", "missing_days",
          "late_rebuild", "retention_prune", "bounded_sample"]


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    from lakekpi.registry import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted("|".join(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
