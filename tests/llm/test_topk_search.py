import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekpi.llm import topk_search as tk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("v", T.StringType()),
                       T.StructField("block", T.IntegerType())])


def brute(rows, k):
    ok = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 20 == 0:
            best = sorted((-int(a @ b), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def search(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, tk.top_k(df, F.col("vec_id") % 20 == 0, **more).collect()))


def test_equals_brute_force(llm):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.2, (600, 16)).astype(np.float32))]
    rows[40] = (40, rows[7][1])
    for i in range(100, 160):  # ties
        rows[i] = (i, rows[100][1])
    rows[200:205] = [(200, None), (201, [float("nan")] * 16), (202, [None] + [0.5] * 15), (None, [0.1] * 16), (204, [0.0] * 16)]
    rows[220] = (220, [0.0] * 16)
    for more in ({}, {"block_rows": 50, "query_rows": 7}):
        assert search(llm, rows, **more) == brute(rows, 20)


def test_few_rows_and_large_numbers(llm):
    rows = [(0, [1e6, -1e6]), (1, [1e6, 2e6]), (2, [-3e6, 1e6])]
    assert search(llm, rows) == brute(rows, 20)
    assert search(llm, []) == []


def test_reading_stops_early():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 10, (4000, 8)))
    x[:30] *= 6
    q = x[0]
    left = tk.SortedLists(x).best(q, 20)
    assert len(left) < 400 and set(np.argsort(-(x @ q), kind="stable")[:20]) <= set(left)


def test_many_queries_read_the_lists_once():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 8, (5000, 64)))
    x[100:140] = x[100]  # ties
    queries = np.concatenate([x[::100], np.zeros((1, 64)), x[:1] * 1e30])
    lists, depths = tk.SortedLists(x), []
    read = lists.read
    lists.read = lambda unread: depths.append(unread) or read(unread)
    scores = queries @ x.T
    known = np.sort(scores, axis=1)[:, -25]
    known[::2] = -np.inf
    for q, s, least, rows in zip(queries, scores, known, lists.best_of(queries, np.full(len(queries), 20), known)):
        floor = max(least, np.sort(s)[-20])
        assert set(np.flatnonzero(s >= floor)) <= set(rows)
        assert len(rows) <= 160 or not q.any()
    assert len(depths) <= len(tk.UNREAD)


def test_scores_held_at_the_least_long_give_no_bound(llm):
    rng = np.random.default_rng(4)
    rows = [(0, [1e15, 1e15])] + [(i, [-float(x), -1e15]) for i, x in enumerate(rng.integers(10**14, 10**16, 79), 1) if i % 20]
    found = search(llm, rows, block_rows=25)
    assert [r[2] for r in found] == [i for i, _ in rows[1:21]] and {r[3] for r in found} == {-2**63}
