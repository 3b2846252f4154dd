"""Exact top-k inner products by no-random-access aggregation over sorted component lists.

Vectors are turned to integers and dealt into blocks of bounded size; every query block meets every candidate block.
Inside a block each component has a list of its values in order, read from the end that its query weight prefers.
All lists are read in step.  A candidate's lower bound is the sum of what was read of it plus, for each list in which
it has not come up, that list's last value; its upper bound takes the value reached in that list instead.  Reading
stops when only a small part of the candidates has an upper bound that reaches the k-th best lower bound, so neither
unseen nor seen outsiders can qualify; the scores of those left are then resolved.  The first block's k-th best score
is a lower bound for all other blocks, which lets them stop much earlier.  Ties at the bound are kept, and
the blocks' lists are merged by (score, smaller id), which makes the result exact.

How far a list is read does not depend on the query, only its end does.  So what is read of a block down to a depth is
the same for all queries: one matrix for either end, and the bounds of many queries are two matrix products.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors of different
lengths are filled up with zeros; rows with a null id take no part; repeated rows of an id are candidates each on
their own (and no candidate for their own id); scores beyond 64 bits are held at the largest long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
UNREAD = (2, 4, 8, 16, 32)  # the lists are read up to these parts of them, bounds are compared after each
RESOLVE = 64  # reading stops when this part of a block's rows is left; their scores are then resolved
TOGETHER = 128  # queries whose bounds are held at a time
LIMIT = 2**63 - 1


def _matrix(rows: pd.Series, dim: int) -> np.ndarray:
    """Integer vectors as one matrix, filled up with zeros."""
    if len(rows) and (rows.map(len) == dim).all():
        return np.concatenate(rows.to_numpy()).reshape(len(rows), dim)
    m = np.zeros((len(rows), dim), np.float64)
    for i, r in enumerate(rows):
        m[i, :len(r)] = r
    return m


class SortedLists:
    """The component lists of a block: ids of its rows in order of each component, smallest value first."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.unit = np.abs(x).max(initial=0.0) or 1.0  # bounds are taken in single precision, of numbers up to 1
        self.ids = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x / self.unit, self.ids, 0).astype(np.float32)
        self.largest = np.abs(self.values).max(axis=0, initial=0.0).astype(float)

    def read(self, unread: int) -> tuple[np.ndarray, np.ndarray]:
        """What is known of each row when all but ``unread`` entries of each list were read: least and most that its
        components are worth, side by side for lists read from their large and from their small end."""
        n, dim = self.x.shape
        low, up = np.empty((2, n, 2 * dim), np.float32)
        for at, end, last, edge in ((slice(0, dim), slice(unread, n), 0, unread),
                                    (slice(dim, 2 * dim), slice(0, n - unread), n - 1, n - unread - 1)):
            low[:, at], up[:, at] = self.values[last], self.values[edge]
            for m in (low[:, at], up[:, at]):
                np.put_along_axis(m, self.ids[end], self.values[end], 0)
        return low, up

    def best(self, q: np.ndarray, k: int, known: float = -np.inf) -> np.ndarray:
        """Rows that hold all of the k best scores for ``q`` (ties included) that are not below ``known``."""
        return self.best_of(q[None], np.array([k]), np.array([known], float))[0]

    def best_of(self, queries: np.ndarray, k: np.ndarray, known: np.ndarray) -> list[np.ndarray]:
        """``best`` for each of many queries."""
        n, found = len(self.x), [np.arange(len(self.x))] * len(queries)
        wide = int(k.max(initial=0))
        if n <= wide:
            return found
        largest = np.abs(queries).max(axis=1, initial=0.0)
        open_ = np.flatnonzero(largest > 0)  # all rows are equal to a query of zeros
        unit = np.where(largest > 0, largest, 1.0)
        w = queries / unit[:, None]
        floor = known / (self.unit * unit)
        # products of 2 * dim numbers, each rounded, and their sums: more than their rounding
        slack = (2 * queries.shape[1] + 8) * 2.0 ** -24 * (np.abs(w) @ self.largest) * 2 + 1e-30
        sides = np.concatenate([np.maximum(w, 0), np.minimum(w, 0)], 1).astype(np.float32)
        enough = max(8 * wide, n // RESOLVE)
        for part in UNREAD:
            if not len(open_) or n // part < 1:
                break
            low, up = self.read(n // part)
            still = []
            for at in range(0, len(open_), TOGETHER):
                some = open_[at:at + TOGETHER]
                most = sides[some] @ up.T
                left = most >= (floor[some] - slack[some]).astype(np.float32)[:, None]
                many = np.flatnonzero(left.sum(axis=1) > enough)
                if len(many):  # the bound is not known well enough: take it from this block
                    at_least = np.partition(sides[some[many]] @ low.T, n - wide, axis=1)[:, n - wide]
                    floor[some[many]] = np.maximum(floor[some[many]], at_least - slack[some[many]])
                    left[many] = most[many] >= (floor[some[many]] - slack[some[many]]).astype(np.float32)[:, None]
                count = left.sum(axis=1)
                for i, c, rows in zip(some, count, left):
                    found[i] = np.flatnonzero(rows)
                still.append(some[count > enough])
            open_ = np.concatenate(still)
        return found


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    bound = np.abs(x).max(initial=0.0) * np.abs(q).max(initial=0.0) * max(1, len(q))
    if bound < 2**53:
        return (x @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, q)) for r in x]
    return np.array([max(-LIMIT - 1, min(LIMIT, s)) for s in exact], np.int64)


def _meet(k: int):
    def meet(cand: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(cand) and len(queries):
            dim = int(max(cand.v.map(len).max(), queries.v.map(len).max()))
            x, ids = _matrix(cand.v, dim), cand.vec_id.to_numpy()
            lists = SortedLists(x)
            q_ids, q_rows = queries.vec_id.to_numpy(), _matrix(queries.v, dim)
            # held scores say nothing of what lies beyond 64 bits
            floors = np.minimum(queries.floor.to_numpy(float, na_value=-np.inf), LIMIT)
            floors[floors <= -LIMIT] = -np.inf
            # one more than k for each row of the query's own id, which is no candidate
            own = pd.Series(ids).value_counts().reindex(q_ids, fill_value=0).to_numpy()
            for qid, q, rows in zip(q_ids, q_rows, lists.best_of(q_rows, k + own, floors)):
                rows = rows[ids[rows] != qid]
                score = _scores(x[rows], q)
                top = np.lexsort((ids[rows], ~score))[:k]  # ~ turns the order round without overflow
                out["query_id"].append(np.full(len(top), qid))
                out["vec_id"].append(ids[rows][top])
                out["score"].append(score[top])
        cols = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}
        return pd.DataFrame(cols)

    return meet


def top_k(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: int = 64,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k best inner products of floor(scale * x) for each row where ``is_query`` holds, against all other rows.

    Blocks are groups of at most about ``block_rows`` candidates and ``query_rows`` queries; their numbers follow
    the row counts.
    """
    parts = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    rows = stage(vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
                 .select(F.col(id_col).cast("long").alias("vec_id"), parts.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")), "tk-rows")
    count = rows.agg(F.count(F.lit(1)), F.sum(F.col("q").cast("long"))).first()
    blocks, teams = max(1, -(-count[0] // block_rows)), max(1, -(-(count[1] or 0) // query_rows))

    def dealt(name, n, salt):
        return F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(n)).cast("int").alias(name)

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cand = rows.select("vec_id", "v", dealt("block", blocks, 1))
    # aliases: the two sides of a cogroup must not share columns
    queries = rows.where("q").select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), dealt("team", teams, 2)).distinct()

    def meet(cand, queries, first, last):
        """Every query block against the candidate blocks first..last."""
        some = cand.where(F.col("block").between(first, last)).withColumn("team", every(teams))
        wide = queries.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last))))
        return some.groupBy("block", "team").cogroup(wide.groupBy("block", "team")).applyInPandas(
            _meet(k), "query_id long, vec_id long, score long")

    found = meet(cand, queries.withColumn("floor", F.lit(None).cast("double")), 0, 0)
    if blocks > 1:  # the k-th best of the first block is a bound from the start for the others
        found = stage(found, "tk-first")
        floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.min("score").cast("double").alias("floor"), F.count(F.lit(1)).alias("n"))
        floors = floors.select("vec_id", F.when(F.col("n") >= k, F.col("floor")).alias("floor"))
        found = found.union(meet(cand, queries.join(floors, "vec_id", "left"), 1, blocks - 1))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best neighbours of every vector whose id is divisible by 20."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
           from embeddings where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
     s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
           from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20
"""
