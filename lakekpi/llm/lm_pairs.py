"""Pair features of the words outside the head, in tables that grow with the corpus.

Within a rest class k,

    P(word | k, word before) = (c + 0.5) exp(theta) / Z,    Z = z + sum over the group's pairs of (c + 0.5) (exp(theta) - 1)

where c is the word's count, z the class's total of c + 0.5 with one share for unseen words, and theta the weight of the
pair (word before, word).  The group of a token is (word before, k).  Pairs of at least ``LEAST`` occurrences in the training
documents have a weight, all others weigh 0: a feature cutoff, not a cap, so the table grows with the corpus.

All pairs of a group lie in one range of group hashes; a range has about ``RANGE`` training tokens, so their number
grows with the corpus.  Tasks send pairs in blocks, one for each range, equal pairs added up before.  Since a rest word is rarer
than each of the head's, and its pairs rarer still, no pair is hot; equal ones of a group collapse as they arrive.
Weights are the maximum of the log likelihood less ``DECAY`` / 2 * theta ** 2, found by gradient steps scaled by the
expected counts, all ranges at once.  In the table a group is its range and 32 bits more, a pair another 32.  Scoring sends every token's group and pair to its range and gets log10 values back,
added up by document; nothing of the tables' size is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import stage

LEAST = 2
RANGE = 2_000_000  # training tokens of a range, about
STEPS, MOVE, DECAY = 30, 1.0, 0.1
HELD = 1_000_000  # pairs that a task gathers before it adds equal ones up
START = np.uint64(0x5BD1E9955BD1E900)  # stands before a document's first token
CLASS_BITS = np.uint64(127)
LOW = np.uint64(0xFFFFFFFF)


class Finder:
    """Places of 64-bit hashes in an ascending table, by their leading bits."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.shift = np.uint64(64 - max(1, min(20, len(table).bit_length())))
        self.start = np.searchsorted(table >> self.shift, np.arange((1 << int(64 - self.shift)) + 1, dtype=np.uint64))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not in the table."""
        lead = (h >> self.shift).astype(np.int64)
        at, stop, out = self.start[lead], self.start[lead + 1], np.full(len(h), -1)
        todo = np.flatnonzero(at < stop)
        while len(todo):
            hit = self.table[at[todo]] == h[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < stop[todo]]
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def groups(h: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the group (word before, class) of the tokens at ``at``."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[off[:-1]] = START
    return _mix(before[at] * np.uint64(0x9E3779B97F4A7C15) + (h[at] & CLASS_BITS))


def pair_keys(g: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of a pair within its range: 32 bits of the group's hash, 32 of the pair's; zeros in place of these are the group's."""
    return g << np.uint64(32) | _mix(g ^ (w * np.uint64(0xD6E8FEB86659FD93))) & LOW | np.uint64(1)


def range_of(g: np.ndarray, ranges: int) -> np.ndarray:
    return ((g >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _add_up(g: np.ndarray, w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs in order of their range, equal ones added up."""
    order = np.argsort(g & ~LOW | _mix(g ^ w) & LOW)
    g, w, n = g[order], w[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])[:len(g)])
    return g[first], w[first], np.add.reduceat(n, first) if len(first) else n


def _blocks(k: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row for each range in ``k`` (ascending): the range and the bytes of its part of every column."""
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])[:len(k)])
    ends = np.append(cut[1:], len(k))
    return pa.RecordBatch.from_arrays(
        [pa.array(k[cut], pa.int64())] + [pa.array([c[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()) for c in columns],
        names=["k"] + [f"x{i}" for i in range(len(columns))])


def _by_range(batches):
    """(range, list of its rows so far, whether it is complete) of rows in order of range; a list may be emptied by the caller."""
    k, rows = None, []
    for b in batches:
        for i, at in enumerate(b.column(0).to_pylist()):
            if k is not None and at != k:
                yield k, rows, True
                rows = []
            k = at
            rows.append([c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for c in b.columns[1:]])
            yield k, rows, False
    if k is not None:
        yield k, rows, True


def count_pairs(docs: DataFrame, shared, tokens, ranges: int, parts: int) -> DataFrame:
    """(k, g, w, n, total, c) of the pairs that have a weight: range, group, word, counts of pair, group and word (0: not among the
    model's known words).  ``tokens`` gives a text column's token hashes and offsets."""
    def run(batches):
        m, held, size = shared.value, [], 0
        for b in batches:
            h, off = tokens(b.column(0))
            if len(h):
                at = np.flatnonzero(m.in_rest(h))
                held.append((groups(h, off, at), h[at], np.ones(len(at), np.int64)))
                size += len(at)
            if size > HELD:
                g, w, n = _add_up(*map(np.concatenate, zip(*held)))
                yield _blocks(range_of(g, ranges), g, w, n.astype(np.uint32))
                held, size = [], 0
        if size:
            g, w, n = _add_up(*map(np.concatenate, zip(*held)))
            yield _blocks(range_of(g, ranges), g, w, n.astype(np.uint32))

    def add(batches):
        m = shared.value
        kept, size = None, 0
        for k, rows, whole in _by_range(batches):
            if not whole:
                size += rows[-1][0].size // 8
                if size < 4 * HELD:
                    continue
            parts = [(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), np.frombuffer(c, np.uint32).astype(np.int64)) for a, b, c in rows]
            kept = _add_up(*map(np.concatenate, zip(*(parts if kept is None else [kept, *parts]))))
            rows.clear()
            size = 0
            if whole:
                order = np.argsort(kept[0])  # by group; each pair is there once
                g, w, n = (x[order] for x in kept)
                kept = None
                new = np.concatenate([[True], g[1:] != g[:-1]])
                total = np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1]
                hit = np.flatnonzero(n >= LEAST)
                for i in range(0, len(hit), 1 << 17):
                    j = hit[i:i + (1 << 17)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(j), k)), pa.array(g[j].view(np.int64)), pa.array(w[j].view(np.int64)), pa.array(n[j]), pa.array(total[j]),
                         pa.array(m.look(w[j])[0])], names=["k", "g", "w", "n", "total", "c"])

    sent = docs.select("text").mapInArrow(run, "k long, x0 binary, x1 binary, x2 binary")
    return sent.repartitionById(parts, F.col("k").cast("int")).sortWithinPartitions("k").mapInArrow(add, "k long, g long, w long, n long, total long, c long")


def weights_of(g: np.ndarray, n: np.ndarray, total: np.ndarray, c: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the pairs, places where groups (ascending in ``g``) begin, and ln(Z / z) of each group."""
    new = np.concatenate([[True], g[1:] != g[:-1]])
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    base, theta = c + 0.5, np.zeros(len(g))
    more = lambda: np.add.reduceat(base * np.expm1(theta), first)
    for _ in range(STEPS):
        mean = total * base * np.exp(theta) / (z[first] + more())[of]
        theta += np.clip((n - mean - DECAY * theta) / (mean + DECAY), -MOVE, MOVE)
    return theta, first, np.log1p(more() / z[first])


def fit_pairs(pairs: DataFrame, rest_z: np.ndarray, parts: int) -> DataFrame:
    """(k, x0, x1): keys and log10 values of each range's pairs and groups."""
    def run(batches):
        held = []

        def flush():
            k, g, w, n, total, c = map(np.concatenate, zip(*held))
            g, w = g.view(np.uint64), w.view(np.uint64)
            z = rest_z[(w & CLASS_BITS).astype(np.int64) % len(rest_z)]
            theta, first, lnz = weights_of(g, n, total, c, z)
            keys, values = _mix(np.concatenate([pair_keys(g, w), g[first] << np.uint64(32)])), np.concatenate([theta, -lnz]) / np.log(10)
            order = np.argsort(keys)
            return _blocks(np.full(len(order), k[0]), keys[order], values[order])

        for b in batches:
            columns = [b.column(i).to_numpy() for i in range(6)]
            cut = np.flatnonzero(np.diff(columns[0])) + 1
            for part in zip(*(np.split(x, cut) for x in columns)):
                if not len(part[0]):
                    continue
                if held and held[-1][0][0] != part[0][0]:
                    yield flush()
                    held = []
                held.append(part)
        if held:
            yield flush()

    return pairs.repartitionById(parts, F.col("k").cast("int")).sortWithinPartitions("k", "g").mapInArrow(run, "k long, x0 binary, x1 binary")


def train(docs: DataFrame, counts: DataFrame, model, tokens) -> tuple[DataFrame, int, int] | None:
    """Weights of the pairs in the training rows ``docs(text)``, in a table; the number of ranges and of partitions."""
    if not model.n:
        return None
    spark = docs.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, -(-model.n // RANGE))
    parts = ranges
    shared = spark.sparkContext.broadcast(model)
    pairs = stage(count_pairs(docs, shared, tokens, ranges, parts), "lm-pairs")
    least = int(model.c.min()) if len(model.c) else None
    if least is None or least > LEAST:  # some words with pairs are not among the known: their counts are joined
        rare = counts if least is None else counts.where(F.col("c") < least)
        pairs = pairs.join(rare.select(F.col("h").alias("w"), F.col("c").alias("own")), "w", "left").select(
            "k", "g", "w", "n", "total", F.greatest("c", F.coalesce("own", F.lit(0))).alias("c"))
    return stage(fit_pairs(pairs, model.rest_z, parts), "lm-weights"), ranges, parts


def evidence(rows: DataFrame, model_shared, learnt, tokens) -> DataFrame:
    """(row, pairs): sum over the tokens of ``rows(row, text)`` of log10 of what the pair features make of their share of the class."""
    weights, ranges, parts = learnt

    def ask(batches):
        m = model_shared.value
        for b in batches:
            h, off = tokens(b.column(1))
            if not len(h):
                continue
            at = np.flatnonzero(m.in_rest(h))
            doc = np.repeat(b.column(0).to_numpy(), np.diff(off))[at]
            g = groups(h, off, at)
            k = range_of(g, ranges)
            order = np.argsort(k.astype(np.min_scalar_type(ranges)), kind="stable")
            blocks = _blocks(k[order], pair_keys(g, h[at])[order], doc[order])
            yield blocks.append_column("src", pa.array(np.full(blocks.num_rows, b.column(0)[0].as_py()))).select(["k", "src", "x0", "x1"])

    def answer(batches):
        table = None
        for k, rows, whole in _by_range(batches):
            if whole:
                rows.clear()
                table = None
                continue
            src, x0, x1 = rows.pop()
            if src is None:
                table = Finder(np.frombuffer(x0, np.uint64)), np.frombuffer(x1, np.float64)
            elif table is not None:
                key, doc = np.frombuffer(x0, np.uint64), np.frombuffer(x1, np.int64)
                group = table[0].find(_mix(key & ~LOW))
                hit = np.flatnonzero(group >= 0)  # a pair has a weight only where its group has one
                pair = table[0].find(_mix(key[hit]))
                doc, sums = doc[hit], table[1][group[hit]] + np.where(pair >= 0, table[1][pair], 0.0)
                if len(doc):  # a document's tokens are neighbours
                    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    yield _blocks(np.full(len(first), src), doc[first], np.add.reduceat(sums, first))

    def add(batches):
        for _, rows, whole in _by_range(batches):
            if whole:
                doc, sums = (np.concatenate([np.frombuffer(r[i], t) for r in rows]) for i, t in ((0, np.int64), (1, np.float64)))
                own, back = np.unique(doc, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(back, sums, len(own)))], names=["row", "pairs"])

    sent = rows.select("row", "text").mapInArrow(ask, "k long, src long, x0 binary, x1 binary")
    both = weights.selectExpr("k", "cast(null as long) as src", "x0", "x1").union(sent)
    told = both.repartitionById(parts, F.col("k").cast("int")).sortWithinPartitions("k", F.col("src").asc_nulls_first())
    told = told.mapInArrow(answer, "k long, x0 binary, x1 binary")  # k: the first row of the batch that asked
    return told.repartition(parts, "k").sortWithinPartitions("k").mapInArrow(add, "row long, pairs double")
