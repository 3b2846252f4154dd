"""SimHash near duplicates: 64-bit fingerprints, linked by a binary trie that is joined with itself.

A fingerprint's bit is set where it is set in over half of the hashes of the text's shingles.  Equal fingerprints form a
class, and only distinct fingerprints go further.  Two that differ in at most ``most`` bits agree on at least one of
``most + 1`` equal parts, so the fingerprints are put into that many tries, each of which begins with another part, and
only nodes that agree on the whole first part are paired.

From there pairs of nodes go down together: a node with itself gives both children with themselves and the one with the
other, two nodes give their four pairs of children; each step adds the bit in which the children differ, and a pair that
exceeds ``most`` is dropped with all below it.  A trie is kept as the sorted list of its fingerprints, a node being a
range of it, so a task takes many node pairs down one level at a time.  A node pair of more than ``NODE`` fingerprints a
side is taken down in the shuffle instead, by the counts of its children, until each part is small enough for a task;
so no group grows with the data.  Tasks give no more links than they need to join their fingerprints' components.

Defined results: null or blank texts have fingerprint zero, linked like any other; rows with a null id are linked with
nothing and have a null component; repeated rows each get their (equal) result; rows of one id with unlike texts keep
a fingerprint each; other columns of any name are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import components, read_table, stage, text_bytes
from lakekpi.operators.joins import hot_keys, skew_split_join

BITS = 64
NODE = 1 << 15  # fingerprints of a trie node that a task takes in
STEP = 4        # levels that a large node goes down in the shuffle at a time
TASK_ROWS = 1 << 18  # fingerprints that a task takes down at a time
FRONTIER = 1 << 18   # node pairs that are held at a time
LEAF = 8        # node pairs with at most so many pairs of fingerprints are compared at once

POWERS = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """SimHash of a text's shingles of ``width`` words, repeats counted."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for s in range(0, n, 4096):  # very long texts in pieces
        e = min(n, s + 4096)
        h = np.fromiter([digest(line[i:j], seed) for i, j in zip(starts[s:e].tolist(), ends[s + k - 1:e + k - 1].tolist())], np.uint64, e - s)
        counts += np.unpackbits(h.byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(POWERS[2 * counts > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int, seed: int) -> DataFrame:
    """Per row: id, fp (64 bits as a long)."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, width, seed) for t in text_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def _parts(most: int) -> list[tuple[int, int]]:
    """(turn, depth) of each trie: the bits are turned left by ``turn``, and the first ``depth`` must agree."""
    cuts = [BITS * i // (most + 1) for i in range(most + 2)]
    return [(s, e - s) for s, e in zip(cuts, cuts[1:])]


def _turn(fp: Column, by: Column) -> Column:
    return F.call_function("shiftleft", fp, by).bitwiseOR(F.call_function("shiftrightunsigned", fp, F.lit(BITS) - by))


def _prefix(x: Column, depth: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, (F.lit(BITS) - depth).cast("int"))


def node_pairs(tries: DataFrame, most: int, node: int) -> DataFrame:
    """Node pairs (turn, depth, p, q, left) that hold all links, p <= q prefixes of ``depth`` bits, ``left`` the bits in which
    fingerprints may still differ; no node has more than ``node`` fingerprints (at full depth it has one)."""
    counts = tries.groupBy("turn", "depth", _prefix(F.col("x"), F.col("depth")).alias("p")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = stage(counts.select("turn", "depth", "p", F.col("p").alias("q"), F.lit(most).alias("left"), F.col("n").alias("np"), F.col("n").alias("nq")), "sh-nodes")
    small = F.greatest("np", "nq") <= node
    done, open_ = counts.where(small), counts.where(~small)
    while not open_.isEmpty():
        step = F.least(F.lit(STEP), F.lit(BITS) - F.col("depth"))
        nodes = open_.select("turn", "depth", "p").union(open_.select("turn", "depth", "q")).distinct()
        kids = stage(_below(tries, nodes).groupBy("turn", "depth", "p", _prefix(F.col("x"), F.col("depth") + step).alias("kid"))
                     .agg(F.count(F.lit(1)).alias("n")), "sh-kids")
        a, b = kids.toDF("turn", "depth", "p", "pk", "npk"), kids.toDF("turn", "depth", "q", "qk", "nqk")
        differ = F.bit_count(F.col("pk").bitwiseXOR(F.col("qk"))) - F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
        down = (open_.drop("np", "nq").join(a, ["turn", "depth", "p"]).join(b, ["turn", "depth", "q"])
                .withColumn("left", (F.col("left") - differ).cast("int")).where("left >= 0 and (p <> q or pk <= qk) and (pk <> qk or npk > 1)")
                .select("turn", (F.col("depth") + step).cast("int").alias("depth"), F.col("pk").alias("p"), F.col("qk").alias("q"), "left",
                        F.col("npk").alias("np"), F.col("nqk").alias("nq")))
        down = stage(down, "sh-nodes")
        done, open_ = done.union(down.where(small)), down.where(~small)
    return done.drop("np", "nq")


def _below(tries: DataFrame, nodes: DataFrame) -> DataFrame:
    """Fingerprints (x) with each of the given nodes (turn, depth, p) that they are below."""
    depths = nodes.select("turn", "depth").distinct()  # at most one row a trie and level
    return (tries.select("turn", "x").join(F.broadcast(depths), "turn").withColumn("p", _prefix(F.col("x"), F.col("depth")))
            .join(nodes, ["turn", "depth", "p"]))


def _ones(x: np.ndarray, bit: int) -> np.ndarray:
    """How many of the fingerprints before each position have ``bit`` set."""
    return np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])


def _leaves(x: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """All (i, j) with i < j of the node pairs, as two columns."""
    alo, ahi, blo, bhi = pairs[:4]
    size = (ahi - alo) * (bhi - blo)
    at = np.repeat(np.arange(len(size)), size)
    k = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    wide = (bhi - blo)[at]
    i, j = alo[at] + k // wide, blo[at] + k % wide
    keep = i < j
    return np.stack([i[keep], j[keep]])


class Forest:
    """Components of the positions 0..n-1, and the links that joined them."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            if not len(i):
                return
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((lo, hi))
            first = order[np.flatnonzero(np.diff(hi[order], prepend=-1))]  # each larger root goes to its smallest partner
            self.root[hi[first]] = lo[first]
            self.links.append(np.stack([i[first], j[first]]))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def self_join(x: np.ndarray, pairs: np.ndarray, bit: int, most: int) -> Forest:
    """Links that join the components of sorted fingerprints ``x`` (with ``pairs`` columns alo, ahi, blo, bhi, left: node
    pairs whose fingerprints agree above ``bit``, equal ranges for a node with itself)."""
    forest, work, ones, level = Forest(len(x)), [(bit, pairs)], None, None
    while work:
        bit, pairs = work.pop()
        if pairs.shape[1] > FRONTIER:
            work += [(bit, half) for half in np.array_split(pairs, 2, axis=1)]
            continue
        alo, ahi, blo, bhi, left = pairs
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (bit < 0)
        if small.any():
            i, j = _leaves(x, pairs[:, small])
            near = np.bitwise_count(x[i] ^ x[j]) <= most
            forest.add(i[near], j[near])
        if small.all():
            continue
        pairs = pairs[:, ~small]
        alo, ahi, blo, bhi, left = pairs
        if level != bit:
            ones, level = _ones(x, bit), bit
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])  # where the bit turns to one
        own = (alo == blo) & (ahi == bhi)
        kids = [np.stack([alo, amid, blo, bmid, left]), np.stack([amid, ahi, bmid, bhi, left]), np.stack([alo, amid, bmid, bhi, left - 1]),
                np.stack([amid, ahi, blo, bmid, left - 1])[:, ~own]]
        down = np.concatenate(kids, axis=1)
        down = down[:, (down[4] >= 0) & (down[1] > down[0]) & (down[3] > down[2]) & ~((down[0] == down[2]) & (down[1] == down[3]) & (down[1] - down[0] == 1))]
        if down.shape[1]:
            work.append((bit - 1, down))
    return forest


def _join_units(most: int):
    """Links (a, b) from rows (turn, depth, p, q, left, x) of whole units, in order, those of p before those of q."""
    def solve(t: pa.Table, out: list) -> None:
        cols = [t.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(6)]
        turn, depth, p, q, left = cols[:5]
        x = cols[5].view(np.uint64)
        new = (np.diff(turn, prepend=-1) != 0) | (np.diff(depth, prepend=-1) != 0)
        new[1:] |= (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(x))
        for d in np.unique(depth[starts]):
            s, e = starts[depth[starts] == d], ends[depth[starts] == d]
            cross = p[s] != q[s]
            # in a cross unit the rows of p and those of q follow each other
            isq = np.concatenate([[0], np.cumsum((x >> np.uint64(BITS - d)).view(np.int64) != p)])
            mid = e - (isq[e] - isq[s])
            pairs = np.stack([s, np.where(cross, mid, e), np.where(cross, mid, s), e, left[s].astype(np.int64)])
            pairs = pairs[:, (pairs[1] > pairs[0]) & (pairs[3] > pairs[2])]
            forest = self_join(x, pairs, int(BITS - d - 1), most)
            for link in forest.links:
                i, j = link
                back = [np.where(turn[k] == 0, x[k], (x[k] >> turn[k].astype(np.uint64)) | (x[k] << (np.uint64(BITS) - turn[k].astype(np.uint64))))
                        for k in (i, j)]
                out.append([b.view(np.int64) for b in back])

    def run(batches):
        held, rows = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows < TASK_ROWS:
                continue
            t = pa.Table.from_batches(held)
            last = t.slice(rows - 1).to_pylist()[0]  # its unit may go on
            same = np.ones(rows, bool)
            for c in ("turn", "depth", "p", "q"):
                same &= t.column(c).to_numpy() == last[c]
            cut = rows - int(same.sum())
            out = []
            if cut:
                solve(t.slice(0, cut), out)
            held, rows = t.slice(cut).to_batches(), rows - cut
            if out:
                yield from _edges(out)
        out = []
        if rows:
            solve(pa.Table.from_batches(held), out)
        if out:
            yield from _edges(out)

    def _edges(out):
        a, b = (np.concatenate(c) for c in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(fps: DataFrame, most: int = 3, node: int = NODE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps(fp)`` that join the components of all pairs within ``most`` bits."""
    parts = F.array(*[F.struct(F.lit(t).alias("turn"), F.lit(d).alias("depth")) for t, d in _parts(most)])
    tries = fps.select("fp", F.inline(parts)).select("turn", "depth", _turn(F.col("fp"), F.col("turn")).alias("x"))
    units = node_pairs(tries, most, node)
    sides = units.withColumn("side", F.explode(F.when(F.col("p") == F.col("q"), F.array("p")).otherwise(F.array("p", "q"))))
    depths = sides.select("turn", "depth").distinct()
    rows = (tries.select("turn", "x").join(F.broadcast(depths), "turn").withColumn("side", _prefix(F.col("x"), F.col("depth")))
            .join(sides, ["turn", "depth", "side"]).repartition("turn", "depth", "p", "q"))
    return (rows.sortWithinPartitions("turn", "depth", "p", "q", "side", "x").select("turn", "depth", "p", "q", "left", "x")
            .mapInArrow(_join_units(most), "a long, b long"))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, seed: int = 42,
                       most: int = 3) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id reachable over links)."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle_words, seed), "sh-rows")
    classes = stage(rows.where("id is not null").groupBy("fp").agg(F.min("id").alias("least")), "sh-class")
    found = stage(links(classes.select("fp"), most), "sh-link")
    named = classes.withColumnRenamed("least", "component_id")
    if not found.isEmpty():
        ends = found
        for c in "ab":  # the components' names are then their smallest ids
            ends = ends.join(classes.toDF(c, f"id{c}"), c)
        comp = components(ends.select(F.col("ida").alias("a"), F.col("idb").alias("b")), "sh-comp")
        named = classes.join(comp.withColumnRenamed("id", "least"), "least", "left").select(
            "fp", F.coalesce("comp", "least").alias("component_id"))
    # a fingerprint may be that of a third of all rows
    out = skew_split_join(rows, named, "fp", "left", hot_keys(rows, "fp"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def op12_simhash_dups(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of documents and their components under links of at most 3 differing bits."""
    return simhash_duplicates(read_table(spark, sf_dir, "documents"))
