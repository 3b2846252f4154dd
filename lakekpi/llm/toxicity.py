"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Learning takes a sample of at most ``examples`` training rows per label (a documented bound, by hash of the id; of unlike texts
under one id that with the smallest hash).  Copies of an example with the same label go, confirmed on full trigram sets at ``SAME``.
A term is the first ``STEM`` characters of a word, so that forms of a word meet; every word of every example counts, weighted by its
term's document frequency over all documents, and every example with a word is in the index.

The index keeps the largest weight of each term in each block of like examples.  Blocks are searched from the largest bound on and
passed over once they cannot hold one of the k nearest, so the k nearest are exact.  Their votes, weighted by cosine, become a
probability by an isotonic fit of leave-one-out votes of the examples.  Documents that share no term with an example get the toxic
share of training rows without words.  The nearest examples are given as evidence.

An example that is a document of its own finds itself in the index: scores of rows that are not held out include their label.

Defined results: null and empty texts have no terms; rows with a null id are not held out; a document labelled more
than once is toxic if any label says so; without labelled rows every score is the smoothed empty share, 0.1.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import MULT, read_table, stage, text_bytes
from lakekpi.llm.near_dups import _minhash, _mix, _params, shingle_sets

# all but 0-9, a-z and the bytes of other letters stand between words
BLANKS = bytes(i if i >= 0x80 or chr(i).isdigit() or "a" <= chr(i) <= "z" else 0x20 for i in range(256))
STEM = 4
EXAMPLES, NEIGHBOURS, BLOCK = 8000, 16, 128
QUERIES, CELLS = 512, 8_000_000  # texts searched at once, and how many weights they may have room for
RARE = 0.02  # share of the examples up to which a term has a list of its own
FIRST = 4  # blocks each text looks into before it compares bounds; three times as many in each round after
BANDS, DRAWS, SAME = 32, 5, 0.8  # of copies: MinHash bands, samples of a band, least share of common trigrams
MARGIN = 1e-5  # more than short numbers can be off
CACHE = 500_000


def fold(id_col: str, n: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def sample_labels(labels: DataFrame, id_col: str, label_col: str, folds: int, held: int, per_label: int) -> tuple[DataFrame, dict]:
    """At most ``per_label`` training rows of each label, and how many training rows there are of each."""
    rows = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
            .where(fold("id", folds) != held))
    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = stage(rows, "lab")
    picked = [rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_label) for y in (0, 1)]
    return picked[0].union(picked[1]), total


class Terms:
    """Counts of texts' terms; the places of a word's term in the table are remembered."""

    def __init__(self, table: list[str]):
        self.place = {s: i for i, s in enumerate(table)}
        self.known: dict[bytes, int] = {}

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets by text, and in ascending order the terms of the table that each text holds, and how often."""
        if len(self.known) > CACHE:
            self.known.clear()
        lists = [t.lower().translate(BLANKS).split() for t in texts]
        for w in set(itertools.chain.from_iterable(lists)).difference(self.known):
            self.known[w] = self.place.get(stem(w), -1)
        sizes = [len(x) for x in lists]
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(lists)), np.int64, sum(sizes))
        of = np.repeat(np.arange(len(texts)), sizes)[at >= 0]
        keys, c = np.unique(of * len(self.place) + at[at >= 0], return_counts=True)
        of, t = np.divmod(keys, max(1, len(self.place)))
        return np.searchsorted(of, np.arange(len(texts) + 1)), t, c


def stem(word: bytes) -> str:
    return word[:4 * STEM].decode("utf-8", "ignore")[:STEM]


def _parts(batches, size: int = QUERIES):
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


def vocabulary(rows: DataFrame) -> list[str]:
    """All terms of the examples, ascending."""
    def run(batches):
        for b in batches:
            words = set().union(*(t.lower().translate(BLANKS).split() for t in text_bytes(b.column(0))))
            yield pa.RecordBatch.from_arrays([pa.array(sorted({stem(w) for w in words}), pa.string())], names=["term"])

    return sorted(rows.select("text").mapInArrow(run, "term string").distinct().toArrow().column(0).to_pylist())  # of the bounded examples


def _frequencies(docs: DataFrame, text_col: str, table: list[str]) -> tuple[int, np.ndarray]:
    """Documents, and documents that hold each term."""
    shared, size = docs.sparkSession.sparkContext.broadcast(table), len(table)

    def run(batches):
        terms, df = Terms(shared.value), np.zeros(size + 1, np.int64)
        for b in _parts(batches):
            df[:-1] += np.bincount(terms.counts(text_bytes(b.column(0)))[1], minlength=size)
            df[-1] += b.num_rows
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["i", "n"])

    df = np.zeros(size + 1, np.int64)
    got = docs.select(text_col).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    df[got.column("i").to_numpy()] = got.column("n").to_numpy()
    return int(df[-1]), df[:-1]


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of all spans, one span after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def alike(off: np.ndarray, t: np.ndarray, w: np.ndarray, n_terms: int, block: int) -> np.ndarray:
    """Order of the vectors in which like ones stand together: halves by two means, until a part fits into a block."""
    parts, out = [np.arange(len(off) - 1)], []
    while parts:
        rows = parts.pop()
        if len(rows) <= block:
            out.append(rows)
            continue
        at, sizes = _spans(off[rows], off[rows + 1]), off[rows + 1] - off[rows]
        cut = -(-len(rows) // (2 * block)) * block  # whole blocks on the left side
        axis = np.zeros(n_terms)
        axis[t[off[rows[0]]:off[rows[0] + 1]]] = w[off[rows[0]]:off[rows[0] + 1]]
        for _ in range(4):
            side = np.add.reduceat(axis[t[at]] * w[at], np.cumsum(sizes) - sizes)
            left = np.zeros(len(rows), bool)
            left[np.argsort(-side, kind="stable")[:cut]] = True
            sign = np.repeat(np.where(left, 1 / cut, -1 / (len(rows) - cut)), sizes)
            axis = np.bincount(t[at], w[at] * sign, n_terms)
        parts += [rows[~left], rows[left]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class BlockMaxIndex:
    """Inverted index over example vectors (each with a term), in blocks of like examples.

    Rare terms (in at most ``RARE`` of the examples) have lists of their examples, summed for every query first.  Of all other
    terms ``most`` holds the largest weight in each block: a query's weights times these, with the block's largest sum of rare terms,
    bound its cosines with the block's examples.  Blocks are searched from the largest bound on, until none that is left can
    reach the k-th best.  A block holds those terms' lists as rows over its examples.  Sums in short numbers choose, sums in
    long ones give the cosines.
    """

    def __init__(self, off: np.ndarray, t: np.ndarray, w: np.ndarray, n_terms: int, block: int = BLOCK):
        self.off, self.t, self.w, self.n = off, t, w, len(off) - 1
        order = alike(off, t, w, n_terms, block)
        self.block, n_blocks = block, -(-self.n // block)
        held = np.bincount(t, minlength=n_terms)
        rare = held <= RARE * self.n
        at = _spans(off[order], off[order + 1])
        where = np.repeat(np.arange(self.n), off[order + 1] - off[order])[rare[t[at]]]  # an example's place in the blocks
        at = at[rare[t[at]]]
        by = np.argsort(t[at], kind="stable")
        self.listed, self.list_w = where[by], w[at][by]
        self.list_at = np.concatenate([[0], np.cumsum(np.where(rare, held, 0))])
        self.common = np.where(rare, -1, np.cumsum(~rare) - 1)  # row of a term that has block lists
        self.blocks, self.most = [], np.zeros((np.count_nonzero(~rare), n_blocks), np.float32)
        for b in range(n_blocks):
            ids = order[b * block:(b + 1) * block]
            at = _spans(off[ids], off[ids + 1])
            of = np.repeat(np.arange(len(ids)), off[ids + 1] - off[ids])[~rare[t[at]]]
            at = at[~rare[t[at]]]
            lists = np.zeros((len(self.most), len(ids)), np.float32)
            lists[self.common[t[at]], of] = w[at]
            self.most[:, b] = lists.max(1)
            self.blocks.append((ids, lists))
        self.searched = 0  # blocks looked into, over all queries

    def nearest_all(self, off: np.ndarray, t: np.ndarray, w: np.ndarray, k: int, skips=None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each query (offsets, terms, weights): the k examples with the largest positive cosine (ties to the earlier example),
        best first.  ``skips`` names an example for each query that is left out."""
        size = max(16, min(QUERIES, CELLS // max(1, len(self.common), self.n)))
        out = []
        for i in range(0, len(off) - 1, size):
            part = off[i:i + size + 1]
            own = slice(part[0], part[-1])
            out += self._nearest(part - part[0], t[own], w[own], k, None if skips is None else np.asarray(skips[i:i + size]))
        return out

    def _nearest(self, off, t, w, k, skips):
        m, n = len(off) - 1, len(self.blocks)
        if not n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * m
        of = np.repeat(np.arange(m), np.diff(off))
        q = np.zeros((m, len(self.common)))
        q[of, t] = w
        own = self.common[t] >= 0
        short = np.zeros((m, len(self.most)), np.float32)
        short[of[own], self.common[t[own]]] = w[own]
        starts, ends = self.list_at[t], self.list_at[t + 1]
        at = _spans(starts, ends)
        rest = np.bincount(np.repeat(of, ends - starts) * (n * self.block) + self.listed[at], self.list_w[at] * np.repeat(w, ends - starts),
                           m * n * self.block).astype(np.float32).reshape(m, n, self.block)
        bound = short @ self.most + rest.max(2)
        order = np.argsort(-bound, axis=1, kind="stable")
        bound[bound > 0] += MARGIN
        best, alive, found = np.zeros((m, k), np.float32), np.arange(m), []
        lo, step = 0, FIRST
        while lo < n and len(alive):
            part = order[alive, lo:lo + step]
            for b in np.unique(part):
                ids, lists = self.blocks[b]
                some = alive[(part == b).any(1)]
                some = some[bound[some, b] > best[some].min(1)]
                if not len(some):
                    continue
                self.searched += len(some)
                cos = short[some] @ lists + rest[some, b, :len(ids)]
                if skips is not None:
                    cos[skips[some][:, None] == ids] = 0
                best[some] = -np.partition(-np.concatenate([best[some], cos], 1), k - 1, axis=1)[:, :k]
                at, e = np.nonzero(cos > np.maximum(best[some].min(1) - MARGIN, 0)[:, None])
                found.append((some[at], ids[e], cos[at, e]))
            lo, step = lo + step, step * 3
            if lo < n:
                alive = alive[bound[alive, order[alive, lo]] > best[alive].min(1)]
        of, ids, cos = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        near = cos > best.min(1)[of] - MARGIN
        of, ids = of[near], ids[near]
        sizes = self.off[ids + 1] - self.off[ids]
        at = _spans(self.off[ids], self.off[ids + 1])
        exact = np.add.reduceat(q[np.repeat(of, sizes), self.t[at]] * self.w[at], np.cumsum(sizes) - sizes) if len(ids) else np.zeros(0)
        last = np.lexsort((ids, -exact.round(12), of))
        of, ids, exact = of[last], ids[last], exact[last]
        starts = np.searchsorted(of, np.arange(m + 1))
        return [(ids[s:min(s + k, e)], exact[s:min(s + k, e)]) for s, e in zip(starts[:-1], starts[1:])]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising steps (x of each step's middle, value)."""
    steps: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        steps.append([x[i] * w[i], y[i] * w[i], w[i]])
        while len(steps) > 1 and (steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2] or steps[-2][0] / steps[-2][2] == steps[-1][0] / steps[-1][2]):
            last = steps.pop()
            steps[-1] = [p + q for p, q in zip(steps[-1], last)]
    return np.array([s[0] / s[2] for s in steps]), np.array([(s[1] + 0.1) / (s[2] + 0.5) for s in steps])


def weigh(off: np.ndarray, t: np.ndarray, c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of counted terms, of length one in each text."""
    w = (1 + np.log(c)) * idf[t]
    of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return w / np.sqrt(np.bincount(of, w * w, len(off) - 1))[of]


class Model:
    """All that scoring needs: at most ``2 * EXAMPLES`` examples' term counts, and the terms' weights."""

    def __init__(self, table, idf, ids, labels, vectors, share_without, prior):
        self.table, self.idf, self.ids, self.labels = table, idf, np.array(ids, np.int64), np.array(labels, np.int64)
        self.vectors, self.empty, self.prior, self.curve = vectors, share_without, prior, None
        self._index = None

    def index(self) -> BlockMaxIndex:
        """Built once in each Python worker."""
        if self._index is None:
            off, t, c = self.vectors
            self._index = BlockMaxIndex(off, t, weigh(off, t, c, self.idf), len(self.table))
        return self._index

    def votes(self, off, t, c, skips=None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Share of toxic weight among the nearest examples, these, and their cosines."""
        found = self.index().nearest_all(off, t, weigh(off, t, c, self.idf), NEIGHBOURS, skips)
        return [(float((cos @ self.labels[ids] + 0.1 * self.prior) / (cos.sum() + 0.1)), ids, cos) for ids, cos in found]

    def score(self, off, t, c) -> list[tuple[float, list]]:
        out = []
        for vote, ids, cos in self.votes(off, t, c):
            if not len(ids):
                out.append((self.empty, []))
                continue
            p = float(np.interp(vote, *self.curve))
            out.append((min(1.0, max(0.0, p)), [(int(self.ids[i]), float(x), int(self.labels[i])) for i, x in zip(ids[:3], cos[:3])]))
        return out


def _left_out(vec: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Votes on each example by the others, in tasks: (example, vote)."""
    shared = vec.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in _parts(batches):
            lists = [b.column(i).cast(pa.large_list(pa.int64())) for i in (1, 2)]
            off = np.concatenate([[0], np.cumsum(pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))]).astype(np.int64)
            t, c = (pc.list_flatten(x).to_numpy() for x in lists)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v[0] for v in m.votes(off, t, c, b.column(0).to_numpy())], pa.float64())],
                                             names=["e", "vote"])

    got = vec.select("e", "t", "c").mapInArrow(run, "e long, vote double").toArrow().sort_by("e")  # two numbers an example
    return got.column("e").to_numpy(), got.column("vote").to_numpy()


def _samples(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each text: its trigrams, and the keys of its bands."""
    mul, add = _params(BANDS * DRAWS)
    sets = shingle_sets(texts, 3)
    sig = np.array([_minhash(x, mul, add) for x in sets], np.uint64).reshape(len(sets), BANDS, DRAWS)
    keys = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(sets), 1), np.uint64)
    for i in range(DRAWS):
        keys = _mix(keys * MULT + sig[:, :, i])
    return sets, keys


def _without_near_copies(rows: DataFrame) -> DataFrame:
    """Near copies of one text would vote as many: of the examples of a label, confirmed copies of an earlier one go.

    Every example is held against the first one of each of its bands (by id and text hash) on full sets.
    """
    def run(batches):
        for b in _parts(batches):
            grams, keys = _samples(text_bytes(b.column(3)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64())),
                                              pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64()))],
                                             names=["id", "y", "text_hash", "grams", "keys"])

    key = ["id", "y", "text_hash"]
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    held = stage(rows.dropDuplicates(key).select(*key, "text").mapInArrow(run, "id long, y int, text_hash long, grams array<long>, keys array<long>"), "tx-grams")
    bands = held.select(*key, F.explode("keys").alias("key"))
    firsts = (bands.groupBy("y", "key").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("y", "key", F.col("first.id").alias("id2"), F.col("first.text_hash").alias("text_hash2")))
    pairs = bands.join(firsts, ["y", "key"]).where("struct(id, text_hash) > struct(id2, text_hash2)").select(*key, "id2", "text_hash2").distinct()
    other = held.select(F.col("id").alias("id2"), "y", F.col("text_hash").alias("text_hash2"), F.col("grams").alias("grams2"))
    both = F.size(F.array_intersect("grams", "grams2"))
    gone = (pairs.join(held.select(*key, "grams"), key).join(other, ["id2", "y", "text_hash2"])
            .where(both >= SAME * (F.size("grams") + F.size("grams2") - both)).select(*key).distinct())
    return stage(rows.join(gone, key, "left_anti").drop("text_hash"), "tx-distinct")


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int,
        examples: int = EXAMPLES) -> Model:
    picked, total = sample_labels(labels, id_col, label_col, folds, held, examples)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(picked), "id"))  # bounded: 2 * examples ids
    rows = rows.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("r")).select("id", "r.text", "r.y")
    rows = _without_near_copies(stage(rows, "tx-example"))
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = vocabulary(rows)
    n, df = _frequencies(docs, text_col, table) if table else (0, np.zeros(0))
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)

    def vectors(batches):
        tool = Terms(shared.value)
        for b in _parts(batches):
            off, t, c = tool.counts(text_bytes(b.column(1)))
            lists = [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(x, pa.int32())) for x in (t, c)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *lists], names=["id", "y", "t", "c"])

    vec = stage(rows.select("id", "text", "y").mapInArrow(vectors, "id long, y int, t array<int>, c array<int>"), "tx-vector")
    weights = {y: total.get(y, 0) / max(1, sizes.get(y, 0)) for y in (0, 1)}  # each example stands for that many rows
    without = {r["y"]: r["n"] * weights[r["y"]] for r in vec.where("size(t) = 0").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = vec.where("size(t) > 0").orderBy("id").toArrow().combine_chunks()  # at most 2 * examples rows
    off = np.concatenate([[0], np.cumsum(pc.list_value_length(known.column("t")).to_numpy())]).astype(np.int64)
    t, c = (pc.list_flatten(known.column(x)).to_numpy() for x in "tc")
    ids, y = known.column("id").to_numpy(), known.column("y").to_numpy()
    model = Model(table, idf, ids, y, (off, t, c), (without.get(1, 0) + 0.5) / (sum(without.values()) + 5), (total.get(1, 0) + 0.5) / (sum(total.values()) + 5))
    if len(ids):
        places = spark.createDataFrame(pa.table({"id": ids, "e": np.arange(len(ids))}))
        own = vec.where("size(t) > 0").join(F.broadcast(places), "id").repartition(spark.sparkContext.defaultParallelism, "e")
        e, votes = _left_out(own, model)
        model.curve = isotonic(votes, y[e].astype(float), np.array([weights[k] for k in y[e]]))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held: int = 2,
          threshold: float = 0.3) -> DataFrame:
    """Per row: id, held_out, score, predicted, evidence (nearest examples, their cosine and label)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        m = shared.value
        terms = Terms(m.table)
        for b in _parts(batches):
            got = m.score(*terms.counts(text_bytes(b.column(2))))
            p = np.array([g[0] for g in got], float)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32)),
                 pa.array([[dict(zip(("id", "cosine", "label"), e)) for e in g[1]] for g in got], kind)],
                names=["doc_id", "held_out", "score", "predicted", "evidence"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, held_out boolean, score double, predicted int, "
                                "evidence array<struct<id: bigint, cosine: double, label: int>>")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels, "doc_id", "text", "toxic", 4, 2))
