"""Near-duplicate documents: MinHash bands propose links, odd sketches screen them, full shingle sets confirm them.

A document's set holds its distinct shingles of ``shingle_words`` words (a shorter document is one shingle).  Documents
with equal sets form a class and only one row per class goes further.  Every class gets ``bands * rows`` MinHash
samples.  The samples of a band are its bucket key; all samples together are folded into an odd sketch, a bitmap
in which each (position, value) flips one bit, so the XOR of two sketches counts the samples in which they differ.
The estimate from that count is sharp at high similarity, and pairs more than five standard errors below the
threshold are left out.  What remains is confirmed on the full sets.

Links between classes are found in rounds, each confirmed before the next.  First every class is held against the
closest, by sketch, of the smallest members of its buckets.  Then, in buckets that still hold several components, dealt
into chunks of about ``CHUNK`` rows, every row names its closest partners of other components, and the closest two of each
document are confirmed; so a group of thousands of near copies is joined with a few comparisons per member.  The last
round makes the result complete: the members of buckets that are still mixed meet in blocks of about ``BLOCK`` rows, with
their texts, and every pair across components that passes the screen is held against the full sets right there, in the
first band that the two share; only links leave the task.  Pairs within a component are never compared, and no link that
could change a component is left out.

Defined results: null or blank texts have an empty set and are linked with nothing; rows with a null id
are linked with nothing and have a null component; repeated rows each get their (equal) result; rows of one id with unlike
texts are documents of their own, which keep their links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekpi.llm.common import hash_words, read_table, relabel, row_keys, split_words, stage, text_bytes, window_hashes

SKETCH_BITS = 512
LONGS = SKETCH_BITS // 64
CHUNK, BLOCK = 1000, 4000
ROUNDS = 1  # of closest partners
AT_ONCE = 100  # texts whose words are held at a time


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, off = split_words(texts, lower=True)
    h = hash_words(words)
    grams = window_hashes(h, width)
    out = []
    for i in range(len(texts)):
        s, e = off[i], off[i + 1]
        if e - s >= width:
            out.append(np.unique(grams[s:e - width + 1]))
        elif e > s:  # fewer words: the whole sequence is the only shingle
            out.append(window_hashes(h[s:e], int(e - s)) + np.uint64(e - s))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _params(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    return rng.integers(0, 2**63, k, dtype=np.uint64) * 2 + 1, rng.integers(0, 2**63, k, dtype=np.uint64)


def _minhash(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    sig = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        np.minimum(sig, (s[i:i + 1024, None] * mul + add).min(0), out=sig)
    return sig


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def _odd_sketch(sig: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed (position, value) of each sample, and the bitmap in which each flips one bit."""
    spots = _mix(sig ^ place)
    parity = np.bincount((spots >> np.uint64(55)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return spots, np.packbits(parity.astype(np.uint8)).view(np.int64)


def _places(k: int) -> np.ndarray:
    return _mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """Per document: id, n_shingles, fp (128-bit fingerprint of the set), keys (band keys), sketch (parity bitmap)."""
    k = bands * rows

    def run(batches):
        mul, add = _params(k)
        place = _places(k)
        for b in batches:
            ids = b.column(0).to_pylist()
            n, fp, keys, sk = [], [], [], []
            sets = (x for j in range(0, b.num_rows, AT_ONCE) for x in shingle_sets(text_bytes(b.column(1).slice(j, AT_ONCE)), width))
            for i, s in zip(ids, sets):
                n.append(len(s))
                if not len(s) or i is None:  # linked with nothing: a fingerprint of its own
                    fp.append(b"alone" + str(i).encode())
                    keys.append(None)
                    sk.append(None)
                    continue
                fp.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig = _minhash(s, mul, add)
                spots, bitmap = _odd_sketch(sig, place)
                keys.append(_mix(spots.reshape(bands, rows).cumsum(1, dtype=np.uint64)[:, -1]
                                 + spots.reshape(bands, rows)[:, 0] * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64))
                sk.append(bitmap)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sk, pa.list_(pa.int64()))],
                names=["id", "n", "fp", "keys", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n long, fp binary, keys array<long>, sketch array<long>")


def _most_flips(k: int, threshold: float) -> int:
    """Largest XOR population count with which a pair is still held against the full sets."""
    low = threshold - 5 * math.sqrt(threshold * (1 - threshold) / k)
    mean = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * k * (1 - low)))
    return math.ceil(mean + 3 * math.sqrt(mean))


def _flips(a: str, b: str):
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, LONGS)),
               F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def _groups(batches):
    """Record batches of one (first column, second column) each, from rows that are ordered by the two."""
    held = []
    for b in batches:
        key, part = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if held and b.num_rows and (held[-1].column(0)[0].as_py(), held[-1].column(1)[0].as_py()) != (key[0], part[0]):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if s:
                yield pa.Table.from_batches(held)
                held = []
            if e > s:
                held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


class _Members:
    """Rows of one bucket: which pairs of different components pass the screen, and by how many flips."""

    def __init__(self, table: pa.Table, most: int, percent: int):
        self.ids, self.comp, self.n = (table.column(c).to_numpy() for c in ("id", "comp", "n"))
        self.sketch, self.most, self.percent = _matrix(table, "sketch").view(np.uint64), most, percent

    def flips(self, s: int, e: int) -> np.ndarray:
        """Rows s..e against all; more than the screen allows where a pair is not to be compared."""
        flips = np.bitwise_count(self.sketch[s:e, None, :] ^ self.sketch[None, :, :]).sum(2).astype(np.int32)
        lo, hi = np.minimum(self.n[s:e, None], self.n[None, :]), np.maximum(self.n[s:e, None], self.n[None, :])
        flips[(self.comp[s:e, None] == self.comp[None, :]) | (100 * lo < self.percent * hi) | (flips > self.most)] = SKETCH_BITS + 1
        return flips


def _propose(most: int, percent: int, partners: int):
    """For each row of a chunk its closest ``partners`` of other components."""
    def run(batches):
        for t in _groups(batches):
            m, out = _Members(t, most, percent), []
            for s in range(0, t.num_rows, 64):
                flips = m.flips(s, s + 64)
                rows = np.arange(len(flips))
                for _ in range(min(partners, t.num_rows - 1)):
                    best = flips.argmin(1)
                    some = flips[rows, best] <= most
                    out.append((m.ids[s:s + 64][some], m.ids[best[some]], flips[rows, best][some].astype(np.int64)))
                    flips[rows, best] = SKETCH_BITS + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "flips"])

    return run


def _link(most: int, percent: int, width: int):
    """Links that join components, from the full sets of a block's (or two blocks') rows."""
    def run(batches):
        for t in _groups(batches):
            m = _Members(t, most, percent)
            if (m.comp == m.comp[0]).all():
                continue
            key, band_keys, block = t.column(0)[0].as_py(), _matrix(t, "keys"), t.column("block").to_numpy()
            two = (block != block[0]).any()
            text, sets, root, out = t.column("text"), {}, {c: c for c in m.comp.tolist()}, []

            def find(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            def own(i):
                if i not in sets:
                    sets[i] = shingle_sets(text_bytes(text.slice(i, 1).combine_chunks()), width)[0]
                return sets[i]

            for s in range(0, t.num_rows, 64):
                flips = m.flips(s, s + 64)
                i, j = np.nonzero(flips <= most)
                ok = (j > i + s) & ((block[j] != block[i + s]) if two else True)
                i, j = i[ok] + s, j[ok]
                same = band_keys[i] == band_keys[j]
                ok = band_keys[i, same.argmax(1)] == key if len(i) else np.zeros(0, bool)  # elsewhere another band comes first
                i, j = i[ok], j[ok]
                order = np.argsort(flips[i - s, j], kind="stable")
                for x, y in zip(i[order].tolist(), j[order].tolist()):
                    p, q = find(m.comp[x]), find(m.comp[y])
                    if p == q:
                        continue
                    both = len(np.intersect1d(own(x), own(y), assume_unique=True))
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        root[p] = q
                        out.append((int(m.ids[x]), int(m.ids[y])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return run


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def run(batches):
        last, last_set = None, None  # rows arrive ordered by b
        for t in batches:
            a, b = t.column(0).to_pylist(), t.column(1).to_pylist()
            ta, tb = text_bytes(t.column(2)), text_bytes(t.column(3))
            keep = []
            for i, s in enumerate(shingle_sets(ta, width)):
                if b[i] != last:
                    last, last_set = b[i], shingle_sets([tb[i]], width)[0]
                both = len(np.intersect1d(s, last_set, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(last_set) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, y in zip(v, keep) if y], pa.int64()) for v in (a, b)], names=["a", "b"])

    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id reachable over links), kept."""
    keyed, names = row_keys(docs, id_col, text_col)
    out = _components(keyed, text_col, shingle_words, percent, bands, rows)
    if names is not None:  # keys are in order of the ids, so the smallest key of a component has its smallest id
        own, first = names.toDF("_key", "id"), names.toDF("component_id", "first")
        out = (out.join(own, "_key", "left").join(first, "component_id", "left")
               .select(F.col("id").alias("_key"), "n_shingles", F.col("first").alias("component_id")))
    return out.select(F.col("_key").alias(id_col), "n_shingles", "component_id", F.expr("_key <=> component_id").alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                         percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """One row of ``docs``, that with the smallest id, of each component; rows with a null id all stay."""
    keyed, _ = row_keys(docs, id_col, text_col)
    found = stage(_components(keyed, text_col, shingle_words, percent, bands, rows), "nd-found")
    left = keyed.join(found.where("_key <> component_id").select("_key").distinct(), "_key", "left_anti")
    again = found.where("_key is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key")
    if again.isEmpty():
        return left.select([f"`{c}`" for c in docs.columns])
    # repeated rows stay once
    return left.join(again, "_key", "left_anti").select([f"`{c}`" for c in docs.columns]).union(
        left.join(again, "_key", "left_semi").dropDuplicates(["_key"]).select([f"`{c}`" for c in docs.columns]))


def _components(docs: DataFrame, text_col: str, shingle_words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Per row of keyed ``docs``: _key, n_shingles, component_id (smallest key reachable)."""
    id_col, most = "_key", _most_flips(bands * rows, percent / 100)
    sk = stage(sketches(docs, id_col, text_col, shingle_words, bands, rows), "nd-sketch")
    classes = stage(sk.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "nd-class")
    reps = sk.where("keys is not null").join(classes, "fp").where("id = rep")

    rows_ = reps.select("id", F.explode("keys").alias("key")).distinct()
    shared = rows_.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("hub")).where("size > 1")
    buckets = stage(rows_.join(shared, "key"), "nd-bucket")
    members = stage(buckets.select("id").distinct(), "nd-member")
    texts = stage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                  .join(members, "id", "left_semi").dropDuplicates(["id"]), "nd-text")
    info = stage(reps.select("id", "n", "sketch", "keys").join(members, "id", "left_semi").dropDuplicates(["id"]), "nd-info")

    def close(a: str, b: str):
        return (100 * F.least(f"n{a}", f"n{b}") >= percent * F.greatest(f"n{a}", f"n{b}")) & (_flips(f"sk{a}", f"sk{b}") <= most)

    comp = tried = None
    for r in range(ROUNDS + 2):
        if r:
            named = buckets
            if comp is not None:
                named = buckets.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
            else:
                named = buckets.withColumn("comp", F.col("id"))
            mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
            open_ = named.join(mixed, "key", "left_semi").join(info, "id")
        if r == 0:
            a, b = (info.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"sk{x}")) for x in "ab")
            hubs = buckets.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
            near = hubs.join(a, "a").join(b, "b").where(close("a", "b"))
            pairs = near.groupBy("a").agg(F.min_by("b", F.struct(_flips("ska", "skb"), "b")).alias("b")).select(
                F.col("b").alias("lo"), F.col("a").alias("hi"))
        elif r <= ROUNDS:
            chunk = F.pmod(F.xxhash64("id", F.lit(r)), F.ceil(F.col("size") / CHUNK)).cast("long")
            near = (open_.select("key", chunk.alias("chunk"), "id", "comp", "n", "sketch").repartition("key", "chunk")
                    .sortWithinPartitions("key", "chunk", "id").mapInArrow(_propose(most, percent, r + 1), "a long, b long, flips long"))
            near = near.distinct().select("a", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "flips")
            turn = F.row_number().over(Window.partitionBy("a").orderBy("flips", "lo", "hi"))
            pairs = near.join(tried, ["lo", "hi"], "left_anti").withColumn("turn", turn).where("turn <= 2").select("lo", "hi").distinct()
        if r <= ROUNDS:
            pairs = stage(pairs, "nd-pair")
            tried = pairs if tried is None else tried.union(pairs)
            found = _confirm(pairs.toDF("a", "b"), texts, shingle_words, percent)
        else:
            blocks = F.ceil(F.col("size") / BLOCK).cast("long")
            parts = (open_.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
                     .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                     .withColumn("part", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")))
            found = (parts.join(texts, "id").select("key", "part", "block", "id", "comp", "n", "sketch", "keys", "text").repartition("key", "part")
                     .sortWithinPartitions("key", "part", "id").mapInArrow(_link(most, percent, shingle_words), "a long, b long").distinct())
        found = stage(found, "nd-link")
        if not found.isEmpty():
            comp = relabel(comp, found, "nd-comp")
    if comp is None:
        comp = members.select("id", F.col("id").alias("comp"))

    named = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "fp", F.coalesce("comp", "rep").alias("component_id"))
    return (sk.select("id", "n", "fp").join(named, "fp", "left")
            .select(F.col("id").alias("_key"), F.col("n").alias("n_shingles"), "component_id"))


def op3_near_dups(spark, sf_dir: str) -> DataFrame:
    """Components of documents under links of 2-word shingle sets with a similarity of 0.8 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=2)


SQL = r"""
with recursive d as (select row_number() over () as r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
           from documents),
     s as (select distinct r, g from (select r, unnest(list_transform(range(greatest(len(ws) - 1, 1)), lambda i: array_to_string(ws[i + 1:i + 2], ' '))) as g
                                      from d where len(ws) > 0)),
     n as (select r, count(*) as n from s group by r),
     met as (select a.r as a, b.r as b, count(*) as c from s a join s b on a.g = b.g and a.r < b.r group by 1, 2),
     link as (select a, b from met join n na on na.r = a join n nb on nb.r = b where 100 * c >= 80 * (na.n + nb.n - c)),
     edge as (select a, b from link union all select b, a from link),
     reach as (select r, r as x from d union select reach.r, edge.b from reach join edge on edge.a = reach.x),
     comp as (select reach.r, min(d.doc_id) as c from reach join d on d.r = reach.x group by reach.r)
select doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c as component_id, doc_id = c as kept
from d left join n on n.r = d.r join comp on comp.r = d.r
"""
