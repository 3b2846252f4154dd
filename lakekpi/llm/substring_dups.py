"""Substring de-duplication with difference-cover anchors.

A window is ``window`` consecutive words; every word under a window whose word sequence starts earlier too (smaller
id, or same document and earlier start) goes.  Two equal windows at any two positions share an offset at which both
positions fall on the cover modulo its period, so short anchors hashed only at cover positions find every long match
with a third to a fifth of the hashes.  Anchors that occur once are forgotten; the others are extended to every
window that holds one, and only those windows are compared, by 95 bits of two hashes of their words.

Hot passages: a task settles repeats inside its own rows first and passes one row per distinct hash on, so a passage
that sits in a third of all documents arrives once per task, not once per copy.

Defined results: null texts have no words; null ids sort before all others; repeated rows are one document to the order (equal
windows at the same start of both are not earlier than each other); rows of one id, or of none, with unlike texts are
documents of their own, in order of a hash of their text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekpi.llm.common import MULT, MULT2, hash_words, read_table, row_keys, split_words, stage, text_bytes, window_hashes

# Perfect difference sets: every residue modulo the period is a difference of two members.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
FLUSH_ROWS = 1_000_000
NULL_ID = -(2**63)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """Largest period that leaves anchors of at least two fifths of the window."""
    return max(((p, d) for p, d in COVERS.items() if 5 * (window - p + 1) >= 2 * window), default=(1, (0,)))


def _first_only(h: np.ndarray, check: np.ndarray | None, ids: np.ndarray, pos: np.ndarray):
    """Order by (hash, id, position): the order, whether a row is the first of its hash, and the hash's row count."""
    order = np.lexsort((pos, ids, h) if check is None else (pos, ids, check, h))
    hs = h[order]
    new = np.ones(len(hs), bool)
    new[1:] = hs[1:] != hs[:-1]
    if check is not None:
        cs = check[order]
        new[1:] |= cs[1:] != cs[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(hs)))
    return order, new, count


# Rows as the shuffle gets them: id, then p (settled: the sign; 31 bits of a second hash or a mark; 32 bits of position),
# then the hash.  What changes from row to row lies together, which shuffle files compress best.
SHAPE = "id long, p long, h long"
POSITION = 0xFFFFFFFF


def _rows(ids: np.ndarray, pos: np.ndarray, mark: np.ndarray, settled: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    # settled rows get keys of their own, spread evenly
    own = (ids.astype(np.uint64) * MULT2 + pos.astype(np.uint64)) * MULT
    p = (settled.astype(np.uint64) << np.uint64(63)) | (mark.astype(np.uint64) << np.uint64(32)) | pos.astype(np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(p.view(np.int64)), pa.array(np.where(settled, own, h).view(np.int64))],
                                      names=["id", "p", "h"])


def repeated_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(id, marks): positions of each document's anchors that occur more than once in the corpus."""
    period, cover = cover_for(window)
    width = window - period + 1
    on_cover = np.zeros(period, bool)
    on_cover[list(cover)] = True

    def settle(parts):
        h, ids, pos = (np.concatenate(x) for x in zip(*parts))
        order, new, count = _first_only(h, None, ids, pos)
        several = np.repeat(count > 1, count)
        # the first of a repeated hash repeats as well, but others must still meet it under its own key
        return _rows(ids[order], pos[order], several, several & ~new, h[order])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            words, off = split_words(text_bytes(b.column(1)), lower=False)
            if len(words) >= width:
                w = window_hashes(hash_words(words), width)
                size = np.diff(off)
                pos = np.arange(len(words)) - np.repeat(off[:-1], size)
                left = np.repeat(size, size) - pos
                # anchors are of use only where a whole window fits into the document
                ok = np.flatnonzero((on_cover[pos % period] & (left >= width) & (np.repeat(size, size) >= window))[:len(w)])
                parts.append((w[ok], np.repeat(ids, size)[ok], pos[ok]))
                held += len(ok)
            if held >= FLUSH_ROWS:
                yield settle(parts)
                parts, held = [], 0
        if held:
            yield settle(parts)

    n = F.count(F.lit(1)).over(Window.partitionBy("h"))
    marks = (docs.mapInArrow(run, SHAPE).withColumn("n", n).where((F.col("n") > 1) | (F.shiftrightunsigned("p", 32) > 0))
             .select("id", F.col("p").bitwiseAND(F.lit(POSITION)).cast("int").alias("pos")))
    return marks.groupBy("id").agg(F.collect_list("pos").alias("marks"))


def repeated_windows(docs: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """(id, starts): starts of each document's windows whose word sequence starts earlier too."""
    period, _ = cover_for(window)

    def settle(parts):
        h, check, ids, pos = (np.concatenate(x) for x in zip(*parts))
        order, new, count = _first_only(h, check, ids, pos)
        ids, pos = ids[order], pos[order]
        lead = np.repeat(np.flatnonzero(new), count)
        earlier = (ids != ids[lead]) | (pos != pos[lead])  # an earlier start lies in this task
        return _rows(ids, pos, check[order], earlier, h[order])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            marks = b.column(2).to_pylist()
            words, off = split_words(text_bytes(b.column(1)), lower=False)
            hw = hash_words(words)
            for i, m in enumerate(marks):
                h = hw[off[i]:off[i + 1]]
                m = np.asarray(m, np.int64)
                n = len(h) - window + 1
                if n <= 0:
                    continue
                # extend: every window [s, s + window) that holds a repeated anchor
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, np.clip(m - period + 1, 0, n), 1)
                np.add.at(edge, np.clip(m + 1, 0, n), -1)
                s = np.flatnonzero(np.cumsum(edge[:n]) > 0)
                if not len(s):
                    continue
                check = (window_hashes(h, window, MULT2)[s] >> np.uint64(33)).astype(np.uint32)
                parts.append((window_hashes(h, window)[s], check, np.full(len(s), ids[i]), s))
                held += len(s)
                if held >= FLUSH_ROWS:
                    yield settle(parts)
                    parts, held = [], 0
        if held:
            yield settle(parts)

    rows = docs.join(marks, "id").select("id", "text", "marks").mapInArrow(run, SHAPE)
    spec = Window.partitionBy("h").orderBy("id", F.col("p"))
    first = rows.withColumn("r", F.rank().over(spec)).withColumn("f", F.first("p").over(spec))
    same = F.shiftrightunsigned("f", 32) == F.shiftrightunsigned("p", 32)  # else two texts share 64 bits by chance
    late = first.where((F.col("p") < 0) | (F.col("r") > 1) & same).select(
        "id", F.col("p").bitwiseAND(F.lit(POSITION)).cast("int").alias("s"))
    return late.groupBy("id").agg(F.collect_set("s").alias("starts"))


def covered(n: int, starts, window: int) -> np.ndarray:
    """Mask of the words under any of the windows."""
    edge = np.zeros(n + 1, np.int64)
    s = np.asarray(starts, np.int64)
    s = s[s + window <= n]
    edge[s] += 1
    np.add.at(edge, s + window, -1)
    return np.cumsum(edge[:n]) > 0


def repeats(rows: DataFrame, text_col: str = "text", window: int = 20) -> DataFrame:
    """(id, starts) for the documents with repeated windows, by the ``_key`` of ``rows``."""
    rows = rows.select(F.col("_key").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    marks = stage(repeated_anchors(rows, window), "sd-mark")
    return stage(repeated_windows(rows, marks, window), "sd-repeat")


def _cut(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words marked, and without the blanks that follow each of them."""
    parts = re.finditer(rb"^[\x20\x09-\x0D]*|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)  # the first is the leading blanks
    return b"".join(m.group() for m, g in zip(parts, [False, *gone.tolist()]) if not g)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text_col`` (blanks elsewhere stay as they are), and two more columns:
    ``_words``, the words there were, and ``_removed``, those that went."""
    cols = docs.columns
    rows, _ = row_keys(docs, id_col, text_col, NULL_ID)
    at = cols.index(text_col)
    rows = rows.join(repeats(rows, text_col, window).toDF("_key", "_starts"), "_key", "left")
    schema = T.StructType([*docs.schema.fields, T.StructField("_words", T.LongType()), T.StructField("_removed", T.LongType())])

    def run(batches):
        for b in batches:
            texts = b.column(at).cast(pa.large_binary()).to_pylist()
            words, removed = [], []
            for i, s in enumerate(b.column(len(cols)).to_pylist()):
                words.append(len((texts[i] or b"").split()))
                gone = covered(words[-1], s, window) if s else np.zeros(0, bool)
                removed.append(int(gone.sum()))
                if removed[-1]:
                    texts[i] = _cut(texts[i], gone)
            new = pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(b.column(at).type)
            yield pa.RecordBatch.from_arrays([*(new if i == at else b.column(i) for i in range(len(cols))), pa.array(words, pa.int64()), pa.array(removed, pa.int64())],
                                             names=[*cols, "_words", "_removed"])

    return rows.select(*[f"`{c}`" for c in cols], "_starts").mapInArrow(run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space)."""
    rows, _ = row_keys(docs, id_col, text_col, NULL_ID)
    found = repeats(rows, text_col, window).withColumnRenamed("id", "_key")
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), "_key").join(found, "_key", "left")

    def run(batches):
        for b in batches:
            n, gone_n, sha = [], [], []
            for t, s in zip(text_bytes(b.column(1)), b.column(2).to_pylist()):
                words = t.split()
                gone = covered(len(words), s, window) if s else None
                n.append(len(words))
                gone_n.append(0 if gone is None else int(gone.sum()))
                kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone_n, pa.int64()), pa.array(sha)],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.select("doc_id", "text", "starts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op4_substring_dups(spark, sf_dir: str) -> DataFrame:
    """Words left of each document once every repeated window of 20 words is gone."""
    return digests(read_table(spark, sf_dir, "documents"))


SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     w as (select r, doc_id, i, array_to_string(ws[i + 1:i + 20], ' ') as t
           from (select r, doc_id, ws, unnest(range(len(ws) - 19)) as i from d where len(ws) >= 20)),
     k as (select r, i, row_number() over (partition by t order by doc_id, i) as n from w),
     gone as (select distinct r, unnest(range(i, i + 20)) as p from k where n > 1),
     word as (select r, unnest(range(len(ws))) as p, unnest(ws) as x from d),
     kept as (select word.r, string_agg(x, ' ' order by word.p) as t from word anti join gone on gone.r = word.r and gone.p = word.p group by word.r),
     removed as (select r, count(*) as n from gone group by r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(removed.n, 0) as bigint) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from d left join kept on kept.r = d.r left join removed on removed.r = d.r
"""
