"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, probed with every window of every document.

A window is ``width`` consecutive words of a benchmark item; an item with fewer words, but at least one, is one window.
Each document is split into words once; the windows that begin at each word are hashed inside the scan stage and looked
up in the broadcast set, and the words of a window are compared before it counts.  Only true hits leave the scan.  The
set is broadcast up to ``broadcast_windows`` distinct windows (about 100 bytes each); a larger benchmark takes
a shuffled join on two independent hashes instead.

All steps are DataFrame functions.  Defined results: null texts have no words; benchmark rows with null item_id or
text are left out; rows of documents are told apart by id and text, so repeated rows each get their own equal result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage

WIDTH = 13
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # two words of text in any case
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
BROADCAST_WINDOWS = 500_000


def any_case_words(text: Column) -> Column:
    """Words as they stand, by ``split``: 2.6 s for 0.1 GB of documents, where ``regexp_extract_all`` took 21.1 s."""
    return F.array_remove(F.split(text, BETWEEN), "")  # empty before the first and after the last word


def words(text: Column) -> Column:
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    ascii_only = F.octet_length(text) == F.length(text)  # for which ``lower``, the faster, turns A-Z alone
    return any_case_words(F.when(ascii_only, F.lower(text)).otherwise(low))


def benchmark_windows(benchmark: DataFrame, width: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, w, h): the words of each window, and their hash."""
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("ws")).where("size(ws) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - width, F.lit(0)))
    return (items.select("item", "ws", F.explode(starts).alias("at"))
            .select("item", F.slice("ws", F.col("at") + 1, width).alias("w")).distinct()
            .withColumn("h", F.xxhash64("w")))


def window_hits(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str,
                broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Distinct (id, text_hash, at, len, h, h2): the benchmark windows that occur in each document."""
    grams = windows.select("h", "w").distinct()
    lengths = [r[0] for r in grams.select(F.size("w")).distinct().collect()]  # at most ``width`` numbers
    at = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("ws")).select(
        "id", "text_hash", "ws", F.posexplode("ws").alias("at", "word")).drop("word")
    if len(lengths) == 1:
        at = at.withColumn("len", F.lit(lengths[0]))
    else:
        at = at.withColumn("len", F.explode(F.array(*[F.lit(n) for n in sorted(lengths)]) if lengths else F.lit([]).cast("array<int>")))
    at = at.where(F.col("at") + F.col("len") <= F.size("ws"))
    part = F.slice("ws", F.col("at") + 1, F.col("len"))
    if grams.count() <= broadcast_windows:
        hit = at.withColumn("h", F.xxhash64(part)).join(F.broadcast(grams), "h").where(part == F.col("w"))
        hit = hit.select("id", "text_hash", "at", "len", "h", F.xxhash64(F.lit(1), F.col("w")).alias("h2"))
    else:
        keys = at.select("id", "text_hash", "at", "len", F.xxhash64(part).alias("h"), F.xxhash64(F.lit(1), part).alias("h2"))
        hit = keys.join(grams.select("h", F.xxhash64(F.lit(1), F.col("w")).alias("h2")), ["h", "h2"], "left_semi")
    return hit.select("id", "text_hash", "at", "len", "h", "h2").distinct()


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
          percent: int = 5, broadcast_windows: int = BROADCAST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Verdict per document (id, text_hash, n_hit, n_items, items_sha256; only documents with hits), and the hits."""
    windows = stage(benchmark_windows(benchmark, width), "bd-window")
    hits = stage(window_hits(docs, windows, id_col, text_col, broadcast_windows), "bd-hit")
    doc = ["id", "text_hash"]
    # words under the union of the windows: each start adds what reaches beyond all ends before it
    ends = hits.groupBy(*doc, "at").agg((F.col("at") + F.max("len")).alias("end"))
    before = Window.partitionBy(*doc).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("at", F.coalesce(F.col("reach"), F.lit(0)))
    hit = (ends.withColumn("reach", F.max("end").over(before))
           .groupBy(*doc).agg(F.sum(F.greatest(fresh, F.lit(0))).cast("long").alias("n_hit")))
    named = windows.select("h", F.xxhash64(F.lit(1), F.col("w")).alias("h2"), "item")
    items = (hits.select(*doc, "h", "h2").distinct().join(named, ["h", "h2"]).select(*doc, "item").distinct()
             .groupBy(*doc).agg(F.count(F.lit(1)).alias("n_items"),
                                F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256")))
    same = [hit.id.eqNullSafe(items.id), hit.text_hash == items.text_hash]
    return hit.join(items, same).select(hit.id, hit.text_hash, "n_hit", "n_items", "items_sha256"), hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  width: int = WIDTH, percent: int = 5, remove: str = "documents",
                  broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` without the contaminated documents, or (``remove="spans"``) with the hit words cut from every text.

    A document is contaminated when hit words make up ``percent`` or more of its words.
    """
    verdict, hits = judge(docs, benchmark, id_col, text_col, width, percent, broadcast_windows)
    d = docs.alias("d")
    own = [F.col(f"d.`{id_col}`"), F.xxhash64(F.col(f"d.`{text_col}`"))]
    cols = [F.col(f"d.`{c}`") for c in docs.columns]
    if remove == "documents":
        v = verdict.alias("v")
        bad = (F.col("v.n_hit") > 0) & (100 * F.col("v.n_hit") >= percent * F.size(any_case_words(F.col(f"d.`{text_col}`"))))
        return d.join(v, own[0].eqNullSafe(F.col("v.id")) & (own[1] == F.col("v.text_hash")) & bad, "left_anti")
    spots = (hits.groupBy("id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list(
        F.sequence(F.col("at"), F.col("at") + F.col("len") - 1)))).alias("spots"))).alias("s")
    text = F.col(f"d.`{text_col}`")
    pieces = F.regexp_extract_all(text, F.lit(GAP + ANY_CASE), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.array_contains(F.col("s.spots"), i))
    new = F.when(F.col("s.spots").isNull(), text).otherwise(
        F.concat(F.array_join(kept, ""), F.regexp_extract(text, GAP + "$", 0)))
    joined = d.join(spots, own[0].eqNullSafe(F.col("s.id")) & (own[1] == F.col("s.text_hash")), "left")
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
           percent: int = 5, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    verdict, _ = judge(docs, benchmark, id_col, text_col, width, percent, broadcast_windows)
    v = verdict.withColumnsRenamed({"id": "v_id", "text_hash": "v_hash"})
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.when(F.col(text_col).isNull(), 0).otherwise(F.size(any_case_words(F.col(text_col)))).cast("long").alias("n_words"))
    out = rows.join(v, (rows.text_hash == v.v_hash) & rows.doc_id.eqNullSafe(v.v_id), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((n_hit > 0) & (100 * n_hit >= percent * F.col("n_words"))).alias("contaminated"))


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Hits of 13-word benchmark windows in each document, and whether they make up a twentieth of its words."""
    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as ws
           from documents),
     b as (select item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as ws
           from benchmark where item_id is not null),
     bw as (select distinct item_id, w, len(w) as n from
              (select item_id, unnest(list_transform(range(greatest(len(ws) - {WIDTH}, 0) + 1), lambda i: ws[i + 1 : i + {WIDTH}])) as w
               from b where len(ws) > 0)),
     lens as (select distinct n from bw),
     dw as (select r, n, i, ws[i + 1 : i + n] as w
            from (select r, ws, n, unnest(range(len(ws) - n + 1)) as i from d, lens where len(ws) >= n)),
     hit as (select r, i, dw.n, item_id from dw join bw on dw.w = bw.w),
     spots as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
     items as (select r, count(*) as n_items, sha256(string_agg(s, ',' order by s)) as items_sha256
               from (select distinct r, cast(item_id as varchar) as s from hit) group by r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join spots using (r) left join items using (r)
"""
