"""Token counts of whole texts; huge documents are encoded in overlapping chunks and spliced.

Texts of up to ``chunk_chars`` characters are counted at once, from the ids of their words.  Longer ones are cut into chunks that overlap, the chunks
are dealt over the cluster, and each is encoded with offsets.  Inside an overlap, a token that begins right after a
blank is a stable boundary: no token of this vocabulary reaches across a blank, so what follows does not
depend on what came before.  Two neighbours are spliced at the first position that both report as stable; where an
overlap has none, the document is done again with chunks and overlaps four times as wide, in the end as one chunk.

Defined results: null texts are empty; empty texts have no tokens; every row, repeated ones and those with a null
id too, gets a row of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage, text_bytes
from lakekpi.llm.tokenizing import VOCABULARY, encoder, load

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
AT_ONCE = 8  # chunks whose encodings are held at a time
SPREAD_BYTES = 4 << 20  # of huge texts in a partition of chunks
BLANKS = " \t\n\r"


def _count_short(name: str, chunk_chars: int):
    def run(batches):
        words = encoder(name)
        for b in batches:
            texts = text_bytes(b.column(2))
            plain = [t.decode("utf-8", "replace") if len(t) > chunk_chars else None for t in texts]  # no more characters than bytes
            short = [p is None or len(p) <= chunk_chars for p in plain]
            n = words.count([t if s else b"" for t, s in zip(texts, short)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64(), mask=~np.array(short, bool)),
                 pa.array([None if s else p for p, s in zip(plain, short)], pa.string())],
                names=["row", "doc_id", "n_bytes", "n_tokens", "text"])

    return run


def _chunks(chunk_chars: int, overlap: int):
    def run(batches):
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                step, out = chunk_chars - overlap, []
                for no, start in enumerate(range(0, max(1, len(text) - overlap), step)):
                    out.append((row, no, start, start + chunk_chars >= len(text), text[start:start + chunk_chars]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))], names=["row", "no", "start", "last", "piece"])

    return run


def _stable(encoding, piece: str, low: int, high: int) -> list[tuple[int, int]]:
    """(place, token) of the tokens of a piece that begin at one of the places low..high - 1, right after a blank."""
    out = []
    for a in range(low, high):
        if piece[a - 1] in BLANKS and piece[a] not in BLANKS:
            t = encoding.char_to_token(a)
            if t is not None and encoding.token_to_chars(t)[0] == a:
                out.append((a, t))
    return out


def _encode(name: str, overlap: int):
    pairs = pa.map_(pa.int64(), pa.int64())

    def run(batches):
        tok = load(name)
        for b in batches:
            row, no, start, last, piece = (b.column(i).to_pylist() for i in range(5))
            n, left, right = [], [], []
            for i in range(0, len(piece), AT_ONCE):
                for s, p, e in zip(start[i:], piece[i:i + AT_ONCE], tok.encode_batch(piece[i:i + AT_ONCE], add_special_tokens=False)):
                    n.append(len(e))
                    left.append([(s + a, t) for a, t in _stable(e, p, 1, min(overlap, len(p)))])
                    right.append([(s + a, t) for a, t in _stable(e, p, max(1, len(p) - overlap), len(p))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(no, pa.int64()), pa.array(last, pa.bool_()), pa.array(n, pa.int64()),
                 pa.array(left, pairs), pa.array(right, pairs)], names=["row", "no", "last", "n", "left", "right"])

    return run


def splice(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens): tokens between the splice points, null where two neighbours share no stable boundary."""
    order = Window.partitionBy("row").orderBy("no")
    common = F.array_sort(F.array_intersect(F.map_keys("right"), F.map_keys(F.lead("left").over(order))))
    cut = encoded.withColumn("to", F.when(~F.col("last"), F.try_element_at(common, F.lit(1)))).withColumn("from", F.lag("to").over(order))
    upto = F.when(F.col("last"), F.col("n")).otherwise(F.try_element_at("right", F.col("to")))
    since = F.when(F.col("no") == 0, F.lit(0)).otherwise(F.try_element_at("left", F.col("from")))
    part = cut.select("row", (upto - since).alias("n"))
    return part.groupBy("row").agg(F.when(F.count("n") == F.count(F.lit(1)), F.sum("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 limit: int = 2048, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    done = stage(rows.mapInArrow(_count_short(vocabulary, chunk_chars), "row long, doc_id long, n_bytes long, n_tokens long, text string"), "tc-rows")
    todo = done.where("n_tokens is null").select("row", "text")
    size = done.where("n_tokens is null").agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES))
    found = None
    while not todo.isEmpty():
        pieces = todo.mapInArrow(_chunks(chunk_chars, overlap), "row long, no long, start long, last boolean, piece string")
        encoded = pieces.repartition(parts, "row", "no").mapInArrow(
            _encode(vocabulary, overlap), "row long, no long, last boolean, n long, left map<bigint,bigint>, right map<bigint,bigint>")
        got = stage(splice(encoded), "tc-splice")
        ok = got.where("n_tokens is not null")
        found = ok if found is None else found.union(ok)
        todo = todo.join(got.where("n_tokens is null"), "row", "left_semi")
        chunk_chars, overlap = 4 * chunk_chars, 4 * overlap
    out = done.select("row", "doc_id", "n_bytes", "n_tokens")
    if found is not None:
        out = out.join(found.withColumnRenamed("n_tokens", "spliced"), "row", "left").withColumn("n_tokens", F.coalesce("n_tokens", "spliced"))
    return out.select(F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 49k word vocabulary."""
    return count_tokens(read_table(spark, sf_dir, "documents"))
