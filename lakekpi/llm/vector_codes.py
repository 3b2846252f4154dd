"""Vector code compression: a codebook for each part of the vectors, fitted by ball k-means on integers.

Components are turned to integers, vectors are cut into equal parts, and every part position has its own codebook.  An
entry and the parts assigned to it form a ball.  In a round, each block of rows measures its parts against their own
entry; the largest distance is the ball's radius in that block.  Only entries nearer to a ball's entry than twice its
radius are its neighbours.  Parts nearer to their entry than half the way to its nearest neighbour are the stable core and
keep their code; the others lie in rings, the m-th of which reaches half way to the m-th neighbour and is compared with
the first m neighbours only.  Balls whose entry and neighbours did not move are left alone.  All of that follows from
the triangle inequality in squared integers, so the codes are those of a comparison with every entry, ties included.

The first assignment has no balls yet and compares with every entry.  Each round is one job over the rows as the last
round wrote them with their codes; it writes them with the new codes and, from every task, the sums and counts of the
parts by entry, from which the next entries follow.  Only codebooks (``entries`` times the vector's length) come to the driver.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors that are shorter than
the longest, or than a multiple of the number of parts, are filled up with zeros; components are held at 2**62 either way
and errors at the largest long; rows with a null id are coded too, and come last among the first entries; rows of one id are
each coded, and ordered by their vector; with fewer rows than entries the codebooks are smaller.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage
from lakekpi.operators.joins import hot_keys, skew_split_join
from lakekpi.session import scratch_dir

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
HELD = 2**62
BLOCK_BYTES = 1 << 25  # of vectors that are worked on at a time
EXACT = 2**53  # doubles hold integers up to here
LIMIT = 2**63 - 1


def _square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(-1)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries."""
    if x.dtype == object:
        return np.array([[sum(int(d) ** 2 for d in r - e) for e in c] for r in x], object).reshape(len(x), len(c))
    return _square(x)[:, None] - 2 * (x @ c.T) + _square(c)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its squared distance, ties to the lower index."""
    codes, error = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for s in range(0, len(x), 4096):
        d = _distances(x[s:s + 4096], c)
        codes[s:s + 4096] = d.argmin(1)
        error[s:s + 4096] = d[np.arange(len(d)), codes[s:s + 4096]]
    return codes, error


class Balls:
    """A codebook's entries, how far they are from each other, and which moved since the last round."""

    def __init__(self, entries: np.ndarray, last: np.ndarray):
        self.entries, self.moved = entries, (entries != last).any(1)
        apart = np.maximum(_distances(entries, entries), 0)
        np.fill_diagonal(apart, -1)  # an entry comes first in its own order
        self.order = np.argsort(apart, 1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.compared = 0  # distances of parts to entries other than their own

    def assign(self, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``nearest``, for parts that had ``codes`` in the last round."""
        error = _square(x - self.entries[codes])
        codes, reach = codes.copy(), 4 * error
        order = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes, minlength=len(self.entries)))
        for ball, e in enumerate(ends):
            rows = order[ends[ball - 1] if ball else 0:e]
            if not len(rows):
                continue
            near = np.searchsorted(self.apart[ball], reach[rows], "right")  # ring of each part: 0 is the core
            widest = near.max()
            if not widest or not (self.moved[ball] or self.moved[self.order[ball, :widest]].any()):
                continue
            low = 0
            while low < widest:
                high = min(widest, max(1, 2 * low))  # rings are taken together up to twice as many neighbours
                ring = rows[(near > low) & (near <= high)]
                if len(ring):
                    others = np.sort(np.append(self.order[ball, :high], ball))
                    d = _distances(x[ring], self.entries[others])
                    self.compared += d.size - len(ring)
                    best = d.argmin(1)
                    codes[ring], error[ring] = others[best], d[np.arange(len(ring)), best]
                low = high
        return codes, error


def _blocks(batches, dim: int):
    """Batches put together to blocks of about ``BLOCK_BYTES`` of vectors, with the vectors as a matrix."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows * dim * 8 >= BLOCK_BYTES:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of 64-bit integers, filled up with zeros."""
    column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim), np.int64)
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _exact(v: np.ndarray, books: np.ndarray, width: int) -> bool:
    """Whether all sums of a part's distances fit a double."""
    top = max(int(abs(int(f(a)))) for a in (v, books) if a.size for f in (np.min, np.max)) if v.size or books.size else 0
    return 16 * top * top * max(1, width) < EXACT


def _round(books: np.ndarray, last: np.ndarray | None, dim: int):
    """One assignment: rows with their new codes and errors and, at the end, the task's sums of parts by entry."""
    parts, width = books.shape[0], books.shape[2]

    def run(batches):
        sums = np.zeros(books.shape, object)
        counts, safe, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64), 0
        for t in _blocks(batches, dim):
            v = _matrix(t.column("v"), dim)
            exact = _exact(v, books, width)
            codes, error = np.zeros((len(v), parts), np.int64), np.zeros(len(v), np.int64 if exact else object)
            old = None if last is None else np.frombuffer(b"".join(t.column("codes").to_pylist()), np.uint16).reshape(-1, parts)
            for p in range(parts):
                x, c = v[:, p * width:(p + 1) * width], books[p]
                if not exact:
                    codes[:, p], e = nearest(x.astype(object), c.astype(object))
                elif old is None:
                    codes[:, p], e = nearest(x.astype(np.float64), c.astype(np.float64))
                else:
                    balls = Balls(c.astype(np.float64), last[p].astype(np.float64))
                    codes[:, p], e = balls.assign(x.astype(np.float64), old[:, p].astype(np.int64))
                error += e.astype(error.dtype)
                order = np.argsort(codes[:, p], kind="stable")
                counts[p] += (n := np.bincount(codes[:, p], minlength=len(c)))
                if used := list(np.flatnonzero(n)):
                    starts = (np.cumsum(n) - n)[used]
                    if exact:  # far below 2**63 for the rows of a block
                        safe[p][used] += np.add.reduceat(x[order], starts, axis=0)
                    else:
                        sums[p][used] += np.add.reduceat(x[order].astype(object), starts, axis=0)
            total += len(v)
            if total > 1 << 30:  # long before the sums could overflow
                sums, safe, total = sums + safe, np.zeros(books.shape, np.int64), 0
            packed = codes.astype(np.uint16)
            yield _batch(t.num_rows, vec_id=t.column("vec_id"), label=t.column("label"), v=t.column("v"),
                         codes=pa.array([r.tobytes() for r in packed], pa.binary()),
                         error=pa.array(error if exact else [min(LIMIT, int(x)) for x in error], pa.int64()))
        p, e = np.nonzero(counts)
        if len(p):
            sums = sums + safe
            yield _batch(len(p), part=pa.array(p, pa.int32()), entry=pa.array(e, pa.int32()), n=pa.array(counts[p, e]),
                         sums=pa.array([[int(x) for x in r] for r in sums[p, e]], pa.list_(pa.decimal128(38, 0))))

    return run


FIELDS = {"vec_id": pa.int64(), "label": pa.string(), "v": pa.list_(pa.int64()), "codes": pa.binary(), "error": pa.int64(), "part": pa.int32(),
          "entry": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.decimal128(38, 0))}
SCHEMA = ("vec_id long, label string, v array<long>, codes binary, error long, part int, entry int, n long, "
          "sums array<decimal(38,0)>")


def _batch(rows: int, **columns) -> pa.RecordBatch:
    cols = []
    for name, kind in FIELDS.items():
        c = columns.get(name)
        c = pa.nulls(rows, kind) if c is None else c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        cols.append(c.cast(kind))
    return pa.RecordBatch.from_arrays(cols, names=list(FIELDS))


def _assign(rows: DataFrame, books: np.ndarray, last: np.ndarray | None, dim: int) -> tuple[DataFrame, DataFrame]:
    """(rows with codes and errors, sums of parts by entry), written in one pass."""
    spark = rows.sparkSession
    path = f"{scratch_dir(spark)}/vc-round-{uuid.uuid4().hex}"
    out = rows.select("vec_id", "label", "v", "codes").mapInArrow(_round(books, last, dim), SCHEMA)
    out.withColumn("kind", F.when(F.col("part").isNull(), "rows").otherwise("sums")).write.partitionBy("kind").parquet(path)
    back = spark.read.schema(SCHEMA + ", kind string").parquet(path)
    return (back.where("kind = 'rows'").select("vec_id", "label", "v", "codes", "error"),
            back.where("kind = 'sums'").select("part", "entry", "n", "sums"))


def _moved(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Each entry replaced by the floor of its parts' mean; unused entries stay."""
    long = sums.select("part", "entry", "n", F.posexplode("sums").alias("pos", "s"))
    total = long.groupBy("part", "entry", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = books.copy()
    for r in total.collect():  # as many rows as the codebooks have components
        out[r.part, r.entry, r.pos] = int(r.s) // r.n
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(rows: vec_id, label, codes (one per part), error; codebooks: parts x entries x width integers)."""
    if not 0 < entries <= 1 << 16:
        raise ValueError("a codebook has 1 to 65536 entries")
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    bound = F.lit(float(HELD))
    whole = F.transform(F.col(vec_col), lambda x: F.floor(F.greatest(-bound, F.least(bound, x.cast("double") * scale))).cast("long"))
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    rows = stage(vectors.where(F.col(vec_col).isNotNull() & F.coalesce(fine, F.lit(False)))
                 .select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"),
                         F.lit(None).cast("binary").alias("codes")), "vc-rows")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    dim = width * parts
    first = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    books = np.zeros((parts, len(first), width), np.int64)
    for i, r in enumerate(first):
        books[:, i, :] = np.array(r.v + [0] * (dim - len(r.v)), np.int64).reshape(parts, width)
    last = None
    for turn in range(rounds + 1):
        rows, sums = _assign(rows, books, last, dim)
        last = books
        if turn < rounds:
            books = _moved(books, sums)
    return rows.select("vec_id", "label", "codes", "error"), books


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all embeddings in 4 codebooks of 256 entries, with errors by row and by label."""
    coded, books = compress(read_table(spark, sf_dir, "embeddings"))
    # codes are stored as little-endian 16-bit numbers; with 256 entries the first byte of each says all
    code = F.lower(F.concat(*[F.substring(F.hex("codes"), 4 * p + 1, 2) for p in range(PARTS)]))
    coded = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("null")))
    sums = coded.groupBy("key").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("all"))
    sums = sums.select("key", F.least("all", F.lit(LIMIT)).cast("long").alias("label_error"))
    # a label may be that of a third of all rows
    out = skew_split_join(coded, sums, "key", "left", hot_keys(coded, "key"))
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    def assigned(i):
        return f"""a{i} as materialized (
      select p.r, p.part, arg_min(b.entry, (dist, b.entry)) as entry, min(dist) as dist
      from (select p.r, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as dist
            from p join b{i} b on b.part = p.part) p join b{i} b on b.part = p.part and b.entry = p.entry
      group by p.r, p.part)"""

    def moved(i):
        return f"""s{i} as materialized (
      select a.part, a.entry, k, cast(floor(sum(p.x[k]) / cast(count(*) as double)) as bigint) as m
      from a{i} a join p on p.r = a.r and p.part = a.part, unnest(range(1, len(p.x) + 1)) u(k) group by a.part, a.entry, k),
    b{i + 1} as materialized (
      select b.part, b.entry, coalesce(m.c, b.c) as c
      from b{i} b left join (select part, entry, list(m order by k) as c from s{i} group by part, entry) m
        on m.part = b.part and m.entry = b.entry)"""

    steps = []
    for i in range(rounds):
        steps += [assigned(i), moved(i)]
    steps.append(assigned(rounds))
    return f"""
    with v as materialized (
      select row_number() over (order by vec_id) - 1 as r, vec_id, label,
             list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
      from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as materialized (
      select r, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] as x from v, unnest(range(0, {parts})) u(part)),
    b0 as materialized (select part, r as entry, x as c from p where r < {entries}),
    {", ".join(steps)},
    e as (select r, cast(sum(dist) as bigint) as error, string_agg(printf('%02x', entry), '' order by part) as code from a{rounds} group by r),
    h as (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, k)) as d
          from (select part, entry, k, c[k] as x from b{rounds}, unnest(range(1, len(c) + 1)) u(k)))
    select v.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h.d as codebooks_sha256
    from v join e on e.r = v.r, h"""


SQL = _sql()
