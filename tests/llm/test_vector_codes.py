import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from lakekpi.llm import vector_codes as vc

FIELDS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("v", "codes", "key", "part", "n", "kind")]])


def table(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxxx") for r in rows], FIELDS)


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, [max(-2**62, min(2**62, math.floor(scale * x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[r[p] for r in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(r[p], c)), e) for e, c in enumerate(books[p])) for p in range(parts)] for r in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [r[p] for r, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    coded = [(i, "".join(f"{e:02x}" for _, e in f), min(2**63 - 1, sum(d for d, _ in f)), label) for (i, _, label), f in zip(kept, assign())]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, min(2**63 - 1, sum(y[2] for y in coded if y[3] == label)), sha) for i, c, e, label in coded), key=str)


def through(spark, rows, monkeypatch):
    monkeypatch.setattr(vc, "read_table", lambda *a: table(spark, rows))
    out = vc.op11_vector_codes(spark, "")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def vectors(rng, n, dim, spread=0.2):
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(12)]
    return [[x + rng.gauss(0, spread) for x in rng.choice(centres)] for _ in range(n)]


def test_equals_brute_force(llm, monkeypatch):
    rng = random.Random(4)
    rows = [(i, v, rng.choice([0, 0, 0, 1, None])) for i, v in enumerate(vectors(rng, 420, 8))]
    rows += [(1000 + i, rows[i][1], 5) for i in range(30)] + [rows[3], rows[3], (7, [0.5] * 8, 1), (None, [0.1] * 8, 1), (None, [0.2] * 8, None)]
    rows += [(2000, None, 1), (2001, [0.0] * 7 + [None], 1), (2002, [math.nan] * 8, 1), (2003, [math.inf] + [0.0] * 7, 1)]
    assert through(llm, rows, monkeypatch) == brute(rows)


def test_ties_and_equal_entries(llm, monkeypatch):
    """Vectors on a coarse grid: many equal first entries, many parts as near to one entry as to another."""
    rng = random.Random(9)
    rows = [(i, [rng.randrange(4) / 1024 for _ in range(4)], i % 3) for i in range(600)]
    assert through(llm, rows, monkeypatch) == brute(rows)


@pytest.mark.parametrize("rows", [
    [], [(1, None, 1)], [(5, [], 1)], [(1, [0.3, -0.2], None), (2, [0.1, 0.2, 0.3, 0.4, 0.5], None), (2, [0.9], 1)],
    [(i, [(-1) ** i * 10.0 ** (i % 40), 2.0**-i, 3e38, -1.0], 0) for i in range(30)]])
def test_small_ragged_and_huge(llm, monkeypatch, rows):
    assert through(llm, rows, monkeypatch) == brute(rows)


def test_other_shapes(llm):
    rng = random.Random(3)
    rows = [(i, v, 0) for i, v in enumerate(vectors(rng, 100, 6))]
    coded, books = vc.compress(table(llm, rows), label_col=None, parts=2, entries=16, rounds=2, scale=64)
    want = brute(rows, 2, 16, 2, 64)
    assert vc.codebook_digest(books) == want[0][-1] and books.shape == (2, 16, 3)
    got = {r.vec_id: (np.frombuffer(r.codes, np.uint16).tolist(), r.error) for r in coded.collect()}
    assert got == {i: ([int(c[:2], 16), int(c[2:], 16)], e) for i, c, e, _, _ in want}
    with pytest.raises(ValueError):
        vc.compress(table(llm, rows), entries=1 << 17)


def test_balls_compare_with_neighbours_only():
    rng = np.random.default_rng(5)
    centres = rng.integers(-1000, 1000, (64, 3)).astype(float)
    x = (centres[rng.integers(0, 64, 5000)] + rng.integers(-60, 61, (5000, 3))).astype(float)
    old, _ = vc.nearest(x, centres)
    entries = centres + rng.integers(-30, 31, centres.shape)
    balls = vc.Balls(entries, centres)
    codes, error = balls.assign(x, old)
    want, least = vc.nearest(x, entries)
    assert (codes == want).all() and (error == least).all()
    assert 0 < balls.compared < 5000 * 63 / 8
    still = vc.Balls(centres, centres)  # nothing moved: nothing is compared
    assert (still.assign(x, old)[0] == old).all() and still.compared == 0


def test_balls_after_any_code():
    """Right whatever entry a part had before."""
    rng = np.random.default_rng(6)
    entries = rng.integers(-5, 6, (40, 2)).astype(float)
    x = rng.integers(-8, 9, (2000, 2)).astype(float)
    codes, error = vc.Balls(entries, entries + 1).assign(x, rng.integers(0, 40, 2000))
    want, least = vc.nearest(x, entries)
    assert (codes == want).all() and (error == least).all()


def test_blocks_of_a_task(llm, monkeypatch):
    rng = random.Random(8)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(rng, 300, 4))]
    monkeypatch.setattr(vc, "BLOCK_BYTES", 1)
    assert through(llm, rows, monkeypatch) == brute(rows)
