import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakekpi.llm import simhash_dups as sh

from .conftest import frame, prose


def plain_fingerprint(text, width=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(items, most=3):
    """Smallest id reachable for each (id, fingerprint)."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            if None not in (items[a][0], items[b][0]) and (items[a][1] ^ items[b][1]).bit_count() <= most:
                root[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(items):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return [least.get(find(x)) if i is not None else None for x, (i, _) in enumerate(items)]


def brute(rows, width=3):
    fps = [(i, plain_fingerprint(t, width)) for i, t in rows]
    return sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, least_reachable(fps))), key=str)


def test_equals_brute_force(llm, awkward):
    for width in (3, 1):
        out = sh.simhash_duplicates(frame(llm, awkward), shingle_words=width)
        assert out.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(map(tuple, out.collect()), key=str) == brute(awkward, width)


def test_unlike_rows_of_one_id_keep_their_links(llm):
    rng = random.Random(1)
    a, b = prose(rng, 300, 4000), prose(rng, 300, 4000)
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (5, None), (6, "")]
    assert sorted(map(tuple, sh.simhash_duplicates(frame(llm, rows)).collect()), key=str) == brute(rows)


def clouds(rng, centres, members, flips):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(members):
            x = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("node", [1 << 15, 40, 3])
def test_links_join_what_all_pairs_join(llm, node):
    """Random fingerprints, clouds of near ones, and a crowd that shares its first 16 bits; nodes of any size."""
    rng = random.Random(node)
    fps = set(clouds(rng, 12, 30, 4)) | {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1, 7, 8}
    fps |= {(0xABCD << 48) | rng.getrandbits(20) for _ in range(150)} | {x ^ 1 << 63 for x in list(fps)[:20]}
    fps = sorted(fps)
    df = llm.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(3)
    found = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in sh.links(df, 3, node).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    want = least_reachable([(x, x) for x in fps])
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert [find(x) for x in fps] == want


def test_large_nodes_go_down_in_the_shuffle(llm):
    fps = llm.range(0, 600).select(F.col("id").alias("fp"))
    tries = fps.select(F.lit(0).alias("turn"), F.lit(16).alias("depth"), F.col("fp").alias("x"))
    pairs = sh.node_pairs(tries, 3, 100).collect()
    assert len(pairs) > 1 and all(r.depth > 16 for r in pairs)
    assert all(r.left == 3 - (r.p ^ r.q).bit_count() for r in pairs)


def test_few_links_leave_a_task(llm):
    """A crowd in which nearly all are near: no more links than are needed."""
    fps = [1 << b for b in range(64)] + [0]
    df = llm.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").coalesce(1)
    assert sh.links(df, 3).count() < 4 * len(fps)


def test_small_batches(llm, monkeypatch):
    monkeypatch.setattr(sh, "FRONTIER", 5)
    x = np.array(sorted(clouds(random.Random(2), 3, 20, 3)), np.uint64)
    forest = sh.self_join(x, np.array([[0], [len(x)], [0], [len(x)], [3]]), 63, 3)
    want = least_reachable([(i, int(v)) for i, v in enumerate(x)])
    assert [want[r] for r in forest.root] == want and len(set(forest.root.tolist())) == len(set(want))


def test_empty_table(llm):
    assert sh.simhash_duplicates(frame(llm, [])).collect() == []
    assert [tuple(r) for r in sh.simhash_duplicates(frame(llm, [(3, None)])).collect()] == [(3, "0" * 16, 3)]
    assert [tuple(r) for r in sh.simhash_duplicates(frame(llm, [(None, "a b c d")])).collect()] == [
        (None, f"{plain_fingerprint('a b c d'):016x}", None)]
