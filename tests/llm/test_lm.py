import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakekpi.llm import lm

from .conftest import frame

SMALL = "/root/testdata/sf0.01"


def brute(rows):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    c = Counter(x for w, h in zip(tokens, held) if not h for x in w)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
            for (i, _), w, h in zip(rows, tokens, held)]


@pytest.mark.parametrize("known", [lm.KNOWN, 40])  # 40: nearly all words take the join
def test_base_scores_equal_brute_force(llm, awkward, known, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", known)
    got = lm.score_corpus(frame(llm, awkward)).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(brute(awkward), key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
    assert lm.score_corpus(frame(llm, [])).collect() == []


def test_no_training_rows(llm):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm.score_corpus(frame(llm, [(held, "a b")])).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)


def test_hashes_follow_the_words():
    texts = ["A b a", None, "", " \t\r\n", "aB\x0bab", "é É ÉA", "x"]
    h, off = lm.token_hashes(pa.array(texts))
    words = [w for t in texts for w in (t or "").encode().lower().split() + [None]]
    assert len(h) == len(words) and np.diff(off).tolist() == [4, 1, 1, 1, 3, 4, 2]
    by = {}
    for w, x in zip(words, h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    part = pa.array(["zz zz"] + texts).slice(1)
    assert (lm.token_hashes(part)[0] == h).all()


def test_model_beats_the_base_and_sums_to_one(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    got = lm.score_corpus(docs).where("held_out").collect()
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score for r in got) / tokens > sum(r.base_score for r in got) / tokens + 0.1
    rows = docs.selectExpr("doc_id as id", "text")
    counts = lm.token_counts(rows).cache()
    m = lm.fit(rows, counts, rounds=2)
    f = m.features(np.array([3, lm.HEAD + 2, 40]), np.array([0, 3]))
    p = m.classes(f)
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    for k in range(lm.CLASSES):
        assert np.allclose(m.words(f, np.full(3, k)).sum(1), 1, atol=1e-5)
    h, c = (np.array(x) for x in zip(*[(r.h, r.c) for r in counts.collect()]))
    symbol = m.look(h.view(np.uint64))[1]
    for k in range(lm.REST):  # known words, and one share for all unseen ones
        inside = c[symbol == lm.HEAD + k]
        assert (inside + 0.5).sum() + 0.5 == pytest.approx(m.rest_z[k])


def test_expected_counts_cover_every_token():
    none = np.zeros(0, np.uint64)
    m = lm.Model(0, 0, (none, none.astype(np.int64)), {}, none)
    symbol = np.array([3, lm.HEAD + 2, 40, 3, 7, 500, lm.HEAD + 9, 1, 2, 40, 5])
    sums = lm.Sums()
    sums.add(m, symbol, np.array([0, 6, 11]))
    # under any weights the classes' shares of a feature add up to how often it is seen
    assert np.allclose(sums.mean1.sum(1), sums.seen1.sum(1), atol=1e-4)
    assert np.allclose(sums.mean2.sum(1), sums.seen2.sum(1), atol=1e-4)


def test_finder():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5000):
        table = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        h = np.concatenate([table, rng.integers(0, 2**64, 100, dtype=np.uint64)])
        got = lm.Finder(table).find(h)
        assert (got[:len(table)] == np.arange(len(table))).all() and (got[len(table):] == -1).all()


def small_corpus():
    """(id, text) rows with more words than the head has, a word outside it that always follows another one, and copies."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"a{int(x)}" for x in rng.integers(0, 1500, 200))) for i in range(200)]
    return rows + [(200 + i, f"a{i} a{i + 7} rareone raretwo a{i} rarethree") for i in range(12)]


def brute_pairs(rows, m):
    """Score share of the pair features of every row: weights by Newton steps for one group at a time, classes by the words' last bytes."""
    c, pairs = Counter(), {}
    docs = {i: lm.token_hashes(pa.array([t]))[0].tolist() for i, t in rows}
    rest = {h: bool(m.in_rest(np.array([h], np.uint64))[0]) for d in docs.values() for h in d}
    steps = lambda d: [(a, b) for a, b in zip([None] + d, d) if rest[b]]
    for i, d in docs.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(d)
            for a, b in steps(d):
                pairs.setdefault((a, (b & 127) % lm.REST), Counter())[b] += 1
    theta, log_z = {}, {}
    for (a, k), own in pairs.items():
        kept = {b: n for b, n in own.items() if n >= lm.lm_pairs.LEAST}
        t = dict.fromkeys(kept, 0.0)
        z = lambda: m.rest_z[k] + sum((c[b] + 0.5) * math.expm1(t[b]) for b in kept)
        for _ in range(600):  # small steps up the penalised likelihood
            total = z()
            move = {b: n - sum(own.values()) * (c[b] + 0.5) * math.exp(t[b]) / total - lm.lm_pairs.DECAY * t[b] for b, n in kept.items()}
            t = {b: t[b] + max(-0.5, min(0.5, 0.3 * g)) for b, g in move.items()}
        if kept:
            theta.update({(a, b): x for b, x in t.items()})
            log_z[a, k] = math.log(z() / m.rest_z[k])
    return {i: sum(theta.get((a, b), 0) - log_z.get((a, (b & 127) % lm.REST), 0) for a, b in steps(d)) / math.log(10) for i, d in docs.items()}


@pytest.mark.parametrize("known", [lm.KNOWN, 700])  # 700: counts of other words are joined
def test_pair_features_equal_brute_force(llm, known, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = small_corpus()
    docs = frame(llm, rows, extra=False).repartition(3).selectExpr(
        "doc_id as row", "doc_id as id", "crc32(cast(cast(doc_id as string) as binary)) % 5 = 1 as held_out", "text").cache()
    train = docs.where("not held_out")
    counts = lm.token_counts(train).cache()
    m = lm.fit(train, counts)
    learnt = lm.lm_pairs.train(train, counts, m, lm.token_hashes)
    with_pairs, without = ({r.doc_id: r.score for r in lm.score(docs, m, counts, x).collect()} for x in (learnt, None))
    want = brute_pairs(rows, m)
    assert max(want.values()) > 4  # the two rare words that always stand together
    for i, w in want.items():
        assert with_pairs[i] - without[i] == pytest.approx(w, abs=0.02), i


def test_word_outside_the_head_depends_on_its_context(llm):
    rows = small_corpus()
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    extra = [(held[0], "rareone raretwo a1"), (held[1], "raretwo rareone a1")]
    got = {r.doc_id: r for r in lm.score_corpus(frame(llm, rows + extra)).where(f"doc_id in ({held[0]}, {held[1]})").collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)
    assert got[held[0]].score > got[held[1]].score + 1


def test_pair_weights_leave_a_distribution():
    g = np.array([1, 1, 1, 5], np.uint64)
    n, total, c, z = (np.array(x, float) for x in ([40, 2, 3, 2], [60, 60, 60, 2], [50, 9, 900, 2], [5000] * 4))
    theta, first, lnz = lm.lm_pairs.weights_of(g, n, total, c, z)
    for j, (a, b) in enumerate(((0, 3), (3, 4))):
        p = (c[a:b] + 0.5) * np.exp(theta[a:b]) / (z[a] * np.exp(lnz[j]))
        assert p.sum() + (z[a] - (c[a:b] + 0.5).sum()) / (z[a] * np.exp(lnz[j])) == pytest.approx(1)
        assert np.allclose(n[a:b] - total[a] * p, lm.lm_pairs.DECAY * theta[a:b], atol=0.01)
