import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekpi.llm import quality as qc
from lakekpi.llm import toxicity as tx

from .conftest import frame

SMALL = "/root/testdata/sf0.01"
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType()),
                       T.StructField("y", T.StringType())])


def accuracy(df, labels, col):
    rows = df.where("held_out").join(labels.select("doc_id", F.col(col).alias("label")), "doc_id").where("label is not null").collect()
    return np.mean([r.predicted == r.label for r in rows])


def test_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    assert accuracy(tx.op6_toxicity(llm, SMALL), labels, "toxic") > 0.9
    assert accuracy(qc.op7_quality(llm, SMALL), labels, "quality") > 0.93
    model = qc.fit(docs, labels, "doc_id", "text", "quality", 3, 1)
    assert 0.7 < model.prior < 0.95
    kept = qc.keep_good(docs, model)
    assert kept.columns == docs.columns and 700 < kept.count() < 950


@pytest.mark.parametrize("run", [lambda d, l: tx.score(d, tx.fit(d, l, "doc_id", "text", "toxic", 4, 2)),
                                 lambda d, l: qc.score(d, qc.fit(d, l, "doc_id", "text", "quality", 3, 1))])
def test_awkward_rows(llm, awkward, run):
    docs = frame(llm, awkward)
    labels = llm.createDataFrame([(i, i % 2, int(i % 3 == 0), "x") for i in range(20, 60)] + [(20, None, None, "x"), (None, 1, 1, "x"), (21, 0, 1, "x")], LABELS)
    for lab in (labels, labels.limit(0)):
        got = run(docs, lab).collect()
        assert len(got) == len(awkward) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
        assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _ in awkward), key=str)
    assert run(frame(llm, []), labels).collect() == []


def rows_of(vectors):
    """Offsets, terms and weights of sparse vectors."""
    return (np.cumsum([0, *map(len, vectors)]), np.array([t for v in vectors for t in sorted(v)], np.int64),
            np.array([v[t] for v in vectors for t in sorted(v)], float))


def unit(v):
    return {t: w / np.sqrt(sum(x * x for x in v.values())) for t, w in v.items()}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    make = lambda: {int(t): float(w) for t, w in zip(rng.choice(40, 5, False), rng.random(5))}
    vectors = [unit(make()) for _ in range(480)] + [unit({0: 1.0, 1: 1.0})] * 20  # equal cosines
    index = tx.BlockMaxIndex(*rows_of(vectors), 40, block=16)
    queries = [unit(make()) for _ in range(60)] + [unit({0: 1.0}), {}]
    skips = np.array([i if i % 2 else -1 for i in range(len(queries))])
    for q, skip, (ids, got) in zip(queries, skips, index.nearest_all(*rows_of(queries), 16, skips)):
        cos = np.array([sum(w * v.get(t, 0) for t, w in q.items()) for v in vectors])
        if skip >= 0:
            cos[skip] = 0
        want = [x for x in np.lexsort((np.arange(500), -cos.round(12)))[:16] if cos[x] > 0]
        assert ids.tolist() == want and np.allclose(got, cos[want])


def test_blocks_that_cannot_hold_a_nearest_one_are_passed_over():
    """Examples of twenty subjects in mixed order: like ones share blocks, a query looks into few of them."""
    rng = np.random.default_rng(3)
    make = lambda k: unit({int(t) + 50 * k: float(w) for t, w in zip(rng.choice(50, 12, False), rng.random(12))} | {1000: 0.3})
    vectors = [make(i % 20) for i in range(2000)]
    index = tx.BlockMaxIndex(*rows_of(vectors), 1001, block=25)
    assert sorted(i for ids, _ in index.blocks for i in ids) == list(range(2000)) and len(index.blocks) == 80
    queries = [make(i % 20) for i in range(100)]
    for q, (ids, got) in zip(queries, index.nearest_all(*rows_of(queries), 5)):
        cos = np.array([sum(w * v.get(t, 0) for t, w in q.items()) for v in vectors])
        want = np.lexsort((np.arange(2000), -cos.round(12)))[:5]
        assert ids.tolist() == want.tolist() and np.allclose(got, cos[want])
    assert index.searched < 0.2 * len(queries) * len(index.blocks)


def test_scores_equal_brute_force_over_raw_texts(llm):
    """Terms, document frequencies, cosines, votes, calibration and evidence, from the texts alone."""
    rng = random.Random(8)
    word = lambda toxic: ("grim" if toxic and rng.random() < 0.2 else "w") + f"{int(rng.paretovariate(0.6)) % 200}é"
    bad = lambda i: i % 4 == 0
    texts = {i: " ".join(word(bad(i)) for _ in range(rng.randint(3, 40))) for i in range(300)}
    labels = llm.createDataFrame([(i, int(bad(i))) for i in range(240)], "doc_id long, toxic int")
    docs = frame(llm, list(texts.items()))
    model = tx.fit(docs, labels, "doc_id", "text", "toxic", 4, 2)
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    kept = sorted(model.ids)
    assert set(kept) <= {i for i in range(240) if fold(i) != 2} and len(kept) > 150
    terms = {i: [w[:4] for w in t.lower().split()] for i, t in texts.items()}
    df = {}
    for x in terms.values():
        for t in set(x):
            df[t] = df.get(t, 0) + 1
    held = {t for i in kept for t in terms[i]}
    vec = {i: unit({t: (1 + np.log(x.count(t))) * (np.log(301 / (df[t] + 1)) + 1e-3) for t in set(x) & held}) for i, x in terms.items()}
    training = [i for i in range(240) if fold(i) != 2]
    prior = (sum(map(bad, training)) + 0.5) / (len(training) + 5)

    def nearest(i, others):
        cos = {j: sum(w * vec[j].get(t, 0) for t, w in vec[i].items()) for j in others}
        best = sorted((j for j in cos if cos[j] > 0), key=lambda j: (-round(cos[j], 12), j))[:16]
        return (sum(cos[j] for j in best if bad(j)) + 0.1 * prior) / (sum(cos[j] for j in best) + 0.1), best

    share = {y: sum(bad(i) == y for i in training) / sum(bad(i) == y for i in kept) for y in (False, True)}
    votes = np.array([nearest(i, [j for j in kept if j != i])[0] for i in kept])
    curve = tx.isotonic(votes, np.array([float(bad(i)) for i in kept]), np.array([share[bad(i)] for i in kept]))
    for i in texts:
        vote, best = nearest(i, kept)
        assert [e.id for e in got[i].evidence] == best[:3]
        assert got[i].score == pytest.approx(float(np.interp(vote, *curve)), abs=1e-9) and got[i].held_out == (fold(i) == 2)


def test_unlike_texts_of_one_id_give_one_example(llm):
    docs = frame(llm, [(4, f"text number{i} of many") for i in range(50)] + [(5, "some other words"), (6, None)])
    labels = llm.createDataFrame([(4, 1), (5, 0), (6, 0)], "doc_id long, toxic int")
    model = tx.fit(docs, labels, "doc_id", "text", "toxic", 4, 9)
    assert model.ids.tolist() == [4, 5]
    assert tx.score(docs, model).count() == 52


def test_cosine_is_taken_over_all_words(llm):
    """No word is common among the toxic examples, so a list of toxic terms would be empty."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2][:200]
    text = lambda i: " ".join(f"word{i}x{j} {'abcdefgh'[j]}{i}" for j in range(8))
    copy = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 4 == 2)
    docs = frame(llm, [(i, text(i)) for i in ids] + [(copy, text(ids[50]))])
    labels = llm.createDataFrame([(i, None, int(i % 5 == 0), "x") for i in ids], LABELS)
    model = tx.fit(docs, labels, "doc_id", "text", "toxic", 4, 2)
    assert sorted(model.ids) == ids
    got = {r.doc_id: r for r in tx.score(docs, model).collect()}
    for i, want in [(copy, ids[50])] + [(i, i) for i in ids]:
        assert got[i].evidence[0].id == want and got[i].evidence[0].cosine == pytest.approx(1, abs=1e-6)


def test_only_confirmed_copies_of_examples_go(llm):
    line = " ".join(f"shared{j}" for j in range(30))
    own = lambda i: line + " " + " ".join(f"own{i}x{j}" for j in range(30))
    rows = [(i, own(i), i % 2) for i in range(40)]  # a third of their trigrams in common, and often the smallest one
    rows += [(100, own(4), 0), (101, own(4).upper() + "  more", 0), (102, own(4), 1), (103, None, 0), (104, "", 0), (105, " ", 1)]
    rows += [(4, own(4), 0), (6, "another text of the same id", 0), (200, "one two", 0), (201, "one three", 0)]
    kept = tx._without_near_copies(llm.createDataFrame(rows, "id long, text string, y int")).collect()
    assert sorted(r.id for r in kept) == sorted([*range(40), 4, 6, 102, 103, 105, 200, 201])
    assert {(r.id, r.text, r.y) for r in kept} <= set(rows)


def test_isotonic_rises():
    x, y = np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0.0, 1, 0, 0, 1])
    at, value = tx.isotonic(x, y, np.ones(5))
    assert (np.diff(at) > 0).all() and (np.diff(value) >= 0).all()


def test_quality_with_every_document_labelled(llm):
    """Labels of all rows: rows that are not good take part as rows without a label, and scores differ."""
    rng = random.Random(11)
    good = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(80)) + ".") for i in range(200)]
    bad = [(i, "BUY! | " * rng.randint(10, 30)) for i in range(200, 400)]
    labels = llm.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id long, quality int")
    docs = frame(llm, good + bad)
    model = qc.fit(docs, labels, "doc_id", "text", "quality", 3, 1)
    got = {r.doc_id: r.score for r in qc.score(docs, model).collect()}
    assert sum(got[i] for i in range(200)) / 200 > 0.6 > 0.4 > sum(got[i] for i in range(200, 400)) / 200
    # what is known of held-out rows changes nothing
    less = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    again = qc.fit(docs, less, "doc_id", "text", "quality", 3, 1)
    assert {r.doc_id: r.score for r in qc.score(docs, again).collect()} == got
    # a row repeated often is one document to the fit
    many = docs.union(docs.where("doc_id = 3").crossJoin(llm.range(300).select()))
    assert {r.doc_id: r.score for r in qc.score(docs, qc.fit(many, labels, "doc_id", "text", "quality", 3, 1)).collect()} == got
