import corpus_pipeline
from lakekpi.llm.common import stage
from lakekpi.llm.tokenizing import load

from . import test_decontaminate as bd
from . import test_near_dups as nd
from . import test_substring_dups as sd
from .conftest import frame

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_brute_force(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    fns = dict(corpus_pipeline.STAGES)
    assert list(fns) == ["quality", "near_duplicates", "substring_duplicates", "decontaminate", "packing"]
    good = stage(fns["quality"](llm, docs, SF), "t")
    assert good.columns == docs.columns
    kept = stage(fns["near_duplicates"](llm, good, SF), "t")
    assert sorted(rows(kept)) == sorted((i, t) for i, t in rows(good) if (i, True) in {(r[0], r[3]) for r in nd.brute(rows(good), 5)})
    cut = stage(fns["substring_duplicates"](llm, kept, SF), "t")
    want = {}
    for (i, t), gone in zip(rows(kept), sd.brute(rows(kept), 50)):
        if not (gone and all(gone)):
            want[i] = [w for w, g in zip(t.encode().split(), gone) if not g]
    assert {i: t.encode().split() for i, t in rows(cut)} == want
    clean = stage(fns["decontaminate"](llm, cut, SF), "t")
    assert sorted(r[0] for r in rows(clean)) == sorted(r[0] for r in bd.brute(rows(cut), bench) if not r[5])
    tok = load()
    packed: dict = {}
    for p in fns["packing"](llm, clean, SF).collect():
        packed.setdefault(p.doc_id, []).append((p.start, p.ids))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in packed.items()} == {
        i: tok.encode(t, add_special_tokens=False).ids + [1] for i, t in rows(clean)}


def test_run_equals_the_stages(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(llm, docs, SF), "t")
    tok, packed = load(), {}
    for p in corpus_pipeline.run(llm, SF).collect():
        packed.setdefault(p.doc_id, []).append((p.start, p.ids))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in packed.items()} == {
        i: tok.encode(t, add_special_tokens=False).ids + [1] for i, t in rows(docs)}


def test_awkward_rows(llm, awkward):
    docs = frame(llm, awkward)
    for name, step in corpus_pipeline.STAGES:
        assert step(llm, docs.limit(0), SF).count() == 0
    bench = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    near = corpus_pipeline.near_duplicates(llm, docs, SF)
    assert near.columns == docs.columns
    least = {(r[0], r[3]) for r in nd.brute(awkward, 5)}
    want = {(i, t) for i, t in awkward if (i, True) in least} | {(i, t) for i, t in awkward if i is None}
    assert sorted(rows(near), key=str) == sorted(want, key=str)  # repeated rows stay once
    cut = corpus_pipeline.substring_duplicates(llm, docs, SF)
    assert cut.columns == docs.columns
    left = [(i, [w for w, g in zip((t or "").encode().split(), gone) if not g]) for (i, t), gone in zip(awkward, sd.brute(awkward, 50))
            if not (gone and all(gone))]
    assert sorted(((i, (t or "").encode().split()) for i, t in rows(cut)), key=str) == sorted(left, key=str)
    clean = corpus_pipeline.decontaminate(llm, docs, SF)
    bad = {r[0] for r in bd.brute(awkward, bench) if r[5]}
    assert sorted(rows(clean), key=str) == sorted(((i, t) for i, t in awkward if i not in bad), key=str)
    assert {r[0] for r in rows(corpus_pipeline.quality(llm, docs, SF))} <= {i for i, _ in awkward}
