import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lakekpi.llm import decontaminate as bd

from .conftest import frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, items, width=13):
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        if w and i is not None:
            for s in range(max(0, len(w) - width) + 1):
                windows.setdefault(tuple(w[s:s + width]), set()).add(str(i))
    out = []
    for d, t in rows:
        w = WORD.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture()
def items(llm, awkward):
    import random
    rng = random.Random(9)
    long = awkward[9 + 40][1]
    rows = [(1, " ".join(long.split()[3:30])), (2, "ONE"), (10, awkward[0][1].upper()), (3, prose(rng, 40)), (4, None), (5, "..."), (None, "one"),
            (1, "Éa É b"), (6, "éa"), (10, awkward[0][1])]
    return rows, frame(llm, rows, "item_id")


def test_equals_brute_force(llm, awkward, items):
    rows, bench = items
    for limit in (bd.BROADCAST_WINDOWS, 0):  # broadcast set, and the shuffled join beyond the bound
        got = bd.report(frame(llm, awkward), bench, broadcast_windows=limit)
        assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(awkward, rows)


def test_one_window_length(llm, awkward):
    rows = [(1, awkward[0][1])]
    assert sorted(map(tuple, bd.report(frame(llm, awkward), frame(llm, rows, "item_id")).collect()), key=str) == brute(awkward, rows)


def test_removal(llm, awkward, items):
    rows, bench = items
    docs = frame(llm, awkward)
    bad = [r[5] for r in brute(awkward, rows)]
    left = bd.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == bad.count(False)
    bench = frame(llm, [(1, "one two three")], "item_id")
    docs = frame(llm, [(1, "Zero ONE, two-three! four"), (2, "one two"), (3, None), (4, "one two three")])
    cut = {r["doc_id"]: r["text"] for r in bd.decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "Zero! four", 2: "one two", 3: None, 4: ""}


def test_empty_tables(llm, awkward):
    none = frame(llm, [], "item_id")
    assert all(r.n_hit == 0 and not r.contaminated for r in bd.report(frame(llm, awkward), none).collect())
    assert bd.report(frame(llm, []), none).collect() == []


def test_texts_are_split(llm, awkward):
    """Words come from ``split``, not from matching them one by one, which took eight times as long; they stay the same."""
    odd = ["...One, TWO!three", "\u00c9A \u0130I \u03a3 \u212a", "a\x00b\x7fc\u0080d", "[A]^`z{", "", "...", None, "\U0001f642b c"]
    rows = [(i, t) for i, t in enumerate(odd)]
    got = frame(llm, rows).select("doc_id", bd.words(F.col("text")).alias("w"), bd.any_case_words(F.col("text")).alias("a")).collect()
    assert {r.doc_id: r.w for r in got} == {i: None if t is None else WORD.findall(lower(t)) for i, t in rows}
    assert {r.doc_id: r.a and [lower(x) for x in r.a] for r in got} == {r.doc_id: r.w for r in got}
    plan = bd.report(frame(llm, awkward), frame(llm, [(1, "one")], "item_id"))._jdf.queryExecution().analyzed().toString()
    assert "regexp" not in plan and "regexp" not in str(bd.words(F.col("text")))
