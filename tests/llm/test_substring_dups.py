import hashlib

import numpy as np
import pytest

from lakekpi.llm import substring_dups as sd

from .conftest import frame


def brute(rows, width):
    """Covered words of each row, in the order of the rows."""
    order = sorted(range(len(rows)), key=lambda x: (rows[x][0] is not None, rows[x][0] or 0))
    first, gone = {}, [None] * len(rows)
    for x in order:
        w = (rows[x][1] or "").encode().split()
        mask = [False] * len(w)
        for s in range(len(w) - width + 1):
            place = first.setdefault(tuple(w[s:s + width]), (rows[x][0], s))
            if place != (rows[x][0], s):
                mask[s:s + width] = [True] * width
        gone[x] = mask
    return gone


@pytest.mark.parametrize("width", [5, 20, 50])
def test_equals_brute_force(llm, awkward, width):
    want = []
    for (i, t), mask in zip(awkward, brute(awkward, width)):
        w = (t or "").encode().split()
        kept = b" ".join(x for x, g in zip(w, mask) if not g)
        want.append((i, len(w), sum(mask), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in sd.digests(frame(llm, awkward), window=width).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_flushes_change_nothing(llm, awkward, monkeypatch):
    want = sorted(map(str, sd.digests(frame(llm, awkward)).collect()))
    monkeypatch.setattr(sd, "FLUSH_ROWS", 50)
    assert sorted(map(str, sd.digests(frame(llm, awkward)).collect())) == want


def test_covers_meet_at_every_distance():
    for period, cover in sd.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_cut_texts_keep_other_blanks(llm):
    p = " ".join(f"p{i}" for i in range(6))
    rows = [(1, f"a\n{p} b"), (2, f"  c\t{p}\n d  e"), (3, p), (4, None), (5, "")]
    got = {r["doc_id"]: r for r in sd.drop_repeats(frame(llm, rows), window=6).collect()}
    assert {i: r["text"] for i, r in got.items()} == {1: rows[0][1], 2: "  c\td  e", 3: "", 4: None, 5: ""}
    assert [(got[i]["_words"], got[i]["_removed"]) for i in (1, 2, 3, 4)] == [(8, 0), (9, 6), (6, 6), (0, 0)]
    assert got[2]["n_words"] == "x" and got[2]["id"] == "x"


def test_empty_table(llm):
    assert sd.digests(frame(llm, [])).collect() == []
    assert sd.covered(3, np.array([0]), 5).sum() == 0


def test_unlike_rows_of_one_id_lose_only_what_repeats(llm):
    p, u, v = (" ".join(f"{c}{i}" for i in range(30)) for c in "puv")
    first = " ".join(p.split()[:20])
    rows = [(1, first), (5, first + " tail"), (5, u), (None, first + " end"), (None, v), (7, v + " " + u)]
    got = {(r.doc_id, r.n_words): r.n_removed for r in sd.digests(frame(llm, rows)).collect()}
    assert got == {(1, 20): 20, (5, 21): 20, (5, 30): 0, (None, 21): 0, (None, 30): 0, (7, 60): 60}
    cut = sd.drop_repeats(frame(llm, rows), window=20)
    assert sorted(((r.doc_id, r._removed) for r in cut.collect()), key=str) == sorted([(1, 20), (5, 20), (5, 0), (None, 0), (None, 0), (7, 60)], key=str)
