import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakekpi.llm import fill_in_middle as fm

from .conftest import frame

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    tok = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(tok)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tok[:a]), "".join(tok[a:b]), "".join(tok[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equals_brute_force(llm, awkward):
    marked = [(300 + i, f"a b <{m}> c") for i, m in enumerate("PSMX")] + [(400 + i, "< <S <P x<" + " y>" * i) for i in range(40)]
    blank = [(500 + i, " " * i + "  \x1f　 é\U0001f600 z \x0b\x0c") for i in range(40)]
    rows = awkward + marked + blank
    out = fm.fill_in_middle(frame(llm, rows))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted((brute(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    back = out.select("doc_id", fm.restored().alias("t")).collect()
    assert sorted((tuple(r) for r in back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_rates(llm):
    rows = [(i, "a b c d") for i in range(200)]
    assert {r.form for r in fm.fill_in_middle(frame(llm, rows), rate=0).collect()} == {"plain"}
    assert {r.form for r in fm.fill_in_middle(frame(llm, rows), rate=100, spm=100).collect()} == {"spm"}
    assert fm.fill_in_middle(frame(llm, [])).collect() == []


@pytest.mark.parametrize("offsets, kind", [
    (np.arange(0, 65536, 17), fm.ARRAY), (np.flatnonzero(np.arange(65536) % 7 % 2), fm.BITMAP),
    (np.arange(100, 60000), fm.RUN), (np.array([5]), fm.ARRAY)])
def test_containers(offsets, kind):
    for shift in (0, 3 << 16):
        found = fm.BoundarySet(offsets + shift)
        assert [c.kind for c in found.containers] == [kind] and len(found) == len(offsets)
        assert [found.select(k) for k in range(len(offsets))] == (offsets + shift).tolist()


def test_many_containers():
    rng = np.random.default_rng(3)
    offsets = np.unique(np.concatenate([rng.integers(0, 9 << 16, 50_000), np.arange(70_000, 200_000), [12 << 16, (13 << 16) - 1]]))
    found = fm.BoundarySet(offsets)
    assert {c.kind for c in found.containers} == {fm.ARRAY, fm.BITMAP, fm.RUN}
    picks = [0, 1, len(offsets) - 1, *rng.integers(0, len(offsets), 3000).tolist()]
    assert [found.select(k) for k in picks] == offsets[picks].tolist()
    assert len(fm.BoundarySet(np.zeros(0, np.int64))) == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\x0bab<>SPMé \U0001f600", max_size=30), st.integers(0, 500))
def test_any_text(text, doc_id):
    assert (doc_id, *fm.cut(text, doc_id, 42, 50, 80)) == brute(doc_id, text)
