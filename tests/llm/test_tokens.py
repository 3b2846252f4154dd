import zlib

import numpy as np

from lakekpi.llm import packing as pk
from lakekpi.llm import token_counts as tc
from lakekpi.llm.tokenizing import WordEncoder, load

from .conftest import frame

ODD = ["<|ENDOFTEXT|> <|endoftext|>", "A\u030a \u212a \u0130 \u03a3", "<|endoftext|> a<|startoftext|>b", "x y z ́e", "don't we'll 123 ...", "日本語のテキスト", "\x00\x1c a\x85b", "🙂🙂 ok"]


def test_counts_equal_the_library(llm, awkward):
    tok = load()
    rows = awkward + [(200 + i, t) for i, t in enumerate(ODD)] + [(300, "日本" * 400)]
    want = sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    for more in ({}, {"chunk_chars": 300, "overlap": 30}, {"chunk_chars": 64, "overlap": 4}):  # the last must widen its overlaps
        got = tc.count_tokens(frame(llm, rows), **more)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        got = got.collect()
        assert sorted((tuple(r)[:3] for r in got), key=str) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert tc.count_tokens(frame(llm, [])).collect() == []


def test_word_encoder(awkward):
    tok, texts = load(), [t or "" for _, t in awkward] + ODD
    for cache in (400_000, 10):
        enc = WordEncoder(cache_words=cache)
        for part in (texts[:20], texts[20:], texts):
            ids, off = enc.encode([t.encode() for t in part])
            assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in part]


def test_packing_holds_every_id_once(llm, awkward):
    tok, rows = load(), [(i if i is not None else None, t) for i, t in awkward]
    pieces = pk.pack(frame(llm, rows).coalesce(2)).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    for i, docs in want.items():
        got = sorted(by_doc[i], key=lambda p: p.start)
        assert sorted(x for p in got for x in p.ids) == sorted(x for d in docs for x in d)
        if len(docs) == 1:
            assert [x for p in got for x in p.ids] == docs[0] and {p.doc_tokens for p in got} == {len(docs[0])}
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    assert pk.pack(frame(llm, [])).collect() == []


def test_texts_are_encoded_in_runs_of_bytes():
    texts = [b"a" * n for n in (3, 3, 4, 1, 25, 0, 10, 0)]
    assert list(pk.runs_of_bytes(texts, 10)) == [(0, 3), (3, 4), (4, 5), (5, 8)]
    assert list(pk.runs_of_bytes([], 10)) == []
    assert list(pk.runs_of_bytes([b"short"] * 2000)) == [(0, 2000)]  # one call, not ten


def test_plain_words_need_the_model_alone():
    enc, marks = WordEncoder(), '.,;:!?*#$%&()"'
    words = ["a", "the", "thedouin", "onenreing", "cannot", "dont", "s", "ll", "z" * 70] + [f"word{m}" for m in marks] + [
        "end.)", "stop!!", 'said,"', "x,***", "a" + marks, "b" + marks[::-1], "we'll.", "it's,", "a.b", "1st.", "caf\u00e9.", "(so", "<|a|>.", "a_", "a1,"]
    whole = {w: enc.tokenizer.encode(w, add_special_tokens=False).ids for w in words}
    asked, encode = [], enc.tokenizer.encode

    class Counting:
        def encode(self, ws, **how):
            asked.extend(ws)
            return encode(ws, **how)

    enc.tokenizer = Counting()
    ids, off = enc.encode([w.encode() for w in words])
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [whole[w] for w in words]
    assert asked == ["we'll.", "it's,", "a.b", "1st.", "caf\u00e9.", "(so", "<|a|>.", "a_", "a1,"]


def test_encoder_copies_its_cache_seldom():
    enc, homes = WordEncoder(), set()
    for i in range(60):  # new words in every call
        words = [f"w{i}x{j}" for j in range(20)]
        ids, _ = enc.encode([" ".join(words).encode()])
        assert ids.tolist() == enc.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
        homes.add(enc.ids.__array_interface__["data"][0])
    assert len(homes) < 15


def test_closest_fill():
    rng = np.random.default_rng(0)
    for _ in range(200):
        counts = {int(x): int(rng.integers(1, 4)) for x in rng.integers(1, 30, rng.integers(1, 6))}
        room = int(rng.integers(0, 60))
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        used = pk.closest_fill(counts, room)
        assert sum(x * n for x, n in used.items()) == max(s for s in sums if s <= room)
        assert all(0 < n <= counts[x] for x, n in used.items())
