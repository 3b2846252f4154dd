import gzip
import hashlib
import random

from pyspark.sql import types as T

from lakekpi.llm import warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       T.StructField("sha1", T.StringType()), T.StructField("leader", T.StringType())])
BIG = "<p>é\r\n\r\nWARC/1.1 in the text</p>" * 60
ROWS = [(1, "http://a/ b\r\n", BIG), (2, None, BIG), (5, "http://c", BIG), (3, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""),
        (None, "u", BIG), (5, "http://c", BIG), (8, "u", "x" * 999), (9, "u", "x" * 999), (10, "u", "y" * 1000), (11, "u", "y" * 1000)]


def expected():
    out = []
    for page, _, html in ROWS:
        payload = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        leader = max(same, default=None) if len(payload) >= 1000 else None
        revisit = leader is not None and (page is None or page < leader)
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", leader if revisit else None))
    return sorted(out, key=str)


def test_round_trip(llm, tmp):
    pages = llm.createDataFrame([r + ("x", "y") for r in ROWS], SCHEMA)
    for compress in (True, False):
        path = f"{tmp}/{compress}"
        warc.write_archives(pages.coalesce(2), path, compress=compress, records_per_file=4)
        records = warc.read_archives(llm, path)
        assert records.where("gap is not null").count() == 0
        assert sorted(map(tuple, warc.archived_pages(records).collect()), key=str) == expected()
        got = {(r.page_id, r.payload.decode()) for r in records.where("record_type = 'response'").collect()}
        assert (5, BIG) in got and (6, "") in got
    warc.write_archives(pages.limit(0), f"{tmp}/none")
    assert warc.archived_pages(warc.read_archives(llm, f"{tmp}/none")).count() == 0


def _archive(n, compress):
    made = [warc.record(i, f"http://x/{i}", f"page {i} ".encode() * 50, hashlib.sha1(f"page {i} ".encode() * 50).hexdigest(), None, "d") for i in range(n)]
    return [warc.gzip_member(m) for m in made] if compress else made


def test_salvage_after_damage():
    rng = random.Random(4)
    for compress in (True, False):
        parts = _archive(30, compress)
        sep = warc.SEPARATOR if compress else b"\r\n"
        whole = bytearray(sep.join(parts))
        starts = [sum(len(p) + len(sep) for p in parts[:i]) for i in range(30)]
        assert len([x for x in warc.salvage(bytes(whole)) if x[2]]) == 30
        bad = sorted(rng.sample(range(30), 6))
        for i in bad:
            for k in range(starts[i] + len(parts[i]) // 2, starts[i] + len(parts[i]) // 2 + 8):
                whole[k] ^= 0xFF
        found = list(warc.salvage(bytes(whole)))
        pages = [int(x[2]["warc-page-id"]) for x in found if x[2]]
        assert pages == [i for i in range(30) if i not in bad]
        gaps = [(x[0], x[1]) for x in found if x[2] is None]
        assert all(any(a <= starts[i] < b for a, b in gaps) for i in bad)
        # a torn end, and rubbish in front
        torn = list(warc.salvage(b"rubbish" + bytes(sep.join(parts))[:-40]))
        assert torn[0][:2] == (0, 7) and torn[-1][2] is None and len([x for x in torn if x[2]]) == 29
    assert list(warc.salvage(b"")) == []


def test_archives_of_any_name_are_read(llm, tmp):
    def record(i):
        return f"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <r{i}>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode()

    for i, (name, pack) in enumerate([("crawl.warc", bytes), ("crawl.warc.gz", gzip.compress), ("part-0", bytes), ("_log", bytes), (".x", bytes)]):
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(pack(record(i)))
    found = lambda **k: sorted((r.record_id, r.gap) for r in warc.read_archives(llm, tmp, **k).collect())
    assert found() == [("<r0>", None), ("<r1>", None), ("<r2>", None)]
    assert found(pattern="*.gz") == [("<r1>", None)]
