"""WARC archives of pages, and a reader that salvages what damaged archives still hold.

Writing: pages with equal payloads of at least ``min_revisit`` bytes share one response record, that of the largest id;
the others become revisit records that name it.  Each record is a gzip member.  Spark's text writer puts the members
into files on whatever store the path names, with an empty gzip member as the line separator, so every file is a
plain multi-member archive.

Reading: members (or bare records) are read in order and checked: gzip CRC, version line, header block, content length,
block digest.  After a failed check the reader looks for the next place that begins with a gzip magic or a version line
and from which a whole member or record passes, goes on from there, and logs the bytes between as a gap.

Defined results: null html is an empty payload; null url leaves out the target; rows with a null id are written and
come back with a null id (and revisit a named equal page if there is one); repeated rows of the largest id are all
responses; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage, text_bytes
from lakekpi.session import scratch_dir

MIN_REVISIT = 1000
RECORDS_PER_FILE = 4000
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
# an empty gzip member (fixed value)
SEPARATOR = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
FEED = 1 << 16


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page, payload_sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{payload_sha1}')}>"


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record(page, url, payload: bytes, sha1: str, revisits, date: str) -> bytes:
    """One record as bytes; a revisit has the HTTP head as its block, a response the payload too."""
    block = HTTP_HEAD % len(payload) + (payload if revisits is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if revisits is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page, sha1)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
            f"WARC-Block-Digest: {_digest(block)}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    if page is not None:
        head.append(f"WARC-Page-ID: {page}")
    if revisits is not None:
        head += [f"WARC-Refers-To: {_record_id(revisits, sha1)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit: int = MIN_REVISIT, records_per_file: int = RECORDS_PER_FILE, compress: bool = True,
                   date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` under ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).select(
        "*", F.sha1(F.col("html").cast("binary")).alias("sha1"))
    several = (rows.where(F.octet_length("html") >= min_revisit).groupBy(F.col("sha1").alias("s"))
               .agg(F.max("page").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1 and leader is not null"))
    typed = rows.join(several, rows.sha1 == several.s, "left").select(
        "page", "url", "html", "sha1", F.when(F.coalesce("page", F.lit(-(2**63))) < F.col("leader"), F.col("leader")).alias("leader"))

    def run(batches):
        for b in batches:
            page, url, sha1, leader = (b.column(i).to_pylist() for i in (0, 1, 3, 4))
            made = [record(*x, date) for x in zip(page, url, text_bytes(b.column(2)), sha1, leader)]
            yield pa.RecordBatch.from_arrays([pa.array([gzip_member(x) for x in made] if compress else made, pa.binary())], names=["value"])

    (typed.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1") if compress else "\r\n")
     .option("maxRecordsPerFile", records_per_file).text(path))


class Damaged(ValueError):
    """A member or record that fails a check."""


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Contents of the gzip member at ``at``, and where it ends."""
    z, out, p = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            if p >= len(data):
                raise Damaged("truncated member")
            out.append(z.decompress(data[p:p + FEED]))
            p = min(len(data), p + FEED)
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return b"".join(out), p - len(z.unused_data)


def _parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers and block of the record at ``at``, checked, and where the record ends."""
    if data[at:at + len(VERSION)] != VERSION:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("no end of the headers")
    head = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header without a colon")
        head[name.strip().lower()] = value.strip()
    if not head.get("content-length", "").isdigit():
        raise Damaged("no content length")
    start, stop = end + 4, end + 4 + int(head["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("record end not found")
    block = data[start:stop]
    if "warc-block-digest" in head and _digest(block) != head["warc-block-digest"]:
        raise Damaged("block digest differs")
    return head, block, stop + 4


def _next_place(data: bytes, at: int) -> int:
    return min((p for p in (data.find(MAGIC, at), data.find(VERSION, at)) if p >= 0), default=len(data))


def salvage(data: bytes):
    """Yield (start, end, headers, block) of every sound record, and (start, end, None, reason) of every gap."""
    view, at, lost, why = memoryview(data), 0, None, ""
    while at < len(data):
        try:
            if data[at:at + 3] == MAGIC:
                inner, end = _member(view, at)
                found, p = [], 0
                while p < len(inner):
                    head, block, p = _parse(inner, p)
                    found.append((head, block))
            elif data[at:at + 2] == b"\r\n" and lost is None:  # blank lines between records
                at += 2
                continue
            else:
                head, block, end = _parse(data, at)
                found = [(head, block)]
        except Damaged as e:
            if lost is None:
                lost, why = at, str(e)
            at = _next_place(data, at + 1)
            continue
        if lost is not None:
            yield lost, at, None, why
            lost = None
        for head, block in found:
            yield at, end, head, block
        at = end
    if lost is not None:
        yield lost, len(data), None, why


RECORDS = ("file string, start long, end long, gap string, record_type string, record_id string, refers_to_id string, "
           "page_id long, url string, payload_digest string, payload binary")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, pattern: str = "[^_.]*") -> DataFrame:
    """A row per record and per gap of the files ``pattern`` (a glob) under ``path``; gaps have a reason in ``gap`` and no type."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for start, end, head, got in salvage(data.as_py()):
                    if head is None:
                        rows.append((name, start, end, got) + (None,) * 8)
                        continue
                    kind = head.get("warc-type")
                    payload = got.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    sha1 = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    digest = base64.b32decode(sha1).hex() if sha1 else None
                    if payload is not None and digest is not None and hashlib.sha1(payload).hexdigest() != digest:
                        rows.append((name, start, end, "payload digest differs") + (None,) * 8)
                        continue
                    page = head.get("warc-page-id")
                    rows.append((name, start, end, None, kind, head.get("warc-record-id"), head.get("warc-refers-to"),
                                 None if page is None else int(page), head.get("warc-target-uri"), digest,
                                 payload if with_payload else None, None if payload is None else len(payload)))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                         pa.string(), pa.string(), pa.binary(), pa.int64()]
                names = ["file", "start", "end", "gap", "record_type", "record_id", "refers_to_id", "page_id", "url",
                         "payload_digest", "payload", "payload_bytes"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content").mapInArrow(
        run, RECORDS + ", payload_bytes long")


def archived_pages(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; revisits look up their response."""
    rows = records.where("record_type is not null")
    answers = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("r_id"), F.col("page_id").alias("r_page"), F.col("payload_bytes").alias("r_bytes")).dropDuplicates(["r_id"])
    return rows.join(answers, rows.refers_to_id == answers.r_id, "left").select(
        "page_id", F.coalesce("payload_bytes", "r_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("r_page").alias("refers_to"))


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Archives written from all pages and read back: type, payload size and digest of each page's record."""
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(read_table(spark, sf_dir, "pages"), path)
    return archived_pages(stage(read_archives(spark, path, with_payload=False), "wa-record"))


SQL = """
with p as (select page_id, sha1(coalesce(html, '')) as payload_digest, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes from pages),
     m as (select payload_digest, max(page_id) as leader from p where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, p.payload_digest,
       case when page_id < leader then 'revisit' else 'response' end as record_type,
       case when page_id < leader then leader end as refers_to
from p left join m on p.payload_digest = m.payload_digest
"""
