"""Fill-in-middle transformation: texts cut at two token boundaries, their parts put in another order.

A text's token boundaries (offsets in code points, one after each token) are kept as a set in containers of 2**16
offsets each: a sorted array where few offsets are set, a bitmap where many are, and (start, length) runs where
neighbouring offsets are set; whichever is smallest.  The containers' cardinalities are summed up, so the offset of the
k-th boundary is found by a search over the containers and a select inside one of them.

Both cuts and the form of a document follow from a hash of the seed and its id alone, so every run, task and retry gives
the same result.  Each row is worked on by itself: nothing is shuffled.

Defined results: a null text is empty, and an empty text is plain; a null id hashes as an empty one; repeated rows
give equal results; other columns of any name are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LOW = 1 << 16  # offsets of a container
ARRAY, BITMAP, RUN = "array", "bitmap", "run"
BITMAP_BYTES = LOW // 8


class _Container:
    """Up to 2**16 offsets in the smallest of the three forms."""

    def __init__(self, low: np.ndarray):
        starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        if 4 * len(starts) < min(2 * len(low), BITMAP_BYTES):
            self.kind = RUN
            lengths = np.diff(starts, append=len(low))
            self.starts, self.before = low[starts].astype(np.uint16), np.concatenate([[0], np.cumsum(lengths)])
        elif 2 * len(low) <= BITMAP_BYTES:
            self.kind = ARRAY
            self.low = low.astype(np.uint16)
        else:
            self.kind = BITMAP
            bits = np.zeros(LOW, np.uint8)
            bits[low] = 1
            self.words = np.packbits(bits, bitorder="little").view(np.uint64)
            self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        """The offset with ``k`` smaller ones in this container."""
        if self.kind == ARRAY:
            return int(self.low[k])
        part = int(np.searchsorted(self.before, k, "right")) - 1
        k -= int(self.before[part])
        if self.kind == RUN:
            return int(self.starts[part]) + k
        bits = np.unpackbits(self.words[part:part + 1].view(np.uint8), bitorder="little")
        return 64 * part + int(np.flatnonzero(bits)[k])


class BoundarySet:
    """Sorted offsets in containers, with ``select``."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        ends = np.append(cuts[1:], len(offsets))
        self.high = high[cuts]
        self.containers = [_Container(offsets[s:e] & (LOW - 1)) for s, e in zip(cuts, ends)]
        self.cumulative = np.concatenate([[0], ends]) if len(offsets) else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: int) -> int:
        """The k-th smallest offset, counted from 0."""
        c = int(np.searchsorted(self.cumulative, k, "right")) - 1
        return int(self.high[c]) * LOW + self.containers[c].select(k - int(self.cumulative[c]))


def boundaries(text: str) -> BoundarySet:
    """Offsets after each token ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (points == 0x20) | (points - np.uint32(9) <= 4)
    ends = ~blank
    ends[:-1] &= blank[1:]  # the last character of a word
    if len(ends):
        ends[-1] = True  # a word's end or that of the blanks after the last word
    return BoundarySet(np.flatnonzero(ends) + 1)


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def cut(text: str, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    found = boundaries(text)
    n, (h1, h2, h3, h4) = len(found), draws(seed, doc_id)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    i, j = (found.select(k - 1) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    head, middle, tail = text[:i], text[i:j], text[j:]
    if h4 % 100 < spm:
        return n, "spm", i, j - i, SUFFIX + tail + PREFIX + head + MIDDLE + middle
    return n, "psm", i, j - i, PREFIX + head + SUFFIX + tail + MIDDLE + middle


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                   spm: int = 80) -> DataFrame:
    """Per row of ``docs``: id, n (tokens), form (plain, spm, psm), prefix_chars, middle_chars, output (text).

    ``rate`` percent of the documents are cut, ``spm`` percent of these get the suffix first.
    """
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [cut(t or "", i, seed, rate, spm) for i, t in zip(ids, b.column(1).to_pylist())]
            n, form, head, middle, output = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(head, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())], names=["id", "n", "form", "head", "middle", "output"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n long, form string, head long, middle long, output string")
    return out.toDF(id_col, "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text again, from output and form.  No marker occurs in a text that was cut, so the output splits at them."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "spm", F.concat(part[2], part[3], part[1]))
            .when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(output))


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's fill-in-middle form and of the text rebuilt from it."""
    out = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
     t as (select *, case when text = '' then cast([] as varchar[]) else
                  regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') end as tok,
                  cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
                  cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
     c as (select *, cast(len(tok) as bigint) as n, least(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) as a,
                  greatest(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) as b,
                  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
                       then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from t),
     p as (select *, array_to_string(tok[1:a], '') as p, array_to_string(tok[a + 1:b], '') as m, array_to_string(tok[b + 1:], '') as s from c)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
                        else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
