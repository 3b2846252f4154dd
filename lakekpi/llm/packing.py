"""Packing token ids into sequences by minimum bin slack.

Each task packs the documents of its own partition, so nothing is shuffled and a partition's size bounds its work.  A
document's ids are cut into full sequences, and its remainder joins a pool.  A sequence is seeded with the longest
remainder; a subset-sum over the multiset of the pool's lengths, kept as a bitset of reachable sums, finds the sum
closest to the room left, and the counts of each length are read back from the layers of the sum.  Where
that sum leaves slack, the next remainder is cut to fill it.  A partition's last ids, fewer than a sequence, are cut into
sequences whose lengths are powers of two, so that none needs padding.

Defined results: a null text is empty; an empty document is its end id alone; every row, repeated ones and those with a
null id too, is packed on its own; sequence ids are unique, but not consecutive across partitions.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, text_bytes
from lakekpi.llm.tokenizing import VOCABULARY, encoder

CAPACITY = 2048
END_ID = 1
ENCODE_BYTES = 4 << 20  # of texts encoded in one call: a call has a cost of its own, and texts can be long
POOL = 4096  # remainders held by a task; packing begins when there are twice as many


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is the largest possible up to ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted([x for x in counts if x <= room], reverse=True):
        left, batch = min(counts[length], room // length), 1
        while left > 0:  # counts in powers of two
            take = min(batch, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, batch = left - take, 2 * batch
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


class Packer:
    """Packs pieces (document, start, ids) into sequences; ``rows`` holds the finished pieces."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, pool: int = POOL):
        self.capacity, self.pool, self.next = capacity, pool, first_sequence
        self.by_length: dict[int, list] = defaultdict(list)
        self.counts: dict[int, int] = {}
        self.held, self.rows = 0, []

    def _place(self, pieces) -> None:
        at = 0
        for doc, start, ids in pieces:
            self.rows.append((doc, start, ids, self.next, at))
            at += len(ids)
        self.next += 1

    def _pool(self, doc, start, ids) -> None:
        self.by_length[len(ids)].append((doc, start, ids))
        self.counts[len(ids)] = self.counts.get(len(ids), 0) + 1
        self.held += 1

    def _take(self, length: int):
        piece = self.by_length[length].pop()
        self.counts[length] -= 1
        self.held -= 1
        if not self.counts[length]:
            del self.counts[length]
        return piece

    def add(self, doc, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % self.capacity
        for s in range(0, full, self.capacity):
            self._place([(doc, s, ids[s:s + self.capacity])])
        if len(ids) > full:
            self._pool(doc, full, ids[full:])
        if self.held > 2 * self.pool:
            while self.held > self.pool:
                self._fill()

    def _fill(self) -> None:
        chosen = [self._take(max(self.counts))]
        room = self.capacity - len(chosen[0][2])
        for length, n in closest_fill(self.counts, room).items():
            for _ in range(n):
                chosen.append(self._take(length))
                room -= length
        if room and self.counts:  # every remainder left is longer than the room: cut one
            doc, start, ids = self._take(min(self.counts))
            chosen.append((doc, start, ids[:room]))
            self._pool(doc, start + room, ids[room:])
            room = 0
        if not room:
            return self._place(chosen)
        size, part, got = 0, [], 0  # the last ids of the partition
        left = self.capacity - room
        for doc, start, ids in chosen:
            while len(ids):
                size = size or 1 << (left.bit_length() - 1)
                n = min(len(ids), size - got)
                part.append((doc, start, ids[:n]))
                start, ids, got = start + n, ids[n:], got + n
                if got == size:
                    self._place(part)
                    left, size, part, got = left - size, 0, [], 0

    def finish(self) -> None:
        while self.held:
            self._fill()


def runs_of_bytes(texts: list[bytes], limit: int = ENCODE_BYTES):
    """(from, to) of consecutive texts of at most ``limit`` bytes together, or of one longer text."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves if asked for."""
    fields = f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    fields += ", ids array<int>" * with_ids
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids

    def run(batches):
        words = encoder(vocabulary)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity)

        def rows():
            out = [((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), size, seq, at) + ((ids.astype(np.int32),) if with_ids else ()))
                   for (doc, size), start, ids, seq, at in packer.rows]
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), text_bytes(b.column(1))
            for i, to in runs_of_bytes(texts):
                ids, off = words.encode(texts[i:to])
                for j, doc in enumerate(doc_ids[i:to]):
                    own = np.append(ids[off[j]:off[j + 1]], np.uint32(end_id))
                    packer.add((doc, len(own)), own)
            if packer.rows:
                yield rows()
        packer.finish()
        if packer.rows:
            yield rows()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, fields)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(read_table(spark, sf_dir, "documents"), with_ids=False)
