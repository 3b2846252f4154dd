"""Hashed maximum-entropy language model with a class-factored softmax.

Tokens are words and one end per document.  Their counts are taken over all training documents.  The ``HEAD`` most
frequent tokens form classes of ``SLOTS`` words by frequency; every other word belongs to one of ``REST`` classes by
its last two bytes.  With the context's features x,

    P(word) = softmax over classes(x) * P(word | class)

where P(word | class) is a second softmax over the class's words: for the head with dense weights, for the rest with those of the
pairs (word before, word), of which a table grows with the corpus (``lm_pairs``), one share standing for words never
seen.  Features of classes and head are the token before (bigram), those two and three before (skips), and the pair before,
hashed into a fixed table.  Weights start at the unigram model.  Training is
by rounds of distributed gradient steps: each round takes its share of the documents (every training document is in one
round), each task sums observed and expected feature counts over all its tokens, tasks are added up, and the difference,
scaled by the expected counts, moves the weights.

Scoring runs in numpy batches inside the scan.  Counts of up to ``KNOWN`` frequent words travel with the tasks (a fixed
bound); rarer words of a document are joined to the count table by hash, so no table of the vocabulary's size is ever
broadcast.

Defined results: null and empty texts are an end alone; rows with a null id count as training rows; without training
rows the base score is 0 for every token and the model is uniform over its classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi.llm import lm_pairs
from lakekpi.llm.common import read_table, stage
from lakekpi.llm.lm_pairs import Finder
from lakekpi.llm.toxicity import fold

SLOTS, CLASSES, REST = 32, 16, 32
HEAD = SLOTS * CLASSES
WIDE = CLASSES + REST
PAD = HEAD + REST  # the symbol before a document's first token
SYMBOLS = PAD + 1
BUCKETS = 4096  # of the class features; those of single symbols come first
KNOWN = 1_000_000
ROUNDS, RATE, DAMP = 4, 0.5, 8.0
CHUNK = 1 << 16  # numbers in a row of gradient sums
BATCH = 4096  # tokens scored at once
PIECE = 1 << 20  # bytes split into words at once
END = np.uint64(0x0E0D0E0D0E0D0E00)


_BASE = np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_DIGIT = _LOWER.astype(np.uint64) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def _hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts data[cuts[i]:cuts[i + 1]], and the number of words of each."""
    low = _LOWER[data]
    word = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)  # texts begin here
    edge[cuts] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    # polynomial hash of each word from prefix sums: sum of byte * base^(end - place), then mixed
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_power(_BACK, len(data)) * _DIGIT[data], out=total[1:])
    h = (total[e] - total[s]) * _power(_BASE, len(data) + 1)[e]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    before = np.where(e - s > 1, low[np.maximum(e - 2, 0)], 0).astype(np.int64)
    ending = (low[e - 1] * np.int64(31) + before * 7) % REST
    return (h & ~np.uint64(127)) | ending.astype(np.uint64), np.diff(np.searchsorted(s, cuts))


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of a text column, the ends included, its low bits the word's rest class; and the texts' offsets."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    parts, sizes, i = [], [], 0
    while i < len(texts):  # about PIECE bytes at a time
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        h, n = _hashes(data[at[i]:at[j]], at[i:j + 1] - at[i])
        parts.append(h)
        sizes.append(n)
        i = j
    n = np.concatenate(sizes) + 1 if sizes else np.zeros(0, np.int64)
    off = np.concatenate([[0], np.cumsum(n)])
    out = np.full(off[-1], END, np.uint64)
    mask = np.ones(len(out), bool)
    mask[off[1:] - 1] = False
    out[mask] = np.concatenate(parts) if parts else out[:0]
    return out, off


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, c) of all tokens of ``docs(text)``, summed in each task first."""
    def run(batches):
        parts, held = [], 0

        def flush():
            h, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            c = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
            return h, c

        for b in batches:
            h, _ = token_hashes(b.column(0))
            if len(h):
                parts.append(np.unique(h, return_counts=True))
                held += len(parts[-1][0])
            if held > 2_000_000:
                parts = [flush()]
                held = len(parts[0][0])
                if held > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), pa.array(parts[0][1])], names=["h", "c"])
                    parts, held = [], 0
        if parts:
            h, c = flush()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _shares(x: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place.  One maximum serves all rows: weights move by at most 1.5 * RATE a round, so rows differ little."""
    if x.size:
        x -= x.max()
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


class Model:
    """Counts, classes and the weights of the classes and the head, which travel with the tasks; those of pairs are a table."""

    def __init__(self, n: int, v: int, known: tuple[np.ndarray, np.ndarray], rest: dict[int, tuple[int, int]], head: np.ndarray):
        self.n, self.z = n, n + 0.5 * (v + 1)
        self.h, self.c = known  # ascending by hash
        self.finder = self.heads = None  # made in the tasks
        self.slot = np.full(len(self.h), -1, np.int32)
        at = np.searchsorted(self.h, head)
        self.slot[at] = np.arange(len(head))
        count = self.c[at].astype(float)
        # the classes' shares of the counts: the rest without the head
        inside = np.bincount((head & np.uint64(127)).astype(np.int64), minlength=REST)[:REST], np.bincount((head & np.uint64(127)).astype(np.int64), count, REST)[:REST]
        self.rest_z = np.array([rest.get(k, (0, 0))[0] - inside[1][k] + 0.5 * (rest.get(k, (0, 0))[1] - inside[0][k] + 1) for k in range(REST)])
        words = np.full(HEAD, 1e-9)
        words[:len(head)] = count + 0.5
        self.b2 = np.log(words).reshape(CLASSES, SLOTS).astype(np.float32)
        self.b1 = np.log(np.concatenate([words.reshape(CLASSES, SLOTS).sum(1), self.rest_z])).astype(np.float32)
        self.b1 -= np.logaddexp.reduce(self.b1)
        self.w1 = np.zeros((BUCKETS, WIDE), np.float32)
        self.w2 = np.zeros((3 * SYMBOLS * CLASSES, SLOTS), np.float32)

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0: not among the known) and symbol of each token."""
        if self.finder is None:
            self.finder = Finder(self.h)
        at = self.finder.find(h)
        hit = at >= 0
        count, symbol = np.zeros(len(h), np.int64), HEAD + (h & np.uint64(127)).astype(np.int64) % REST
        count[hit] = self.c[at[hit]]
        slot = self.slot[at[hit]]
        symbol[hit] = np.where(slot >= 0, slot, symbol[hit])
        return count, symbol

    def in_rest(self, h: np.ndarray) -> np.ndarray:
        """Whether each token is outside the head."""
        return self.symbols(h) >= HEAD

    def symbols(self, h: np.ndarray) -> np.ndarray:
        """Symbol of each token."""
        if self.heads is None:
            at = self.slot >= 0  # ascending by hash
            self.heads = Finder(self.h[at]), np.append(self.slot[at], 0)
        at = self.heads[0].find(h)
        return np.where(at >= 0, self.heads[1][at], HEAD + (h & np.uint64(127)).astype(np.int64) % REST)

    @staticmethod
    def features(symbol: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bucket of each of the four features of every token."""
        pos = np.arange(len(symbol)) - np.repeat(off[:-1], np.diff(off))
        before = []
        for k in (1, 2, 3):
            s = np.full(len(symbol), PAD)
            s[k:] = symbol[:-k] if k < len(symbol) + 1 else symbol[:0]
            s[pos < k] = PAD
            before.append(s)
        pair = (before[0] * SYMBOLS + before[1]) * 2654435761 % (1 << 32) * (BUCKETS - 3 * SYMBOLS) >> 32
        return np.stack([before[0], SYMBOLS + before[1], 2 * SYMBOLS + before[2], 3 * SYMBOLS + pair])

    def classes(self, f: np.ndarray) -> np.ndarray:
        """P(class) for each token."""
        x = self.b1 + self.w1[f[0]]
        for k in (1, 2, 3):
            x += self.w1[f[k]]
        return _shares(x)

    def words(self, f: np.ndarray, k: np.ndarray) -> np.ndarray:
        """P(word | class ``k``) for each token of a head class."""
        x = self.b2[k] + self.w2[f[0] * CLASSES + k]
        for i in (1, 2):
            x += self.w2[f[i] * CLASSES + k]
        return _shares(x)

    def log10(self, symbol: np.ndarray, off: np.ndarray) -> np.ndarray:
        """log10 P(class) of each token, and of its word within a head class; rest words lack their own share."""
        f, out = self.features(symbol, off), np.zeros(len(symbol))
        for i in range(0, len(symbol), BATCH):
            s, g = symbol[i:i + BATCH], f[:, i:i + BATCH]
            cls = np.where(s < HEAD, s // SLOTS, s - HEAD + CLASSES)
            p = self.classes(g)[np.arange(len(s)), cls].astype(float)
            at = np.flatnonzero(s < HEAD)
            p[at] *= self.words(g[:, at], cls[at])[np.arange(len(at)), s[at] % SLOTS]
            out[i:i + BATCH] = np.log10(np.maximum(p, 1e-300))
        return out


def _add_rows(total: np.ndarray, key: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(key.astype(np.uint16), kind="stable")  # both tables have fewer rows than that; short numbers sort faster
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    total[k[first]] += np.add.reduceat(rows[order], first, axis=0)


class Sums:
    """Observed and expected feature counts of a task's tokens."""

    def __init__(self):
        self.seen1, self.mean1 = (np.zeros((BUCKETS, WIDE), np.float32) for _ in range(2))
        self.seen2, self.mean2 = (np.zeros((3 * SYMBOLS * CLASSES, SLOTS), np.float32) for _ in range(2))

    def add(self, m: Model, symbol: np.ndarray, off: np.ndarray) -> None:
        f = m.features(symbol, off)
        cls = np.where(symbol < HEAD, symbol // SLOTS, symbol - HEAD + CLASSES)
        head = symbol < HEAD
        for k in range(4):
            self.seen1 += np.bincount(f[k] * WIDE + cls, minlength=BUCKETS * WIDE).reshape(BUCKETS, WIDE)
        for k in range(3):
            key = (f[k][head] * CLASSES + cls[head]) * SLOTS + symbol[head] % SLOTS
            self.seen2 += np.bincount(key, minlength=self.seen2.size).reshape(self.seen2.shape)
        for i in range(0, len(cls), BATCH):
            g, c, at = f[:, i:i + BATCH], cls[i:i + BATCH], np.flatnonzero(head[i:i + BATCH])
            p = m.classes(g)
            for k in range(4):
                _add_rows(self.mean1, g[k], p)
            if len(at):
                q = m.words(g[:, at], c[at])
                for k in range(3):
                    _add_rows(self.mean2, g[k][at] * CLASSES + c[at], q)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.seen1, self.mean1, self.seen2, self.mean2)])


def _gradient(docs: DataFrame, model) -> np.ndarray:
    """Feature counts of all tokens of ``docs``, added up by ranges so that no task holds more than one copy."""
    size = 2 * (BUCKETS * WIDE + 3 * SYMBOLS * HEAD)

    def run(batches):
        m, sums, some = model.value, Sums(), False
        for b in batches:
            h, off = token_hashes(b.column(0))
            if len(h):
                sums.add(m, m.symbols(h), off)
                some = True
        if some:
            flat = sums.flat()
            for i in range(0, size, CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK], pa.int32()), pa.array([flat[i:i + CHUNK].tobytes()])], names=["k", "g"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(g, np.float32)
                total[k] = total[k] + x if k in total else x.copy()
        for k, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()])], names=["k", "g"])

    flat = np.zeros(size, np.float32)
    rows = docs.select("text").mapInArrow(run, "k int, g binary").repartition("k").mapInArrow(add, "k int, g binary").collect()
    for r in rows:  # one row per range: the size of the model
        flat[r["k"] * CHUNK:r["k"] * CHUNK + len(r["g"]) // 4] += np.frombuffer(r["g"], np.float32)
    return flat


def _step(model: Model, flat: np.ndarray) -> None:
    one, two = model.w1.size, model.w2.size
    parts = np.split(flat, [one, 2 * one, 2 * one + two])
    for w, seen, mean in ((model.w1, parts[0], parts[1]), (model.w2, parts[2], parts[3])):
        move = (seen - mean) / (np.maximum(mean, 0.2 * seen) + DAMP)
        w += (RATE * np.clip(move, -1.5, 1.5)).reshape(w.shape).astype(np.float32)


def fit(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """Model from the training rows ``docs(id, text)`` and their token counts (h, c)."""
    spark = docs.sparkSession
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # smallest count from which on no more than KNOWN tokens are left, to an eighth of a power of two
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    room, least = KNOWN, None
    for s, k in sizes:
        room -= k
        if room < 0:
            break
        least = s
    known = counts.where(step >= least) if least is not None else counts.limit(0)
    table = known.toArrow()  # two numbers for each of at most KNOWN tokens
    h, c = (table.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(h.view(np.uint64))
    h, c = h[order].view(np.uint64), c[order]
    low = F.col("h").bitwiseAND(F.lit(127))
    rest = {r["k"]: (r["c"], r["n"]) for r in counts.groupBy(low.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()}
    top = np.lexsort((h, -c))[:HEAD]
    head = h[top]
    if len(h) and END in h and END not in head:
        head[-1] = END
    model = Model(int(n), int(v), (h, c), rest, head)
    if n:
        turn = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(rounds))
        for r in range(rounds):
            shared = spark.sparkContext.broadcast(model)
            _step(model, _gradient(docs.where(F.coalesce(turn, F.lit(0)) == r), shared))
            shared.destroy()
    return model


def score(docs: DataFrame, model: Model, counts: DataFrame, learnt=None) -> DataFrame:
    """Per row of ``docs(row, id, held_out, text)``: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = int(model.c.min()) if len(model.c) else None

    def run(batches):
        m = shared.value
        for b in batches:
            h, off = token_hashes(b.column(3))
            count, symbol = m.look(h)
            doc = np.repeat(np.arange(b.num_rows), np.diff(off))
            own = np.where(count > 0, np.log10(count + 0.5), 0.0)
            rest = symbol >= HEAD
            part = m.log10(symbol, off)
            part[rest] += own[rest] - np.log10(m.rest_z[symbol[rest] - HEAD])
            n = np.diff(off)
            add = lambda x: np.bincount(doc, x, b.num_rows)
            rare = np.flatnonzero(count == 0)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=b.num_rows))])
            tail = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h[rare].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n), pa.array(n - np.diff(cuts)), pa.array(add(own) - n * np.log10(m.z)),
                 pa.array(add(part)), tail], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"])

    rows = docs.select("row", F.col("id").alias("doc_id"), "held_out", "text")
    done = stage(rows.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
                                      "tail array<long>"), "lm-row")
    # the rare words' counts: log10(c + 0.5), or log10(0.5) for words never seen in training
    rare = counts.where(F.col("c") < least) if least is not None else counts
    found = (done.select("row", F.explode("tail").alias("h")).join(rare, "h")
             .groupBy("row").agg(F.count(F.lit(1)).alias("k"), F.sum(F.log10(F.col("c") + 0.5)).alias("s")))
    k = F.coalesce("k", F.lit(0))
    add = F.coalesce("s", F.lit(0.0)) + (F.size("tail") - k) * F.log10(F.lit(0.5))
    got = done.join(found, "row", "left")
    if learnt is None:
        got = got.withColumn("pairs", F.lit(0.0))
    else:
        got = got.join(lm_pairs.evidence(rows, shared, learnt, token_hashes), "row", "left")
    return got.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + k).cast("long").alias("n_known"), F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + add).alias("base_score"), (F.col("score") + add + F.coalesce("pairs", F.lit(0.0))).alias("score"))


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows outside the held-out fold and score all rows."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    rows = stage(rows, "lm-docs")  # the row numbers are the same in every pass
    train = rows.where(~F.col("held_out"))
    counts = stage(token_counts(train), "lm-count")
    model = fit(train, counts, rounds)
    return score(rows, model, counts, lm_pairs.train(train, counts, model, token_hashes)).withColumnRenamed("doc_id", id_col)


def op9_lm_scores(spark, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents under the model, and under the smoothed unigram base."""
    return score_corpus(read_table(spark, sf_dir, "documents"))
