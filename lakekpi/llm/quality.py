"""Quality classifier by positive-unlabelled learning.

Trusted positives are training rows labelled good; the unlabelled side is web text without any label, good and bad
mixed.  Both are samples of about ``sample`` rows (a documented bound, a share of the rows by hash of the id).  Texts
become a few dozen shape features (shares of character classes, repeats, word and line lengths), each as a
number and as quantile bins.  The class prior is estimated as the smallest ratio of unlabelled to positive rows that a
first classifier of the two sides lets pass.  The final weights minimise the non-negative unbiased risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

by gradient steps that turn round whenever the second term is negative, so that a flexible model cannot drive it
below zero.  All documents are then scored inside the scan.

Defined results: null and empty texts have all features zero; rows with a null id are not held out; a row labelled more
than once counts as good only if all its labels do; without positives or unlabelled rows every score is 0.5.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekpi.llm.common import read_table, stage, text_bytes
from lakekpi.llm.toxicity import fold

SAMPLE = 20_000
BINS = 8
STEPS = 400

LOWER, UPPER, DIGIT, BLANK, STOP, SYMBOL, HIGH, TAIL = range(8)


def _classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.uint8)
    table[ord("a"):ord("z") + 1], table[ord("A"):ord("Z") + 1], table[ord("0"):ord("9") + 1] = LOWER, UPPER, DIGIT
    table[[9, 10, 11, 12, 13, 32]] = BLANK
    table[[ord(c) for c in ".,;:'\"?-()"]] = STOP
    table[0x80:0xC0], table[0xC0:] = TAIL, HIGH
    return table


ABOVE_ASCII = bytes(range(128, 256))
FEATURES = ["log_words", "upper", "digit", "blank", "stop", "symbol", "high", "mean_word", "longest_word", "distinct_words", "same_as_before",
            "distinct_pairs", "top_word", "bar", "bang", "mean_line", "same_lines", "odd_words", "sentence_words"]


def features(t: bytes, table: np.ndarray) -> list[float]:
    words = t.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, k = len(t), len(words)
    by = np.bincount(table[np.frombuffer(t, np.uint8)], minlength=8)
    letters = max(1, by[LOWER] + by[UPPER] + by[HIGH])
    lines = [x for x in t.split(b"\n") if x.strip()]
    seen = Counter(words)
    after = words[1:]
    odd = sum(c for w, c in seen.items() if w.strip(b".,;:!?'\"()-").translate(None, ABOVE_ASCII).isalnum())
    return [np.log1p(k), by[UPPER] / letters, by[DIGIT] / n, by[BLANK] / n, by[STOP] / k, by[SYMBOL] / k, by[HIGH] / letters, (n - by[BLANK]) / k,
            np.log1p(max(map(len, seen))), len(seen) / k, sum(map(bytes.__eq__, words, after)) / k, len(set(zip(words, after))) / max(1, k - 1),
            max(seen.values()) / k, t.count(b"|") / k, t.count(b"!") / k, np.log1p(k / len(lines)), 1 - len(set(lines)) / len(lines), 1 - odd / k,
            np.log1p(k / max(1, t.count(b".") + t.count(b"?") + t.count(b"!")))]


def _featured(rows: DataFrame, keep: str, out: str) -> DataFrame:
    def run(batches):
        table = _classes()
        for b in batches:
            x = [features(t, table) for t in text_bytes(b.column(b.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(x, pa.list_(pa.float64()))],
                                             names=[*b.schema.names[:-1], "x"])

    return rows.mapInArrow(run, f"{keep}, x array<double>")


class Model:
    """Binning, weights, and the estimated share of good documents."""

    def __init__(self, pos: np.ndarray, unl: np.ndarray, steps: int = STEPS):
        self.ready = len(pos) > 0 and len(unl) > 0
        if not self.ready:
            return
        both = np.concatenate([pos, unl])
        self.mean, self.std = both.mean(0), both.std(0) + 1e-9
        self.cuts = np.quantile(both, np.arange(1, BINS) / BINS, axis=0)
        half = lambda x, i: x[i::2] if len(x) > 1 else x
        first = self._descend(*(self.expand(half(x, 0)) for x in (pos, unl)), None, steps)
        self.prior = self._prior(*(self.expand(half(x, 1)) @ first for x in (pos, unl)))
        self.weights = self._descend(self.expand(pos), self.expand(unl), self.prior, steps)

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        bins = [(x > c).astype(float) for c in self.cuts]
        return np.concatenate([np.ones((len(x), 1)), z, np.abs(z), *bins], axis=1)

    @staticmethod
    def _prior(pos: np.ndarray, unl: np.ndarray) -> float:
        """Above a cut that no bad document passes, unlabelled rows pass at the prior times the positives' rate."""
        cuts = np.quantile(pos, np.linspace(0.02, 0.5, 49))
        ratios = [(unl >= c).mean() / max((pos >= c).mean(), 1e-9) for c in cuts]
        return float(np.clip(min(ratios), 0.05, 0.98))

    @staticmethod
    def _descend(pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
        """Adam on the non-negative risk; without a prior on the plain logistic loss of positives against unlabelled."""
        w, m, v = (np.zeros(pos.shape[1]) for _ in range(3))
        for i in range(1, steps + 1):
            sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (pos, unl))
            good, as_bad, bad = pos.T @ (sp - 1) / len(pos), pos.T @ sp / len(pos), unl.T @ su / len(unl)
            if prior is None:
                g = good + bad
            else:
                risk = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
                g = prior * good + (bad - prior * as_bad) if risk >= 0 else prior * as_bad - bad
            g = g + decay * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        return w

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready or not len(x):
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.expand(x) @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int,
        sample: int = SAMPLE) -> Model:
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.min(label_col).alias("y")).where((F.col("y") == 1) & (fold("id", folds) != held)).select("id"))
    # every document is a row without a label; those of good ones are trusted positives besides
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    sides = stage(ids.select("id", F.lit(False).alias("pos")).union(ids.join(marks, "id", "left_semi").select("id", F.lit(True))), "qc-side")
    count = {r["pos"]: r["n"] for r in sides.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("pos"), F.lit(sample / max(1, count.get(True, 0)))).otherwise(F.lit(sample / max(1, count.get(False, 0))))
    picked = sides.where(F.pmod(F.xxhash64("id", "pos"), F.lit(1_000_000)) < share * 1_000_000)  # about 2 * sample ids
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    # one text of each id, however often it occurs
    texts = texts.groupBy("id", "pos").agg(F.min("text").alias("text"))
    got = _featured(texts.select("pos", "text"), "pos boolean", "x")
    # about 2 * sample rows of features; in a fixed order, so that the fit is the same at each run
    table = stage(got, "qc-sample").orderBy("pos", "x").toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    pos = np.array(table.column("pos").to_pylist(), bool)
    return Model(x[pos], x[~pos])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held: int = 1,
          threshold: float = 0.5) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        table, m = _classes(), shared.value
        for b in batches:
            x = np.array([features(t, table) for t in text_bytes(b.column(2))], float).reshape(-1, len(FEATURES))
            p = m.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        table, m = _classes(), shared.value
        for b in batches:
            x = np.array([features(t, table) for t in text_bytes(b.column(at))], float).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(m.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score(docs, fit(docs, labels, "doc_id", "text", "quality", 3, 1))
