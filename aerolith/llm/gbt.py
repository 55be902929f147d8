"""Quality rules by gradient-boosted trees over document statistics.

Base statistics of every whole text (words ``[^\\x20\\x09-\\x0D]+``): n_words,
word_chars, n_symbols, n_dup_lines, n_repeat_words, and base_failed (fewer
than 50 words, or over half of the words in repeated 3-word windows).

The trees learn labels.quality with the logistic loss from at most ``SAMPLE``
labelled documents (chosen by a hash of the id) in numpy: histograms of
quantile bins, second-order gains, fixed depth. On features marked -1 in
``docstats.FEATURES`` more may only lower the score: a split that would raise
it is not taken, and each side's values are bounded by the middle of the two,
so every tree, and their sum, is monotone. All trees are one set of flat node
arrays (feature, threshold, left, right, value); scoring steps all rows
through all trees at once, a level at a time, without a shuffle.

Defined cases: null text has no words and fails the base rule; a null doc_id
stays null; a document labelled twice counts with its smallest quality, an id on
several texts with the first of them in order; without
labels of both kinds the model keeps every document; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import bounded_sample, mapped, table, texts
from aerolith.llm.docstats import FEATURES, base, features

SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LAMBDA, LEAST = 60, 4, 32, 0.2, 1.0, 5.0
KEEP_AT = 0.5
MIN_WORDS = 50
EXTRA = {"symbols_per_word": -1, "dup_lines": -1, "repeat_share": -1, "chars_per_word": 0}
SIGNS = np.array([*FEATURES.values(), *EXTRA.values()])


def statistics(text: bytes) -> tuple[tuple[int, ...], list[float]]:
    """The base statistics, and the features of the trees."""
    b = base(text)
    n = max(b[0], 1)
    return b, [*features(text), b[2] / n, float(b[3]), b[4] / n, b[1] / n]


@dataclass
class Forest:
    """Nodes of all trees; a leaf points to itself."""
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _best_split(binned, g, h, low, high, cuts):
    """(gain, feature, bin, left value, right value) of the best admissible split."""
    best = (1e-6, None)
    whole_g, whole_h = g.sum(), h.sum()
    parent = whole_g ** 2 / (whole_h + LAMBDA)
    for f in range(binned.shape[1]):
        gl = np.cumsum(np.bincount(binned[:, f], g, BINS))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, BINS))[:-1]
        gr, hr = whole_g - gl, whole_h - hl
        vl, vr = np.clip(-gl / (hl + LAMBDA), low, high), np.clip(-gr / (hr + LAMBDA), low, high)
        gain = gl ** 2 / (hl + LAMBDA) + gr ** 2 / (hr + LAMBDA) - parent
        allowed = (hl > LEAST * 0.05) & (hr > LEAST * 0.05) & (SIGNS[f] * (vr - vl) >= 0) & np.isfinite(cuts[f])
        gain = np.where(allowed, gain, -np.inf)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], f, k, float(vl[k]), float(vr[k]))
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    if len(y) == 0 or y.min() == y.max():
        one = np.zeros(1, dtype=np.int64)
        return Forest(one, one, np.zeros(1), one, one, np.zeros(1), 30.0)
    cuts = np.full((x.shape[1], BINS - 1), np.inf)
    for f in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
        cuts[f, : len(q)] = q
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k
    bias = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(len(y), bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(node())
        open_ = [(roots[-1], np.arange(len(y)), -4.0, 4.0, 0)]
        while open_:
            k, rows, low, high, depth = open_.pop()
            best = _best_split(binned[rows], g[rows], h[rows], low, high, cuts) if depth < DEPTH else (0, None)
            if best[1] is None:
                value[k] = RATE * float(np.clip(-g[rows].sum() / (h[rows].sum() + LAMBDA), low, high))
                z[rows] += value[k]
                continue
            _, f, b, vl, vr = best
            feature[k], threshold[k], left[k], right[k] = f, cuts[f, b], node(), node()
            go_left = binned[rows, f] <= b
            mid = (vl + vr) / 2
            lows, highs = (low, low), (high, high)
            if SIGNS[f] < 0:
                lows, highs = (mid, low), (high, mid)
            elif SIGNS[f] > 0:
                lows, highs = (low, mid), (mid, high)
            open_.append((left[k], rows[go_left], lows[0], highs[0], depth + 1))
            open_.append((right[k], rows[~go_left], lows[1], highs[1], depth + 1))
    return Forest(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right),
                  np.array(value), bias)


def trained(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Forest:
    marked = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
              .agg(F.min("quality").cast("int").alias("quality")))
    here = marked.join(docs.select("doc_id").where("doc_id is not null"), "doc_id", "left_semi")
    chosen = bounded_sample(here, "doc_id", most)  # at most SAMPLE ids

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"),
             pa.array([statistics(t)[1] for t in texts(batch)], pa.list_(pa.float64()))], names=["doc_id", "y", "x"])
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = sorted(mapped(picked, run, "doc_id long, y int, x array<double>").collect(), key=lambda r: r.doc_id)
    return fit(np.array([r.x for r in found]).reshape(len(found), len(SIGNS)), np.array([r.y for r in found], dtype=float))


def judged(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and score of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [statistics(t) for t in texts(batch)]
        counts = np.array([b for b, _ in found], dtype=np.int64)
        score = forest.score(np.array([x for _, x in found]))
        failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > 50 * counts[:, 0])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(counts[:, i]) for i in range(5)), pa.array(failed),
             pa.array(~failed & (score >= KEEP_AT)), pa.array(score)],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"])
    return mapped(docs.select("doc_id", "text"), run,
                  "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "base_failed boolean, kept boolean, score double")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, trained(docs, table(spark, sf_dir, "labels")))
