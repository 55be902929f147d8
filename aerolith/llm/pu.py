"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents all of whose labels say quality 1; the
unlabelled set is web text without a label. The share of positives among the
unlabelled (class prior) is estimated as the smallest ratio, over score
thresholds, of the unlabelled to the positive share above the threshold, with
scores of a plain positive-against-unlabelled classifier on rows it did not
learn from. A generalised
additive logistic model over document statistics then minimises the
non-negative unbiased risk

    prior * R_pos(+1) + max(0, R_unl(-1) - prior * R_pos(-1))

with the logistic loss, so its output estimates P(quality = 1 | text). Where
the bracket is negative, the step goes against it, as in the published method.

Both samples are bounded by ``SAMPLE`` documents each, chosen by a hash of the
id, from rows whose crc32(doc_id as text) mod 5 is not 0. Scoring reads every
whole text once, without a shuffle.

Defined cases: null text is empty and gets the score of the statistics of an
empty text; a null doc_id has an empty id text (held out, crc32 0 mod 5 = 0);
without positives or without unlabelled rows the score is the constant 0.5;
repeated label rows of one document count as one (positive if all say 1); an
id on several texts is learned from with the first of them in order;
rows with null quality are no labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import bounded_sample, flagged, fold, mapped, table, texts
from aerolith.llm.docstats import features

SAMPLE = 20_000
BINS = 12
FOLDS = 5
ACCEPT = 0.3
EPOCHS = 400


@dataclass
class Model:
    cuts: np.ndarray | None  # (features, BINS - 1) quantiles; None: no training rows
    weights: np.ndarray | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(design(x, self.cuts) @ self.weights, -30, 30)))


def design(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One column for each feature and quantile that is passed, and a constant."""
    return np.hstack([(x[:, :, None] > cuts[None]).reshape(len(x), -1), np.ones((len(x), 1))]).astype(np.float64)


def _descend(gradient, width: int, epochs: int = EPOCHS, rate: float = 0.05) -> np.ndarray:
    """Adam from zero weights, the same at every run."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, epochs + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_prior(pos: np.ndarray, unl: np.ndarray, l2: float = 1e-2) -> float:
    """Estimated share of positives among the unlabelled: one half of the rows
    trains the plain classifier, the other gives the ratios, and vice versa."""
    found = []
    for k in (0, 1):
        p, u = pos[k::2], unl[k::2]
        sp, su = pos[1 - k::2], unl[1 - k::2]
        if not min(len(p), len(u), len(sp), len(su)):
            return 0.5
        x = np.vstack([p, u])
        y = np.r_[np.ones(len(p)), np.zeros(len(u))]
        weight = np.r_[np.full(len(p), 0.5 / len(p)), np.full(len(u), 0.5 / len(u))]
        w = _descend(lambda w: x.T @ (weight * (_sigmoid(x @ w) - y)) + l2 * w, x.shape[1])
        sp, su = sp @ w, su @ w
        found.append(min((su >= t).mean() / (sp >= t).mean() for t in np.quantile(sp, np.linspace(0, 0.5, 26))))
    return float(np.clip(np.mean(found), 0.05, 0.99))


def fit(pos: np.ndarray, unl: np.ndarray, l2: float = 2e-4) -> Model:
    """pos, unl: rows of document statistics."""
    if not len(pos) or not len(unl):
        return Model(None, None)
    cuts = np.quantile(np.vstack([pos, unl]), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    p, u = design(pos, cuts), design(unl, cuts)
    prior = class_prior(p, u)

    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        as_pos = p.T @ (sp - 1) / len(p)   # of the positives' loss as positives
        as_neg = p.T @ sp / len(p)         # of the positives' loss as negatives
        unl_neg = u.T @ su / len(u)
        negative_risk = -np.log(np.clip(1 - su, 1e-12, 1)).mean() + prior * np.log(np.clip(1 - sp, 1e-12, 1)).mean()
        rest = unl_neg - prior * as_neg
        return (prior * as_pos + rest if negative_risk >= 0 else -rest) + l2 * w
    return Model(cuts, _descend(gradient, p.shape[1]))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics of the sampled positives and of the sampled unlabelled documents."""
    marked = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
              .agg(F.min("quality").alias("quality")))
    ids = (docs.select("doc_id").where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
           .distinct().join(marked, "doc_id", "left"))
    chosen = [bounded_sample(ids.where(where).select("doc_id"), "doc_id", most).withColumn("part", F.lit(part))
              for part, where in enumerate(("quality = 1", "quality is null"))]
    both = chosen[0].unionAll(chosen[1])  # at most twice SAMPLE ids

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(t) for t in texts(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))],
            names=["part", "doc_id", "x"])
    picked = docs.select("doc_id", "text").join(F.broadcast(both), "doc_id").groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    found = mapped(picked, run, "part int, doc_id long, x array<double>").collect()
    found.sort(key=lambda r: (r.part, r.doc_id))
    part = [np.array([r.x for r in found if r.part == k]) for k in (0, 1)]
    return part[0], part[1]


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(*training_rows(docs, labels))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = model.score(np.array([features(t) for t in texts(batch)]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s),
                                           pa.array((s >= ACCEPT).astype(np.int32))],
                                          names=["doc_id", "held_out", "score", "predicted"])
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    return mapped(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject."""
    return flagged(docs, lambda batch: (model.score(np.array([features(t) for t in texts(batch)])) >= ACCEPT).tolist())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, trained(docs, table(spark, sf_dir, "labels")))
