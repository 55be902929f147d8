"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into sequences of ``STEPS`` (the last one
shorter). One network reads each from the left, one from the right, both from
``WARM`` bytes further out, so that no position near a cut is without context;
at every position both states give log-odds of the languages, and a softmax
labels the position. A document's probabilities are the mean over all its positions: the
whole text counts, no prefix. Sequences of many documents run side by side as
one numpy batch.

Training is backpropagation through time in numpy on the driver, with Adam,
on ``PIECES`` sequences of each of at most ``SAMPLE`` documents a language
(chosen by a hash of the id) that have text and language and whose
crc32(doc_id as text) mod 5 is not 0. All language names of such documents are
learned, however rare, up to the ``LANGS`` most frequent ones; an id with
several counts for the first of them.

Defined cases: a text that is null or without letters is ``und`` with score
0; a null doc_id has an empty id text (held out, crc32 0 mod 5 = 0); without
training documents every text is ``und``; repeated rows repeat; an empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import bounded_sample, fold, mapped, table

FOLDS = 5
SAMPLE, PIECES, TRAIN_STEPS, TRAIN_BATCH, UPDATES = 625, 4, 64, 512, 90
STEPS, WARM, WIDE = 128, 16, 4_096
#: languages learned: the most frequent ones, ties by name
LANGS = 1_000
HIDDEN = 8
LETTER = regex.compile(r"\p{L}")
UND = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Cell:
    """A gated recurrent cell; rows of the weights: update, reset, candidate."""
    byte: np.ndarray   # (3 * HIDDEN, 256) input weights of each byte, biases included
    state: np.ndarray  # (3 * HIDDEN, HIDDEN)

    def run(self, x: np.ndarray, live: np.ndarray, order, keep: list | None = None):
        """Yields (t, state) after each position; x, live: (steps, batch)."""
        h = np.zeros((HIDDEN, x.shape[1]), dtype=np.float32)
        for t in order:
            a = np.take(self.byte, x[t], axis=1)
            u = self.state @ h
            gates = _sigmoid(a[: 2 * HIDDEN] + u[: 2 * HIDDEN])
            z, r = gates[:HIDDEN], gates[HIDDEN:]
            n = np.tanh(a[2 * HIDDEN:] + r * u[2 * HIDDEN:])
            new = n + z * (h - n)
            new *= live[t]
            if keep is not None:
                keep.append((t, h, z, r, n, u[2 * HIDDEN:]))
            h = new
            yield t, h


@dataclass
class Network:
    langs: list[str]
    cells: tuple[Cell, Cell] | None = None
    out: np.ndarray | None = None   # (languages, 2 * HIDDEN)
    bias: np.ndarray | None = None  # (languages, 1)

    def odds(self, x: np.ndarray, live: np.ndarray, keeps=(None, None), states=None) -> np.ndarray:
        """(steps, languages, batch) log-odds of every position."""
        steps = len(x)
        odds = np.empty((steps, len(self.langs), x.shape[1]), dtype=np.float32)
        for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            w = self.out[:, d * HIDDEN: (d + 1) * HIDDEN]
            for t, h in self.cells[d].run(x, live, order, keeps[d]):
                if states is not None:
                    states[d][t] = h
                if d == 0:
                    np.add(w @ h, self.bias, out=odds[t])
                else:
                    odds[t] += w @ h
        return odds

    def position_probabilities(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        p = self.odds(x, live)
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages) mean probabilities over all bytes."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        total = np.zeros((len(texts), len(self.langs)))
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        pieces = -(-sizes // STEPS)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = number * STEPS - WARM  # in the text
        span = np.arange(STEPS + 2 * WARM)[:, None]
        own = (span >= WARM) & (span < WARM + STEPS)
        for i in range(0, len(owner), WIDE):
            part = slice(i, i + WIDE)
            at, size = start[part] + span, sizes[owner[part]]
            there = (at >= 0) & (at < size)
            x = data[np.where(there, (np.cumsum(sizes) - sizes)[owner[part]] + at, 0)]
            p = self.position_probabilities(x, there.astype(np.float32))
            np.add.at(total, owner[part], np.einsum("tlb,tb->bl", p, (there & own).astype(np.float32)))
        return total / np.maximum(sizes, 1)[:, None]


def _gradient(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over positions, in the order of ``_parameters``."""
    steps, batch = x.shape
    live = np.ones(x.shape, dtype=np.float32)
    keeps: tuple[list, list] = ([], [])
    states = [np.empty((steps, HIDDEN, batch), dtype=np.float32) for _ in (0, 1)]
    p = net.odds(x, live, keeps, states)
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    p[:, y, np.arange(batch)] -= 1
    p /= steps * batch
    flat = p.transpose(1, 0, 2).reshape(len(net.langs), -1)
    grads = [np.hstack([flat @ s.transpose(1, 0, 2).reshape(HIDDEN, -1).T for s in states]), flat.sum(axis=1, keepdims=True)]
    for d in (0, 1):
        cell, w = net.cells[d], net.out[:, d * HIDDEN: (d + 1) * HIDDEN]
        byte, state = np.zeros_like(cell.byte), np.zeros_like(cell.state)
        dh = np.zeros((HIDDEN, batch), dtype=np.float32)
        for t, h, z, r, n, un in reversed(keeps[d]):
            dh = dh + w.T @ p[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            into = np.vstack([dz, dr, dn])       # gradients at the gates' sums, input side
            back = np.vstack([dz, dr, dn * r])   # and on the side of the state
            state += back @ h.T
            for k in range(3 * HIDDEN):
                byte[k] += np.bincount(x[t], into[k], 256)
            dh = dh * z + cell.state.T @ back
        grads += [byte, state]
    return grads


def _parameters(net: Network) -> list[np.ndarray]:
    return [net.out, net.bias, *(w for c in net.cells for w in (c.byte, c.state))]


def fit(rows: list[tuple[str, bytes]], updates: int = UPDATES, seed: int = 7, rate: float = 0.03) -> Network:
    """rows: (language, bytes of a sequence of ``TRAIN_STEPS``)."""
    langs = sorted({lang for lang, _ in rows})
    net = Network(langs)
    if not rows:
        return net
    rng = np.random.default_rng(seed)

    def weights(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)
    net.cells = tuple(Cell(weights(3 * HIDDEN, 256, scale=0.3), weights(3 * HIDDEN, HIDDEN, scale=0.3)) for _ in (0, 1))
    net.out, net.bias = weights(len(langs), 2 * HIDDEN, scale=0.3), np.zeros((len(langs), 1), dtype=np.float32)
    data = np.stack([np.frombuffer(s, dtype=np.uint8) for _, s in rows], axis=1)
    y = np.array([langs.index(lang) for lang, _ in rows])
    params = _parameters(net)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, updates + 1):
        pick = rng.integers(0, len(y), min(TRAIN_BATCH, len(y)))
        grads = _gradient(net, data[:, pick], y[pick])
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        lr = rate * (1 - step / (updates + 1))
        for p, g, m, v in zip(params, grads, first, second):
            g = g * min(1.0, 1.0 / max(norm, 1e-12))
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def pieces(text: bytes, n: int = PIECES) -> list[bytes]:
    """Up to ``n`` training sequences, evenly spaced over a text; a short text is repeated to fill one."""
    if not text:
        return []
    if len(text) <= TRAIN_STEPS:
        return [(text * (TRAIN_STEPS // len(text) + 1))[:TRAIN_STEPS]]
    last = len(text) - TRAIN_STEPS
    return [text[a: a + TRAIN_STEPS] for a in sorted({last * k // max(n - 1, 1) for k in range(n)})]


def trained(docs: DataFrame, most: int = SAMPLE) -> Network:
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UND)
                        & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id"), FOLDS) != 0))
    frequent = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).select("lang")
    usable = usable.join(F.broadcast(frequent), "lang")
    of_lang = usable.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    ids = bounded_sample(of_lang, "doc_id", most, by="lang").select("doc_id")  # at most SAMPLE ids a language
    rows = (usable.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("d")).select("doc_id", "d.*"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = [pieces(t.encode()) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(cut, pa.list_(pa.binary()))],
                                          names=["doc_id", "lang", "p"])
    found = sorted(mapped(rows, run, "doc_id long, lang string, p array<binary>").collect(), key=lambda r: r.doc_id)
    return fit([(r.lang, bytes(p)) for r in found for p in r.p])


def labelled(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        there = [i for i, t in enumerate(texts) if net.langs and LETTER.search(t)]
        lang, score = [UND] * len(texts), [0.0] * len(texts)
        if there:
            p = net.documents([texts[i].encode() for i in there])
            for i, k, s in zip(there, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                lang[i], score[i] = net.langs[k], min(s, 1.0)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(score)],
                                          names=["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select("doc_id", "text", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    return mapped(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return labelled(docs, trained(docs))
