"""Ranked lexical search with documents grouped by the terms they match.

Terms are the maximal runs of letters, digits and characters beyond ASCII, A-Z
lower-cased. With N documents that hold a term, L terms in all of them, n in
one and df documents that hold a term, a term weighs
w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's length gives
m = 25 + (75 * n * N) div L, and a term that occurs tf times has the impact
(1000000000 * tf) div (1000 * tf + 8 * m). A document's score for an item sums
w * impact over the item's terms, repeats included.

Search. The postings of a block of documents, by term, set the term's bit in a
bitmap of each document: its mask of the item's terms. Documents of equal mask
make a group, and a mask's maximum score sums, over its bits, the weight times
the largest impact that the term has in the block. Distinct masks are evaluated
by descending maximum score; the search of the block has safely finished when
the next maximum is below the k-th best score found so far, in this block or an
earlier one of the task. Equal scores go to the smaller id, so a maximum that
equals the k-th best is evaluated still.

Distribution. Items are the stated set of queries and are read in blocks of
bounded size, whose terms are the vocabulary sent to the tasks. One pass reads
the texts and writes each document's length and postings of these terms; df is
counted from them, combined before the shuffle. A second pass searches; a task
returns at most k documents an item, and a ranking for each item merges these.

Defined cases: null texts have no terms; an item without terms, or none that
occurs, gives no rows; each benchmark row is an item of its own, also where ids
repeat or are null; each document row is a document of its own; a null doc_id
follows all others of the same score; empty tables give no rows.
"""

from __future__ import annotations

import math
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import staged, table, texts
from aerolith.llm.decontam import words_of
from aerolith.session import scratch_path

TOP = 10
#: text of the items searched for in one pass
BLOCK_BYTES = 2 << 20
#: documents grouped by mask together
DOCS = 8192
#: documents scored before the next look at the stopping rule, at least
STEP = 16
LAST = np.iinfo(np.int64).max


def item_blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """(item_id, its terms with repeats) of the items with terms, by bounded size of text."""
    held, size = [], 0
    for r in items.select("item_id", "text").toLocalIterator():
        words = Counter(words_of((r.text or "").encode()))
        if words:
            held.append((r.item_id, words))
            size += len(r.text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n, terms, tfs of the documents with a term; ``vocabulary``: a broadcast list of terms."""
    def run(batches):
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            n, terms, tfs, there = [], [], [], []
            for i, text in enumerate(texts(batch)):
                words = words_of(text)
                if words:
                    found = [(number[t], k) for t, k in Counter(words).items() if t in number]
                    there.append(i)
                    n.append(len(words))
                    terms.append([t for t, _ in found])
                    tfs.append([k for _, k in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(there, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if 75 * int(n.max(initial=0)) * n_docs < LAST:
        return 25 + 75 * n * n_docs // n_terms
    return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)


class Block:
    """The postings of some documents, by term and document, with their impacts."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_vocabulary: int):
        self.ids = ids
        self.key = term.astype(np.int64) * len(ids) + doc
        order = np.argsort(self.key)
        self.key, self.doc, tf = self.key[order], doc[order], tf[order].astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc])
        self.first = np.searchsorted(self.key, np.arange(n_vocabulary + 1) * len(ids))

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """Per document the bitmap of the given terms, 64 in a number."""
        out = np.zeros((-(-len(terms) // 64), len(self.ids)), np.uint64)
        for bit, t in enumerate(terms):
            out[bit >> 6, self.doc[self.first[t]: self.first[t + 1]]] |= np.uint64(1 << (bit & 63))
        return out

    def largest(self, terms: np.ndarray) -> np.ndarray:
        """Per term its largest impact."""
        return np.array([self.impact[self.first[t]: self.first[t + 1]].max(initial=0) for t in terms], np.int64)

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        wanted = terms[:, None].astype(np.int64) * len(self.ids) + docs
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return (weights[:, None] * np.where(self.key[at] == wanted, self.impact[at], 0)).sum(0)


def groups(masks: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct masks (in columns) that are not empty, and the documents of each."""
    there = np.flatnonzero(masks.any(0))
    masks = masks[:, there]
    order = np.lexsort(masks)
    masks = masks[:, order]
    new = np.flatnonzero((masks[:, 1:] != masks[:, :-1]).any(0)) + 1 if len(order) else np.zeros(0, np.int64)
    starts = np.concatenate([np.zeros(min(len(order), 1), np.int64), new])
    return masks[:, starts], np.split(there[order], new) if len(order) else []


class Ranking:
    """The best documents of one item, through any number of blocks."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, top: int):
        self.terms, self.weights, self.top = terms, weights, top
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.scored = 0

    def search(self, block: Block) -> None:
        if not len(self.terms):
            return
        masks, members = groups(block.masks(self.terms))
        bit = np.arange(len(self.terms))
        held = (masks[bit >> 6].T >> (bit & 63).astype(np.uint64)) & np.uint64(1)
        most = held.astype(np.int64) @ (self.weights * block.largest(self.terms))
        order = np.argsort(-most, kind="stable")
        now, size = [], 0
        for g in order:
            if len(self.score) == self.top and most[g] < self.score[-1]:
                break  # neither this mask nor any later one can reach the k-th best
            now.append(members[g])
            size += len(members[g])
            if size >= STEP:
                self._score(block, np.concatenate(now))
                now, size = [], 0
        if now:
            self._score(block, np.concatenate(now))

    def _score(self, block: Block, docs: np.ndarray) -> None:
        self.scored += len(docs)
        score = block.scores(docs, self.terms, self.weights)
        good = score > 0
        score, ids = np.concatenate([self.score, score[good]]), np.concatenate([self.ids, block.ids[docs[good]]])
        first = np.lexsort((ids, -score))[: self.top]
        self.score, self.ids = score[first], ids[first]


def _searched(found: DataFrame, items, top: int, n_docs: int, n_terms: int, n_vocabulary: int, block_docs: int) -> DataFrame:
    def run(batches):
        ranks = [Ranking(t, w, top) for t, w in items.value]
        for batch in batches:
            for at in range(0, batch.num_rows, block_docs):
                part = batch.slice(at, block_docs)
                sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
                block = Block(part.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False),
                              length_norm(part.column("n").to_numpy(), n_docs, n_terms),
                              np.repeat(np.arange(len(sizes)), sizes), part.column("terms").flatten().to_numpy(),
                              part.column("tfs").flatten().to_numpy(), n_vocabulary)
                if len(block.key):
                    for r in ranks:
                        r.search(block)
        for i, r in enumerate(ranks):
            if len(r.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r.score), i, np.int32)), pa.array(r.ids, mask=r.ids == LAST),
                                                  pa.array(r.score)], names=["item", "doc_id", "score"])
    return found.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, block_docs: int = DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents."""
    spark = docs.sparkSession
    path = os.path.join(scratch_path(spark, "llm"), uuid.uuid4().hex)
    schema = "block int, item int, item_id long, doc_id long, score long"
    n_blocks = 0
    for number, block in enumerate(item_blocks(items, block_bytes)):
        vocabulary = sorted({t for _, words in block for t in words})
        told = spark.sparkContext.broadcast(vocabulary)
        found = staged(postings(docs, told))
        told.destroy()
        n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        w = np.zeros(len(vocabulary), np.int64)
        for t, df in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
            w[t] = weight(n_docs, df)
        at = {t: i for i, t in enumerate(vocabulary)}
        queries = []
        for _, words in block:
            terms = np.array([at[t] for t in words], np.int64)
            counts = np.array(list(words.values()), np.int64)
            used = w[terms] > 0
            queries.append((terms[used], (w[terms] * counts)[used]))
        sent = spark.sparkContext.broadcast(queries)
        ids = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], "item int, item_id long")
        (_searched(found, sent, top, n_docs, n_terms, len(vocabulary), block_docs).join(F.broadcast(ids), "item")
         .select(F.lit(number).alias("block"), "item", "item_id", "doc_id", "score").write.mode("append").parquet(path))
        sent.destroy()
        n_blocks += 1
    if not n_blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = W.partitionBy("block", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score"))


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH i AS (SELECT row_number() OVER () AS k, item_id, {TERMS} AS t FROM benchmark),
q AS (SELECT k, item_id, t, count(*) AS c FROM (SELECT k, item_id, unnest(t) AS t FROM i) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM p, s GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 25 + (75 * CAST(len(t) AS BIGINT) * n_docs) // l AS m FROM d, s WHERE len(t) > 0),
e AS (SELECT k, item_id, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN p USING (t) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM e WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""
