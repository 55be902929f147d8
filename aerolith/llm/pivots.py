"""Exact top-k search by inner product with a table of distances to pivots.

Components x become floor(256 * x); the score of two vectors is their integer
inner product. Queries are the rows whose vec_id is divisible by ``EVERY``,
candidates all rows but the query's own.

Elimination. Twice the inner product is |q|^2 + |x|^2 - d(q, x)^2, and for any
pivot p d(q, x) is at least |d(q, p) - d(x, p)|. The distances of every row to
``PIVOTS`` pivots (the origin, then rows of a sample taken farthest first) are
computed once; the largest of the pivots' lower bounds gives each pair an upper
bound of its score. A query looks at the candidates in the order of bound and
id, computes their scores, and stops at the first that cannot precede the k-th
best found: the result is exact. Whole runs of candidates go by the least and
largest distance to each pivot; candidates are therefore ordered by their
nearest pivot and the distance to it. The k-th best score within the sample
starts every query off.

Distribution. Queries are read in blocks of bounded size. Each block is sent to
all tasks, which carry its best candidates through their rows and return at
most k for each query; a ranking for each query merges these. No pair is a row
of a table. The sample bounds nothing but speed: every row is a candidate.

Defined cases: vectors that are null or hold a null or non-finite component
take no part; a shorter vector counts as if filled up with zeros; components
and scores beyond 64 bits count as the nearest 64-bit number; a null vec_id is
no query, and as a candidate it follows all other ids of the same score;
repeated rows are queries and candidates of their own; an empty table gives no
rows.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import bounded_sample, staged, table
from aerolith.session import scratch_path

TOP, EVERY, SCALE = 5, 50, 256
PIVOTS, SAMPLE = 32, 2048
#: bytes of the queries sent to all tasks at a time
QUERY_BYTES = 32 << 20
#: candidates that are eliminated together, and queries compared with them at a time
RUN, GROUP = 1024, 1024
#: scores computed before the first look at the stopping rule
FIRST = 16
#: error of a stored distance for each unit of length of its vectors (stored with 24 bits)
ERROR = 4e-7
LAST = np.iinfo(np.int64).max


def vectors(embeddings: DataFrame) -> DataFrame:
    """row (a number), vec_id, vec (whole numbers as doubles) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vec = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return (embeddings.where(F.col("embedding").isNotNull() & ~bad)
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")))


def matrix(column) -> np.ndarray:
    """A list column as rows of equal length, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, exact, within 64 bits."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, -LAST - 1, LAST).astype(np.int64)


def lengths(a: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", a, a))


def distances(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = min(a.shape[1], pivots.shape[1])
    square = np.square(lengths(a))[:, None] + np.square(lengths(pivots)) - 2 * (a[:, :width] @ pivots[:, :width].T)
    return np.sqrt(np.maximum(square, 0))


def chosen(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """The origin, then the sample's rows that are farthest from those chosen before."""
    pivots = [np.zeros(sample.shape[1])]
    near = lengths(sample)
    while len(pivots) < most and near.max(initial=0) > 0:
        pivots.append(sample[near.argmax()])
        near = np.minimum(near, distances(sample, pivots[-1][None])[:, 0])
    return np.array(pivots)


class Side:
    """Vectors with their squared lengths and the range of each distance to a pivot."""

    def __init__(self, vec: np.ndarray, dist: np.ndarray, pivot_lengths: np.ndarray):
        self.vec, self.square = vec, np.square(lengths(vec))
        slack = ERROR * (np.sqrt(self.square)[:, None] + pivot_lengths)
        self.low, self.high = dist - slack, dist + slack


def upper(q_square, c_square, apart) -> np.ndarray:
    """The most that the score of vectors at least ``apart`` from each other can be."""
    both = q_square + c_square
    return np.floor((both - np.square(apart)) / 2 + 1e-9 * both)


def apart(q: Side, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For the queries ``which`` and each row of ``low`` and ``high`` (ranges of the
    distances to the pivots) the largest lower bound of their distance."""
    out = np.zeros((len(which), len(low)))
    for p in range(low.shape[1]):
        np.maximum(out, q.low[which, p, None] - high[:, p], out=out)
        np.maximum(out, low[:, p] - q.high[which, p, None], out=out)
    return out


class Search:
    """The best candidates of a block's queries, through any number of runs of candidates."""

    def __init__(self, queries: Side, rows: np.ndarray, start: np.ndarray, top: int):
        self.q, self.rows, self.top = queries, rows, top
        #: what a score must reach to count
        self.least = start.astype(float)
        # best first: score, id, row
        self.best = [(np.zeros(0, np.int64),) * 3 for _ in rows]
        self.scored = 0

    def run(self, c: Side, ids: np.ndarray, rows: np.ndarray) -> None:
        low, high, square = c.low.min(0)[None], c.high.max(0)[None], c.square.max()
        every = np.arange(len(self.rows))
        for at in range(0, len(every), GROUP):
            group = every[at: at + GROUP]
            reach = upper(self.q.square[group], square, apart(self.q, group, low, high)[:, 0])
            group = group[reach >= self.least[group]]
            if len(group):
                bounds = upper(self.q.square[group, None], c.square, apart(self.q, group, c.low, c.high))
                for i, bound in zip(group, bounds):
                    self._evaluate(i, bound, c.vec, ids, rows)

    def _evaluate(self, i: int, bound: np.ndarray, vec: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        there = np.flatnonzero((bound >= self.least[i]) & (rows != self.rows[i]))
        order = there[np.lexsort((ids[there], -bound[there]))]
        at, step = 0, FIRST
        while at < len(order):
            score, held, _ = self.best[i]
            if len(score) == self.top:
                b = bound[order[at]]
                if b < score[-1] or (b == score[-1] and ids[order[at]] > held[-1]):
                    return  # neither this candidate nor any later one can precede the k-th best
            now = order[at: at + step]
            self._keep(i, products(vec[now], self.q.vec[i: i + 1])[:, 0], ids[now], rows[now])
            at, step = at + step, 2 * step

    def _keep(self, i: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.scored += len(score)
        new = score >= self.least[i]
        score, ids, rows = (np.concatenate([a, b[new]]) for a, b in zip(self.best[i], (score, ids, rows)))
        first = np.lexsort((rows, ids, -score))[: self.top]
        self.best[i] = score[first], ids[first], rows[first]
        if len(first) == self.top:
            self.least[i] = max(self.least[i], float(score[first[-1]]))


def _with_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``dist``, the distances to the pivots, ordered by the nearest one."""
    def run(batches):
        for batch in batches:
            dist = distances(matrix(batch.column("vec")), pivots).astype(np.float32)
            near = dist.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(dist), pa.list_(pa.float32())), pa.array(near.astype(np.int32)),
                 pa.array(dist[np.arange(len(near)), near])], names=[*batch.schema.names, "dist", "near", "away"])
    out = rows.mapInArrow(run, "row long, vec_id long, vec array<double>, dist array<float>, near int, away float")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["near", "away", "row"]
    return out.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _starts(vec: np.ndarray, rows: np.ndarray, sample: np.ndarray, sample_rows: np.ndarray, top: int) -> np.ndarray:
    """For each query the k-th best score within the sample, which the result reaches too."""
    out = np.full(len(rows), float(-LAST))
    for at in range(0, len(rows), GROUP):
        part = slice(at, at + GROUP)
        score = products(vec[part], sample).astype(float)
        score[rows[part, None] == sample_rows] = -np.inf
        if score.shape[1] > top:
            kth = -np.partition(-score, top - 1, axis=1)[:, top - 1]
            out[part] = np.maximum(np.nextafter(kth, -np.inf), float(-LAST))
    return out


def nearest(embeddings: DataFrame, top: int = TOP, every: int = EVERY, query_bytes: int = QUERY_BYTES,
            most_pivots: int = PIVOTS, sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``top`` best other rows."""
    spark = embeddings.sparkSession
    rows = staged(vectors(embeddings))
    width, n_queries = rows.agg(F.coalesce(F.max(F.size("vec")), F.lit(0)),
                                F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    told = bounded_sample(rows, "row", sample_rows).toArrow()
    sample, numbers = matrix(told.column("vec")), told.column("row").to_numpy()
    pivots = chosen(sample, most_pivots)
    pivot_lengths = lengths(pivots)
    placed = staged(_with_distances(rows, pivots))
    n_blocks = -(-n_queries // max(1, query_bytes // (8 * (width + 3 * len(pivots)) + 64)))
    path = os.path.join(scratch_path(spark, "llm"), uuid.uuid4().hex)
    block = F.pmod(F.xxhash64("row"), F.lit(max(1, n_blocks))).cast("int")
    (placed.where(F.col("vec_id") % every == 0).withColumn("block", block).write.partitionBy("block").parquet(f"{path}/queries"))
    queries = spark.read.schema("row long, vec_id long, vec array<double>, dist array<float>, block int").parquet(f"{path}/queries")
    schema = "query_row long, query_id long, vec_id long, row long, score long"

    def search(part):
        def run(batches):
            q = part.value
            search = Search(Side(q["vec"], q["dist"], pivot_lengths), q["row"], q["start"], top)
            for batch in batches:
                ids = batch.column("vec_id").fill_null(LAST).to_numpy(zero_copy_only=False)
                side = matrix(batch.column("vec")), matrix(batch.column("dist")), batch.column("row").to_numpy()
                for at in range(0, len(ids), RUN):
                    vec, dist, row = (x[at: at + RUN] for x in side)
                    search.run(Side(vec, dist, pivot_lengths), ids[at: at + RUN], row)
            for i, (score, ids, row) in enumerate(search.best):
                if len(score):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(score), q["row"][i])), pa.array(np.full(len(score), q["id"][i])),
                         pa.array(ids, mask=ids == LAST), pa.array(row), pa.array(score)],
                        names=["query_row", "query_id", "vec_id", "row", "score"])
        return run
    for number in range(n_blocks):
        told = queries.where(F.col("block") == number).toArrow()
        if not told.num_rows:
            continue
        vec, row = matrix(told.column("vec")), told.column("row").to_numpy()
        part = spark.sparkContext.broadcast({
            "vec": vec, "dist": matrix(told.column("dist")), "row": row, "id": told.column("vec_id").to_numpy(),
            "start": _starts(vec, row, sample, numbers, top)})
        placed.select("row", "vec_id", "vec", "dist").mapInArrow(search(part), schema).write.mode("append").parquet(f"{path}/best")
        part.destroy()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return (spark.read.schema(schema).parquet(f"{path}/best").withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score"))


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.r AS cr, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, cr) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""
