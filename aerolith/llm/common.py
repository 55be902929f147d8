"""Helpers shared by the training-data operators: reading tables, staging
intermediate tables in the shared folder, bounded samples of labelled rows."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.session import limit_batches, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    limit_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    lineage is cut, and a lost executor never makes a finished step run again."""
    spark = df.sparkSession
    path = os.path.join(scratch_path(spark, "llm"), uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """``name`` or, where a column of that name exists (case aside), a longer one."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def lowered(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes, null as empty."""
    return [t.encode() if t is not None else b"" for t in batch.column(name).to_pylist()]


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over Arrow batches, one batch in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    limit_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def flagged(docs: DataFrame, keep: Callable[[pa.RecordBatch], list], text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, for which ``keep`` says true."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch), pa.bool_()))
    limit_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def threshold(n: int, most: int) -> int:
    """The signed 64-bit number that about 1.1 * ``most`` + 100 of ``n`` hashes do
    not exceed (in whole numbers: no share is too small), all if ``n`` <= ``most``."""
    wanted = 1 << 64 if n <= most else (11 * most + 1000 << 64) // (10 * n) + 1
    return min(wanted, 1 << 64) - 1 - (1 << 63)


def bounded_sample(ids: DataFrame, id_col: str, most: int, seed: int = 17, by: str | None = None) -> DataFrame:
    """At most ``most`` rows of ``ids`` (one per id), those of the smallest hashes
    of the id: the same rows at every run, and all rows where there are no more
    than that. Only ids below a hash threshold reach the final ordering. The
    sample of a table with rows is never empty: that is an error. With ``by``
    (a column of few values) the bound holds for the rows of each value."""
    h = F.xxhash64(F.lit(seed), F.col(id_col))
    if by is not None:
        return _sample_by(ids, id_col, most, h, by)
    n = ids.count()
    sample = staged(ids.where(h <= F.lit(threshold(n, most)).cast("long"))
                    .withColumn("__h", h).orderBy("__h", id_col).limit(most).drop("__h"))
    if n and sample.isEmpty():
        raise RuntimeError(f"no row of {n} in a sample of up to {most}")
    return sample


def _sample_by(ids: DataFrame, id_col: str, most: int, h: Column, by: str) -> DataFrame:
    ids = staged(ids)
    cuts = [(r[0], threshold(r[1], most)) for r in ids.groupBy(by).count().collect()]  # a row per value
    cut = F.broadcast(ids.sparkSession.createDataFrame(cuts, f"{by} string, __cut long"))
    order = W.partitionBy(by).orderBy("__h", id_col)
    sample = staged(ids.withColumn("__h", h).join(cut, by).where("__h <= __cut")
                    .withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= most)
                    .select(*ids.columns))
    if lost := {v for v, _ in cuts} - {r[0] for r in sample.select(by).distinct().collect()}:
        raise RuntimeError(f"no rows of {sorted(lost)} in a sample of up to {most}")
    return sample


#: a key on more rows than this, and than a ten-thousandth of all, is frequent
FREQUENT = 1_000


def spread_join(rows: DataFrame, told: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` (staged) with the row of ``told`` of their ``key``, which is in
    ``told`` once; its column ``n`` is the number of rows of the key. Frequent
    keys, at most 10,000 of them, are broadcast, so no task gets all rows of one."""
    total = told.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    often = F.col(n) > max(FREQUENT, total // 10_000)
    hot, rest = F.broadcast(told.where(often).drop(n)), told.where(~often).drop(n)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key))
