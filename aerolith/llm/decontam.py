"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A-Z are lower-cased and words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A
pattern is ``WINDOW`` = 13 consecutive words of a benchmark item; an item of
fewer words, but not none, is one pattern. Document words inside an occurrence
of a pattern are hit; a document is contaminated if it has a hit and
20 * n_hit >= n_words.

Search. Patterns of one length m make a table. A block of two words at the
end of the window under test looks up its shift: how far the window can move
without passing an occurrence (m - 1 where no pattern holds the block). Where
the shift is zero, the block is some pattern's end, the patterns in that
block's bucket are the candidates, and a direct comparison of the words
confirms.

The benchmark is the stated set of queries: it is read in blocks of about
``BLOCK_BYTES`` of text, and every block is searched in all documents. One
block is searched in one pass, and no document row is shuffled. With more, each
block has a pass of its own, which adds its hits to a table; its broadcast goes
before the next block is sent, and the hits are merged by row. So neither the
driver nor a task holds more than two blocks however large the benchmark is.

Defined cases: a null text has no words; benchmark rows without an item_id
or without words are no items; rows that repeat an item_id are one item;
an empty benchmark hits nothing; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import fresh, staged, table, texts
from aerolith.session import scratch_path

WINDOW = 13
BLOCK_BYTES = 16 << 20
_WORD_BYTE = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: A-Z to a-z, bytes outside words to space
FOLD = bytes(ord(bytes([b]).lower()) if _WORD_BYTE.match(bytes([b]).lower()) else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class WuManber:
    """Tables for the patterns of some items, one set of tables per length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        owners: dict[tuple, set[str]] = defaultdict(set)
        for item, text in items:
            words = words_of(text)
            for i in range(max(len(words) - window, 0) + 1 if words else 0):
                owners[tuple(words[i: i + window])].add(item)
        self.owners = {k: tuple(v) for k, v in owners.items()}
        self.tables = {}
        for m in sorted({len(p) for p in owners}):
            shift: dict = {}
            bucket: dict = defaultdict(list)
            width = min(2, m)
            for p in owners:
                if len(p) == m:
                    for end in range(width, m + 1):
                        block = p[end - width: end]
                        shift[block] = min(shift.get(block, m), m - end)
                    bucket[p[m - width:]].append(p)
            self.tables[m] = (shift, dict(bucket), width)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges of all occurrences, and the items whose patterns occur."""
        ranges, items = [], set()
        for m, (shift, bucket, width) in self.tables.items():
            skip, end, n = m - width + 1, m, len(words)
            while end <= n:
                block = (words[end - 2], words[end - 1]) if width == 2 else (words[end - 1],)
                step = shift.get(block, skip)
                if step:
                    end += step
                    continue
                for p in bucket[block]:
                    if tuple(words[end - m: end]) == p:
                        ranges.append((end - m, end))
                        items.update(self.owners[p])
                end += 1
        return ranges, items


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in blocks of bounded size, in the order of their ids."""
    held, size = [], 0
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        held.append((str(r.item_id), r.text.encode()))
        size += len(held[-1][1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _covered(ranges: list[tuple[int, int]]) -> int:
    """Words inside any of the ranges."""
    n, done = 0, 0
    for a, b in sorted(ranges):
        n += max(b - max(a, done), 0)
        done = max(done, b)
    return n


def contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def _found(tables: WuManber, batch: pa.RecordBatch) -> list[tuple[int, list, set]]:
    """(number of words, hit ranges, items) of every row."""
    return [(len(words), *tables.search(words)) for words in map(words_of, texts(batch))]


def _hits(rows: DataFrame, name: str, items: Iterator[list[tuple[str, bytes]]]) -> DataFrame:
    """Per row with hits its number (column ``name``), hit ranges (starts and
    stops in turn) and items: a pass over the rows for each block, whose
    broadcast goes before the next is made, added to one table."""
    spark = rows.sparkSession
    path = os.path.join(scratch_path(spark, "llm"), uuid.uuid4().hex)
    schema = f"`{name}` long, ranges array<int>, items array<string>"

    def search(part):
        def run(batches):
            tables = WuManber(part.value)
            for batch in batches:
                there = [(k, r, i) for k, (_, r, i) in enumerate(_found(tables, batch)) if r]
                if there:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(name).take(pa.array([k for k, _, _ in there])),
                         pa.array([[x for ab in r for x in ab] for _, r, _ in there], pa.list_(pa.int32())),
                         pa.array([sorted(i) for _, _, i in there], pa.list_(pa.string()))],
                        names=[name, "ranges", "items"])
        return run
    for block in items:
        part = spark.sparkContext.broadcast(block)
        rows.select(name, "text").mapInArrow(search(part), schema).write.mode("append").parquet(path)
        part.destroy()
    return (spark.read.schema(schema).parquet(path).groupBy(name)
            .agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.flatten(F.collect_list("items")).alias("items")))


def _annotated(docs: DataFrame, benchmark: DataFrame, finish, schema) -> DataFrame:
    """``finish(batch, [(n_words, n_hit, items)])`` over batches of ``docs``."""
    spark, every = docs.sparkSession, blocks(benchmark)
    first = list(islice(every, 2))
    if len(first) < 2:
        part = spark.sparkContext.broadcast(first[0] if first else [])

        def run(batches):
            tables = WuManber(part.value)
            for batch in batches:
                if batch.num_rows:
                    yield finish(batch, [(n, _covered(r), i) for n, r, i in _found(tables, batch)])
        return docs.mapInArrow(run, schema)

    number, ranges, items = (fresh(docs.columns, n) for n in ("__row", "__ranges", "__items"))
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()))
    hits = _hits(rows, number, chain((first.pop(0) for _ in range(2)), every))
    columns = docs.columns

    def merged(batches):
        for batch in batches:
            if batch.num_rows:
                n = [len(words_of(t)) for t in texts(batch)]
                found = zip(n, batch.column(ranges).to_pylist(), batch.column(items).to_pylist())
                yield finish(batch.select(columns), [(w, _covered(list(zip(r[::2], r[1::2]))) if r else 0, set(i or ()))
                                                     for w, r, i in found])
    return (rows.join(hits.withColumnsRenamed({"ranges": ranges, "items": items}), number, "left").drop(number)
            .mapInArrow(merged, schema))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    def finish(batch, found):
        digest = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for _, _, i in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([w for w, _, _ in found], pa.int64()),
             pa.array([n for _, n, _ in found], pa.int64()), pa.array([len(i) for _, _, i in found], pa.int64()),
             pa.array(digest), pa.array([contaminated(n, w) for w, n, _ in found])],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return _annotated(docs.select("doc_id", "text"), benchmark, finish,
                      "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    def finish(batch, found):
        return batch.filter(pa.array([not contaminated(n, w) for w, n, _ in found], pa.bool_()))
    return _annotated(docs, benchmark, finish, docs.schema)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


W4 = "regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
     "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {W4.format(t='text')} AS w FROM benchmark
           WHERE item_id IS NOT NULL AND text IS NOT NULL),
pat AS (SELECT DISTINCT item, array_to_string(w[i : i + 12], ' ') AS p, least(len(w), 13) AS m
        FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, {W4.format(t='text')} AS w FROM documents),
len AS (SELECT DISTINCT m FROM pat),
win AS (SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS p
        FROM d, len, unnest(range(1, greatest(len(w) - m + 2, 1))) AS u(i)),
hit AS (SELECT r, win.m, i, item FROM win JOIN pat ON win.p = pat.p AND win.m = pat.m),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hit) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
      FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)
"""
