"""SimHash near-dedup by Golay-code fuzzy hashing.

A text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and
4-word shingles (repeats included, joined by one space; fewer words: the
whole sequence). A fingerprint bit is 1 if it is set in over half of the
shingles' XXH64 values (seed 42). Texts without words have fingerprint zero
and are linked like any other.

Fingerprints at ``MAX_BITS`` = 4 or fewer differing bits are linked.

Search. The 64 bits are three segments of 23, 23 and 18 bits. Of four errors
over three segments at least two segments hold two or fewer each. In a
segment of 23 bits (18 are filled up with zeros) the perfect (23, 12) Golay
code has a word within distance 3 of every vector. Let u and v differ in two
bits or fewer and x lie half way: the word nearest to x is within 4 of both.
So the indices of all words within 4 of a segment (one, or six where the
nearest is at distance 3) are keys of which u and v share at least one. Every
pair of segments is a table, keyed by the pairs of indices; each link of four
bits or fewer meets in at least one bucket, where it is verified. Only
distinct fingerprints take part, so copies cost nothing; within a bucket a
member that was reached is not compared again, so a large group of close
fingerprints gives links to one centre instead of all pairs.

Defined cases: null text is empty; a null doc_id keeps its row and is not
considered when a component is named (null if there is none else); repeated
rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import components
from aerolith.llm.common import fresh, mapped, spread_join, staged, table, texts

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GENERATOR = 0b110001110101  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((41, 23), (18, 23), (0, 18))  # (shift, bits)
SMALL_GROUP = 8
EMIT = 2_000


def fingerprint(text: bytes) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i: i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_cols: list[str], text: str = "text", name: str = "fp") -> DataFrame:
    """``id_cols`` and the fingerprint of every row."""
    from pyspark.sql.types import LongType, StructField, StructType
    schema = StructType([docs.schema[c] for c in id_cols] + [StructField(name, LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = pa.array([fingerprint(t) for t in texts(batch, text)], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(c) for c in id_cols] + [fp], names=[*id_cols, name])
    return mapped(docs.select(*id_cols, text), run, schema)


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, all columns as they are, and the fingerprint of every row."""
    from pyspark.sql.types import LongType, StructField, StructType

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = pa.array([fingerprint(t) for t in texts(batch)], pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns, fp], names=[*batch.schema.names, name])
    return mapped(docs, run, StructType([*docs.schema, StructField(name, LongType())]))


class Golay:
    """Tables of the (23, 12) code, made from the generator polynomial."""

    def __init__(self):
        self.remainder = np.zeros((3, 256), dtype=np.int64)  # of each byte of a vector
        for place in range(3):
            for v in range(256):
                self.remainder[place, v] = self._mod(v << 8 * place)
        patterns = {d: [sum(1 << b for b in bits) for bits in combinations(range(23), d)] for d in range(5)}
        # per syndrome the error patterns of weight 4 or less: one, or one of weight 3 and five of weight 4
        self.errors = np.full((1 << 11, 6), -1, dtype=np.int64)
        filled = np.zeros(1 << 11, dtype=np.int64)
        for d in range(5):
            for e in patterns[d]:
                s = self.syndrome(np.array([e]))[0]
                self.errors[s, filled[s]] = e
                filled[s] += 1

    @staticmethod
    def _mod(v: int) -> int:
        for bit in range(23, 10, -1):
            if v >> bit & 1:
                v ^= GENERATOR << (bit - 11)
        return v

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        r = self.remainder
        return r[0, v & 255] ^ r[1, v >> 8 & 255] ^ r[2, v >> 16]

    def keys(self, v: np.ndarray) -> np.ndarray:
        """(n, 6) indices of the code words within 4 of each vector, -1 where there are fewer."""
        e = self.errors[self.syndrome(v)]
        return np.where(e < 0, -1, (v[:, None] ^ e) >> 11)


def bucket_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every bucket that each fingerprint goes to."""
    u = fps.view(np.uint64)
    index = [golay.keys(((u >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64))
             for shift, bits in SEGMENTS]
    rows, keys = [], []
    for t, (x, y) in enumerate(combinations(range(3), 2)):
        key = (t << 24) | (index[x][:, :, None] << 12) | index[y][:, None, :]
        there = (index[x][:, :, None] >= 0) & (index[y][:, None, :] >= 0)
        rows.append(np.nonzero(there)[0])
        keys.append(key[there])
    return np.concatenate(rows), np.concatenate(keys)


def near(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect exactly the fingerprints of one bucket that a chain of
    verified links connects: those reached leave the set still to compare."""
    links, rest = [], fps
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            hit = np.bitwise_count((rest ^ at).view(np.uint64)) <= MAX_BITS
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                links += [(at, f) for f in found]
                frontier += list(found)
    return links


def _bucket_links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among rows that are sorted by key, whole buckets."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    k, f = key[small], fp[small]
    a, b = [], []
    for lag in range(1, SMALL_GROUP):
        if len(k) <= lag:
            break
        hit = (k[lag:] == k[:-lag]) & (np.bitwise_count((f[lag:] ^ f[:-lag]).view(np.uint64)) <= MAX_BITS)
        a.append(f[:-lag][hit])
        b.append(f[lag:][hit])
    for i in np.flatnonzero(sizes > SMALL_GROUP):
        if links := near(fp[starts[i]: starts[i] + sizes[i]]):
            a.append(np.array([x for x, _ in links], dtype=np.int64))
            b.append(np.array([y for _, y in links], dtype=np.int64))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``fp`` that connect exactly
    those within ``MAX_BITS`` of each other, directly or through others."""
    def spread(batches):
        golay = Golay()
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(every), EMIT):
                fps = every[i: i + EMIT]
                row, key = bucket_keys(fps, golay)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(fps[row])],
                                                 names=["key", "fp"])

    def meet(batches):
        keys, fps = [], []
        for batch in batches:
            keys.append(batch.column(0).to_numpy(zero_copy_only=False))
            fps.append(batch.column(1).to_numpy(zero_copy_only=False))
            if keys[-1][-1] == keys[0][0]:
                continue  # one bucket so far
            key, fp = np.concatenate(keys), np.concatenate(fps)
            whole = int(np.searchsorted(key, key[-1]))
            a, b = _bucket_links(key[:whole], fp[:whole])
            keys, fps = [key[whole:]], [fp[whole:]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if keys:
            a, b = _bucket_links(np.concatenate(keys), np.concatenate(fps))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    # dealt out evenly first: each row becomes about 80
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (distinct.select("fp").repartition(parts).mapInArrow(spread, "key int, fp long")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(meet, "a long, b long"))


def labels(fps: DataFrame, *found) -> DataFrame:
    """Per distinct fingerprint of ``fps`` its number of rows, the aggregates
    ``found`` over them, and the ``label`` of its component: the smallest
    fingerprint linked."""
    each = staged(fps.groupBy("fp").agg(F.count("*").alias("n"), *found))
    named = components.labels(links(each.select("fp"))).withColumnRenamed("node", "fp")
    return staged(each.join(named, "fp", "left").withColumn("label", F.coalesce("label", "fp")))


def labelled(fps: DataFrame) -> DataFrame:
    """``fps`` (staged, with column ``fp``) and the ``label`` of each row's component."""
    return spread_join(fps, labels(fps), "fp", "n")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``."""
    rows = staged(fingerprints(docs, ["doc_id"]))
    each = labels(rows, F.min("doc_id").alias("least"))  # components are named from the distinct fingerprints
    named = staged(each.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("k")))
    each = staged(spread_join(each.select("fp", "label", "n"), named, "label", "k").drop("label"))
    return (spread_join(rows, each, "fp", "n")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.
    Rows without an id are named by a hash of their text and kept only where
    the component has no row with an id; of rows of the component that agree in
    the id, the first in the order of their text, lang, source and n_chars stays.
    An id on texts of several components can stay once in each."""
    names = [fresh(docs.columns, n) for n in ("__none", "__id")]
    none, key = names
    fp, label, whole = (fresh(docs.columns, n) for n in ("__fp", "__label", "__row"))
    keyed = docs.withColumn(none, F.col("doc_id").isNull()) \
        .withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")))
    rows = staged(labelled(staged(fingerprints(keyed, names))))
    best = rows.groupBy("label").agg(F.min(F.struct(*names)).alias("best")).select("label", "best.*")
    several = rows.groupBy(*names).agg((F.min("fp") != F.max("fp")).alias("several"))
    best = staged(best.join(several, names))
    order = F.struct(*[c for c in ("text", "lang", "source", "n_chars") if c in docs.columns])
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias(whole)
    one = best.where("not several").select(*names)  # the id tells the component
    kept = keyed.join(one, names, "left_semi").groupBy(*names).agg(first).select(f"{whole}.*")
    more = best.where("several").select("label", *names)
    if more.isEmpty():
        return kept
    of = rows.join(more, ["label", *names]).distinct().withColumnsRenamed({"fp": fp, "label": label})
    found = with_fingerprint(keyed.join(more.select(*names).distinct(), names, "left_semi"), fp)
    return kept.unionAll(found.join(of, [*names, fp]).groupBy(*names, label).agg(first).select(f"{whole}.*"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
