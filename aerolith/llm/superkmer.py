"""Substring dedup by super-k-mer partitioning over words.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``WINDOW`` = 35
consecutive words of one document. Every word covered by a window whose word
sequence also starts anywhere else, in the same document or another, goes;
windows are judged on the input.

A window's minimiser is the smallest hash of its ``MINIMISER``-word pieces.
Consecutive windows of one document that share it form a run, which travels
as one packed string to the bucket of the minimiser, so equal windows meet and
a word is carried about three times instead of 35 times. Equal runs of one
task are packed once with a count. In a bucket the windows of the distinct
runs are sorted by a rolling hash, neighbours are compared word by word, and
windows that occur twice or more are counted exactly. The bucket returns the
128-bit hash of each run with such windows and a bit per window; documents
look their runs up and lose the words covered.

Hot minimisers (a passage that very many documents share brings many
different surroundings to one bucket) are found by counting windows per
minimiser over all documents first; a task reports those with ``REPORTED``
windows or more in one flush. The windows of a minimiser above ``HOT_WINDOWS``
are spread over as many sub-buckets as needed by the window's own hash: equal
windows still meet, and no bucket grows without bound. All others stay packed,
however large the corpus is. Runs are matched by a 128-bit hash of their words.

Defined cases: null text has no words; a null doc_id stays null; repeated rows
repeat each other's windows, so their long passages go; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import staged, table, texts

WINDOW = 35
MINIMISER = 4
BUCKET_BYTES = 2 << 20
HOT_WINDOWS = 1_000_000
REPORTED = 64
FLUSH_BYTES = 8 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed values: odd constants of a multiplicative hash
MIX = np.uint64(0xBF58476D1CE4E5B9)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base)]))[:n]


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(ODD, len(h)), dtype=np.uint64)])
    n = len(h) - width + 1
    return _mixed((sums[width:] - sums[:n]) * _powers(INVERSE, n))


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Runs:
    """The runs of a list of texts: words, and per run the first word, the
    number of windows, the document's position and the bucket."""

    def __init__(self, lists: list[list[bytes]], hot: dict[int, int] | None = None, buckets: int = 1):
        self.words = [w for words in lists for w in words]
        n = len(self.words)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        none = np.zeros(0, dtype=np.int64)
        self.start, self.windows, self.doc, self.bucket = none, none, none, none
        self.key = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        hashes = {w: xxhash.xxh64_intdigest(w) for w in set(self.words)}
        h = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, n)
        low = smallest(rolling(h, MINIMISER), WINDOW - MINIMISER + 1)
        at = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1:])
        if not len(at):
            return
        key = low[at]
        if hot is None:
            self.key = key
            return
        first = np.r_[True, (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1])]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        if hot:
            keys, parts = (np.array(x) for x in zip(*sorted(hot.items())))
            number = np.minimum(np.searchsorted(keys.astype(np.uint64), key), len(keys) - 1)
            spread = keys.astype(np.uint64)[number] == key
            if spread.any():
                own, number = rolling(h, WINDOW)[at][spread], number[spread]
                # sub-buckets have negative numbers
                bucket[spread] = -1 - (number * (1 << 40) + (own % parts[number].astype(np.uint64)).astype(np.int64))
                first |= spread | np.r_[False, spread[:-1]]
        begin = np.flatnonzero(first)
        self.start, self.windows = at[begin], np.diff(np.r_[begin, len(at)])
        self.doc, self.bucket = owner[self.start], bucket[begin]

    def strings(self) -> list[bytes]:
        stop = self.start + self.windows + (WINDOW - 1)
        return [b" ".join(self.words[a:b]) for a, b in zip(self.start.tolist(), stop.tolist())]


def _flushes(batches, columns: tuple[str, ...] = ()):
    """Word lists of some MB of text at a time, with further columns as lists."""
    lists, others, size = [], [[] for _ in columns], 0
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in columns]
        for i, text in enumerate(texts(batch)):
            lists.append(text.split())
            for held, v in zip(others, values):
                held.append(v[i])
            size += len(text)
            if size >= FLUSH_BYTES:
                yield lists, others
                lists, others, size = [], [[] for _ in columns], 0
    if lists:
        yield lists, others


def hot_minimisers(docs: DataFrame, most: int, least: int = REPORTED) -> dict[int, int]:
    """Minimisers with more than ``most`` windows, and the number of parts they
    are spread over. At most total / most of them."""
    def count(batches):
        for lists, _ in _flushes(batches):
            key, n = np.unique(Runs(lists).key, return_counts=True)
            often = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(key[often].view(np.int64)), pa.array(n[often])], names=["key", "n"])
    found = (docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") > most).collect())
    return {r.key % (1 << 64): -(-r.n // max(most // 2, 1)) for r in found}


def _packed(docs: DataFrame, hot: dict[int, int], buckets: int) -> DataFrame:
    """(bucket, runs, counts): the distinct runs of a flush per bucket, compressed."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for lists, _ in _flushes(batches):
            r = Runs(lists, hot, buckets)
            groups: dict[int, dict[bytes, int]] = defaultdict(dict)
            for bucket, s in zip(r.bucket.tolist(), r.strings()):
                group = groups[bucket]
                group[s] = group.get(s, 0) + 1
            if groups:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(groups), pa.int64()),
                     pa.array([squeeze.compress(b"\n".join(g)) for g in groups.values()], pa.binary()),
                     pa.array([squeeze.compress(np.fromiter(g.values(), np.int64, len(g)).tobytes()) for g in groups.values()],
                              pa.binary())], names=["bucket", "runs", "counts"])
    return docs.select("text").mapInArrow(run, "bucket long, runs binary, counts binary")


def repeated_windows(runs: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flag per window of the runs in turn, windows per run): whether the
    window's words occur twice or more, a run of count c counting c times."""
    ids: dict[bytes, int] = {}
    lengths, parts = [], []
    for s in runs:
        words = s.split()
        lengths.append(len(words))
        parts.append(np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int32))
    a = np.concatenate(parts)
    lengths = np.array(lengths)
    owner = np.repeat(np.arange(len(runs)), lengths)
    at = np.flatnonzero(owner[: len(a) - WINDOW + 1] == owner[WINDOW - 1:])
    h = rolling(_mixed((a.astype(np.uint64) + np.uint64(1)) * ODD), WINDOW)[at]
    weight = counts[owner[at]]
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    new = np.r_[True, sorted_h[1:] != sorted_h[:-1]]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(order)])
    total = np.add.reduceat(weight[order], begin)
    flag = np.zeros(len(at), dtype=bool)
    flag[order] = np.repeat(total > 1, size)
    # compare the words of neighbours of equal hash
    inner = np.flatnonzero(~new)
    span = np.arange(WINDOW)
    wrong: set[int] = set()
    for i in range(0, len(inner), 100_000):
        part = inner[i: i + 100_000]
        differ = (a[at[order[part]][:, None] + span] != a[at[order[part - 1]][:, None] + span]).any(axis=1)
        wrong.update(sorted_h[part[differ]].tolist())
    for value in wrong:  # different windows of one hash: count their words themselves
        members = order[sorted_h == value]
        seen: dict[bytes, int] = defaultdict(int)
        for m in members:
            seen[a[at[m]: at[m] + WINDOW].tobytes()] += int(weight[m])
        for m in members:
            flag[m] = seen[a[at[m]: at[m] + WINDOW].tobytes()] > 1
    return flag, lengths - WINDOW + 1


def _name(run: bytes) -> tuple[int, int]:
    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(run), dtype="<i8")
    return int(hi), int(lo)


def _bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """hi, lo, flags of the runs of one bucket that hold a repeated window;
    flags: a bit per window, empty if all are repeated."""
    open_ = zstandard.ZstdDecompressor()
    merged: dict[bytes, int] = defaultdict(int)
    for runs, counts in zip(rows["runs"], rows["counts"]):
        each = np.frombuffer(open_.decompress(counts), np.int64)
        for s, n in zip(open_.decompress(runs).split(b"\n"), each.tolist()):
            merged[s] += n
    flag, windows = repeated_windows(list(merged), np.fromiter(merged.values(), np.int64, len(merged)))
    ends = np.cumsum(windows)
    some = np.add.reduceat(flag, ends - windows, dtype=np.int64)
    out = []
    for s, n, k, end in zip(merged, windows.tolist(), some.tolist(), ends.tolist()):
        if k:
            out.append((*_name(s), b"" if k == n else np.packbits(flag[end - n: end]).tobytes()))
    return pd.DataFrame(out, columns=["hi", "lo", "flags"])


def _lookups(keyed: DataFrame, hot: dict[int, int], buckets: int) -> DataFrame:
    def run(batches):
        for lists, (ids, keys) in _flushes(batches, ("doc_id", "h")):
            r = Runs(lists, hot, buckets)
            first = np.cumsum([0] + [len(x) for x in lists])
            if not len(r.start):
                continue
            names = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, r.strings())), dtype="<i8").reshape(-1, 2)
            doc = r.doc.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array([ids[d] for d in doc], pa.int64()),
                 pa.array([keys[d] for d in doc], pa.int64()), pa.array((r.start - first[r.doc]).astype(np.int32)),
                 pa.array(r.windows.astype(np.int32))], names=["hi", "lo", "doc_id", "h", "at", "n"])
    return keyed.select("text", "doc_id", "h").mapInArrow(run, "hi long, lo long, doc_id long, h long, at int, n int")


def covered(n_words: int, runs: list) -> np.ndarray:
    """Whether each word lies in a repeated window of the (at, n, flags) given."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for r in runs:
        if len(r["flags"]):
            on = r["at"] + np.flatnonzero(np.unpackbits(np.frombuffer(r["flags"], np.uint8))[: r["n"]])
            np.add.at(edge, on, 1)
            np.add.at(edge, on + WINDOW, -1)
        else:
            edge[r["at"]] += 1
            edge[r["at"] + r["n"] + WINDOW - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def removals(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot_windows: int = HOT_WINDOWS, reported: int = REPORTED) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with ``runs``, the repeated runs of the
    row, null where it has none."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    hot = hot_minimisers(docs, hot_windows, reported)
    flags = (_packed(docs, hot, buckets).groupBy("bucket")
             .applyInPandas(_bucket, "hi long, lo long, flags binary"))
    found = (_lookups(keyed, hot, buckets).join(staged(flags), ["hi", "lo"])
             .groupBy("doc_id", "h").agg(F.collect_set(F.struct("at", "n", "flags")).alias("runs")))
    found = found.withColumnsRenamed({"doc_id": "__i", "h": "__h"})
    return (keyed.join(found, keyed["doc_id"].eqNullSafe(found["__i"]) & (keyed["h"] == found["__h"]), "left")
            .select("doc_id", "text", "runs"))


def deduplicate(docs: DataFrame, **sizes) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    def run(batches):
        for batch in batches:
            out = []
            for text, runs in zip(texts(batch), batch.column("runs").to_pylist()):
                words = text.split()
                kept = words
                if runs:
                    gone = covered(len(words), runs)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, digest = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return removals(docs, **sizes).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
           FROM documents),
win AS (SELECT r, i, sha256(array_to_string(w[i : i + 34], ' ')) AS p
        FROM d, unnest(range(1, greatest(len(w) - 33, 1))) AS u(i)),
rep AS (SELECT p FROM win GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM win SEMI JOIN rep USING (p)),
word AS (SELECT r, j, w[j] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(j)),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
