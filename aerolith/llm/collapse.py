"""The prefix trie of rebuilt conversations, from their distinct whole sequences.

A conversation's turns are in the order of their number, null first; turns of
one number in the order of their digests. Conversation c is rebuilt as the
first h turns of conversation c - c % 20 (all if fewer, none if absent), then
its own turns after its first h; h = crc32(decimal c) % 4. Each distinct
sequence of first d rebuilt turns (role, text) is a node of depth d.

Whole-sequence collapse. Rebuilt conversations of equal turns are one weighted
sequence with the list of its ends, named by its smallest conversation. Only
the turns of that conversation go on. A sequence that is a proper prefix of
another is found among the parents of nodes; an anti-join drops it, and the
sequences left are the leaves. Prefixes of sequences, weighted, aggregate to
nodes. A node's own value belongs to its smallest conversation, so the sum over
a subtree is the sum, over the sequences through its top, of the values from
that depth on.

Names. A turn is known by the md5 of its role and text, and a prefix by its
length and the exclusive or of two 64-bit hashes of each position and turn;
names are not compared by text. Texts are read once and not shuffled.

Hot keys. Turns are numbered within range partitions, and the few conversations
that cross a border get an offset: no task holds a whole conversation. Running
values along a conversation are computed for ``CHUNK`` turns at a time and
shifted by the totals of the chunks before. Aggregations combine before the
shuffle. Parents with very many children, at most 10,000 of them, are broadcast
to their children, the others joined. The list of ends of a sequence is written
in pieces of up to ``PIECE`` ids; its digest, sequential by definition, is
computed over the pieces in order, one in memory at a time.

Defined cases: rows without conv_id take no part; null role or text is empty;
repeated rows are turns of their own; a conversation without rebuilt turns is a
member of the root alone; an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import WORD, staged, table

FAMILY, HEAD = 20, 4
CHUNK = 4096
PIECE = 8192
#: a parent with more children than this, and than this share of all nodes, is broadcast
MANY_CHILDREN = 10_000


def placed(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn's digest and words, in the order of each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("tie")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "tie"]  # no column decides alone: copies of a row spread

    def numbered(batches):
        last, n = None, 0  # the conversation at the end of the batch before, and its turns so far
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            first = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
            pos = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
            if conv[0] == last:
                pos[: first[1] if len(first) > 1 else len(conv)] += n
            last, n = conv[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos)], names=[*batch.schema.names, "local"])
    rows = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "words")
                  .withColumn("part", F.spark_partition_id())
                  .mapInArrow(numbered, "conv_id long, digest string, words long, part int, local long"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    # a conversation has rows before a partition only if it crosses the border: at most a row per partition
    crossing = (rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).withColumn("before", before)
                .where("before is not null").drop("n"))
    return (rows.join(F.broadcast(crossing), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, pos, digest, words of every rebuilt conversation, with a row of position 0 for each."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    heads = (turns.where((F.col("pos") < HEAD) & (F.col("conv_id") % FAMILY == 0))
             .groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head")))
    none = F.expr("cast(array() as array<struct<pos: long, digest: string, words: long>>)")
    convs = staged(turns.where("pos = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
                   .join(heads, "base", "left")
                   .select("conv_id", "h", F.slice(F.coalesce("head", none), F.lit(1), F.col("h")).alias("head")))
    own = (turns.join(convs.select("conv_id", "h", F.size("head").alias("k")), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "words"))
    lent = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.digest", "t.words")
    top = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("words"))
    return top.unionAll(lent).unionAll(own)


def running(rows: DataFrame, keys: list[str], values: dict[str, str], total, back: bool = False) -> DataFrame:
    """``rows`` (by ``keys`` and pos) with the running totals of ``values`` (name:
    column) up to each position, or from it on with ``back``. ``total`` is an
    aggregate function that can be applied to its own results."""
    rows = rows.withColumn("chunk", F.floor(F.col("pos") / CHUNK).cast("long"))
    order = F.col("pos").desc() if back else F.col("pos")
    inner = W.partitionBy(*keys, "chunk").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    outer = W.partitionBy(*keys).orderBy(F.col("chunk").desc() if back else F.col("chunk")).rowsBetween(W.unboundedPreceding, -1)
    chunks = rows.groupBy(*keys, "chunk").agg(*[total(F.col(c)).alias(f"{n}_") for n, c in values.items()])
    shifts = chunks.select(*keys, "chunk", *[total(F.col(f"{n}_")).over(outer).alias(f"{n}_before") for n in values])
    shifts = shifts.where(" or ".join(f"{n}_before is not null" for n in values))  # none where one chunk holds all
    out = rows.select("*", *[total(F.col(c)).over(inner).alias(f"{n}_here") for n, c in values.items()]).join(shifts, [*keys, "chunk"], "left")
    for n in values:
        before = F.coalesce(f"{n}_before", F.lit(0).cast("long"))
        here = F.col(f"{n}_here")
        out = out.withColumn(n, here.bitwiseXOR(before) if total is F.bit_xor else here + before).drop(f"{n}_here", f"{n}_before")
    return out.drop("chunk")


def named(turns: DataFrame) -> DataFrame:
    """``turns`` with the names a, b of the prefix up to each and pa, pb of its parent."""
    def h(seed: int) -> Column:
        return F.when(F.col("pos") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "pos", "digest"))
    rows = running(turns.select("*", h(1).alias("ha"), h(2).alias("hb")), ["conv_id"], {"a": "ha", "b": "hb"}, F.bit_xor)
    return rows.select("conv_id", "pos", "words", "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
                       F.col("b").bitwiseXOR(F.col("hb")).alias("pb"))


KEY = ["pos", "a", "b"]


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """pos, a, b, ends_sha256 of the sequences of ``ends`` (conv_id, pos, a, b)."""
    def parts(batch: pa.RecordBatch) -> np.ndarray:
        keys = np.array([batch.column(c).to_numpy() for c in KEY])
        return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [batch.num_rows]])

    def pieces(batches):
        for batch in batches:
            if batch.num_rows:
                cuts = parts(batch)
                at = [i for a, b in zip(cuts, cuts[1:]) for i in range(a, b, piece)]
                conv = [str(c) for c in batch.column("conv_id").to_pylist()]
                text = [",".join(conv[a:b]) for a, b in ((i, min(i + piece, stop)) for s, stop in zip(cuts, cuts[1:]) for i in range(s, stop, piece))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(at)) for c in [*KEY, "conv_id"]], pa.array(text)],
                                                 names=[*KEY, "first", "ids"])

    def digests(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for *k, ids in zip(*[batch.column(c).to_pylist() for c in [*KEY, "ids"]]):
                if k != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield from out(done)
        if key is not None:
            yield from out([(*key, digest.hexdigest())])

    def out(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*KEY, "ends_sha256"])
    order = [*KEY, "conv_id"]
    listed = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(pieces, "pos long, a long, b long, first long, ids string"))
    return (listed.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")
            .mapInArrow(digests, "pos long, a long, b long, ends_sha256 string"))


def with_parents(nodes: DataFrame, kids: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id; ``kids`` (pos, a, b, n_children) of the parents."""
    limit = max(MANY_CHILDREN, nodes.count() // MANY_CHILDREN)
    parents = staged(kids.join(nodes, KEY).select((F.col("pos") + 1).alias("pos"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                                                  F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > limit).alias("hot")))
    at = ["pos", "pa", "pb"]
    hot = F.broadcast(parents.where("hot").drop("hot"))  # at most 10,000 rows: their children are nodes of their own
    few = nodes.join(hot.select(*at), at, "left_anti").join(parents.where("not hot").drop("hot"), at, "left")
    return few.unionByName(nodes.join(hot, at))


def trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per node conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = staged(named(rebuilt(staged(placed(conversations)))))
    last = F.max(F.struct(*KEY))
    ends = staged(turns.groupBy("conv_id").agg(last.alias("last")).select("conv_id", "last.*"))
    sequences = ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    sequences = staged(sequences.join(end_digests(ends, piece), KEY))
    prefixes = staged(turns.join(sequences.select("conv_id", "weight"), "conv_id"))
    nodes = staged(prefixes.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"),
                                              F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    kids = staged(nodes.where("pos > 0").groupBy((F.col("pos") - 1).alias("pos"), F.col("pa").alias("a"), F.col("pb").alias("b"))
                  .agg(F.count("*").alias("n_children")))
    leaves = sequences.join(kids, KEY, "left_anti").select("conv_id", "pos", F.lit(1).cast("long").alias("leaf"))
    own = nodes.select("conv_id", "pos", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    zero = F.lit(0).cast("long")
    valued = (prefixes.select("conv_id", *KEY).join(own, ["conv_id", "pos"], "left").join(leaves, ["conv_id", "pos"], "left")
              .withColumns({"saved": F.coalesce("saved", zero), "leaf": F.coalesce("leaf", zero)}))
    below = (running(valued, ["conv_id"], {"saved_tokens": "saved", "n_leaves": "leaf"}, F.sum, back=True)
             .groupBy(*KEY).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves")))
    nothing = hashlib.sha256(b"").hexdigest()
    return (with_parents(nodes, kids).join(below, KEY).join(kids, KEY, "left").join(sequences.select(*KEY, "ends_sha256"), KEY, "left")
            .select("conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: crc32 of the decimal id, byte by byte and bit by bit
CRC = ("xor(4294967295::BIGINT, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)), "
       "lambda c, s: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)), xor(c, s)), 4294967295::BIGINT))")
ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n, turn
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'g': g, 'n': n}} ORDER BY turn NULLS FIRST, g) AS l FROM t GROUP BY conv_id),
h AS (SELECT *, {CRC} % 4 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(b.l, [])[1 : h], h.l[h + 1 :]) AS l
      FROM h LEFT JOIN c AS b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, CASE WHEN d > 0 THEN l[d].n ELSE 0 END AS n, len(l) AS len,
             md5(array_to_string(list_transform(l[1 : d], lambda x: x.g), ',')) AS k,
             CASE WHEN d > 0 THEN md5(array_to_string(list_transform(l[1 : d - 1], lambda x: x.g), ',')) END AS up
      FROM r, unnest(range(0, len(l) + 1)) AS u(d)),
n AS (SELECT d, k, min(conv_id) AS conv_id, max(up) AS up, max(n) AS n, count(*) AS n_convs,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = d), '') AS ends
      FROM p GROUP BY d, k),
kid AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n.n_convs - 1) * n.n AS own, u.conv_id AS parent_conv_id
      FROM n LEFT JOIN kid USING (d, k) LEFT JOIN n AS u ON u.d = n.d - 1 AND u.k = n.up),
a AS (SELECT DISTINCT x.d AS td, x.k AS tk, y.d, y.k FROM p AS x JOIN p AS y ON x.conv_id = y.conv_id AND y.d >= x.d),
s AS (SELECT td AS d, tk AS k, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM a JOIN m USING (d, k) GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM m JOIN s USING (d, k)
"""
