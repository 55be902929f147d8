"""Mixing sources to target weights.

The size of a document is its number of words ``[^\\x20\\x09-\\x0D]+``.
Sources, ordered by code point with null last, weigh 1, 2, 3, 1, 2, 3, ... and
share the sum of all sizes; a target stops at ``MOST`` = 3 times its source's
size, and the excess is shared by weight among the others until none is above.
A source's repetition rate is target / size. Each document is emitted
floor(rate) times, and once more if a hash of its id, as a number in [0, 1),
is below the rate's fraction: the same choice at every run.

The water level of the capped sources comes from sums over the table of
sources (a row each), repeated: sources above their cap at the present level
are capped, which lifts the level, until no more are. Sources are numbered in
range partitions; no task holds that table. Sizes are summed per source in
each task before anything is shuffled; the join back is planned by Spark from
the size of that table, and a source with a third of all rows is a skewed
join that Spark splits.

Defined cases: null text has size 0 and is taken 0 words; null source is a
source; a null doc_id draws by its text (null: empty); repeated rows draw
alike; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import WORD, fresh, staged, table

MOST = 3
WEIGHTS = 3


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighed(sums: DataFrame) -> DataFrame:
    """``sums`` (source, source_size) with the weight ``w`` of each source: numbers
    within range partitions, shifted by the counts of the partitions before."""
    part = F.shiftright(F.col("__n"), 33)
    placed = staged(sums.repartitionByRange(F.col("source").asc_nulls_last())
                    .sortWithinPartitions(F.col("source").asc_nulls_last())
                    .withColumn("__n", F.monotonically_increasing_id()))
    before, offsets = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):  # a row per partition
        offsets.append((r["part"], before))
        before += r["count"]
    offset = sums.sparkSession.createDataFrame(offsets, "__part long, __before long")
    number = F.col("__before") + F.col("__n").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(offset), "__part")
            .select("source", "source_size", (number % WEIGHTS + 1).cast("double").alias("w")))


def water_level(sources: DataFrame) -> float | None:
    """What the sources that are not capped get for each unit of weight."""
    most = F.lit(float(MOST)) * F.col("source_size")
    level, n_capped = None, 0
    while True:  # the capped only grow
        capped = F.lit(False) if level is None else F.lit(level) * F.col("w") > most
        total, all_w, size, w, n = sources.agg(
            F.sum("source_size"), F.sum("w"), F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, F.col("w"))), F.lit(0.0)), F.count(F.when(capped, 1))).first()
        if total is None or all_w == w:
            return None
        if level is not None and n == n_capped:
            return level
        level, n_capped = (float(total) - MOST * float(size)) / (all_w - w), n


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target of each source of ``sized`` (source, size)."""
    sources = staged(weighed(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    level, most = water_level(sources), (MOST * F.col("source_size")).cast("double")
    return sources.select("source", "source_size",
                          (most if level is None else F.least(F.lit(level) * F.col("w"), most)).alias("target"))


def draw(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the md5 of the id, or of the text where there is no id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long").cast("double") / F.lit(float(1 << 48))


def copies(target: Column, source_size: Column, u: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _joined(rows: DataFrame, source: str, share: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with their source's size and target under ``names``."""
    s, t = names
    of = fresh([*rows.columns, s, t], "__of")
    share = share.select(F.col("source").alias(of), F.col("source_size").alias(s), F.col("target").alias(t))
    return rows.join(share, rows[source].eqNullSafe(share[of])).drop(of)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("u"))
    rows = _joined(sized, "source", targets(sized.select("source", "size")), ["source_size", "target"])
    n = copies(F.col("target"), F.col("source_size"), F.col("u"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    share = targets(docs.select("source", size_of(F.col("text")).alias("size")))
    s, t, k = (fresh(docs.columns, n) for n in ("__source_size", "__target", "__copy"))
    rows = _joined(docs, "source", share, [s, t])
    n = copies(F.col(t), F.col(s), draw(F.col("doc_id"), F.col("text"))).cast("int")
    return rows.withColumn(k, F.explode(F.array_repeat(F.lit(0), n))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


MIX_SQL = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12)) AS BIGINT)
                    / 281474976710656.0::DOUBLE AS u
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM s),
r AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, sum(w) OVER () AS all_w,
             coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS cs,
             coalesce(sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cw
      FROM w),
l AS (SELECT *, (total - 3 * cs) / (all_w - cw) AS level FROM r),
f AS (SELECT arg_min(level, source_size / w) AS level FROM l WHERE level * w <= 3 * source_size),
t AS (SELECT source, source_size, CAST(CASE WHEN (SELECT level FROM f) IS NULL THEN 3 * source_size
             ELSE least((SELECT level FROM f) * w, 3 * source_size) END AS DOUBLE) AS target FROM l),
e AS (SELECT doc_id, size, source_size, target, u,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM e
"""
