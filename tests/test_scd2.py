"""SCD2 invariants: idempotent re-sync, contiguous half-open intervals."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.operators import scd2
from aerolith.plans import scenarios as SC
from aerolith.sources.driver_tables import core
from tests.conftest import SF_SMALL


def test_resync_with_same_source_changes_nothing(spark):
    c = core(spark, SF_SMALL)
    d1 = SC.dim_location_history(c).cache()
    again = scd2.sync_locations(SC.location_snapshot_2(c.location), d1, "2024-02-01 00:00:00")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, d1.collect()))


def test_versions_are_contiguous_and_single_current(spark):
    c = core(spark, SF_SMALL)
    d = SC.dim_location_history(c)
    w = Window.partitionBy("source_location_id").orderBy("valid_from")
    chk = d.withColumn("next_from", F.lead("valid_from").over(w))
    assert chk.filter(F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))).count() == 0
    assert chk.filter(F.col("next_from").isNull() & ~F.col("is_current")).count() == 0
    assert d.groupBy("source_location_id").agg(F.count_if("is_current").alias("k")).filter("k <> 1").count() == 0
    assert d.filter(~F.col("is_current")).count() > 0


def test_inactive_source_stays_current(spark):
    c = core(spark, SF_SMALL)
    d1 = SC.dim_location_first_load(c)
    gone = c.location.withColumn("is_active", F.lit(False))
    d2 = scd2.sync_locations(gone, d1, "2024-03-01 00:00:00")
    assert d2.filter(~F.col("is_current")).count() == 0
    assert d2.count() == d1.count()


def test_close_inactive_option(spark):
    c = core(spark, SF_SMALL)
    d1 = SC.dim_location_first_load(c)
    gone = c.location.withColumn("is_active", F.lit(False))
    src = scd2.location_source(gone)
    d2 = scd2.scd2_sync(src, d1, "location_id", "source_location_id", scd2.LOCATION_TRACKED,
                        scd2.LOCATION_TRACKED, "2024-03-01 00:00:00", close_inactive=True)
    assert d2.filter("is_current").count() == 0
    assert d2.count() == d1.count()


def test_null_marker_separates_swapped_nulls(spark):
    from aerolith.functions import scalars as S
    df = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    plain = {r[0] for r in df.select(S.row_hash("a", "b")).collect()}
    marked = {r[0] for r in df.select(S.row_hash(*[F.coalesce("a", F.lit("\\u0000")), F.coalesce("b", F.lit("\\u0000"))]))
              .collect()}
    assert len(plain) == 1 and len(marked) == 2
