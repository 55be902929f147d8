"""Whole load is idempotent and readers only see published runs."""

import os
import tempfile

from pyspark.sql import functions as F

from aerolith.operators import alerts as A
from aerolith.plans import load as PL
from aerolith.plans import scenarios as SC
from aerolith.sources.driver_tables import core
from tests.conftest import SF_SMALL


def test_second_load_changes_nothing(spark):
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-test")
    first = PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_1)
    assert first["readings"] > 0 and first["alerts"] > 0 and first["parameters"] > 0
    second = PL.run_etl(spark, c, root, A.alerts(c), "2024-02-01 00:00:00")
    assert second == {"parameters": 0, "locations": 0, "sensors": 0, "readings": 0, "alerts": 0}
    fact = PL.table(spark, root, "fact_measurement")
    assert fact.count() == first["readings"]
    assert fact.groupBy("source_measurement_id").count().filter("count > 1").count() == 0


def test_changed_source_expires_versions(spark):
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-test-2")
    PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_1)

    class Moved:
        def __getattr__(self, name):
            if name == "location":
                return SC.location_snapshot_2(c.location)
            return getattr(c, name)
    n = PL.run_etl(spark, Moved(), root, A.alerts(c), SC.AS_OF_2)
    changed = SC.location_snapshot_2(c.location).filter(
        F.col("is_active") & ((F.col("location_id") % 10 == 0) | (F.col("location_id") % 15 == 1))).count()
    assert n["locations"] == 2 * changed  # one expired + one new version each
    assert n["readings"] == 0


def test_rewrite_partitioned_keeps_ids(spark):
    c = core(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="rewrite-")
    c.measurement.drop("measured_month").write.mode("overwrite").parquet(base + "/flat")
    t = PL.rewrite_partitioned(spark, base + "/flat", base + "/by_month")
    assert sorted(r[0] for r in t.select("measurement_id").collect()) == \
        sorted(r[0] for r in c.measurement.select("measurement_id").collect())
    assert "measured_month" in t.columns


def test_alert_status_refresh_and_per_sensor_bound(spark):
    from aerolith.operators import facts, runs
    c = core(spark, SF_SMALL)
    a = A.alerts(c)
    fact = facts.load_alert_facts(c, a, SC.dim_location_first_load(c))
    reviewed = SC.reviewed_alerts(c)
    fresh = facts.refresh_alert_status(fact, reviewed)
    assert fresh.count() == fact.count()
    assert fresh.filter("alert_status <> 'open'").count() > 0
    assert fact.filter("alert_status <> 'open'").count() == 0
    b = runs.lower_bound_per_sensor(c.measurement)
    assert b.count() == c.measurement.select("sensor_id").distinct().count()


def test_prediction_list_filters(spark):
    from aerolith.operators import features as FT
    from aerolith.operators import scd2
    c = core(spark, SF_SMALL)
    fact = SC.published(c, "fact_measurement")
    locs = scd2.current(SC.published(c, "dim_location"))
    f = FT.features(FT.star_rows(fact, spark))
    preds = FT.prediction_rows(f, FT.fixed_linear_score(f), "fixed_linear", "2024-02-01 00:00:00")
    some = FT.predictions_vs_actual(preds, fact, locs, limit=None).first()
    out = FT.predictions_vs_actual(preds, fact, locs, city=some.city, location=some.location_name,
                                   parameter=some.parameter_code, limit=None)
    rows = out.collect()
    assert rows and all((r.city, r.location_name, r.parameter_code) ==
                        (some.city, some.location_name, some.parameter_code) for r in rows)
    assert all(r.actual_value is not None for r in rows)  # backtest targets are real readings


def test_fact_outside_dim_date_fails_the_whole_load(spark):
    import pytest as _pt
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-test-fk")

    class Future:
        def __getattr__(self, name):
            if name == "measurement":
                m = c.measurement
                return m.withColumn("measured_at", F.when(F.col("measurement_id") % 100 == 0,
                                                          F.timestamp_add("YEAR", F.lit(5), "measured_at"))
                                    .otherwise(F.col("measured_at")))
            return getattr(c, name)
    with _pt.raises(ValueError, match="outside dim_date"):
        PL.run_etl(spark, Future(), root, A.alerts(c), SC.AS_OF_1)
    assert PL.read_manifest(spark, root) is None  # nothing published


def test_incremental_load_equals_full_anti_join_load(spark):
    c = core(spark, SF_SMALL)

    class Early:  # first load: early runs only, every fifth sensor not active yet
        def __getattr__(self, name):
            if name == "measurement":
                return c.measurement.filter(F.col("ingestion_run_id") <= 20240115)
            if name == "sensor":
                return c.sensor.withColumn("is_active", F.col("is_active") & (F.col("sensor_id") % 5 != 0))
            return getattr(c, name)
    base = spark.conf.get("spark.checkpoint.dir")
    inc, full = os.path.join(base, "wh-inc"), os.path.join(base, "wh-full")
    first = PL.run_etl(spark, Early(), inc, A.alerts(c), SC.AS_OF_1, incremental=True)
    assert first["readings"] > 0
    second = PL.run_etl(spark, c, inc, A.alerts(c), SC.AS_OF_2, incremental=True)
    PL.run_etl(spark, c, full, A.alerts(c), SC.AS_OF_1)
    got = PL.table(spark, inc, "fact_measurement")
    want = PL.table(spark, full, "fact_measurement")
    key = ["source_measurement_id", "measured_at", "measurement_value", "risk_class_key"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert first["readings"] + second["readings"] == want.count()


def test_incremental_after_full_load_and_with_late_readings(spark):
    c = core(spark, SF_SMALL)

    class Part:  # of the runs up to the 20th, every third reading comes late
        def __getattr__(self, name):
            if name == "measurement":
                return c.measurement.filter((F.col("ingestion_run_id") <= 20240120) & (F.col("measurement_id") % 3 != 0))
            return getattr(c, name)
    base = spark.conf.get("spark.checkpoint.dir")
    root, full = os.path.join(base, "wh-late"), os.path.join(base, "wh-late-full")
    first = PL.run_etl(spark, Part(), root, A.alerts(c), SC.AS_OF_1)  # a full load
    none = PL.run_etl(spark, Part(), root, A.alerts(c), SC.AS_OF_1, incremental=True)
    assert first["readings"] > 0 and none["readings"] == 0
    PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_2, incremental=True)
    PL.run_etl(spark, c, full, A.alerts(c), SC.AS_OF_1)

    def ids(r):
        return sorted(x[0] for x in PL.table(spark, r, "fact_measurement").select("source_measurement_id").collect())
    assert ids(root) == ids(full) and len(set(ids(root))) == len(ids(root))


def test_replaced_input_files_are_seen(spark, tmp_path):
    for t in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.write.parquet(str(tmp_path / "events.parquet"))
    n = core(spark, str(tmp_path)).measurement.count()
    ev.filter("event_id % 10 = 0").write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    assert core(spark, str(tmp_path)).measurement.count() == ev.filter("event_id % 10 = 0").count() < n


def test_the_load_does_not_shuffle_stored_facts(spark):
    from aerolith.operators import facts
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-bucketed")
    PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_1)
    PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_2)  # a second run: two files a bucket
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = PL.table(spark, root, "fact_measurement")
        new = facts.load_measurement_facts(c, PL.table(spark, root, "dim_location"), PL.table(spark, root, "dim_sensor"), existing=stored)
        plan = new._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("LeftAnti"):]
        scan = side[:side.index("fact_measurement")]
        below = scan[scan.rindex("measurement_id"):] if "Exchange" in scan else scan
        # the exchange below the anti join belongs to the new readings; the stored ids are read in their buckets
        assert "Bucketed: true" in side and side.count("Exchange hashpartitioning(measurement_id") == 1, plan
        assert new.count() == 0 and below is not None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_another_session_reads_the_bucketed_facts(spark):
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-other")
    n = PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_1)["readings"]
    name = PL._registered(spark, root, "fact_measurement", PL.read_manifest(spark, root))
    spark.sql(f"DROP TABLE {name}")  # as in a session that has not seen it
    assert PL.table(spark, root, "fact_measurement").count() == n


def test_a_load_writes_only_buckets_with_a_change(spark):
    c = core(spark, SF_SMALL)
    root = os.path.join(spark.conf.get("spark.checkpoint.dir"), "wh-buckets")
    PL.run_etl(spark, c, root, A.alerts(c), SC.AS_OF_1)
    first = PL.read_manifest(spark, root)["dims"]
    one = c.location.filter("is_active").agg(F.min("location_id")).first()[0]

    class Moved:
        def __getattr__(self, name):
            t = getattr(c, name)
            return t.withColumn("city", F.when(F.col("location_id") == one, "Elsewhere").otherwise(F.col("city"))) if name == "location" else t
    n = PL.run_etl(spark, Moved(), root, A.alerts(c), SC.AS_OF_2)
    second = PL.read_manifest(spark, root)["dims"]
    assert n["locations"] == 2 and second["dim_sensor"] == first["dim_sensor"]
    assert [b for b in second["dim_location"] if second["dim_location"][b] != first["dim_location"][b]] == [str(one % PL.DIM_BUCKETS)]
    assert PL.table(spark, root, "dim_location").filter(F.col("source_location_id") == one).count() == 2
