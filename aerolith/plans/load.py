"""The warehouse load as one all-or-nothing run.

Order: the dimensions parameters (E4), locations (E5) and sensors (E6), then
the facts readings (E7) and alerts (E8); steps of one group do not depend on
each other and run as concurrent Spark jobs. The five counts are returned
like the reference's ETL result.

There is no multi-table transaction on Parquet, so a run stages everything
under its own folder and publishes a manifest last:

* the parameter dimension is rewritten as a whole; the SCD2 dimensions are kept
  in ``DIM_BUCKETS`` buckets of their business key, a run rewrites the buckets
  in which a version starts or ends, and the manifest names each bucket's folder;
* facts are append-only: each run writes only its new rows into
  ``fact_*/load_run=<id>``; readers take the partitions the manifest lists,
  so a half-written run is invisible and a re-run is idempotent (anti joins);
* facts are bucketed and sorted by their source id, as many buckets as the
  session shuffles to when the warehouse is made (the manifest keeps the
  number), so the anti join reads the stored ids where they lie: only the new
  readings are shuffled. The tables' folders are all there is to them; a session
  registers them under a name made from the folder when it first reads them.

Every written table is read back before the next step, which cuts lineage
(a lost executor recomputes from the staged files, not from the sources).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators import dims, facts, scd2
from aerolith.sources import store

DIMS = ("dim_parameter", "dim_location", "dim_sensor")
FACTS = ("fact_measurement", "fact_alert")
DIM_BUCKETS = 64


def _manifest_path(root: str) -> str:
    return os.path.join(root, "_manifest")


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    text = store.read_marker(spark, _manifest_path(root))
    return None if text is None else json.loads(text)


def table(spark: SparkSession, root: str, name: str, manifest: dict | None = None) -> DataFrame | None:
    """The published version of a warehouse table (None before the first run)."""
    manifest = manifest or read_manifest(spark, root)
    if manifest is None:
        return None
    if name in DIMS:
        kept = manifest["dims"][name]
        return _read_buckets(spark, kept) if isinstance(kept, dict) else spark.read.parquet(kept)
    return spark.table(_registered(spark, root, name, manifest)).filter(F.col("load_run").isin(manifest["fact_runs"])).drop("load_run")


FACT_KEY = {"fact_measurement": "source_measurement_id", "fact_alert": "source_alert_id"}


def _registered(spark: SparkSession, root: str, name: str, manifest: dict) -> str:
    """The session's name of a bucketed fact table."""
    table_name = f"{name}_{hashlib.sha1(root.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(table_name):
        spark.sql(f"CREATE TABLE {table_name} ({manifest['fact_columns'][name]}, load_run STRING) USING parquet PARTITIONED BY (load_run) "
                  f"CLUSTERED BY ({FACT_KEY[name]}) SORTED BY ({FACT_KEY[name]}) INTO {manifest['fact_buckets']} BUCKETS "
                  f"LOCATION '{os.path.join(root, name)}'")
    spark.catalog.recoverPartitions(table_name)  # runs of this and of other sessions
    return table_name


def _append(spark: SparkSession, root: str, name: str, rows: DataFrame, run_id: str, n_buckets: int) -> DataFrame:
    """Write one run's rows as buckets and return them as written."""
    key, path = FACT_KEY[name], os.path.join(root, name)
    staged_name = f"stage_{name}_{run_id}"
    (rows.repartition(n_buckets, key).sortWithinPartitions(key)
     .write.format("parquet").option("path", os.path.join(path, f"load_run={run_id}")).bucketBy(n_buckets, key).sortBy(key)
     .saveAsTable(staged_name))
    spark.sql(f"DROP TABLE {staged_name}")  # external: the folder stays
    return spark.read.schema(rows.schema).parquet(os.path.join(path, f"load_run={run_id}"))


def bucket_of(key: str) -> F.Column:
    return F.pmod(F.col(key), F.lit(DIM_BUCKETS)).cast("int")


def _read_buckets(spark: SparkSession, buckets: dict[str, str], only: set[int] | None = None) -> DataFrame | None:
    """The rows of a bucketed dimension, or of some buckets of it."""
    paths = [p for b, p in buckets.items() if only is None or int(b) in only]
    return spark.read.parquet(*paths) if paths else None


def publish_scd2(spark: SparkSession, path: str, sync, source: DataFrame, key: str, dim_key: str, tracked: list[str],
                 empty: DataFrame, buckets: dict[str, str], as_of) -> tuple[dict[str, str], int]:
    """Sync a bucketed SCD2 dimension (E5, E6): the folders of its buckets after
    the run, and the number of versions that ended or began.

    Keys with a change are found by one anti join; their buckets (at most
    ``DIM_BUCKETS`` numbers) are synced and written, all others stay as they are."""
    cur = _read_buckets(spark, buckets)
    keys = scd2.changed_keys(source, empty if cur is None else cur, key, dim_key, tracked)
    changed = {r[0] for r in keys.select(bucket_of(dim_key)).distinct().collect()}
    if not changed:
        return buckets, 0
    before = _read_buckets(spark, buckets, changed)
    before = empty if before is None else before
    after = sync(source.filter(bucket_of(key).isin(changed)), before, as_of).withColumn("bucket", bucket_of(dim_key))
    after.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(path)
    written = spark.read.parquet(path)
    expired = written.filter(~F.col("is_current") & (F.col("valid_to") == F.lit(as_of).cast("timestamp_ntz"))).count()
    return {**buckets, **{str(b): os.path.join(path, f"bucket={b}") for b in changed}}, expired + written.count() - before.count()


def run_etl(spark: SparkSession, core, root: str, alerts_df: DataFrame, as_of, incremental: bool = False) -> dict:
    """One warehouse load from the core tables into ``root``; returns counts.

    ``incremental``: instead of anti-joining every reading against the whole
    stored fact (the reference's NOT EXISTS), compare row counts per (run,
    sensor) and anti-join only the groups that differ
    (``facts.not_stored``). The result equals the full anti-join load, also
    after a full load and with late readings of old runs.
    """
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    manifest = read_manifest(spark, root)
    run_id = uuid.uuid4().hex[:12]
    stage = os.path.join(root, "runs", run_id)
    n_buckets = (manifest or {}).get("fact_buckets") or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write_dim(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(stage, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    # Parameters (SCD1). Count = new or changed codes.
    def parameters():
        cur_p = table(spark, root, "dim_parameter", manifest)
        src_p = dims.dim_parameter(core.parameter)
        if cur_p is None:
            cur_p = dims.empty_parameter_dim(core.parameter)
        new = write_dim("dim_parameter", dims.dim_parameter_upsert(core.parameter, cur_p))
        return new, src_p.join(cur_p, src_p.columns, "left_anti").count()

    # SCD2 dimensions. Count = expired + inserted versions.
    buckets: dict[str, dict[str, str]] = {}

    def scd2_step(name, sync, source, key, dim_key, tracked, empty):
        kept = (manifest or {}).get("dims", {}).get(name, {})
        buckets[name], n = publish_scd2(spark, os.path.join(stage, name), sync, source, key, dim_key, tracked, empty, kept, as_of)
        new = _read_buckets(spark, buckets[name])
        return (empty if new is None else new), n

    # Append-only facts, new rows only. A fact whose date is not in
    # dim_date breaks the date foreign key: the whole load fails and nothing
    # is published (the written partition stays invisible).
    lo, hi = dims.date_key_range()

    columns: dict[str, str] = {}

    def append_fact(name: str, df: DataFrame) -> int:
        written = _append(spark, root, name, df, run_id, n_buckets)
        columns[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        n, outside = written.agg(F.count(F.lit(1)), F.count_if(~F.col("date_key").between(lo, hi))).first()
        if outside:
            raise ValueError(f"{name}: {outside} rows have a date outside dim_date; load not published")
        return n

    # The three dimensions are independent, and so are the two facts once the
    # dimensions are written: each group runs as concurrent Spark jobs.
    with ThreadPoolExecutor(max_workers=3) as pool:
        fp = pool.submit(parameters)
        fl = pool.submit(scd2_step, "dim_location", scd2.sync_locations, core.location, "location_id", "source_location_id",
                         scd2.LOCATION_TRACKED, scd2.empty_location_dim(spark, core.location))
        fs = pool.submit(scd2_step, "dim_sensor", scd2.sync_sensors, core.sensor, "sensor_id", "source_sensor_id",
                         scd2.SENSOR_TRACKED, scd2.empty_sensor_dim(spark, core.sensor))
        (dp, n_param), (dl, n_loc), (ds, n_sen) = fp.result(), fl.result(), fs.result()
        existing_a = table(spark, root, "fact_alert", manifest)
        existing_m = table(spark, root, "fact_measurement", manifest)
        fm = pool.submit(append_fact, "fact_measurement",
                         facts.load_measurement_facts(core, dl, ds, existing=existing_m, incremental=incremental,
                                                      dim_parameter=dp))
        fa = pool.submit(append_fact, "fact_alert", facts.load_alert_facts(core, alerts_df, dl, existing=existing_a, dim_parameter=dp))
        n_read, n_alert = fm.result(), fa.result()

    # publish last
    runs = (manifest or {}).get("fact_runs", []) + [run_id]
    new_manifest = {"run_id": run_id, "as_of": as_of.isoformat(), "fact_runs": runs, "fact_buckets": n_buckets, "fact_columns": columns,
                    "dims": {"dim_parameter": os.path.join(stage, "dim_parameter"), **buckets}}
    store.write_marker(spark, _manifest_path(root), json.dumps(new_manifest))
    return {"parameters": n_param, "locations": n_loc, "sensors": n_sen, "readings": n_read, "alerts": n_alert}


def rewrite_partitioned(spark: SparkSession, src: str, dst: str, ts: str = "measured_at",
                        month_col: str = "measured_month") -> DataFrame:
    """Rewrite an unpartitioned table as month partitions, ids kept.

    No ``repartition(month)``: that would send a whole month to one task. The
    rebalance by month gives few files a month, AQE splits a large one."""
    df = spark.read.parquet(src)
    if month_col not in df.columns:
        df = df.withColumn(month_col, F.trunc(F.col(ts).cast("date"), "MM"))
    df.hint("rebalance", F.col(month_col)).sortWithinPartitions(month_col, ts).write.mode("overwrite").partitionBy(month_col).parquet(dst)
    return spark.read.parquet(dst)
