"""Steps that must not grow with the tables: broadcasts, landed text, stream batches."""

import glob
from types import SimpleNamespace

from pyspark.sql import functions as F

from aerolith import session
from aerolith.sources import bronze as B
from aerolith.streaming import jobs as ST

PARAMETER = "parameter_id int, code string, display_name string"


def _events(spark, n=120):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_add("MINUTE", (F.col("id") * 7).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") / 4).alias("value"))


def _parameter(spark):
    return spark.createDataFrame([(1, "view", "VIEW")], PARAMETER)


def test_broadcast_limit_is_lowered_and_never_raised(spark):
    old = spark.conf.get(session.BROADCAST_CONF)
    try:
        for given, then in (("10MB", str(session.BROADCAST_MB << 20)), ("256k", "256k"), ("-1", "-1")):
            spark.conf.set(session.BROADCAST_CONF, given)
            session.limit_broadcasts(spark)
            assert spark.conf.get(session.BROADCAST_CONF) == then
    finally:
        spark.conf.set(session.BROADCAST_CONF, old)


def test_a_join_of_a_table_over_the_limit_is_not_broadcast(spark, tmp_path):
    # 2.4 MB of files of sequential keys; below Spark's own limit of 10 MB
    spark.range(600_000).select("id", F.hash("id").alias("x")).write.parquet(str(tmp_path / "dim"))
    dim, other = (spark.read.parquet(str(tmp_path / "dim")) for _ in range(2))
    assert "BroadcastExchange" not in dim.join(other, "id")._jdf.queryExecution().executedPlan().toString()


def test_pages_are_landed_compressed_and_read_back_whole(spark, tmp_path):
    pages = B.measurement_pages(_events(spark), _parameter(spark))
    path = B.land(pages, str(tmp_path / "pages"))
    files = glob.glob(f"{path}/run_id=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    cols = ["run_id", "source_id", "page_no", "response_body"]
    back = B.read_landed(spark, path).select(cols)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pages.select(cols).collect()))


def test_pages_are_gathered_from_columns_not_from_their_text(spark):
    plan = B.measurement_pages(_events(spark), _parameter(spark))._jdf.queryExecution().optimizedPlan().toString()
    gathered = plan.split("collect_list(")[1].split("), 0, 0")[0]
    assert "event_id" in gathered and "date_format" not in gathered and "format_string" not in gathered


def test_staged_rows_come_from_compressed_columns(spark):
    df = spark.range(50).withColumn("text", F.lit("a repeated text " * 20))
    out = session.staged(df, "rows")
    assert out.dtypes == df.dtypes and sorted(out.collect()) == sorted(df.collect())
    assert all(f.endswith(".parquet") and "/staged/rows-" in f for f in out.inputFiles())


def test_update_stream_runs_its_state_once_a_batch(spark):
    core = SimpleNamespace(
        sensor=spark.createDataFrame([(u * 1000 + 1, u, 1) for u in range(3)], "sensor_id long, location_id long, parameter_id int"),
        location=spark.createDataFrame([(u, "X") for u in range(3)], "location_id long, city string"),
        parameter=_parameter(spark))
    feed = ST.Feed(spark, "once-a-batch").land(B.measurement_pages(_events(spark), core.parameter))
    rows = ST.hourly_updates(feed, core).collect()
    assert sum(r.measurement_count for r in rows) == 117  # 7, 57 and 107 lack their value
    out, ckpt = feed.dirs("hourly-updates")
    plain = lambda p: p.removeprefix("file://")
    # every batch is written as it comes, empty ones too: none is asked for rows first
    batches = {f.rsplit("/", 1)[1] for f in glob.glob(f"{plain(ckpt)}/commits/[0-9]*")}
    assert len(batches) > 1
    assert {f.rsplit("=", 1)[1] for f in glob.glob(f"{plain(out)}/batch_id=*")} == batches
