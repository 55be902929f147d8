"""Ingest runs with isolated units of work (T7) and their error text."""

import json

import pytest
from pyspark.sql import functions as F

from aerolith.operators.runs import error_texts
from aerolith.sources import bronze as B
from aerolith.sources import ingest


def _page(run, endpoint, source, number, body, url="u"):
    return (run, endpoint, url, None, source, number, body if isinstance(body, str) or body is None else json.dumps(body))


def _location(i, sensors, city="Budapest", **other):
    return {"id": i, "name": f"Station {i}", "city": city, "country": {"code": "HU"},
            "coordinates": {"latitude": 47.5, "longitude": 19.0}, "timezone": "Europe/Budapest", "sensors": sensors} | other


def _sensor(i, name="pm25"):
    return {"id": i, "parameter": {"name": name, "units": "ug/m3"}}


def _reading(value, hour, **other):
    return {"value": value, "datetime": {"utc": f"2026-05-19T{hour:02d}:00:00Z"}, "parameter": {"name": "pm25", "units": "ug/m3"}} | other


def _results(*records):
    return {"results": list(records)}


@pytest.fixture()
def run(spark):
    def ingest_pages(*pages, **options):
        return ingest.ingest(spark.createDataFrame(list(pages), B.PAGE_SCHEMA), **options)
    return ingest_pages


def _log(r):
    return {x["run_id"]: x for x in r.log.collect()}


def _kept(r):
    return sorted((x["sensor_id"], x["measured_at"].hour) for x in r.readings.collect())


def test_a_failing_sensor_batch_leaves_the_others(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(_location(1, [_sensor(1), _sensor(2)]))),
            _page(1, ingest.READINGS, 1, 1, _results(_reading(30, 0))), _page(1, ingest.READINGS, 1, 2, _results(_reading(31, 1))),
            _page(1, ingest.READINGS, 2, 1, _results(_reading(12, 0))), _page(1, ingest.READINGS, 2, 2, _results(_reading("broken", 1))))
    row = _log(r)[1]
    assert (row["status"], row["records_inserted"], row["records_failed"], row["batches_undone"]) == ("partial", 2, 1, 1)
    assert row["error_message"] == "sensor 2 at location 1 rolled back: unparsable value broken"
    assert _kept(r) == [(1, 0), (1, 1)]


def test_an_invalid_reading_does_not_undo_its_batch(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(_location(1, [_sensor(1)]))),
            _page(1, ingest.READINGS, 1, 1, _results(_reading(None, 0), _reading(18, 1))))
    row = _log(r)[1]
    assert (row["status"], row["records_inserted"], row["records_failed"]) == ("partial", 1, 1)
    assert row["error_message"].startswith("sensor 1 measurement skipped at 2026-05-19T00:00:00Z for parameter pm25 with value None: "
                                           "Measurement payload missing datetime/value: {")
    assert _kept(r) == [(1, 1)]


def test_an_unreadable_location_page_fails_the_run_and_keeps_what_came_before(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(_location(1, [_sensor(1)]))),
            _page(1, ingest.LOCATIONS, None, 2, "<html>", url="/locations?page=2"),
            _page(1, ingest.LOCATIONS, None, 3, _results(_location(3, [_sensor(3)]))),
            _page(1, ingest.READINGS, 1, 1, _results(_reading(1, 0))), _page(1, ingest.READINGS, 3, 1, _results(_reading(3, 0))),
            _page(2, ingest.LOCATIONS, None, 1, None, url="/locations?page=1"), _page(2, ingest.READINGS, 1, 1, _results(_reading(5, 5))))
    log = _log(r)
    assert (log[1]["status"], log[1]["records_inserted"], log[1]["records_failed"]) == ("failed", 1, 1)
    assert log[1]["error_message"] == "run failed: unreadable response from /locations?page=2"
    assert (log[2]["status"], log[2]["records_inserted"], log[2]["records_failed"]) == ("failed", 0, 1)
    assert _kept(r) == [(1, 0)]


def test_a_bad_location_is_undone_with_its_batches(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(
                _location(1, [_sensor(1)], coordinates={"latitude": 91.0, "longitude": 0.0}), _location(2, [_sensor(2)]),
                _location(3, []), _location(4, [_sensor(4, "no2")]), _location(5, [_sensor(5)], country={"code": "  "}))),
            _page(1, ingest.SENSORS, 3, 1, "not json", url="/locations/3/sensors"), _page(1, ingest.SENSORS, 4, 1, _results(_sensor(40))),
            *[_page(1, ingest.READINGS, s, 1, _results(_reading(s, 0), _reading(None, 1))) for s in (1, 2, 4, 40, 5)],
            parameters=["PM25"])
    row = _log(r)[1]
    # location 4 has no embedded sensor in scope, so its sensor page is read; undone locations report no readings
    assert _kept(r) == [(2, 0), (40, 0)]
    assert (row["records_inserted"], row["records_failed"], row["readings_skipped"], row["locations_undone"]) == (2, 5, 2, 3)
    parts = row["error_message"].split(" | ")
    assert parts[0] == "location 1 rolled back: latitude out of range 91.0"
    assert parts[1].startswith("sensor 2 measurement skipped at 2026-05-19T01:00:00Z")
    assert parts[2] == "location 3 rolled back: unreadable response from /locations/3/sensors"
    assert parts[3].startswith("sensor 40 measurement skipped") and parts[4] == "location 5 rolled back: country is blank"
    assert sorted(x["location_id"] for x in r.locations.collect()) == [2, 4]
    assert sorted(x["sensor_id"] for x in r.batches.collect()) == [2, 40]


def test_readings_after_a_fault_are_never_seen(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(_location(1, [_sensor(1), _sensor(2)]))),
            _page(1, ingest.READINGS, 1, 1, _results(_reading(None, 0), _reading(5, 1), _reading(100000, 2), _reading(None, 3))),
            _page(1, ingest.READINGS, 1, 2, _results(_reading(7, 4), _reading(None, 5))),
            _page(1, ingest.READINGS, 2, 1, _results(_reading(1, 0), _reading(2, 0))), _page(1, ingest.READINGS, 2, 2, "{"),
            _page(1, ingest.READINGS, 2, 3, _results(_reading(None, 6))))
    row = _log(r)[1]
    assert _kept(r) == []
    assert (row["records_failed"], row["readings_skipped"], row["batches_undone"]) == (3, 1, 2)
    assert [p.split(":")[0] for p in row["error_message"].split(" | ")][1:] == ["sensor 1 at location 1 rolled back", "sensor 2 at location 1 rolled back"]


def test_a_sensor_without_a_parameter_undoes_its_batch_and_scope_filters_cities(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, _results(_location(1, [{"id": 1, "parameter": {"units": "x"}}, _sensor(2)]),
                                                         _location(9, [_sensor(9)], city="Vienna"))),
            *[_page(1, ingest.READINGS, s, 1, _results(_reading(s, 0))) for s in (1, 2, 9)], cities=["buda"])
    assert _kept(r) == [(2, 0)]
    assert _log(r)[1]["error_message"] == "sensor 1 at location 1 rolled back: Parameter payload has no name/code"


def test_first_writer_wins_across_runs_and_stored_rows(run, spark):
    pages = [_page(n, ingest.LOCATIONS, None, 1, _results(_location(1, [_sensor(1)]))) for n in (1, 2)]
    pages += [_page(1, ingest.READINGS, 1, 1, _results(_reading(1, 0), _reading(2, 1))), _page(2, ingest.READINGS, 1, 1, _results(_reading(9, 1), _reading(3, 2)))]
    stored = spark.sql("select 1L as sensor_id, timestamp_ntz'2026-05-19 02:00:00' as measured_at")
    r = run(*pages, stored=stored)
    assert sorted((x["measured_at"].hour, float(x["value"]), x["run_id"]) for x in r.readings.collect()) == [(0, 1.0, 1), (1, 2.0, 1)]
    log = _log(r)
    assert (log[1]["records_inserted"], log[2]["records_inserted"], log[2]["status"]) == (2, 0, "succeeded")
    assert log[2]["error_message"] is None


def test_empty_and_missing_results_are_empty_pages(run):
    r = run(_page(1, ingest.LOCATIONS, None, 1, {"results": None}), _page(1, ingest.LOCATIONS, None, 2, {"meta": 1}))
    assert _log(r)[1]["status"] == "succeeded" and _kept(r) == []


def test_error_text_is_the_capped_join_of_the_first_messages(spark):
    rows = [(k, i, f"{k} message {i} " + "x" * (i * 7 % 50)) for k, n in (("a", 1000), ("b", 3), ("c", 1)) for i in range(n)]
    rows += [("d", 0, "y" * 9000), ("e", 0, "z" * 4000), ("f", 0, "q" * 3998), ("f", 1, "a message of length"), ("g", 0, "q" * 4000), ("g", 1, "a message of length")]
    got = {r["k"]: r["error_message"] for r in error_texts(spark.createDataFrame(rows, "k string, at int, m string").repartition(7), ["k"], "at", "m").collect()}
    for k in "abcdefg":
        whole = " | ".join(m for kk, _, m in rows if kk == k)
        assert got[k] == (whole if len(whole) <= 4000 else whole[:3997] + "..."), k


def test_error_text_keeps_few_rows_of_a_run_before_the_shuffle(spark):
    errors = spark.range(200_000).select((F.col("id") % 3).alias("run_id"), F.col("id").alias("at"), F.concat(F.lit("a long enough message "), F.col("id")).alias("m"))
    plan = error_texts(errors.repartition(8), ["run_id"], "at", "m")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
