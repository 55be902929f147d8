"""Golden checks taken from the reference's own tests (FIXTURES.md F1-F5)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from aerolith.operators import alerts as A
from aerolith.operators import features as FT
from aerolith.operators import quality as QL
from aerolith.sources import bronze as B


def _pages(spark, rows):
    return spark.createDataFrame(rows, B.PAGE_SCHEMA)


def test_f1_location_page(spark):
    body = {"results": [{
        "id": 1, "name": "Station 1", "city": "Budapest", "country": {"code": "HU"},
        "coordinates": {"latitude": 47.5, "longitude": 19.0}, "timezone": "Europe/Budapest",
        "sensors": [{"id": 1, "parameter": {"name": "pm25", "units": "µg/m³"}},
                    {"id": 2, "parameter": {"name": "pm25", "units": "µg/m³"}}]}]}
    pages = _pages(spark, [(1, "/v3/locations", "u", None, 1, 1, json.dumps(body))])
    locs = B.parse_locations(B.unnest(pages, B.LOCATION_JSON))
    loc = locs.first()
    assert (loc.location_id, loc.name, loc.city, loc.country, loc.timezone) == \
        (1, "Station 1", "Budapest", "HU", "Europe/Budapest")
    assert (float(loc.latitude), float(loc.longitude)) == (47.5, 19.0)
    sensors = sorted(tuple(r) for r in B.sensors_of(locs).select("sensor_id", "parameter_code", "unit").collect())
    assert sensors == [(1, "pm25", "ug/m3"), (2, "pm25", "ug/m3")]


def _reading_page(sensor, page, recs):
    return (20260519, "/v3/sensors/{id}/measurements", "u", None, sensor, page, json.dumps({"results": recs}))


def test_f2_reading_pages_first_writer(spark):
    rows = [_reading_page(1, 1, [{"value": "30", "datetime": {"utc": "2026-05-19T00:00:01Z"}}]),
            _reading_page(1, 2, [{"value": "31", "datetime": {"utc": "2026-05-19T01:00:01Z"}}]),
            _reading_page(2, 1, [{"value": "12", "datetime": {"utc": "2026-05-19T00:00:02Z"}}]),
            _reading_page(2, 2, [{"value": "13", "datetime": {"utc": "2026-05-19T01:00:02Z"}},
                                 {"value": "99", "datetime": {"utc": "2026-05-19T01:00:02Z"}}])]
    parsed = B.parse_measurements(B.unnest(_pages(spark, rows), B.MEASUREMENT_JSON))
    good = parsed.filter(F.col("error").isNull()).select("sensor_id", "measured_at", "value", "run_id",
                                                          "page_no", "position")
    kept = B.insert_if_absent(good, None)
    got = sorted((r.sensor_id, float(r.value)) for r in kept.collect())
    assert got == [(1, 30.0), (1, 31.0), (2, 12.0), (2, 13.0)]  # the later duplicate (99) lost
    # against the stored table nothing is new
    assert B.insert_if_absent(good, kept.select("sensor_id", "measured_at")).count() == 0


def test_f3_invalid_reading_is_counted(spark):
    rows = [_reading_page(1, 1, [{"value": None, "datetime": {"utc": "2026-05-19T00:00:00Z"}},
                                 {"value": "18", "datetime": {"utc": "2026-05-19T01:00:00Z"}}])]
    parsed = B.parse_measurements(B.unnest(_pages(spark, rows), B.MEASUREMENT_JSON))
    good = parsed.filter(F.col("error").isNull()).select("sensor_id", "measured_at", "value", "run_id",
                                                          "page_no", "position")
    counts = B.run_counts(parsed, B.insert_if_absent(good, None)).first()
    assert (counts.records_inserted, counts.records_failed, counts.status) == (1, 1, "partial")
    assert "measurement skipped" in counts.error_message


def test_f4_feature_row(spark):
    base = dt.datetime(2026, 1, 1)
    rows = [(1, 10, "pm25", base + dt.timedelta(hours=i), float(10 + i), i, 0, 4, 1, False) for i in range(7)]
    star = spark.createDataFrame(rows, "source_sensor_id long, source_location_id long, parameter_code string, "
                                       "measured_at timestamp_ntz, measurement_value double, hour int, "
                                       "minute int, weekday int, month int, is_weekend boolean")
    out = FT.features(star).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.current_value, r.previous_value, r.rolling_3h, r.rolling_6h, r.target_value) == \
        (15.0, 14.0, 14.0, 12.5, 16.0)


def _rules(spark):
    return spark.createDataFrame(
        [(1, 7, "Budapest", "low", 0), (2, 7, "Budapest", "moderate", 10), (3, 7, "Budapest", "high", 25),
         (4, 7, "Budapest", "critical", 50)],
        "threshold_rule_id long, parameter_id int, city string, warning_level string, min_value int") \
        .withColumn("min_value", F.col("min_value").cast("decimal(12,4)")).withColumn("is_active", F.lit(True))


def test_f5_alert_outbox_review(spark):
    reading = spark.createDataFrame([(100, dt.datetime(2026, 1, 1), 12.34, 7, "Budapest")],
                                    "measurement_id long, measured_at timestamp_ntz, value double, "
                                    "parameter_id int, city string") \
        .withColumn("value", F.col("value").cast("decimal(12,4)"))
    alerts = A.generate_alerts(reading, _rules(spark))
    a = alerts.collect()
    assert [(x.alert_level, x.status, x.threshold_rule_id) for x in a] == [("moderate", "open", 2)]
    created = A.outbox_events(None, alerts).collect()
    assert [(e.event_type, e.previous_status, e.current_status) for e in created] == [("created", None, "open")]
    cmd = spark.createDataFrame([(100, "reviewed", "looked at it", dt.datetime(2026, 1, 2))],
                                "pollution_alert_id long, status string, notes string, command_at timestamp_ntz")
    reviewed = A.review_alerts(alerts, A.valid_review_commands(cmd))
    r = reviewed.first()
    assert (r.status, r.notes, r.reviewed_at) == ("reviewed", "looked at it", dt.datetime(2026, 1, 2))
    changed = A.outbox_events(alerts, reviewed).collect()
    assert [(e.event_type, e.previous_status, e.current_status) for e in changed] == \
        [("status_changed", "open", "reviewed")]
    payload = json.loads(changed[0].payload)
    assert set(payload) == {"alert_level", "generated_at", "reviewed_at", "notes"}
    # a notes-only edit emits nothing
    notes_only = A.review_alerts(reviewed, spark.createDataFrame(
        [(100, "reviewed", "more notes", dt.datetime(2026, 1, 3))], cmd.schema))
    assert A.outbox_events(reviewed, notes_only).count() == 0
    # reopening keeps reviewed_at
    reopened = A.review_alerts(reviewed, spark.createDataFrame(
        [(100, "open", None, dt.datetime(2026, 1, 4))], cmd.schema)).first()
    assert (reopened.status, reopened.reviewed_at, reopened.notes) == ("open", dt.datetime(2026, 1, 2),
                                                                      "looked at it")


def test_f5_highest_rule_wins_and_ties_go_to_higher_id(spark):
    rules = _rules(spark).unionByName(spark.createDataFrame(
        [(9, 7, "Budapest", "high", 25)], "threshold_rule_id long, parameter_id int, city string, "
                                          "warning_level string, min_value int")
        .withColumn("min_value", F.col("min_value").cast("decimal(12,4)")).withColumn("is_active", F.lit(True)))
    readings = spark.createDataFrame([(1, dt.datetime(2026, 1, 1), 5.0, 7, "Budapest"),
                                      (2, dt.datetime(2026, 1, 1), 30.0, 7, "Budapest"),
                                      (3, dt.datetime(2026, 1, 1), 80.0, 7, "Budapest"),
                                      (4, dt.datetime(2026, 1, 1), 80.0, 7, "Pécs")],
                                     "measurement_id long, measured_at timestamp_ntz, value double, "
                                     "parameter_id int, city string")
    got = sorted((r.measurement_id, r.threshold_rule_id) for r in A.generate_alerts(readings, rules).collect())
    assert got == [(2, 9), (3, 4)]  # 5.0 is 'low' (no alert); other city has no rule


def test_f5_rejections(spark):
    loc = spark.createDataFrame([(1, 100.0, 19.04), (2, 47.4979, 19.0402)],
                                "location_id long, latitude double, longitude double")
    rules = {"location": {"C3_latitude_range": QL.ROW_RULES["location"]["C3_latitude_range"]}}
    bad = {r.rule: r.bad_count for r in QL.row_rule_counts({"location": loc}, rules).collect()}
    assert bad == {"C3_latitude_range": 1}
    sensors = spark.createDataFrame([(1,)], "sensor_id long")
    readings = spark.createDataFrame([(10, 1), (11, 999)], "measurement_id long, sensor_id long")
    assert QL.orphans(readings, sensors, ["sensor_id"], ["sensor_id"]).count() == 1
    rules_df = _rules(spark)
    param = spark.createDataFrame([(7, "pm25")], "parameter_id int, code string")
    cmds = spark.createDataFrame([("pm25", "Budapest", "impossible", 5.0, True),
                                  ("pm25", "Budapest", "high", -1.0, True),
                                  ("nope", "Budapest", "high", 30.0, True),
                                  ("pm25", "Budapest", "high", 30.0, False)],
                                 "parameter_code string, city string, warning_level string, min_value double, "
                                 "is_active boolean")
    out = A.threshold_upsert(rules_df.withColumn("updated_at", F.lit(None).cast("timestamp_ntz")), param, cmds,
                             "2026-01-01 00:00:00")
    got = {(r.warning_level, float(r.min_value), r.is_active) for r in out.collect()}
    assert got == {("low", 0.0, True), ("moderate", 10.0, True), ("high", 30.0, False), ("critical", 50.0, True)}


def test_seeded_city_rules_only_for_known_parameters(spark):
    from aerolith.sources import seeds
    param = spark.createDataFrame([(7, "pm25")], "parameter_id int, code string")
    existing = _rules(spark).filter("warning_level = 'low'").withColumn("city", F.lit("Pécs"))
    out = seeds.seed_city_rules(spark, param, existing)
    assert sorted((r.city, r.warning_level, float(r.min_value)) for r in out.collect()) == [
        ("Budapest", "critical", 50.0), ("Budapest", "high", 25.0), ("Budapest", "low", 0.0),
        ("Budapest", "moderate", 10.0)]
    empty = seeds.seed_city_rules(spark, param.filter("code = 'x'"), existing)
    assert empty.count() == 0


def test_review_unknown_id_is_not_found(spark):
    reading = spark.createDataFrame([(100, dt.datetime(2026, 1, 1), 30.0, 7, "Budapest")],
                                    "measurement_id long, measured_at timestamp_ntz, value double, "
                                    "parameter_id int, city string")
    alerts = A.generate_alerts(reading, _rules(spark))
    cmd = spark.createDataFrame([(999, "closed", None, dt.datetime(2026, 1, 2))],
                                "pollution_alert_id long, status string, notes string, command_at timestamp_ntz")
    assert [r.pollution_alert_id for r in A.review_not_found(alerts, cmd).collect()] == [999]
    assert A.review_alerts(alerts, cmd).first().status == "open"


def test_threshold_update_by_id(spark):
    rules = _rules(spark).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    param = spark.createDataFrame([(7, "pm25")], "parameter_id int, code string")
    cmds = spark.createDataFrame([(3, "pm25", "Budapest", "high", 30.0, False),
                                  (42, "pm25", "Budapest", "high", 30.0, True),
                                  (4, "nope", "Budapest", "critical", 60.0, True),
                                  (1, "pm25", "Budapest", "impossible", 1.0, True)],
                                 "threshold_rule_id long, parameter_code string, city string, warning_level string, "
                                 "min_value double, is_active boolean")
    new, rejected = A.threshold_update_by_id(rules, param, cmds, "2026-01-01 00:00:00")
    got = {r.threshold_rule_id: (float(r.min_value), r.is_active, r.updated_at is not None) for r in new.collect()}
    assert got[3] == (30.0, False, True) and got[4] == (50.0, True, False) and len(got) == 4
    assert sorted((r.threshold_rule_id, r.reason) for r in rejected.collect()) == \
        [(1, "invalid"), (4, "invalid"), (42, "not found")]


def test_scope_by_parameter_membership(spark):
    rows = [(1, "Budapest", "Station A", "PM25"), (2, "Budapest", "Station B", "no2"),
            (3, "Debrecen", "Budapest Road", "pm25"), (4, "Pécs", "X", "pm25")]
    df = spark.createDataFrame(rows, "id int, city string, name string, parameter_code string")
    got = sorted(r.id for r in B.in_scope(df, cities=["budapest"], parameters=["pm25"], text_cols=("city", "name"),
                                          parameter_col="parameter_code").collect())
    assert got == [1, 3]  # case-insensitive, substring over the joined place text


def test_city_scope_reads_raw_text_not_defaults(spark):
    body = {"results": [{"id": 7, "name": "", "city": "Szeged", "country": {"name": "Hungary"}},
                        {"id": 8, "locality": "Budapest XI", "name": "Station"}]}
    pages = _pages(spark, [(1, "/v3/locations", "u", None, 1, 1, json.dumps(body))])
    locs = B.parse_locations(B.unnest(pages, B.LOCATION_JSON))
    names = {r.location_id: (r.name, r.city, r.country, r.timezone) for r in locs.collect()}
    assert names[7] == ("OpenAQ location 7", "Szeged", "Hungary", None)
    assert names[8] == ("Station", "Budapest XI", "Unknown", None)
    # the defaulted name is not part of the scope text
    assert [r.location_id for r in B.in_scope(locs, cities=["location"]).collect()] == []
    assert [r.location_id for r in B.in_scope(locs, cities=["budapest"]).collect()] == [8]


def test_split_by_rules_quarantines_with_reasons(spark):
    df = spark.createDataFrame([(1, " ", 12.0), (2, "ug/m3", -5000.0), (3, "ug/m3", 5.0)],
                               "id int, unit string, value double")
    rules = {k: QL.ROW_RULES["measurement_raw"][k] for k in ("C1_unit_not_blank", "C4_value_range")}
    good, bad = QL.split_by_rules(df, rules)
    assert [r.id for r in good.collect()] == [3]
    assert sorted((r.id, tuple(r.broken_rules)) for r in bad.collect()) == \
        [(1, ("C1_unit_not_blank",)), (2, ("C4_value_range",))]


def test_hot_location_sensors_are_paged(spark):
    loc = spark.createDataFrame([(1, 1, "Big", None, "Budapest", "HU", 47.5, 19.0, "UTC")],
                                "location_id long, openaq_location_id long, name string, locality string, "
                                "city string, country string, latitude double, longitude double, timezone string")
    sensors = spark.range(600).select((F.col("id") + 1000).alias("sensor_id"), F.lit(1).cast("long").alias("location_id"),
                                      F.lit(7).alias("parameter_id"), F.lit("ug/m3").alias("unit"))
    param = spark.createDataFrame([(7, "pm25", "PM2.5")], "parameter_id int, code string, display_name string")
    pages = B.location_pages(loc, sensors, param)
    recs = B.unnest(pages.filter(F.col("endpoint") == "/v3/locations"), B.LOCATION_JSON)
    sizes = [r[0] for r in recs.select(F.size(F.col("rec")["sensors"])).collect()]
    assert len(sizes) >= 3 and max(sizes) < 2 * B.PAGE_SIZE  # paged, no single 600-sensor record
    locs = B.parse_locations(recs)
    assert B.distinct_locations(locs).count() == 1
    got = B.sensors_of(locs)
    assert got.count() == 600 and got.select("sensor_id").distinct().count() == 600


def test_parameter_upsert_keeps_description_and_adds_codes(spark):
    cur = spark.createDataFrame([(1, 2, "pm25", "old", "ug/m3", "kept text")],
                                "parameter_id int, openaq_parameter_id int, code string, display_name string, "
                                "preferred_unit string, description string")
    recs = spark.createDataFrame(
        [({"id": 1, "parameter": {"id": 22, "name": "PM25", "units": "µg/m³", "displayName": "PM2.5",
                                  "description": "new text"}},),
         ({"id": 2, "parameter": {"id": 5, "code": "no2", "description": "Nitrogen dioxide"}},),
         ({"id": 3, "parameter": {"units": "ppm"}},)],
        "s struct<id:long, parameter:struct<id:long, name:string, code:string, displayName:string, units:string, "
        "unit:string, description:string>>")
    out = {r.code: r for r in B.upsert_parameters(B.parameters_of(recs), cur).collect()}
    assert set(out) == {"pm25", "no2"}  # the record without name/code is dropped
    assert (out["pm25"].parameter_id, out["pm25"].openaq_parameter_id, out["pm25"].display_name,
            out["pm25"].preferred_unit, out["pm25"].description) == (1, 22, "PM2.5", "ug/m3", "kept text")
    assert (out["no2"].parameter_id, out["no2"].display_name, out["no2"].description,
            out["no2"].preferred_unit) == (2, "NO2", "Nitrogen dioxide", "unknown")


def test_repeated_threshold_commands_give_one_rule_with_an_id(spark):
    rules = _rules(spark).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    param = spark.createDataFrame([(7, "pm25")], "parameter_id int, code string")
    t = dt.datetime(2026, 1, 1)
    cmds = spark.createDataFrame([("pm25", "Eger", "high", 40.0, True, t + dt.timedelta(hours=1)),
                                  ("pm25", "Eger", "high", 90.0, True, t),
                                  ("pm25", "Budapest", "high", 31.0, False, t),
                                  ("pm25", "Budapest", "high", 30.0, True, t + dt.timedelta(hours=1))],
                                 "parameter_code string, city string, warning_level string, min_value double, "
                                 "is_active boolean, command_at timestamp_ntz")
    got = A.threshold_upsert(rules, param, cmds, "2026-01-02 00:00:00").collect()
    ids = [r.threshold_rule_id for r in got]
    assert len(got) == 5 and None not in ids and len(set(ids)) == 5
    assert [(float(r.min_value), r.is_active) for r in got if r.city == "Eger"] == [(40.0, True)]
    assert [(float(r.min_value), r.is_active) for r in got
            if r.city == "Budapest" and r.warning_level == "high"] == [(30.0, True)]


def test_sensor_pages_serve_locations_whose_embedded_sensors_are_out_of_scope(spark):
    sensor = lambda i, n: {"id": i, "unit": "ug/m3", "parameter": {"id": 1, "name": n}}
    body = {"results": [{"id": 7, "name": "A", "city": "Szeged", "sensors": [sensor(1, "no2")]},
                        {"id": 8, "name": "B", "city": "Szeged", "sensors": [sensor(2, "pm25")]}]}
    pages = _pages(spark, [(1, "/v3/locations", "u", None, 1, 1, json.dumps(body))])
    locs = B.parse_locations(B.unnest(pages, B.LOCATION_JSON))
    more = _pages(spark, [(1, "/v3/locations/{id}/sensors", "u", None, 7, 1, json.dumps({"results": [sensor(3, "PM25")]})),
                          (1, "/v3/locations/{id}/sensors", "u", None, 8, 1, json.dumps({"results": [sensor(4, "pm25")]}))])
    got = B.sensors_of(locs, more, parameters=["pm25"])
    assert sorted(r.sensor_id for r in got.collect()) == [2, 3]


def test_pages_are_full_and_numbered_in_time_order(spark):
    ev = spark.range(700).select((F.col("id") * 50).alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                 F.lit("pm25").alias("event_type"), F.lit(1.0).alias("value"), F.lit(None).cast("string")
                                 .alias("props"), F.timestamp_add("SECOND", F.col("id") * 60, F.to_timestamp_ntz(
                                     F.lit("2024-01-01 00:00:00"))).alias("ts"))
    param = spark.createDataFrame([(7, "pm25", "PM2.5")], "parameter_id int, code string, display_name string")
    rows = B.parse_measurements(B.unnest(B.measurement_pages(ev, param), B.MEASUREMENT_JSON)).orderBy("measured_at").collect()
    assert [(r.page_no, r.position) for r in rows] == sorted((r.page_no, r.position) for r in rows)
    sizes = {p: sum(r.page_no == p for r in rows) for p in (1, 2, 3)}
    assert sizes == {1: 250, 2: 250, 3: 200}
