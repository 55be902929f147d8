"""Property tests: scalar expressions against a direct Python statement of each rule."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolith.functions import scalars as S

VALUES = st.lists(st.one_of(st.none(), st.decimals(min_value=-20, max_value=200, places=4, allow_nan=False)),
                  min_size=1, max_size=40)
TIMES = st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31)),
                 min_size=1, max_size=40)
TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=3, max_size=3)


def py_risk(v):
    if v is None or v < 0:
        return None
    for code, _label, lo, hi, order in S.RISK_CLASSES:
        if v >= lo and (hi is None or v < hi):
            return order


@settings(max_examples=15, deadline=None)
@given(VALUES)
def test_risk_class_key(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(12,4)")
    got = [r[0] for r in df.select(S.risk_class_key("v")).collect()]
    assert got == [py_risk(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(TIMES)
def test_date_time_keys_weekday_part_of_day(spark, times):
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = df.select(S.date_key("t"), S.time_key("t"), S.iso_weekday("t"), S.part_of_day(F.hour("t"))).collect()
    for (dk, tk, wd, pod), t in zip(got, times):
        assert dk == int(t.strftime("%Y%m%d"))
        assert tk == t.hour * 100 + t.minute
        assert wd == t.isoweekday()
        assert pod == ("night" if t.hour <= 5 else "morning" if t.hour <= 11 else
                       "afternoon" if t.hour <= 17 else "evening")


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_row_hash_skips_nulls(spark, texts):
    df = spark.createDataFrame([tuple(texts)], "a string, b string, c string")
    got = df.select(S.row_hash("a", "b", "c")).first()[0]
    want = hashlib.md5("|".join(t for t in texts if t is not None).encode()).hexdigest()
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="µ³ugm/3abc", max_size=8), min_size=1, max_size=20),
       st.integers(min_value=4, max_value=12))
def test_normalize_unit_and_cap_text(spark, units, cap):
    df = spark.createDataFrame([(u,) for u in units], "u string")
    got = df.select(S.normalize_unit("u"), S.cap_text("u", cap)).collect()
    for (n, c), u in zip(got, units):
        assert n == u.replace("µ", "u").replace("³", "3")
        assert c == (u if len(u) <= cap else u[:cap - 3] + "...")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2035, 12, 31)),
                min_size=1, max_size=30),
       st.sampled_from(["%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%f+00:00",
                        "%Y-%m-%d %H:%M:%S"]))
def test_lenient_timestamp_round_trips(spark, times, fmt):
    texts = [t.strftime(fmt) for t in times]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    got = [r[0] for r in df.select(S.lenient_timestamp("x").cast("timestamp_ntz")).collect()]
    want = [t if "%f" in fmt else t.replace(microsecond=0) for t in times]
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz:-T ", min_size=1, max_size=12), min_size=1, max_size=20))
def test_lenient_timestamp_rejects_junk_without_failing(spark, texts):
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert all(r[0] is None for r in df.select(S.lenient_timestamp("x")).collect())
