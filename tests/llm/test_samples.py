"""Bounded samples do not shrink or vanish as tables grow."""

import pytest

from aerolith.llm import common, gru


def test_sample_of_billions_is_not_empty(spark, monkeypatch):
    ids = spark.range(20_000_000).withColumnRenamed("id", "doc_id")
    # as if these ids were part of 5e9: about 2,850 of 5e9 hashes are below the threshold, 11 of these
    monkeypatch.setattr(type(ids), "count", lambda self: 5_000_000_000)
    got = len(common.bounded_sample(ids, "doc_id", 2_500).collect())
    assert 2 <= got <= 30


def test_empty_sample_of_rows_is_an_error(spark, monkeypatch):
    ids = spark.range(0).withColumnRenamed("id", "doc_id")
    assert common.bounded_sample(ids, "doc_id", 10).collect() == []
    monkeypatch.setattr(type(ids), "count", lambda self: 100)
    with pytest.raises(RuntimeError):
        common.bounded_sample(ids, "doc_id", 10)


def test_sample_is_bounded_and_whole_where_small(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "doc_id")
    few, whole = (common.bounded_sample(ids, "doc_id", n).collect() for n in (700, 10_000))
    assert len(few) == 700 and len(whole) == 10_000
    for n in (2_501, 10**7, 3 * 10**9, 10**13):
        assert 2_850 <= (common.threshold(n, 2_500) + (1 << 63) + 1) * n / 2**64 <= 2_852 or n < 2_850


def test_rare_language_is_learned(spark):
    rows = [(i, "common words of the one language", "aa") for i in range(40_000)]
    rows += [(i, "zyx ðþ øø ææ", "zz") for i in range(40_000, 40_004)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert gru.trained(docs).langs == ["aa", "zz"]
    sample = common.bounded_sample(docs, "doc_id", 50, by="lang").groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in sample} == {"aa": 50, "zz": 4}
