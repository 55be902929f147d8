"""Texts reach Python workers in batches bounded by bytes, not only by rows."""

import pyarrow as pa
from pyspark.sql import functions as F

from aerolith.llm.common import flagged, mapped
from aerolith.session import BATCH_CONF, BATCH_MB


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    spark.conf.unset(BATCH_CONF)
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab c"), 1000).alias("text"))

    def size(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["b", "n"])
    sizes = mapped(docs, size, "b long, n long").collect()
    assert sum(r.n for r in sizes) == 4000
    assert max(r.b for r in sizes) <= (BATCH_MB << 20) + 100_000  # 16 MB in one batch before
    assert flagged(docs, lambda batch: [i % 2 == 0 for i in batch.column("doc_id").to_pylist()]).count() == 2000


def test_a_lower_limit_stays(spark):
    spark.conf.set(BATCH_CONF, "100k")
    mapped(spark.range(1), lambda batch: batch, "id long")
    assert spark.conf.get(BATCH_CONF) == "100k"
    spark.conf.unset(BATCH_CONF)
