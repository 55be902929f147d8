"""The corpus pipeline: five stages over ``documents``, in this order.

1. quality classifier: rows the classifier rejects go
2. SimHash near-dedup: one row of each group of near copies stays
3. benchmark decontamination: contaminated rows go
4. PII: spans of personal data become the name of their kind
5. mixing: rows are emitted as often as their source's target asks

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that
the one before kept; its result is written as Parquet to the shared folder and
read again for the next. Nulls, empty texts, repeated rows, empty tables and
further columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import decontam, mixing, pii, pu, simhash
from aerolith.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pu.accepted(docs, pu.trained(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [("quality classifier", quality), ("near dedup", near_dedup), ("decontamination", decontaminate),
          ("personal data", personal_data), ("mixing", mix)]

#: the classifier's verdicts are not expressible in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
