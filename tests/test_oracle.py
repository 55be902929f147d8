"""Every registered query against its DuckDB oracle on the small inputs."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import duck, rows_of

ORACLE = E.oracle_sql()
QUERIES = E.queries()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    own = {n for n in ROWS_ONLY if not re.match(r"op\d+_|pipeline$", n)}
    assert own == {"ml_model_metrics", "ml_train_predict"}


SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
               "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert a == b
    # same column types on both sides
    rel = con.sql(ORACLE[name])
    duck_types = {c: str(t).upper() for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["measured_hour", "city", "parameter_code", "unit", "average_value",
                          "measurement_count"]
