"""Plan shape: pruning, pushdown, no nested-loop or cartesian joins (V4)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
PLANNED = sorted(n for n in QUERIES if not n.startswith(("ml_", "stream_")))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs


def test_time_bounds_prune_month_partitions(spark):
    plan = _plan(QUERIES["measurements_filtered"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(measured_month" in plan
    assert "measured_month#" in plan and ">= 2024-01-01" in plan
    assert "PushedFilters: [IsNotNull(measured_at), GreaterThanOrEqual(measured_at" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["hourly_series"](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert scans and not any("raw_payload" in ln for ln in scans)


def test_alert_bands_join_is_hash_join(spark):
    plan = _plan(QUERIES["alert_generation"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "band_lo" in plan


def test_a_filter_on_the_date_dimension_prunes_months(spark):
    plan = _plan(QUERIES["weekend_readings_by_quarter"](spark, SF_SMALL))
    scan = next(ln for ln in plan.splitlines() if "by_month" in ln and "PartitionFilters" in ln)
    assert "dynamicpruningexpression(measured_month" in scan


def test_newest_time_reads_the_last_month_only(spark):
    plan = _plan(QUERIES["watermark_bound"](spark, SF_SMALL))
    assert any("PartitionFilters: [isnotnull(measured_month" in ln and "Subquery" in ln for ln in plan.splitlines())


def test_keys_and_references_are_one_shuffle(spark):
    from aerolith.operators import quality as QL
    from aerolith.sources.driver_tables import core
    c = core(spark, SF_SMALL)
    tables = {"location": c.location, "parameter": c.parameter, "sensor": c.sensor, "measurement_raw": c.measurement}
    plan = _plan(QL.key_rule_counts(tables))
    # one for (constraint, key), one for the counts a constraint; the rules' names are joined to these
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("hashpartitioning(id#") >= 1
