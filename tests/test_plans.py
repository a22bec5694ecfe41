"""Static checks on the physical plans of every registered query."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
SIDE_EFFECTS = {"csv_roundtrip", "load_reconciliation", "incremental_ingest", "load_rejects", "rejected_lines", "load_accepted", "landing_report"}
KEYS = [k for k in entry_mod.queries() if k not in SIDE_EFFECTS]


@pytest.fixture(scope="module")
def plans(spark):
    qs = entry_mod.queries()
    return {k: qs[k](spark, SF)._jdf.queryExecution().executedPlan().toString() for k in KEYS}


@pytest.mark.parametrize("key", KEYS)
def test_no_python_no_cross_join(plans, key):
    plan = plans[key]
    # no Python in the plan, no all-pairs joins, no sort-based aggregation of the big data
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate"):
        assert bad not in plan, f"{key}: {bad}"


# The canonical chain keeps audit rows, so it never needs event_type (which
# only feeds DESC): column pruning must remove it from every events scan.
CANONICAL = ["staging", "diff_abs", "station_list", "hourly_clean", "cohort_summary", "station_compare", "kpi"]


@pytest.mark.parametrize("key", CANONICAL)
def test_scans_are_pruned(plans, key):
    scans = [line for line in plans[key].splitlines() if "events.parquet" in line and "ReadSchema" in line]
    assert scans
    for line in scans:
        assert "event_type" not in line.split("ReadSchema")[1]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["cohort", "date", "entries", "exits", "entries_ma", "exits_ma"]


def test_every_core_query_has_an_oracle():
    """The training-data queries, where SQL cannot express all, have their own tests."""
    from odoflow.plans.catalog import ORACLE, QUERIES

    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_mod.queries())
