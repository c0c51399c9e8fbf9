"""Every registered query against its SQL, and what their plans may not contain."""

import os

import pytest

import __spark_entry__ as entry_module
import compare
from batchlake.oracles import ORACLES
from batchlake.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_is_checked():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["validate_split", "curated_rows", "load_valid_rows", "upsert_customers", "quality_report",
     "run_attribution", "threshold_alarms", "fk_orphans", "order_total_mismatch"],
)
def test_no_python_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(QUERIES["financial_totals"](spark, SF))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and all("o_orderdate" not in s.split("ReadSchema")[1] for s in scans)


def test_repeated_ids_shuffle_is_reused(spark):
    frame = QUERIES["validate_split"](spark, SF)
    frame.collect()
    assert "ReusedExchange" in _plan(frame)
