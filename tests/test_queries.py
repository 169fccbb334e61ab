"""Every registered query against its check query, and properties of the plans."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from check import TABLES, rows_of, type_differences

from __spark_entry__ import entry, oracle_sql, queries
from waybill.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    frame = queries()[name](spark, FOLDER)
    got = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan
    if name not in oracle_sql():
        assert got
        return
    cursor = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(frame.columns) == sorted(columns)
    assert type_differences(frame, types) == []
    want = cursor.fetchall()
    assert want, "the input should exercise the query"
    assert rows_of(frame.columns, got) == rows_of(columns, want)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_fixtures_reach_every_branch(duck):
    from waybill.workload import oracle as o
    from waybill.workload.fixtures import ctes

    roles = duck.execute("WITH " + ctes("stg_fedex") + ", " + o.lines("fedex") + ", " + o.FEDEX_ROLES + " SELECT DISTINCT mps_role FROM fx_roles").fetchall()
    assert {r[0] for r in roles} == {"NORMAL_SINGLE", "MPS_HEADER", "MPS_PARENT", "MPS_CHILD"}
    status = duck.execute(oracle_sql()["cost_ledger"]).df()["status"].unique()
    assert {"matched", "unknown", "cost_high", "cost_low"} <= set(status)
    fixed = duck.execute(oracle_sql()["recon_variance_fixed"]).df()
    assert set(fixed["weight_exception_type"]) == {"Normal", "weight_high", "weight_low"}
    dynamic = duck.execute(oracle_sql()["recon_variance_dynamic"]).df()
    assert set(dynamic["cost_exception_type"]) == {"cost_high", "cost_low"}
    assert set(dynamic["weight_exception_type"]) == {"Normal", "weight_high", "weight_low"}
    errors = duck.execute(oracle_sql()["file_route"]).df()
    assert set(errors["error"].dropna()) == {"unsupported carrier", "carrier not registered", "account mismatch"} and "Skip" in set(errors["route"].dropna())
    issues = set(duck.execute(oracle_sql()["threshold_validate"]).df()["issue"])
    assert {"metric_type", "threshold_type", "weight_unit_required", "weight_unit_on_cost", "range_order", "threshold_value", "overlap"} <= issues
