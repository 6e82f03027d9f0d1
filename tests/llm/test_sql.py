"""The queries that SQL can express, against their SQL on the smallest tables."""

import os

import pytest

from catalog import check
from jobsignal.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name, monkeypatch):
    monkeypatch.setattr(check, "QUERIES", QUERIES)
    monkeypatch.setattr(check, "oracle_sql", lambda: ORACLE_SQL)
    assert check.compare(spark, con, SF_DIR, name) is None


def test_license_scan_stays_in_the_jvm(spark):
    plan = QUERIES["op3_license_scan"](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    for node in ("EvalPython", "InPandas", "InArrow", "ExternalRDD", "CartesianProduct"):
        assert node not in plan.toString()
