"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as contract
from catalog import check, oracles
from catalog import views as V
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Queries that write as they run; their plan is that of reading the result back.
STREAMS = {"streamed_demand", "streamed_keys", "two_runs_in_one_store", "skill_trend_stream"}


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert check.compare(spark, con, SF_DIR, name) is None


def test_every_query_has_sql():
    assert oracles.oracle_sql().keys() == QUERIES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", ["skill_demand_topk", "latest_batch_demand"])
def test_top_lists_really_cut(spark, con, name):
    sql = contract.oracle_sql()[name].replace("LIMIT 20", "")
    assert len(con.sql(sql).fetchall()) > 20
    assert contract.queries()[name](spark, SF_DIR).count() == 20


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert 0 < len(rows) <= 20
    assert rows == sorted(rows, key=lambda r: (-r["count"], r["skill"]))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    plan = physical_plan(contract.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow",
                 "ExternalRDD"):
        assert node not in plan, plan


@pytest.mark.parametrize("name", ["dedup_postings", "source_caps", "collected_postings"])
def test_first_rows_of_a_group_are_cut_before_the_shuffle(spark, name):
    plan = physical_plan(contract.queries()[name](spark, SF_DIR))
    final, exchange, partial = (plan.index(", Final"), plan.index("Exchange"),
                                plan.index(", Partial"))
    assert "WindowGroupLimit" in plan and final < exchange < partial


def test_documents_are_shuffled_once_for_all_feeds(spark):
    """Of five feeds that hold the documents, four use the shuffle of the first."""
    df = V.all_landed(spark, SF_DIR)
    df.collect()
    plan = physical_plan(df).split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 4 and plan.count("Scan parquet") == 2


@pytest.mark.parametrize("name", ["skill_mentions", "top_skills_per_doc", "match_required_skills",
                                  "skill_list_per_doc", "html_to_text", "category_filter"])
def test_work_on_single_texts_moves_no_data(spark, name):
    plan = physical_plan(contract.queries()[name](spark, SF_DIR))
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["skill_demand_topk", "skill_demand_by_source", "fallback_demand",
                                  "market_top_parts", "gap_summary", "cycle_totals"])
def test_sums_are_combined_before_the_shuffle(spark, name):
    assert "partial_" in physical_plan(contract.queries()[name](spark, SF_DIR))


def test_scans_read_only_what_is_used(spark):
    plan = physical_plan(contract.queries()["source_caps"](spark, SF_DIR))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    plan = physical_plan(contract.queries()["source_selection"](spark, SF_DIR))
    assert "In(source, [src1,src19,src7])" in plan
