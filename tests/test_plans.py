"""Physical plans: no cross joins, pruned scans, top-k cut before the shuffle."""

import os
import re

import pytest

import __spark_entry__ as entry_file

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not present")
EAGER = {"st1_cart_stream", "st2_request_stream", "st6_hot_reload"}  # their plan is the collected output


def plan(spark, name):
    return entry_file.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(entry_file.queries()) - EAGER))
def test_no_cross_joins(spark, name):
    text = plan(spark, name).split("== Physical Plan ==")[1]
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scans_are_pruned_and_filtered(spark):
    text = plan(spark, "p1_checkout")
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "struct<p_partkey:bigint,p_retailprice:double>" in text
    text = plan(spark, "src6_cart_read")
    assert "LessThan(c_acctbal,0.0)" in text


@pytest.mark.parametrize("name", ["l4_sample", "t1_token_search", "t2_vector_search"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize("name", ["p3_reconciliation", "p1_order_documents"])
def test_orders_are_priced_once(spark, name):
    """Lines and catalog are scanned by one branch of the executed plan; the others reuse its shuffle."""
    found = entry_file.queries()[name](spark, FOLDER)
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for column in ("l_orderkey", "p_partkey"):
        assert len(re.findall(rf"FileScan parquet \[{column}#", final)) == 1
    assert "ReusedExchange" in final


def test_metrics_page_scans_the_log_once(spark):
    assert plan(spark, "snk5_metrics_text").split("== Physical Plan ==")[1].count("FileScan parquet") == 1
