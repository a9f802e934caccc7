"""What the plans must and must not hold."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tallymart import conform
from tallymart.plans.catalog import REPORTS
from tallymart.plans.views import PREVIEWS

QUERIES = entry.queries()
PLANNED = sorted(REPORTS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_product_no_python_no_window_over_everything(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "MapInPandas" not in plan
    # A window without a partition key would put all rows in one task.
    assert not re.search(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_top_k_is_cut_before_the_shuffle(spark, sf_dir):
    for name in ("top_products_per_country", "top_rep_per_country", "top3_customers_country_quarter"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_products_by_quantity"](spark, sf_dir))


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["monthly_country_trend"](spark, sf_dir))
    line_scan = next(s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in s)
    assert {re.sub(r"#\d+L?", "", c) for c in line_scan.split(",")} == {"l_orderkey", "l_extendedprice", "l_discount"}
    returns = plan_of(QUERIES["returns_detail"](spark, sf_dir))
    assert "EqualTo(l_returnflag,R)" in returns


def test_lines_are_summed_before_they_meet_orders(spark, sf_dir):
    plan = plan_of(QUERIES["sales_per_rep"](spark, sf_dir))
    assert plan.index("BroadcastHashJoin") < plan.index("partial_sum(net_amount")


def test_every_preview_is_registered():
    assert {f"preview_{v}" for v in PREVIEWS} <= set(QUERIES)


def _final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def _line_scans(plan: str) -> int:
    return sum("l_orderkey" in s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan))


@pytest.fixture
def no_broadcast(spark):
    """Tables as they would be at a hundred times the size: none is broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize(
    ("name", "scans"),
    [
        ("customer_lifetime_rank", 1),
        ("rep_attainment_rank", 1),
        ("vw_dm_rep_portfolio_quality", 1),
        ("customer_360_candidate", 2),
        ("vw_customer_360", 2),
        ("vw_product_performance", 3),
        ("vw_returns_analysis", 2),
    ],
)
def test_lines_are_scanned_no_more_than_needed(spark, sf_dir, no_broadcast, name, scans):
    """Once for sales and once for returns; the place in the category reads its sales twice."""
    assert _line_scans(_final_plan(REPORTS[name](conform(spark, sf_dir), entry.PARAMS))) <= scans


@pytest.mark.parametrize("name", PLANNED)
def test_building_a_report_starts_no_job(spark, sf_dir, name):
    star = entry._star(spark, sf_dir)
    REPORTS[name](star, entry.PARAMS)  # reads the files' schemas
    spark.sparkContext.setJobGroup("building", name)
    try:
        REPORTS[name](star, entry.PARAMS)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
