"""The generated mart: goldens, rules, sinks, and reports on a second star."""

from __future__ import annotations

import re
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart import ReportParams, load_star, schema
from tallymart.plans import aggregates, basic, joins, quality, views
from tallymart.plans.catalog import REPORTS
from tallymart.sinks import writer
from tallymart.sources import generate
from tallymart.sources.star import Star

AS_OF = date(2024, 7, 1)
P = ReportParams(as_of=AS_OF)


@pytest.fixture(scope="module")
def mart_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("mart"))
    writer.replace_all(generate.generate_star(spark, AS_OF), path)
    return path


@pytest.fixture(scope="module")
def star(spark, mart_path):
    return load_star(spark, mart_path)


def test_declared_schemas(star):
    for table in schema.TABLES:
        assert star[table].columns == schema.columns_of(table)
        assert [f.dataType for f in star[table].schema] == [f.dataType for f in schema.schema_of(table)]


def test_row_counts(star):
    counts = {r["table_name"]: r["row_count"] for r in quality.table_row_counts(star, P).collect()}
    days = (AS_OF - date(2021, 1, 1)).days + 1
    assert counts == {
        "dim_regions": 20,
        "dim_categories": 18,
        "dim_date": days,
        "dim_sales_reps": 50,
        "dim_customers": 500,
        "dim_products": 200,
        "fact_sales_orders": 5000,
        "fact_order_line_items": 12500,
        "fact_returns": 500,
        "fact_quotas": 50 * 43,
        "rep_customer_assignments": 650,
        "product_promotions": 120,
    }


def test_goldens(star):
    lines, returns = star["fact_order_line_items"], star["fact_returns"]
    assert lines.agg(F.sum("quantity")).first()[0] == 37500
    assert returns.agg(F.sum("return_quantity")).first()[0] == 600
    assert joins.multi_product_orders(star, P).count() == 3750
    assert joins.orphan_customers(star, P).count() == 0
    assert joins.rep_customer_mismatch(star, P).count() == 416
    assert basic.active_products_never_ordered(star, P).count() == 0
    assert basic.high_margin_products(star, P).count() == 50
    assert basic.products_name_contains(star, P).count() == 75
    assert [r[0] for r in basic.reps_without_recent_assignment(star, P).orderBy("sales_rep_id").collect()] == list(range(46, 51))
    top = basic.top_products_by_quantity(star, P).collect()
    assert [(r["product_id"], r["total_quantity_sold"]) for r in top] == [(i, 350) for i in range(1, 200, 20)]
    late = star["fact_sales_orders"].filter("order_status <> 'Cancelled' and datediff(ship_date, order_date) > 14")
    assert late.count() == 1500
    promotions = star["product_promotions"]
    assert promotions.select("product_id").distinct().count() == 120
    assert promotions.select("valid_from", "valid_to").distinct().count() == 12


def test_week_numbers_are_iso(star):
    day = star["dim_date"].filter("full_date = date'2021-01-03'").first()
    assert (day["week_number"], day["day_of_week"], day["is_business_day"]) == (53, 7, False)


def test_rules_hold(star):
    for check in (quality.dq_primary_key, quality.dq_unique, quality.dq_foreign_key, quality.dq_check, quality.dq_orphan_facts):
        assert check(star, P).filter("violations > 0").collect() == []
    assert quality.dq_over_returned_lines(star, P).count() == 0
    assert quality.dq_overlapping_assignments(star, P).count() == 0
    assert quality.dq_orders_without_lines(star, P).count() == 0
    assert quality.dq_date_coverage(star, P).filter("days_missing > 0").count() == 0
    assert quality.dq_cancelled_exclusion(star, P).filter("diff <> 0").count() == 0
    assert quality.dq_customer_name_shape(star, P).count() == 500
    assert quality.dq_customer_name_shape(star, P, violations=True).count() == 0


def _broken(star: Star, **tables) -> Star:
    return Star({t: tables.get(t, star[t]) for t in schema.TABLES})


def test_rules_find_planted_faults(spark, star):
    lines = star["fact_order_line_items"]
    twice = lines.unionByName(lines.filter("order_id = 4"))  # four lines once more
    orphan = star["fact_sales_orders"].withColumn(
        "customer_id", F.when(F.col("order_id") <= 3, F.lit(999999)).otherwise(F.col("customer_id"))
    )
    cheap = star["dim_products"].withColumn(
        "list_price", F.when(F.col("product_id") <= 2, F.lit(1).cast("decimal(18,2)")).otherwise(F.col("list_price"))
    )
    bad = _broken(star, fact_order_line_items=twice, fact_sales_orders=orphan, dim_products=cheap)
    keys = {r["table_name"]: r["violations"] for r in quality.dq_primary_key(bad, P).collect()}
    assert keys["fact_order_line_items"] == 4 and sum(keys.values()) == 4
    refs = {r["constraint"]: r["violations"] for r in quality.dq_foreign_key(bad, P).filter("violations > 0").collect()}
    assert refs == {"customer_id -> dim_customers.customer_id": 3}
    rules = {r["constraint"]: r["violations"] for r in quality.dq_check(bad, P).filter("violations > 0").collect()}
    assert rules == {"price_covers_cost": 2}


def test_corrected_attainment_has_no_fan_out(star):
    plain = {r["sales_rep_id"]: r for r in REPORTS["rep_attainment_rank"](star, P).collect()}
    from tallymart.plans.advanced import rep_attainment_rank

    fixed = {r["sales_rep_id"]: r for r in rep_attainment_rank(star, P, corrected=True).collect()}
    assert plain.keys() == fixed.keys()
    assert all(plain[k]["actual_revenue"] == 12 * fixed[k]["actual_revenue"] for k in fixed)


def test_quota_edge_rows(star):
    """A rep without quotas stays with a zero quota; a rep with other years only is left out."""
    quotas = star["fact_quotas"].filter("sales_rep_id <> 1 and not (sales_rep_id = 2 and year(quota_date) = 2024)")
    thin = _broken(star, fact_quotas=quotas)
    rows = {r["sales_rep_id"]: r for r in views.vw_dm_rep_portfolio_quality(thin, P).collect()}
    assert 2 not in rows
    assert rows[1]["quota_amount"] == 0 and rows[1]["attainment_percentage"] is None
    assert rows[1]["actual_revenue"] > 0


def test_lines_dated_apart_from_their_order(star):
    """Reports on the line date follow the line, and an order counts once per month it touches."""
    moved = star["fact_order_line_items"].withColumn("line_date", F.date_add("line_date", F.col("quantity") * 20))
    shifted = _broken(star, fact_order_line_items=moved)
    lines = moved.join(star["fact_sales_orders"].select("order_id", "customer_id", "order_status"), "order_id")
    lines = star.with_customer_geo(lines.filter("order_status <> 'Cancelled'"), "country_name")
    expected = lines.groupBy(F.trunc("line_date", "month").alias("m"), "country_name").agg(
        F.countDistinct("order_id").alias("o"), F.sum("net_amount").alias("n")
    )
    got = views.vw_summary_monthly_trend(shifted, P)
    want = {(r["m"], r["country_name"]): (r["o"], r["n"]) for r in expected.collect()}
    assert {(r["period_start_date"], r["country_name"]): (r["order_volume"], r["net_revenue"]) for r in got.collect()} == want
    assert aggregates.discount_impact_month(shifted, P).count() == moved.select(F.trunc("line_date", "month")).distinct().count()


def test_date_ids_become_dates(spark, star, mart_path, tmp_path):
    """A mart that stores ids of its date dimension reads like one that stores dates."""
    for table in schema.TABLES:
        df = star[table]
        for id_col, date_col in {
            "fact_sales_orders": {"order_date_id": "order_date", "ship_date_id": "ship_date"},
            "fact_order_line_items": {"date_id": "line_date"},
            "fact_returns": {"date_id": "return_date"},
            "fact_quotas": {"date_id": "quota_date"},
        }.get(table, {}).items():
            df = df.withColumn(id_col, F.date_format(date_col, "yyyyMMdd").cast("int")).drop(date_col)
        df.write.parquet(str(tmp_path / table))
    again = load_star(spark, str(tmp_path))
    for table in ("fact_sales_orders", "fact_quotas"):
        assert again[table].exceptAll(star[table]).count() == 0


def test_views_register_and_drop(spark, star):
    names = writer.register_views(star, P)
    assert spark.sql("SELECT count(*) FROM vw_monthly_trend").first()[0] > 0
    assert writer.drop_views(spark) == names[::-1]
    assert writer.drop_views(spark) == []


def test_snapshots_keep_other_days(spark, star, tmp_path):
    path = str(tmp_path)
    writer.materialize_views(star, P, path, ["vw_product_performance"])
    later = ReportParams(as_of=date(2024, 7, 2))
    writer.materialize_views(star, later, path, ["vw_product_performance"])
    writer.materialize_views(star, later, path, ["vw_product_performance"])
    sold = views.vw_product_performance(star, P).count()
    for day in (AS_OF, later.as_of):
        assert writer.read_snapshot(spark, path, "vw_product_performance", day).count() == sold


def test_layout_joins_without_shuffle(spark, star, tmp_path):
    writer.layout_tables(star, "laid_out", str(tmp_path), buckets=4)
    laid = writer.load_layout(spark, "laid_out")
    # Without size-based broadcast, as for large tables.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = laid.order_values(net=F.sum("net_amount"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        want = star.order_values(net=F.sum("net_amount")).agg(F.sum("net")).first()[0]
        assert joined.agg(F.sum("net")).first()[0] == want > Decimal(0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        writer.drop_layout(spark, "laid_out")


def test_generator_repeats_and_scales(spark):
    a = generate.gen_customers(spark, AS_OF, 50, seed=7)
    assert a.exceptAll(generate.gen_customers(spark, AS_OF, 50, seed=7)).count() == 0
    assert a.select("customer_name").exceptAll(generate.gen_customers(spark, AS_OF, 50, seed=8).select("customer_name")).count() > 0
    size = generate.MartSize(reps=100, open_reps=90, customers=2000, reassigned=600, products=800, orders=20000, returns=2000)
    big = generate.generate_star(spark, AS_OF, size)
    assert big["fact_order_line_items"].count() == 50000
    assert big["fact_returns"].count() == 2000
    assert quality.dq_foreign_key(big, P).filter("violations > 0").count() == 0


def test_layout_prunes_months(spark, star, tmp_path):
    """A report of one quarter reads that quarter's folders of orders and lines only."""
    writer.layout_tables(star, "monthly", str(tmp_path), buckets=2)
    try:
        laid = writer.load_layout(spark, "monthly")
        for table in schema.TABLES:
            assert laid[table].count() == star[table].count()
        report = basic.open_orders_q3(laid, P)
        assert sorted(report.collect()) == sorted(basic.open_orders_q3(star, P).collect())
        plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        pruned = [f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) if writer.MONTH in f]
        assert len(pruned) == 2 and all(f">= {P.last_year}-07-01" in f for f in pruned)
    finally:
        writer.drop_layout(spark, "monthly")


def test_a_stale_snapshot_is_refused(spark, star, tmp_path):
    path = str(tmp_path)
    writer.materialize_views(star, P, path, ["vw_rep_performance_scorecard", "vw_product_performance"])
    for name, days in (("vw_rep_performance_scorecard", 0), ("vw_product_performance", 1)):
        assert writer.read_current(spark, path, name, AS_OF + timedelta(days=days)).count() > 0
        with pytest.raises(writer.StaleSnapshot):
            writer.read_current(spark, path, name, AS_OF + timedelta(days=days + 1))


def test_open_findings_hold_back_the_scorecard(spark, star, tmp_path):
    windows = star["rep_customer_assignments"]
    twice = windows.unionByName(windows.withColumn("assignment_id", F.col("assignment_id") + 10**6))
    broken = Star({t: star[t] for t in schema.TABLES} | {"rep_customer_assignments": twice})
    with pytest.raises(writer.PublicationBlocked):
        writer.materialize_views(broken, P, str(tmp_path), ["vw_product_performance", "vw_rep_performance_scorecard"])
    assert not list(tmp_path.iterdir())
    writer.materialize_views(broken, P, str(tmp_path), ["vw_rep_performance_scorecard"], gated=False)
