"""Basic reports: filters, counts, sums and anti joins over one or two facts.

Every report is ``report(star, params) -> DataFrame``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import calendar as cal
from tallymart.functions.money import percent, ratio, total, units
from tallymart.params import ReportParams
from tallymart.sources.star import Star


def gold_customers_in_country(star: Star, p: ReportParams) -> DataFrame:
    """Customers of one country and tier above a credit floor."""
    wanted = star["dim_customers"].filter((F.col("account_tier") == p.tier) & (F.col("credit_limit") > p.min_credit))
    return (
        star.with_region(wanted, "country_name", "region_name", "territory_name")
        .filter(F.col("country_name") == p.country)
        .select(
            "customer_id",
            "customer_code",
            "customer_type",
            "customer_group",
            "account_tier",
            "credit_limit",
            "country_name",
            "region_name",
            "territory_name",
        )
        .orderBy(F.desc("credit_limit"), "customer_id")
    )


def open_orders_q3(star: Star, p: ReportParams) -> DataFrame:
    """Orders of one quarter of last year that are not fully delivered, with their value."""
    first, last = cal.quarter_days(p.last_year, p.quarter)
    in_quarter = star.order_values(since=first, until=last, total_order_value=total("net_amount"))
    open_orders = in_quarter.filter(F.col("order_status").isin(*p.open_statuses))
    return (
        star.with_customer(open_orders, "customer_code")
        .select("order_id", "customer_code", "order_date", "order_status", "total_order_value")
        .orderBy(F.desc("order_date"), F.desc("total_order_value"), "order_id")
    )


def high_margin_products(star: Star, p: ReportParams) -> DataFrame:
    """Products listed above a multiple of their cost."""
    margin = F.col("list_price") - F.col("unit_cost")
    return (
        star["dim_products"]
        .filter(F.col("list_price") > F.col("unit_cost") * p.margin_factor)
        .select(
            "product_id",
            "product_sku",
            "product_name",
            "brand",
            "product_type",
            "unit_cost",
            "list_price",
            margin.cast("decimal(18,2)").alias("margin_amount"),
            percent(margin, "list_price", 6).alias("margin_percent"),
        )
        .orderBy(F.desc("margin_percent"), "product_id")
    )


def reps_without_recent_assignment(star: Star, p: ReportParams) -> DataFrame:
    """Reps with no assignment window that reaches into the last months."""
    since = cal.months_before(p.as_of, p.idle_months)
    busy = (
        star["rep_customer_assignments"]
        .filter(
            (F.col("valid_from") <= F.lit(p.as_of)) & (F.col("valid_to").isNull() | (F.col("valid_to") >= since))
        )
        .select("sales_rep_id")
        .distinct()
    )
    return (
        star["dim_sales_reps"]
        .join(busy, "sales_rep_id", "left_anti")
        .select("sales_rep_id", "employee_code", "rep_name", "job_title")
        .orderBy("rep_name", "sales_rep_id")
    )


def late_shipments_country(star: Star, p: ReportParams) -> DataFrame:
    """Orders of one country shipped more than some days after the order."""
    delay = F.datediff("ship_date", "order_date")
    late = star["fact_sales_orders"].filter(F.col("ship_date").isNotNull() & (delay > p.late_days))
    return (
        star.with_customer_geo(late, "country_name", customer=("customer_code",))
        .filter(F.col("country_name") == p.late_country)
        .select(
            "order_id",
            "customer_code",
            "country_name",
            "order_date",
            "ship_date",
            delay.alias("delay_days"),
            "order_status",
        )
        .orderBy(F.desc("delay_days"), F.desc("order_date"), "order_id")
    )


def products_name_contains(star: Star, p: ReportParams) -> DataFrame:
    """Products whose name holds any of some parts, in any letter case."""
    hit = F.lit(False)
    for part in p.name_parts:
        hit = hit | F.contains(F.lower("product_name"), F.lit(part.lower()))
    return (
        star["dim_products"]
        .filter(hit)
        .select("product_id", "product_sku", "product_name", "brand", "product_type", "unit_cost", "list_price")
        .orderBy("product_name", "product_id")
    )


def customers_per_country(star: Star, p: ReportParams) -> DataFrame:
    """Customer count per country."""
    per_region = star["dim_customers"].groupBy("region_id").agg(F.count("customer_id").alias("n"))
    return (
        star.with_region(per_region, "country_name")
        .groupBy("country_name")
        .agg(units("n").alias("total_customers"))
        .orderBy(F.desc("total_customers"), "country_name")
    )


def sales_per_rep(star: Star, p: ReportParams) -> DataFrame:
    """Net sales per rep, orders of every status."""
    per_rep = (
        star.order_values(net=total("net_amount")).groupBy("sales_rep_id").agg(total("net").alias("total_sales"))
    )
    return (
        star.with_rep(per_rep, "rep_name")
        .select("sales_rep_id", "rep_name", "total_sales")
        .orderBy(F.desc("total_sales"), "sales_rep_id")
    )


def orders_per_month_last_year(star: Star, p: ReportParams) -> DataFrame:
    """Order count per month of last year."""
    return (
        star["fact_sales_orders"]
        .filter(cal.in_year("order_date", p.last_year))
        .groupBy(cal.year("order_date"), cal.month("order_date"))
        .agg(F.count("order_id").alias("total_orders"))
        .orderBy("month")
    )


def top_products_by_quantity(star: Star, p: ReportParams) -> DataFrame:
    """The products sold in the largest quantity; ties go to the lower id."""
    leaders = (
        star.lines("product_id", "quantity")
        .groupBy("product_id")
        .agg(units("quantity").alias("total_quantity_sold"))
        .orderBy(F.desc("total_quantity_sold"), "product_id")
        .limit(p.top_k)
    )
    return (
        star.with_product(leaders, "product_name")
        .select("product_id", "product_name", "total_quantity_sold")
        .orderBy(F.desc("total_quantity_sold"), "product_id")
    )


def active_products_never_ordered(star: Star, p: ReportParams) -> DataFrame:
    """Active products without any order line."""
    sold = star.lines("product_id").distinct()
    return (
        star["dim_products"]
        .filter("is_active")
        .join(sold, "product_id", "left_anti")
        .select("product_id", "product_sku", "product_name", "brand", "list_price", "stock_level")
        .orderBy(F.desc("stock_level"), "product_name", "product_id")
    )


def avg_line_value_per_customer(star: Star, p: ReportParams) -> DataFrame:
    """Average net value of a customer's lines, reported as ``avg_order_value``."""
    values = star.order_values(net=total("net_amount"), lines=F.count(F.lit(1)))
    return (
        values.groupBy("customer_id")
        .agg(total("net").alias("net"), units("lines").alias("lines"))
        .select("customer_id", ratio("net", "lines", 6).alias("avg_order_value"))
    )
