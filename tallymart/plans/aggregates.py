"""Aggregation reports: star aggregates, ratios, top-k and filters on aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import calendar as cal
from tallymart.functions.money import TOTAL, percent, ratio, total, units, zero
from tallymart.params import ReportParams
from tallymart.sources.star import Star


def returned_lines(star: Star, *line_cols: str) -> DataFrame:
    """Lines that have returns, with their returned units and columns of the line.

    Returns are summed per line first, so several returns of a line do not
    repeat it.
    """
    per_line = (
        star.returns("line_item_id", "return_quantity")
        .groupBy("line_item_id")
        .agg(units("return_quantity").alias("returned"))
    )
    if "line_date" in line_cols:
        return star.sales_of(per_line)
    return per_line.join(star.lines("line_item_id", *line_cols), "line_item_id")


def monthly_quotas(star: Star, *period: Column) -> DataFrame:
    """Monthly quota targets summed per rep and period."""
    return (
        star["fact_quotas"]
        .filter(F.col("quota_period") == "Monthly")
        .groupBy("sales_rep_id", *period)
        .agg(total("quota_amount").alias("quota_target"))
    )


def gross_revenue_month_country(star: Star, p: ReportParams) -> DataFrame:
    """Revenue before discount per month and customer country."""
    values = star.dated_values(gross=total("gross_amount"))
    return (
        star.with_customer_geo(values, "country_name")
        .groupBy(cal.year("line_date"), cal.month("line_date"), cal.month_name("line_date").alias("month_name"), "country_name")
        .agg(total("gross").alias("gross_revenue"))
        .orderBy("year", "month", "country_name")
    )


def net_revenue_quarter_category(star: Star, p: ReportParams) -> DataFrame:
    """Net revenue per quarter and product category."""
    per_product = (
        star.lines("product_id", "line_date", "net_amount")
        .groupBy("product_id", cal.year("line_date"), cal.quarter("line_date"))
        .agg(total("net_amount").alias("net"))
    )
    return (
        star.with_product_category(per_product)
        .groupBy("year", "quarter", "category_name")
        .agg(total("net").alias("net_revenue"))
        .orderBy("year", "quarter", F.desc("net_revenue"), "category_name")
    )


def _category_margin(star: Star) -> DataFrame:
    """Net revenue, cost and units per category."""
    per_product = (
        star.lines("product_id", "net_amount", "quantity")
        .groupBy("product_id")
        .agg(total("net_amount").alias("net"), units("quantity").alias("sold"))
    )
    return (
        star.with_product_category(per_product, "unit_cost")
        .groupBy("category_name")
        .agg(
            total("net").alias("net_revenue"),
            total(F.col("sold") * F.col("unit_cost")).alias("total_cost"),
            units("sold").alias("units_sold"),
        )
    )


def gross_margin_by_category(star: Star, p: ReportParams) -> DataFrame:
    """Revenue, cost, profit and margin per category."""
    profit = F.col("net_revenue") - F.col("total_cost")
    return (
        _category_margin(star)
        .select(
            "category_name",
            "net_revenue",
            "total_cost",
            profit.cast(TOTAL).alias("gross_profit"),
            percent(profit, "net_revenue", 6).alias("gross_margin_percent"),
        )
        .orderBy(F.desc("gross_margin_percent"), "category_name")
    )


def aov_region_month(star: Star, p: ReportParams) -> DataFrame:
    """Revenue, orders and average order value per region and month."""
    values = star.order_values(net=total("net_amount"))
    grouped = (
        star.with_customer_geo(values, "region_name")
        .groupBy(cal.year("order_date"), cal.month("order_date"), cal.month_name("order_date").alias("month_name"), "region_name")
        .agg(total("net").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))
    )
    return grouped.withColumn("average_order_value", ratio("total_revenue", "total_orders")).orderBy(
        "year", "month", "region_name"
    )


def return_rate_product_quarter(star: Star, p: ReportParams) -> DataFrame:
    """Units sold, returned and return rate per product and quarter of sale."""
    period = (cal.year("line_date"), cal.quarter("line_date"))
    sold = (
        star.lines("product_id", "line_date", "quantity")
        .groupBy("product_id", *period)
        .agg(units("quantity").alias("units_sold"))
    )
    returned = (
        returned_lines(star, "product_id", "line_date")
        .groupBy("product_id", *period)
        .agg(units("returned").alias("returned"))
    )
    rated = (
        sold.join(returned, ["product_id", "year", "quarter"], "left")
        .withColumn("units_returned", zero("returned", "bigint"))
        .withColumn("return_rate_percent", percent("units_returned", "units_sold"))
    )
    return (
        star.with_product(rated, "product_sku", "product_name")
        .select(
            "year",
            "quarter",
            "product_id",
            "product_sku",
            "product_name",
            "units_sold",
            "units_returned",
            "return_rate_percent",
        )
        .orderBy("year", "quarter", F.desc("return_rate_percent"), "product_name", "product_id")
    )


def quota_attainment_rep_month(star: Star, p: ReportParams) -> DataFrame:
    """Revenue against monthly quota per rep and month that has both."""
    actual = (
        star.order_values(net=total("net_amount"))
        .groupBy("sales_rep_id", cal.year("order_date"), cal.month("order_date"), cal.month_name("order_date").alias("month_name"))
        .agg(total("net").alias("actual_revenue"))
    )
    target = monthly_quotas(star, cal.year("quota_date"), cal.month("quota_date"))
    both = actual.join(target, ["sales_rep_id", "year", "month"]).withColumn(
        "quota_attainment_percent", percent("actual_revenue", "quota_target")
    )
    return (
        star.with_rep(both, "employee_code", "rep_name")
        .select(
            "year",
            "month",
            "month_name",
            "sales_rep_id",
            "employee_code",
            "rep_name",
            "actual_revenue",
            "quota_target",
            "quota_attainment_percent",
        )
        .orderBy("year", "month", F.desc("quota_attainment_percent"), "rep_name", "sales_rep_id")
    )


def order_frequency_by_tier(star: Star, p: ReportParams) -> DataFrame:
    """Orders per active customer and quarter, by account tier."""
    per_customer = (
        star["fact_sales_orders"]
        .groupBy("customer_id", cal.year("order_date"), cal.quarter("order_date"))
        .agg(F.count("order_id").alias("orders"))
    )
    return (
        star.with_customer(per_customer, "account_tier")
        .groupBy("account_tier", "year", "quarter")
        .agg(F.count("customer_id").alias("customers_in_tier"), units("orders").alias("total_orders"))
        .withColumn("average_order_frequency", ratio("total_orders", "customers_in_tier"))
        .orderBy("year", "quarter", "account_tier")
    )


def top_products_per_country(star: Star, p: ReportParams) -> DataFrame:
    """The products with most revenue in each country last year; ties go to the lower id."""
    last_year = star.order_lines(*cal.year_days(p.last_year), orders=star.orders_placed("country_name"))
    revenue = last_year.groupBy("country_name", "product_id").agg(total("net_amount").alias("net_revenue"))
    by_revenue = Window.partitionBy("country_name").orderBy(F.desc("net_revenue"), "product_id")
    leaders = revenue.withColumn("product_rank", F.row_number().over(by_revenue)).filter(
        F.col("product_rank") <= p.top_k
    )
    return (
        star.with_product(leaders, "product_sku", "product_name")
        .select("country_name", "product_id", "product_sku", "product_name", "net_revenue", "product_rank")
        .orderBy("country_name", "product_rank")
    )


def customer_retention_by_year(star: Star, p: ReportParams) -> DataFrame:
    """Customers per year, and how many of them had ordered on an earlier day.

    A customer returns in a year when the year's last order is later than the
    first order ever, so two dates per customer and year are enough.
    """
    per_year = (
        star["fact_sales_orders"]
        .groupBy("customer_id", cal.year("order_date"))
        .agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    )
    ever = F.min("first_day").over(Window.partitionBy("customer_id"))
    return (
        per_year.withColumn("returning", (F.col("last_day") > ever).cast("bigint"))
        .groupBy("year")
        .agg(F.count("customer_id").alias("total_customers"), units("returning").alias("returning_customers"))
        .withColumn("retention_rate_percent", percent("returning_customers", "total_customers"))
        .orderBy("year")
    )


def avg_products_per_order_month(star: Star, p: ReportParams) -> DataFrame:
    """Lines per order, by month."""
    return (
        star.order_values(lines=F.count("product_id"))
        .groupBy(cal.year("order_date"), cal.month("order_date"))
        .agg(units("lines").alias("lines"), F.count(F.lit(1)).alias("orders"))
        .select("year", "month", ratio("lines", "orders", 6).alias("avg_products_per_order"))
        .orderBy("year", "month")
    )


def discount_impact_month(star: Star, p: ReportParams) -> DataFrame:
    """Gross, net and the discount between them, by month."""
    return (
        star.lines("line_date", "gross_amount", "net_amount")
        .groupBy(cal.year("line_date"), cal.month("line_date"))
        .agg(
            total("gross_amount").alias("total_gross"),
            total("net_amount").alias("total_net"),
            total(F.col("gross_amount") - F.col("net_amount")).alias("total_discount_value"),
        )
        .orderBy("year", "month")
    )


def top_rep_per_country(star: Star, p: ReportParams) -> DataFrame:
    """The rep with most revenue in each customer country; ties go to the lower id."""
    values = star.order_values(net=total("net_amount"))
    revenue = (
        star.with_customer_geo(values, "country_name")
        .groupBy("country_name", "sales_rep_id")
        .agg(total("net").alias("total_revenue"))
    )
    by_revenue = Window.partitionBy("country_name").orderBy(F.desc("total_revenue"), "sales_rep_id")
    best = revenue.withColumn("place", F.row_number().over(by_revenue)).filter("place = 1")
    return (
        star.with_rep(best, "rep_name")
        .select("country_name", "sales_rep_id", "rep_name", "total_revenue")
        .orderBy("country_name")
    )


def avg_discount_by_category(star: Star, p: ReportParams) -> DataFrame:
    """Mean line discount per category, in percent."""
    per_product = (
        star.lines("product_id", "discount")
        .groupBy("product_id")
        .agg(F.sum(F.col("discount") * 100).alias("rates"), F.count("discount").alias("lines"))
    )
    grouped = (
        star.with_product_category(per_product)
        .groupBy("category_name")
        .agg(total("rates").alias("rates"), units("lines").alias("lines"))
    )
    return grouped.select("category_name", ratio("rates", "lines", 6).alias("avg_discount_percent")).orderBy(
        F.desc("avg_discount_percent"), "category_name"
    )


def yoy_growth_by_country(star: Star, p: ReportParams) -> DataFrame:
    """Revenue per country and year beside the year before that has sales."""
    values = star.dated_values(net=total("net_amount"))
    yearly = (
        star.with_customer_geo(values, "country_name")
        .groupBy("country_name", cal.year("line_date"))
        .agg(total("net").alias("total_revenue"))
    )
    before = F.lag("total_revenue").over(Window.partitionBy("country_name").orderBy("year"))
    return yearly.withColumn("previous_year_revenue", before).withColumn(
        "revenue_growth", (F.col("total_revenue") - F.col("previous_year_revenue")).cast(TOTAL)
    )


def reps_high_revenue_low_attainment(star: Star, p: ReportParams) -> DataFrame:
    """Rep quarters with high revenue that still miss their quota."""
    actual = (
        star.order_values(net=total("net_amount"))
        .groupBy("sales_rep_id", cal.year("order_date"), cal.quarter("order_date"))
        .agg(total("net").alias("net_revenue"))
        .filter(F.col("net_revenue") > p.quarter_revenue_floor)
    )
    target = monthly_quotas(star, cal.year("quota_date"), cal.quarter("quota_date"))
    missed = (
        actual.join(target, ["sales_rep_id", "year", "quarter"])
        .filter(F.col("net_revenue") * 100 < F.col("quota_target") * p.quarter_attainment_cap)
        .withColumn("quota_attainment_percent", percent("net_revenue", "quota_target"))
    )
    return (
        star.with_rep(missed, "employee_code", "rep_name")
        .select(
            "year",
            "quarter",
            "sales_rep_id",
            "employee_code",
            "rep_name",
            "net_revenue",
            "quota_target",
            "quota_attainment_percent",
        )
        .orderBy("year", "quarter", F.desc("net_revenue"), "sales_rep_id")
    )


def low_margin_high_return_categories(star: Star, p: ReportParams) -> DataFrame:
    """Categories with a low margin and a high return rate, both on unrounded ratios."""
    returned = (
        returned_lines(star, "product_id").groupBy("product_id").agg(units("returned").alias("returned"))
    )
    returned = (
        star.with_product_category(returned).groupBy("category_name").agg(units("returned").alias("returned"))
    )
    profit = F.col("net_revenue") - F.col("total_cost")
    grouped = _category_margin(star).join(returned, "category_name", "left")
    grouped = grouped.withColumn("units_returned", zero("returned", "bigint"))
    low_margin = (F.col("net_revenue") > 0) & (profit * 100 < F.col("net_revenue") * p.category_margin_cap)
    many_returns = F.col("units_returned") * 100 > F.col("units_sold") * p.category_return_floor
    return (
        grouped.filter(low_margin & many_returns)
        .select(
            "category_name",
            "net_revenue",
            "total_cost",
            percent(profit, "net_revenue").alias("gross_margin_percent"),
            "units_sold",
            "units_returned",
            percent("units_returned", "units_sold").alias("return_rate_percent"),
        )
        .orderBy("gross_margin_percent", F.desc("return_rate_percent"), "category_name")
    )


def frequent_low_value_customers(star: Star, p: ReportParams) -> DataFrame:
    """Customers with many orders of low average value in the year before ``as_of``."""
    trailing = star.order_values(since=cal.months_before(p.as_of, 12), until=p.as_of, net=total("net_amount"))
    trailing = trailing.filter(F.col("order_date") < F.lit(p.as_of))
    frequent = (
        trailing.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("total_orders"), total("net").alias("total_revenue"))
        .filter(
            (F.col("total_orders") > p.frequent_orders)
            & (F.col("total_revenue") < F.col("total_orders") * p.frequent_value_cap)
        )
        .withColumn("average_order_value", ratio("total_revenue", "total_orders"))
    )
    return (
        star.with_customer(frequent, "customer_code", "account_tier")
        .select(
            "customer_id", "customer_code", "account_tier", "total_orders", "total_revenue", "average_order_value"
        )
        .orderBy(F.desc("total_orders"), "average_order_value", "customer_id")
    )
