"""Join reports: wide star joins, validity joins, anti joins and a rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions import calendar as cal
from tallymart.functions.money import MONEY, TOTAL, percent, ratio, total
from tallymart.operators.intervals import covering
from tallymart.params import ReportParams
from tallymart.sources.star import Star


def full_order_summary(star: Star, p: ReportParams) -> DataFrame:
    """One row per line with its order, customer, geography, rep, product and dates."""
    orders = star.orders_placed(
        "country_name",
        "region_name",
        "territory_name",
        customer=("customer_code", "customer_type", "customer_group", "account_tier"),
    )
    orders = star.with_rep(orders, "employee_code", "rep_name", "job_title")
    wide = star.with_product(star.order_lines(orders=orders), "product_sku", "product_name", "brand", "product_type")
    return wide.select(
        "order_id",
        "line_item_id",
        "order_date",
        "ship_date",
        "order_status",
        "payment_terms",
        "document_type",
        "sales_org",
        "distribution_channel",
        "customer_id",
        "customer_code",
        "customer_type",
        "customer_group",
        "account_tier",
        "country_name",
        "region_name",
        "territory_name",
        "sales_rep_id",
        "employee_code",
        "rep_name",
        "job_title",
        "product_id",
        "product_sku",
        "product_name",
        "brand",
        "product_type",
        "quantity",
        "unit_price",
        "discount",
        "gross_amount",
        "net_amount",
    ).orderBy("order_id", "line_item_id")


def orphan_customers(star: Star, p: ReportParams) -> DataFrame:
    """Customers without any order."""
    buyers = star["fact_sales_orders"].select("customer_id").distinct()
    orphans = star["dim_customers"].join(buyers, "customer_id", "left_anti")
    return (
        star.with_region(orphans, "country_name", "region_name", "territory_name")
        .select(
            "customer_id",
            "customer_code",
            "customer_type",
            "customer_group",
            "customer_status",
            "account_tier",
            "credit_limit",
            "is_active",
            "created_at",
            "country_name",
            "region_name",
            "territory_name",
        )
        .orderBy("country_name", "customer_code")
    )


def rep_customer_mismatch(star: Star, p: ReportParams) -> DataFrame:
    """Orders handled by another rep than one assigned to the customer on the order date."""
    orders = star["fact_sales_orders"].select(
        "order_id", "customer_id", F.col("sales_rep_id").alias("processing_sales_rep_id"), "order_date", "order_status"
    )
    windows = star["rep_customer_assignments"].select(
        "customer_id", F.col("sales_rep_id").alias("assigned_sales_rep_id"), "valid_from", "valid_to"
    )
    assigned = covering(orders, windows, "customer_id", "order_date")
    mismatched = assigned.filter(F.col("processing_sales_rep_id") != F.col("assigned_sales_rep_id"))

    def reps(role: str) -> DataFrame:
        names = {"sales_rep_id": "sales_rep_id", "employee_code": "employee_code", "rep_name": "rep_name"}
        return star["dim_sales_reps"].select(*[F.col(c).alias(f"{role}_{n}") for c, n in names.items()])

    return (
        star.with_customer(mismatched, "customer_code", "account_tier")
        .join(reps("processing"), "processing_sales_rep_id")
        .join(reps("assigned"), "assigned_sales_rep_id")
        .select(
            "order_id",
            "customer_id",
            "customer_code",
            "account_tier",
            "processing_sales_rep_id",
            "processing_employee_code",
            "processing_rep_name",
            "assigned_sales_rep_id",
            "assigned_employee_code",
            "assigned_rep_name",
            "order_date",
            "order_status",
        )
        .orderBy(F.desc("order_date"), "customer_code", "order_id", "assigned_sales_rep_id")
    )


def rep_customer_mismatch_top(star: Star, p: ReportParams, k: int = 100) -> DataFrame:
    """The newest mismatches."""
    return rep_customer_mismatch(star, p).limit(k)


def revenue_rollup_geography(star: Star, p: ReportParams) -> DataFrame:
    """Revenue per country, region and territory with labelled subtotals.

    Revenue is summed per region row first; the rollup then works on as many
    rows as there are regions.
    """
    values = star.with_customer(star.order_values(net=total("net_amount")), "region_id")
    per_region = values.groupBy("region_id").agg(total("net").alias("net"))
    named = star.with_region(per_region, "country_name", "region_name", "territory_name")
    rolled = named.rollup("country_name", "region_name", "territory_name").agg(total("net").alias("total_revenue"))
    return rolled.orderBy(
        F.asc_nulls_first("country_name"), F.asc_nulls_first("region_name"), F.asc_nulls_first("territory_name")
    ).select(
        F.coalesce("country_name", F.lit("GRAND TOTAL")).alias("country_name"),
        F.coalesce("region_name", F.lit("ALL REGIONS")).alias("region_name"),
        F.coalesce("territory_name", F.lit("ALL TERRITORIES")).alias("territory_name"),
        "total_revenue",
    )


def line_margin_detail(star: Star, p: ReportParams) -> DataFrame:
    """Price, unit margin and total margin of every line."""
    lines = star.lines(
        "line_item_id", "order_id", "product_id", "quantity", "unit_price", "discount", "net_amount"
    )
    margin = (F.col("net_amount") - F.col("quantity") * F.col("unit_cost")).cast(TOTAL)
    return (
        star.with_product(lines, "product_sku", "product_name", "brand", "unit_cost")
        .select(
            "line_item_id",
            "order_id",
            "product_id",
            "product_sku",
            "product_name",
            "brand",
            "quantity",
            "unit_cost",
            "unit_price",
            "discount",
            ratio("net_amount", "quantity").alias("actual_sell_price_per_unit"),
            ratio(margin, "quantity").alias("margin_per_unit"),
            margin.cast(MONEY).alias("total_margin"),
            percent(margin, "net_amount").alias("margin_percent"),
        )
        .orderBy(F.desc("margin_percent"), "line_item_id")
    )


def unordered_products_12m(star: Star, p: ReportParams) -> DataFrame:
    """Active products without a line in the trailing months."""
    recent = (
        star.lines_between(cal.day_months_before(p.as_of, p.unsold_months))
        .select("product_id")
        .distinct()
    )
    return (
        star["dim_products"]
        .filter("is_active")
        .join(recent, "product_id", "left_anti")
        .select(
            "product_id",
            "product_sku",
            "product_name",
            "brand",
            "product_type",
            "product_status",
            "stock_level",
            "list_price",
            "unit_cost",
            "is_active",
        )
        .orderBy(F.desc("stock_level"), "product_name", "product_id")
    )


def delivery_exceptions(star: Star, p: ReportParams) -> DataFrame:
    """Shipped, non-cancelled orders with a long delay, and their value."""
    delay = F.datediff("ship_date", "order_date")
    late = star.order_values(order_net_value=total("net_amount")).filter(
        F.col("ship_date").isNotNull() & (F.col("order_status") != "Cancelled") & (delay > p.late_days)
    )
    late = star.with_rep(late, "rep_name")
    return (
        star.with_customer_geo(late, "country_name", customer=("customer_code",))
        .select(
            "order_id",
            "customer_code",
            "country_name",
            "rep_name",
            "order_date",
            "ship_date",
            delay.alias("shipping_delay_days"),
            "order_net_value",
        )
        .orderBy(F.desc("shipping_delay_days"), F.desc("order_net_value"), "order_id")
    )


def returns_detail(star: Star, p: ReportParams) -> DataFrame:
    """Return cases with their sale, customer, product and category."""
    cases = star.sales_of(
        star.returns(
            "return_id", "line_item_id", "return_date", "return_quantity", "credit_amount", "return_reason"
        )
    )
    named = star.with_product_category(star.with_customer(cases, "customer_code"), "product_name")
    return named.orderBy(F.desc("return_date"), F.desc("credit_amount"), "order_id", "line_item_id").select(
        "return_id",
        "return_date",
        "order_id",
        "customer_code",
        "product_name",
        "category_name",
        "return_quantity",
        "credit_amount",
        "return_reason",
    )


def customer_revenue_assigned_rep(star: Star, p: ReportParams) -> DataFrame:
    """Revenue per customer with the actively assigned rep; one row per active assignment."""
    revenue = (
        star.order_values(net=total("net_amount")).groupBy("customer_id").agg(total("net").alias("total_revenue"))
    )
    active = star["rep_customer_assignments"].filter("is_active").select("customer_id", "sales_rep_id")
    reps = star["dim_sales_reps"].select("sales_rep_id", F.col("rep_name").alias("assigned_sales_rep"))
    return (
        star.with_customer(revenue, "customer_code")
        .join(active, "customer_id", "left")
        .join(reps, "sales_rep_id", "left")
        .select("customer_id", "customer_code", "total_revenue", "assigned_sales_rep")
        .orderBy(F.desc("total_revenue"), "customer_id", "assigned_sales_rep")
    )


def multi_product_orders(star: Star, p: ReportParams) -> DataFrame:
    """Orders of more than one product, with their value."""
    mixed = star.order_values(
        number_of_products=F.countDistinct("product_id"), total_order_value=total("net_amount")
    ).filter(F.col("number_of_products") > 1)
    return (
        star.with_customer(mixed, "customer_code")
        .select("order_id", "customer_code", "number_of_products", "total_order_value")
        .orderBy(F.desc("total_order_value"), "order_id")
    )


def revenue_category_country(star: Star, p: ReportParams) -> DataFrame:
    """Net revenue per product category and customer country."""
    sales = star.order_lines(orders=star.orders_placed("country_name"))
    per_product = sales.groupBy("country_name", "product_id").agg(total("net_amount").alias("net"))
    return (
        star.with_product_category(per_product)
        .groupBy("category_name", "country_name")
        .agg(total("net").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category_name", "country_name")
    )


def high_spend_customers(star: Star, p: ReportParams) -> DataFrame:
    """Customers whose total spend exceeds a floor."""
    spend = (
        star.order_values(net=total("net_amount"))
        .groupBy("customer_id")
        .agg(total("net").alias("total_spent"))
        .filter(F.col("total_spent") > p.spend_floor)
    )
    return (
        star.with_customer_geo(spend, "country_name", customer=("customer_code",))
        .select("customer_id", "customer_code", "country_name", "total_spent")
        .orderBy(F.desc("total_spent"), "customer_id")
    )
