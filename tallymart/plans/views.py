"""The reporting layer: three tiers of views.

Tier 1 is row level, tier 2 aggregates, tier 3 fixes the columns a report
consumer sees.  Tier 2 is planned from per-order and per-product sums, not from
the tier 1 rows; the figures are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import calendar as cal
from tallymart.functions.money import MONEY, TOTAL, percent, ratio, total, units, zero
from tallymart.operators.prefix import position_by, rank_by_amount
from tallymart.params import ReportParams
from tallymart.plans.advanced import NOT_CANCELLED, returns_per_order
from tallymart.sources.star import Star

# -- shared pieces -----------------------------------------------------------


def _with_cost(star: Star) -> Callable[[DataFrame], DataFrame]:
    """Adds the unit cost to lines that are about to be summed."""
    return lambda lines: star.with_product(lines, "unit_cost")


def _per_order_month(star: Star, prepare=None, **sums: Column) -> DataFrame:
    """Non-cancelled sales, one row per order and month of its lines."""
    dated = star.dated_values(prepare, **sums).filter(NOT_CANCELLED)
    return dated.groupBy(
        "order_id", "customer_id", "sales_rep_id", cal.month_start("line_date").alias("period_start_date")
    ).agg(*[F.sum(name).cast("bigint" if name == "units" else TOTAL).alias(name) for name in sums])


def _period_columns(quarter: bool = False) -> list[Column]:
    first = F.col("period_start_date")
    parts = [first, F.year(first).alias("calendar_year")]
    if quarter:
        parts.append(F.quarter(first).alias("calendar_quarter"))
    return [*parts, F.month(first).alias("calendar_month"), cal.month_name(first).alias("month_name")]


def _rep_region(star: Star, df: DataFrame) -> DataFrame:
    """Attach the country and region of the row's rep."""
    return star.with_region(star.with_rep(df, "region_id"), "country_name", "region_name")


# -- tier 1 ------------------------------------------------------------------


def vw_base_order_line_detail(star: Star, p: ReportParams) -> DataFrame:
    """Sales lines with customer country, rep geography, product and line date."""
    orders = star.orders_placed("country_name").withColumnRenamed("country_name", "customer_country_name")
    lines = star.order_lines(orders=_rep_region(star, orders))
    lines = star.with_product_category(lines, "product_sku", "product_name", "unit_cost")
    day = F.col("line_date")
    return lines.select(
        "line_item_id",
        "order_id",
        "order_status",
        "customer_id",
        "customer_country_name",
        "sales_rep_id",
        F.col("country_name").alias("sales_country_name"),
        F.col("region_name").alias("sales_region_name"),
        "product_id",
        "product_sku",
        "product_name",
        "category_name",
        day.alias("order_date"),
        F.year(day).alias("order_year"),
        F.quarter(day).alias("order_quarter"),
        F.month(day).alias("order_month"),
        cal.month_name(day).alias("order_month_name"),
        "quantity",
        "net_amount",
        (F.col("net_amount") - F.col("quantity") * zero("unit_cost", MONEY)).cast(MONEY).alias("gross_profit"),
    )


def vw_base_quota_detail(star: Star, p: ReportParams) -> DataFrame:
    """Quotas with rep geography and date parts."""
    day = F.col("quota_date")
    return _rep_region(star, star["fact_quotas"]).select(
        "sales_rep_id",
        F.col("country_name").alias("sales_country_name"),
        F.col("region_name").alias("sales_region_name"),
        day,
        F.year(day).alias("quota_year"),
        F.quarter(day).alias("quota_quarter"),
        F.month(day).alias("quota_month"),
        cal.month_name(day).alias("quota_month_name"),
        "quota_period",
        "quota_amount",
    )


def vw_base_return_detail(star: Star, p: ReportParams) -> DataFrame:
    """Returns with their return date and the sale they belong to."""
    sale = vw_base_order_line_detail(star, p).select(
        "line_item_id",
        F.col("order_date").alias("sale_date"),
        F.col("order_year").alias("sale_year"),
        F.col("order_month").alias("sale_month"),
        F.col("order_month_name").alias("sale_month_name"),
        "order_status",
        "customer_id",
        "customer_country_name",
        "product_id",
        "category_name",
        F.col("quantity").alias("sold_quantity"),
    )
    day = F.col("return_date")
    cases = star.returns("line_item_id", "return_quantity", "credit_amount", "return_reason", "return_date").select(
        "*",
        F.year(day).alias("return_year"),
        F.month(day).alias("return_month"),
        cal.month_name(day).alias("return_month_name"),
    )
    return cases.join(sale, "line_item_id")


def vw_base_channel(star: Star, p: ReportParams) -> DataFrame:
    """Sales lines with customer tier and geography."""
    orders = star.orders_placed("region_name", "country_name", customer=("account_tier",))
    return star.order_lines(orders=orders).select(
        "order_id",
        "customer_id",
        "account_tier",
        "region_name",
        "country_name",
        cal.year("order_date"),
        cal.month("order_date"),
        "quantity",
        "net_amount",
    )


def vw_base_orders(star: Star, p: ReportParams) -> DataFrame:
    """Sales lines with rep and month."""
    return star.order_lines().select(
        "order_id", "sales_rep_id", cal.year("order_date"), cal.month("order_date"), "quantity", "net_amount"
    )


def vw_base_country_category_sales(star: Star, p: ReportParams) -> DataFrame:
    """Sales lines with customer country, category and order month."""
    lines = star.order_lines(orders=star.orders_placed("country_name"))
    return star.with_product_category(lines).select(
        "order_id",
        cal.year("order_date"),
        cal.month("order_date"),
        "country_name",
        "category_name",
        "quantity",
        "net_amount",
    )


def vw_base_inventory_risk(star: Star, p: ReportParams) -> DataFrame:
    """Every product with its lines; an unsold product has one row of nulls."""
    sold = star.order_lines().select(
        "product_id", "order_id", cal.year("order_date"), cal.month("order_date"), "quantity", "net_amount"
    )
    products = star["dim_products"].select("product_id", "product_sku", "product_name", "brand", "stock_level")
    return products.join(sold, "product_id", "left")


# -- tier 2 ------------------------------------------------------------------


def vw_summary_sales_executive(star: Star, p: ReportParams) -> DataFrame:
    """Orders, revenue, profit and monthly quota per month and rep geography.

    A month with a quota and no sales stays.
    """
    sales = _per_order_month(
        star, _with_cost(star), net=total("net_amount"), cost=total(F.col("quantity") * F.col("unit_cost"))
    )
    sales = sales.groupBy("sales_rep_id", "period_start_date").agg(
        F.count(F.lit(1)).alias("orders"), total("net").alias("net"), total("cost").alias("cost")
    )
    return executive_figures(star, sales)


def executive_figures(star: Star, sales: DataFrame) -> DataFrame:
    """The executive summary from orders, net and cost per rep and month."""
    quotas = (
        star["fact_quotas"]
        .filter(F.col("quota_period") == "Monthly")
        .groupBy("sales_rep_id", cal.month_start("quota_date").alias("period_start_date"))
        .agg(total("quota_amount").alias("quota"))
    )
    metrics = _rep_region(star, sales.unionByName(quotas, allowMissingColumns=True))
    grouped = metrics.groupBy("period_start_date", "country_name", "region_name").agg(
        zero(units("orders"), "bigint").alias("order_count"),
        zero(total("net")).alias("total_revenue"),
        zero(total(F.col("net") - F.col("cost"))).alias("gross_profit"),
        zero(total("quota")).alias("quota_amount"),
    )
    return grouped.select(
        *_period_columns(quarter=True),
        "country_name",
        "region_name",
        "order_count",
        "total_revenue",
        "gross_profit",
        percent("gross_profit", "total_revenue").alias("gross_margin_percent"),
        ratio("total_revenue", "order_count").alias("average_order_value"),
        "quota_amount",
        percent("total_revenue", "quota_amount").alias("quota_attainment_percent"),
    )


def vw_summary_customer_360(star: Star, p: ReportParams) -> DataFrame:
    """Every customer with revenue, frequency, return rate, assigned rep and segment."""
    since = cal.months_before(p.as_of, 12)
    dated = star.dated_values(net=total("net_amount"), sold=units("quantity")).filter(NOT_CANCELLED)
    per_order = dated.groupBy("order_id", "customer_id").agg(
        total("net").alias("net"),
        units("sold").alias("sold"),
        F.max("line_date").alias("last_day"),
        total(F.when(F.col("line_date") >= since, F.col("net")).otherwise(0)).alias("recent_net"),
    )
    sales = per_order.groupBy("customer_id").agg(
        total("net").alias("lifetime"),
        F.count(F.lit(1)).alias("orders"),
        F.max("last_day").alias("last_order_date"),
        units("sold").alias("sold"),
        F.count(F.when(F.col("last_day") >= since, True)).alias("recent_orders"),
        total("recent_net").alias("recent_net"),
    )
    returned = (
        returns_per_order(star)
        .join(star["fact_sales_orders"].filter(NOT_CANCELLED).select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(units("returned").alias("returned"))
    )
    return customer_profiles(star, p, sales.join(returned, "customer_id", "left"))


def customer_profiles(star: Star, p: ReportParams, sales: DataFrame) -> DataFrame:
    """The customer 360 from sums per customer that ordered."""
    t = p.profile
    # A current assignment before a past one, then the latest, then the highest id.
    best = F.max(F.struct("is_active", "valid_from", "assignment_id", "sales_rep_id")).alias("best")
    assigned = (
        star["rep_customer_assignments"]
        .filter(cal.covers(F.lit(p.as_of)))
        .groupBy("customer_id")
        .agg(best)
        .select("customer_id", "best.sales_rep_id")
    )
    assigned = star.with_rep(assigned, "rep_name").select(
        "customer_id", F.col("rep_name").alias("assigned_rep_name")
    )
    idle = F.datediff(F.lit(p.as_of), "last_order_date")
    recent, spent = F.col("recent_orders"), F.col("recent_net")
    segment = (
        F.when(F.col("last_order_date").isNull(), "Lost")
        .when((idle <= t.new_days) & (recent <= t.new_orders), "New")
        .when(
            (idle <= t.champion_days) & (recent >= t.champion_orders) & (spent >= t.champion_spend), "Champions"
        )
        .when((idle <= t.loyal_days) & (recent >= t.loyal_orders) & (spent >= t.loyal_spend), "Loyal")
        .when((idle > t.loyal_days) & ((recent >= t.loyal_orders) | (spent >= t.loyal_spend)), "At Risk")
        .otherwise("Lost")
    )
    return (
        star["dim_customers"]
        .select("customer_id", "customer_code", "customer_name", "account_tier")
        .join(sales, "customer_id", "left")
        .join(assigned, "customer_id", "left")
        .select(
            "customer_id",
            "customer_code",
            "customer_name",
            "account_tier",
            "assigned_rep_name",
            zero("lifetime").alias("lifetime_revenue"),
            zero("recent_orders", "bigint").alias("order_frequency_last_12_months"),
            "last_order_date",
            zero(ratio("lifetime", "orders"), MONEY).alias("average_order_value"),
            percent(zero("returned", "bigint"), zero("sold", "bigint")).alias("return_rate_percent"),
            segment.alias("rfm_segment"),
        )
    )


def vw_summary_product_performance(star: Star, p: ReportParams) -> DataFrame:
    """Units, revenue, margin, return rate and revenue rank in the category."""
    sold = (
        star.order_lines()
        .filter(NOT_CANCELLED)
        .groupBy("product_id")
        .agg(units("quantity").alias("total_units_sold"), total("net_amount").alias("net_revenue"))
    )
    per_line = star.returned_values(returned=units("return_quantity"))
    valid = star["fact_sales_orders"].filter(NOT_CANCELLED).select("order_id")
    returned = (
        per_line.join(valid, "order_id", "left_semi").groupBy("product_id").agg(units("returned").alias("returned"))
    )
    return product_figures(star, sold.join(returned, "product_id", "left"))


def product_figures(star: Star, sold: DataFrame) -> DataFrame:
    """The product performance from units sold, net revenue and units returned per product that was sold."""
    named = star.with_product_category(sold, "product_sku", "product_name", "unit_cost")
    ranked = position_by(named, ["category_name"], ["net_revenue"], "product_id", "category_revenue_rank")
    profit = F.col("net_revenue") - F.col("total_units_sold") * F.col("unit_cost")
    return ranked.select(
        "product_id",
        "product_sku",
        "product_name",
        "category_name",
        "total_units_sold",
        "net_revenue",
        percent(profit, "net_revenue").alias("gross_margin_percent"),
        percent(zero("returned", "bigint"), "total_units_sold").alias("return_rate_percent"),
        "category_revenue_rank",
    )


def vw_summary_rep_performance(star: Star, p: ReportParams) -> DataFrame:
    """Active reps: revenue, quota, attainment and customers, quarter and year to date."""
    in_quarter = cal.in_quarter("line_date", p.as_of.year, (p.as_of.month + 2) // 3)
    to_date = star.dated_values(since=date(p.as_of.year, 1, 1), until=p.as_of, net=total("net_amount")).filter(NOT_CANCELLED)
    # One row per rep and customer, so that customers are counted, not collected.
    per_customer = to_date.groupBy("sales_rep_id", "customer_id").agg(
        total("net").alias("ytd"),
        total(F.when(in_quarter, F.col("net")).otherwise(0)).alias("qtd"),
        F.max(in_quarter).alias("bought_in_quarter"),
    )
    sales = per_customer.groupBy("sales_rep_id").agg(
        total("qtd").alias("qtd_net"),
        F.count(F.when(F.col("bought_in_quarter"), True)).alias("qtd_customers"),
        total("ytd").alias("ytd_net"),
        F.count(F.lit(1)).alias("ytd_customers"),
    )
    return rep_figures(star, p, sales)


def rep_figures(star: Star, p: ReportParams, sales: DataFrame) -> DataFrame:
    """The rep performance from net revenue and customers per rep, quarter and year to date."""
    year = p.as_of.year
    due = (F.col("quota_period") == "Monthly") & (F.col("quota_date") <= F.lit(p.as_of))
    quota_in_quarter = cal.in_quarter("quota_date", year, (p.as_of.month + 2) // 3)
    quotas = (
        star["fact_quotas"]
        .filter(due & cal.in_year("quota_date", year))
        .groupBy("sales_rep_id")
        .agg(
            total(F.when(quota_in_quarter, F.col("quota_amount")).otherwise(0)).alias("qtd_quota"),
            total("quota_amount").alias("ytd_quota"),
        )
    )
    reps = star["dim_sales_reps"].filter("is_active").select("sales_rep_id", "employee_code", "rep_name", "region_id")
    scored = (
        star.with_region(reps, "region_name")
        .join(sales, "sales_rep_id", "left")
        .join(quotas, "sales_rep_id", "left")
        .select(
            "sales_rep_id",
            "employee_code",
            "rep_name",
            "region_name",
            zero("qtd_net").alias("quarter_to_date_actual_revenue"),
            zero("qtd_quota").alias("quarter_to_date_quota"),
            zero("qtd_customers", "bigint").alias("quarter_to_date_customer_count"),
            zero("ytd_net").alias("year_to_date_actual_revenue"),
            zero("ytd_quota").alias("year_to_date_quota"),
            zero("ytd_customers", "bigint").alias("year_to_date_customer_count"),
        )
    )
    for span in ("quarter_to_date", "year_to_date"):
        scored = scored.withColumn(
            f"{span}_attainment_percent", percent(f"{span}_actual_revenue", f"{span}_quota")
        )
    # No attainment sorts last, below every real one.
    keyed = scored.withColumn(
        "sort_key", F.coalesce("quarter_to_date_attainment_percent", F.lit(-1).cast("decimal(18,2)"))
    )
    ranked = position_by(
        keyed,
        ["region_name"],
        ["sort_key", "quarter_to_date_actual_revenue"],
        "sales_rep_id",
        "quarter_rank_in_region",
        width=1,
    )
    return ranked.select(
        "sales_rep_id",
        "employee_code",
        "rep_name",
        "region_name",
        "quarter_to_date_actual_revenue",
        "quarter_to_date_quota",
        "quarter_to_date_attainment_percent",
        "quarter_to_date_customer_count",
        "quarter_rank_in_region",
        "year_to_date_actual_revenue",
        "year_to_date_quota",
        "year_to_date_attainment_percent",
        "year_to_date_customer_count",
    )


def vw_summary_monthly_trend(star: Star, p: ReportParams) -> DataFrame:
    """Orders, revenue and change to the previous month with sales, per customer country."""
    per_order = _per_order_month(star, net=total("net_amount")).withColumn("orders", F.lit(1))
    return trend_figures(star, per_order)


def trend_figures(star: Star, sales: DataFrame) -> DataFrame:
    """The monthly trend from orders and net revenue per month and customer, or finer."""
    monthly = (
        star.with_customer_geo(sales, "country_name")
        .groupBy("period_start_date", "country_name")
        .agg(units("orders").alias("order_volume"), total("net").alias("net_revenue"))
    )
    before = F.lag("net_revenue").over(Window.partitionBy("country_name").orderBy("period_start_date"))
    trend = monthly.withColumn("before", before)
    return trend.select(
        *_period_columns(),
        "country_name",
        "order_volume",
        "net_revenue",
        ratio("net_revenue", "order_volume").alias("average_order_value"),
        percent(F.col("net_revenue") - F.col("before"), "before").alias("revenue_change_percent"),
    )


def vw_summary_returns_analysis(star: Star, p: ReportParams) -> DataFrame:
    """Return rate and credit per month of SALE, country, category and reason.

    The rate's base is all units sold in that month, country and category.
    """
    month = cal.month_start("line_date").alias("period_start_date")
    keys = ["period_start_date", "country_name", "category_name"]

    def per_product(lines: DataFrame, *more: str, **sums: Column) -> DataFrame:
        """Sums per month, country and category; dimensions join orders and summed rows, never lines."""
        summed = star.with_order(lines, valid).groupBy(month, "country_name", "product_id", *more).agg(*[c.alias(n) for n, c in sums.items()])
        return star.with_product_category(summed)

    valid = star["fact_sales_orders"].filter(NOT_CANCELLED).select("order_id", "customer_id", "order_date")
    valid = star.with_customer_geo(valid, "country_name")
    sold = per_product(star.bare_lines(), units_sold=units("quantity"))
    sold = sold.groupBy(*keys).agg(units("units_sold").alias("units_sold"))
    cases = star.returned_values(
        "return_reason", returned=units("return_quantity"), credit=total("credit_amount")
    )
    returned = (
        per_product(cases, "return_reason", returned=units("returned"), credit=total("credit"))
        .groupBy(*keys, "return_reason")
        .agg(units("returned").alias("units_returned"), total("credit").alias("total_credit_note_value"))
    )
    return returned.join(sold, keys, "left").select(
        *_period_columns(),
        "country_name",
        "category_name",
        "return_reason",
        percent("units_returned", "units_sold").alias("return_rate_percent"),
        "total_credit_note_value",
    )


def vw_channel_summary(star: Star, p: ReportParams) -> DataFrame:
    """Revenue, units and customers per region, country, tier and month."""
    per_customer = (
        star.order_values(net=total("net_amount"), sold=units("quantity"))
        .groupBy("customer_id", cal.year("order_date"), cal.month("order_date"))
        .agg(total("net").alias("net"), units("sold").alias("sold"))
    )
    placed = star.with_customer_geo(per_customer, "region_name", "country_name", customer=("account_tier",))
    return placed.groupBy("region_name", "country_name", "account_tier", "year", "month").agg(
        total("net").alias("total_revenue"),
        units("sold").alias("total_units"),
        F.count("customer_id").alias("customer_count"),
    )


def vw_order_summary(star: Star, p: ReportParams) -> DataFrame:
    """Orders, units and revenue per rep and month."""
    return (
        star.order_values(net=total("net_amount"), sold=units("quantity"))
        .groupBy("sales_rep_id", cal.year("order_date"), cal.month("order_date"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            units("sold").alias("total_units"),
            total("net").alias("total_revenue"),
        )
    )


def vw_country_category_sales_summary(star: Star, p: ReportParams) -> DataFrame:
    """Orders, units and revenue per country, category and month."""
    return (
        vw_base_country_category_sales(star, p)
        .groupBy("country_name", "category_name", "year", "month")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            units("quantity").alias("total_units_sold"),
            total("net_amount").alias("total_revenue"),
        )
    )


def vw_inventory_risk_summary(star: Star, p: ReportParams) -> DataFrame:
    """Orders, units and revenue of every product, zero for an unsold one."""
    sold = (
        star.lines("product_id", "order_id", "quantity", "net_amount")
        .groupBy("product_id", "order_id")
        .agg(units("quantity").alias("sold"), total("net_amount").alias("net"))
        .groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("orders"), units("sold").alias("sold"), total("net").alias("net"))
    )
    products = star["dim_products"].select("product_id", "product_sku", "product_name", "brand", "stock_level")
    return products.join(sold, "product_id", "left").select(
        *products.columns,
        zero("orders", "bigint").alias("total_orders"),
        zero("sold", "bigint").alias("total_units_sold"),
        zero("net").alias("total_revenue"),
    )


def vw_dm_country_month_kpi_trend(star: Star, p: ReportParams) -> DataFrame:
    """Non-cancelled revenue, orders and average order value per country and month of the lines."""
    monthly = star.with_customer_geo(_per_order_month(star, net=total("net_amount")), "country_name")
    return (
        monthly.groupBy("country_name", cal.year("period_start_date"), cal.month("period_start_date"))
        .agg(total("net").alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))
        .withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
    )


def vw_dm_rep_portfolio_quality(star: Star, p: ReportParams, corrected: bool = False) -> DataFrame:
    """Rep revenue, customers, quota of this year, attainment and rank in the region.

    As in ``rep_attainment_rank`` the library's definition repeats every line
    per quota row and every quota per line.  A rep without any quota row keeps
    its lines once; a rep with quotas of other years only is left out.
    """
    per_customer = (
        star.order_values(net=total("net_amount"), lines=F.count(F.lit(1)))
        .filter(NOT_CANCELLED)
        .groupBy("sales_rep_id", "customer_id")
        .agg(total("net").alias("net"), units("lines").alias("lines"))
    )
    sales = per_customer.groupBy("sales_rep_id").agg(
        total("net").alias("net"), units("lines").alias("lines"), F.count(F.lit(1)).alias("customer_count")
    )
    now = cal.in_year("quota_date", p.as_of.year)
    quotas = (
        star["fact_quotas"]
        .groupBy("sales_rep_id")
        .agg(F.count(F.when(now, True)).alias("rows_now"), total(F.when(now, F.col("quota_amount"))).alias("target"))
    )
    repeats = F.coalesce("rows_now", F.lit(1))
    both = sales.join(quotas, "sales_rep_id", "left").filter(repeats > 0)
    actual = F.col("net") if corrected else F.col("net") * repeats
    quota = zero("target") if corrected else zero("target") * F.col("lines")
    figures = _rep_region(star, star.with_rep(both, "rep_name")).select(
        "sales_rep_id",
        "rep_name",
        "country_name",
        "region_name",
        actual.cast(TOTAL).alias("actual_revenue"),
        "customer_count",
        quota.cast(TOTAL).alias("quota_amount"),
        percent(actual, quota).cast("decimal(10,2)").alias("attainment_percentage"),
    )
    ranked = rank_by_amount(figures, ["region_name"], "actual_revenue", "rank_within_region", dense=True)
    return ranked.select(*figures.columns, "rank_within_region")


# -- tier 3 ------------------------------------------------------------------


def vw_sales_executive_summary(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_sales_executive(star, p).select(
        "period_start_date",
        "calendar_year",
        "calendar_quarter",
        "calendar_month",
        "month_name",
        "country_name",
        "region_name",
        "order_count",
        "total_revenue",
        "gross_profit",
        "gross_margin_percent",
        "average_order_value",
        "quota_amount",
        "quota_attainment_percent",
    )


def vw_customer_360(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_customer_360(star, p).select(
        "customer_id",
        "customer_code",
        "customer_name",
        "account_tier",
        "assigned_rep_name",
        "lifetime_revenue",
        "order_frequency_last_12_months",
        "last_order_date",
        "average_order_value",
        "return_rate_percent",
        "rfm_segment",
    )


def vw_product_performance(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_product_performance(star, p).select(
        "product_id",
        "product_sku",
        "product_name",
        "category_name",
        "total_units_sold",
        "net_revenue",
        "gross_margin_percent",
        "return_rate_percent",
        "category_revenue_rank",
    )


def vw_rep_performance_scorecard(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_rep_performance(star, p).select(
        "sales_rep_id",
        "employee_code",
        "rep_name",
        "region_name",
        "quarter_to_date_actual_revenue",
        "quarter_to_date_quota",
        "quarter_to_date_attainment_percent",
        "quarter_to_date_customer_count",
        "quarter_rank_in_region",
        "year_to_date_actual_revenue",
        "year_to_date_quota",
        "year_to_date_attainment_percent",
        "year_to_date_customer_count",
    )


def vw_monthly_trend(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_monthly_trend(star, p).select(
        "period_start_date",
        "calendar_year",
        "calendar_month",
        "month_name",
        "country_name",
        "order_volume",
        "net_revenue",
        "average_order_value",
        "revenue_change_percent",
    )


def vw_returns_analysis(star: Star, p: ReportParams) -> DataFrame:
    return vw_summary_returns_analysis(star, p).select(
        "period_start_date",
        "calendar_year",
        "calendar_month",
        "month_name",
        "country_name",
        "category_name",
        "return_reason",
        "return_rate_percent",
        "total_credit_note_value",
    )


def vw_sales_channel_analysis(star: Star, p: ReportParams) -> DataFrame:
    return vw_channel_summary(star, p).select(
        "region_name",
        "country_name",
        "account_tier",
        "year",
        "month",
        "total_revenue",
        "total_units",
        "customer_count",
        ratio("total_revenue", "customer_count", 6).alias("revenue_per_customer"),
    )


def vw_order_efficiency(star: Star, p: ReportParams) -> DataFrame:
    return star.with_rep(vw_order_summary(star, p), "rep_name").select(
        "sales_rep_id",
        "rep_name",
        "year",
        "month",
        "total_orders",
        "total_units",
        "total_revenue",
        ratio("total_units", "total_orders", 6).alias("avg_units_per_order"),
        ratio("total_revenue", "total_orders", 6).alias("avg_order_value"),
    )


def vw_country_category_sales(star: Star, p: ReportParams) -> DataFrame:
    return vw_country_category_sales_summary(star, p).select(
        "country_name", "category_name", "year", "month", "total_orders", "total_units_sold", "total_revenue"
    )


def vw_inventory_risk_report(star: Star, p: ReportParams) -> DataFrame:
    return vw_inventory_risk_summary(star, p).select(
        "product_id",
        "product_sku",
        "product_name",
        "brand",
        "stock_level",
        "total_orders",
        "total_units_sold",
        "total_revenue",
    )


# -- catalog -----------------------------------------------------------------

TIERS: tuple[tuple[Callable[[Star, ReportParams], DataFrame], ...], ...] = (
    (
        vw_base_order_line_detail,
        vw_base_quota_detail,
        vw_base_return_detail,
        vw_base_channel,
        vw_base_orders,
        vw_base_country_category_sales,
        vw_base_inventory_risk,
    ),
    (
        vw_summary_sales_executive,
        vw_summary_customer_360,
        vw_summary_product_performance,
        vw_summary_rep_performance,
        vw_summary_monthly_trend,
        vw_summary_returns_analysis,
        vw_channel_summary,
        vw_order_summary,
        vw_dm_country_month_kpi_trend,
        vw_dm_rep_portfolio_quality,
        vw_country_category_sales_summary,
        vw_inventory_risk_summary,
    ),
    (
        vw_sales_executive_summary,
        vw_customer_360,
        vw_product_performance,
        vw_rep_performance_scorecard,
        vw_monthly_trend,
        vw_returns_analysis,
        vw_sales_channel_analysis,
        vw_order_efficiency,
        vw_country_category_sales,
        vw_inventory_risk_report,
    ),
)
VIEWS = {view.__name__: view for tier in TIERS for view in tier}

# The final views of the main reporting layer: columns and order of their preview.
PREVIEWS: dict[str, tuple[tuple[str, ...], tuple[tuple[str, bool], ...]]] = {
    "vw_sales_executive_summary": (
        (
            "period_start_date",
            "country_name",
            "region_name",
            "total_revenue",
            "gross_margin_percent",
            "quota_attainment_percent",
        ),
        (("period_start_date", True), ("country_name", False), ("region_name", False)),
    ),
    "vw_customer_360": (
        (
            "customer_code",
            "customer_name",
            "assigned_rep_name",
            "lifetime_revenue",
            "order_frequency_last_12_months",
            "rfm_segment",
        ),
        (("lifetime_revenue", True), ("customer_code", False)),
    ),
    "vw_product_performance": (
        (
            "product_sku",
            "product_name",
            "category_name",
            "total_units_sold",
            "net_revenue",
            "category_revenue_rank",
        ),
        (("net_revenue", True), ("product_sku", False)),
    ),
    "vw_rep_performance_scorecard": (
        (
            "employee_code",
            "rep_name",
            "region_name",
            "quarter_to_date_actual_revenue",
            "quarter_to_date_attainment_percent",
            "quarter_rank_in_region",
        ),
        (("quarter_rank_in_region", False), ("rep_name", False), ("employee_code", False)),
    ),
    "vw_monthly_trend": (
        (
            "period_start_date",
            "country_name",
            "net_revenue",
            "order_volume",
            "average_order_value",
            "revenue_change_percent",
        ),
        (("country_name", False), ("period_start_date", True)),
    ),
    "vw_returns_analysis": (
        (
            "period_start_date",
            "country_name",
            "category_name",
            "return_reason",
            "return_rate_percent",
            "total_credit_note_value",
        ),
        (
            ("period_start_date", True),
            ("total_credit_note_value", True),
            ("country_name", False),
            ("category_name", False),
            ("return_reason", False),
        ),
    ),
}


View = Callable[[Star, ReportParams], DataFrame]


def view_preview(star: Star, p: ReportParams, view: str, k: int = 10, answers: Mapping[str, View] = VIEWS) -> DataFrame:
    """The first rows of a final view in its reading order; ``answers`` may give it from stored sums."""
    columns, order = PREVIEWS[view]
    keys = [F.desc(c) if descending else F.asc(c) for c, descending in order]
    return answers[view](star, p).orderBy(*keys).limit(k).select(*columns)


def view_smoke_counts(star: Star, p: ReportParams, answers: Mapping[str, View] = VIEWS) -> DataFrame:
    """Row count of each final view of the main reporting layer; ``answers`` may give them from stored sums."""
    counts = [
        answers[name](star, p).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        for name in PREVIEWS
    ]
    result = counts[0]
    for df in counts[1:]:
        result = result.unionByName(df)
    return result
