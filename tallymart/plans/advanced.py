"""Advanced reports: segments, trends, running totals and ranks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import calendar as cal
from tallymart.functions.money import TOTAL, percent, ratio, total, units, zero
from tallymart.operators.prefix import block, prefix_sum, rank_by_amount
from tallymart.params import ReportParams
from tallymart.sources.star import Star

NOT_CANCELLED = "order_status <> 'Cancelled'"


def rfm_segmentation(star: Star, p: ReportParams) -> DataFrame:
    """Recency, orders and spend of the trailing year, and the segment they give."""
    t = p.recency
    per_customer = (
        star.order_values(since=cal.months_before(p.as_of, 12), net=total("net_amount"))
        # The clock has a time of day, so the day exactly one year back is out.
        .filter(F.col("order_date") > cal.months_before(p.as_of, 12))
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order"),
            F.count(F.lit(1)).alias("frequency"),
            total("net").alias("monetary"),
        )
        .withColumn("recency", F.datediff(F.lit(p.as_of), "last_order"))
    )
    recency, frequency = F.col("recency"), F.col("frequency")
    segment = (
        F.when(
            (recency <= t.champion_days)
            & (frequency >= t.champion_orders)
            & (F.col("monetary") >= t.champion_spend),
            "Champions",
        )
        .when((recency <= t.loyal_days) & (frequency >= t.loyal_orders), "Loyal")
        .when((recency > t.at_risk_days) & (frequency < t.at_risk_orders), "At Risk")
        .when(recency > t.lost_days, "Lost")
        .otherwise("New")
    )
    return per_customer.select("customer_id", "recency", "frequency", "monetary", segment.alias("customer_segment"))


def mom_revenue_by_country(star: Star, p: ReportParams) -> DataFrame:
    """Month revenue beside the previous month that has sales, per country."""
    values = star.dated_values(net=total("net_amount"))
    monthly = (
        star.with_customer_geo(values, "country_name")
        .groupBy("country_name", cal.year("line_date"), cal.month("line_date"))
        .agg(total("net").alias("current_revenue"))
    )
    before = F.lag("current_revenue").over(Window.partitionBy("country_name").orderBy("year", "month"))
    change = F.col("current_revenue") - F.col("previous_revenue")
    return (
        monthly.withColumn("previous_revenue", before)
        .withColumn("revenue_change", change.cast(TOTAL))
        .withColumn("percentage_change", percent("revenue_change", "previous_revenue", 6))
    )


def running_total_by_quarter(star: Star, p: ReportParams) -> DataFrame:
    """Revenue of each order and the running total in its region and quarter, by order id.

    A region and quarter can hold any number of orders, so the total runs over
    blocks of order ids and then inside each block.
    """
    values = star.order_values(order_revenue=total("net_amount"))
    placed = star.with_customer_geo(values, "region_name").select(
        "region_name",
        cal.year("order_date"),
        cal.quarter("order_date"),
        "order_id",
        "order_revenue",
        block("order_id").alias("order_block"),
    )
    levels = [[("order_block", False)], [("order_id", False)]]
    summed = prefix_sum(placed, ["region_name", "year", "quarter"], levels, "order_revenue", "before")
    return summed.select(
        "region_name",
        "year",
        "quarter",
        "order_id",
        "order_revenue",
        (F.col("before") + F.col("order_revenue")).cast(TOTAL).alias("running_total"),
    )


def rep_attainment_rank(star: Star, p: ReportParams, corrected: bool = False) -> DataFrame:
    """Quota attainment of last year's quotas, ranked in the region.

    The library's definition joins every line of a rep to every quota row, so
    revenue counts once per quota row and the quota once per line.  Both sides
    are summed first and multiplied by the other side's row count, which gives
    the same figures without the product.  ``corrected`` leaves the counts out.
    """
    sales = (
        star.order_values(net=total("net_amount"), lines=F.count(F.lit(1)))
        .groupBy("sales_rep_id")
        .agg(total("net").alias("net"), units("lines").alias("lines"))
    )
    quotas = (
        star["fact_quotas"]
        .filter(cal.in_year("quota_date", p.last_year))
        .groupBy("sales_rep_id")
        .agg(total("quota_amount").alias("target"), F.count(F.lit(1)).alias("quota_rows"))
    )
    both = sales.join(quotas, "sales_rep_id")
    actual = F.col("net") if corrected else F.col("net") * F.col("quota_rows")
    target = F.col("target") if corrected else F.col("target") * F.col("lines")
    figures = star.with_rep(both, "rep_name", "region_id").select(
        "region_id",
        "sales_rep_id",
        "rep_name",
        actual.cast(TOTAL).alias("actual_revenue"),
        target.cast(TOTAL).alias("quota"),
        percent(actual, target, 6).alias("attainment"),
    )
    figures = star.with_region(figures, "region_name")
    average = figures.groupBy("region_name").agg(
        (F.sum("attainment") / F.nullif(F.count("attainment"), F.lit(0)).cast("decimal(20,0)"))
        .cast("decimal(18,6)")
        .alias("region_avg")
    )
    # No attainment sorts last, below every real one.
    keyed = figures.withColumn("sort_key", F.coalesce("attainment", F.lit(-1).cast("decimal(18,6)")))
    ranked = rank_by_amount(keyed, ["region_name"], "sort_key", "rank_in_region", width=1)
    return ranked.join(average, "region_name").select(
        "region_name",
        "sales_rep_id",
        "rep_name",
        "actual_revenue",
        "quota",
        "attainment",
        "rank_in_region",
        "region_avg",
    )


def top_customer_per_country(star: Star, p: ReportParams) -> DataFrame:
    """The customer with most revenue per country this year; ties go to the lower id."""
    first, last = date(p.as_of.year, 1, 1), date(p.as_of.year, 12, 31)
    this_year = star.order_values(since=first, until=last, net=total("net_amount"))
    revenue = this_year.groupBy("customer_id").agg(total("net").alias("total_revenue"))
    named = star.with_customer_geo(revenue, "country_name", customer=("customer_code", "account_tier"))
    by_revenue = Window.partitionBy("country_name").orderBy(F.desc("total_revenue"), "customer_id")
    return (
        named.withColumn("place", F.row_number().over(by_revenue))
        .filter("place = 1")
        .select("country_name", "customer_id", "customer_code", "account_tier", "total_revenue")
    )


def products_not_ordered_high_rev_regions(star: Star, p: ReportParams) -> DataFrame:
    """Products never ordered from the regions with high revenue last year."""
    last_year = star.dated_values(net=total("net_amount")).filter(cal.in_year("line_date", p.last_year))
    strong = (
        star.with_customer(last_year, "region_id")
        .groupBy("region_id")
        .agg(total("net").alias("net"))
        .filter(F.col("net") > p.region_revenue_floor)
    )
    buyers = star["dim_customers"].select("customer_id", "region_id").join(strong, "region_id", "left_semi")
    orders = star["fact_sales_orders"].select("order_id", "customer_id").join(buyers, "customer_id", "left_semi")
    wanted = star.lines("order_id", "product_id").join(orders, "order_id", "left_semi").select("product_id").distinct()
    return star["dim_products"].join(wanted, "product_id", "left_anti").select("product_id", "product_name")


def customer_lifetime_rank(star: Star, p: ReportParams) -> DataFrame:
    """Lifetime revenue per customer and its rank in the country."""
    revenue = (
        star.order_values(net=total("net_amount")).groupBy("customer_id").agg(total("net").alias("lifetime_revenue"))
    )
    named = star.with_customer_geo(revenue, "country_name")
    return rank_by_amount(named, ["country_name"], "lifetime_revenue", "rank_in_country").select(
        "customer_id", "country_name", "lifetime_revenue", "rank_in_country"
    )


def days_between_orders(star: Star, p: ReportParams) -> DataFrame:
    """Days since a customer's previous order; a customer's first order is left out.

    Only the first order of a day looks back to another day, so the ordered
    pass runs over the days a customer ordered on, not over the orders.
    """
    orders = star["fact_sales_orders"].select("customer_id", "order_date", "order_id")
    days = orders.groupBy("customer_id", "order_date").agg(F.min("order_id").alias("first_order"))
    by_day = Window.partitionBy("customer_id").orderBy("order_date")
    days = days.withColumn("day_before", F.lag("order_date").over(by_day))
    previous = F.when(F.col("order_id") == F.col("first_order"), F.col("day_before")).otherwise(F.col("order_date"))
    return (
        orders.join(days, ["customer_id", "order_date"])
        .select("customer_id", "order_date", previous.alias("previous_order_date"))
        .filter(F.col("previous_order_date").isNotNull())
        .withColumn("days_between_orders", F.datediff("order_date", "previous_order_date"))
        .orderBy("customer_id", "order_date", "previous_order_date")
    )


def top3_customers_country_quarter(star: Star, p: ReportParams, k: int = 3) -> DataFrame:
    """Customers on the first revenue ranks of each country and quarter; ties stay."""
    revenue = (
        star.order_values(net=total("net_amount"))
        .groupBy("customer_id", cal.year("order_date"), cal.quarter("order_date"))
        .agg(total("net").alias("total_revenue"))
    )
    named = star.with_customer_geo(revenue, "country_name", customer=("customer_code", "account_tier"))
    by_revenue = Window.partitionBy("country_name", "year", "quarter").orderBy(F.desc("total_revenue"))
    return (
        named.withColumn("revenue_rank", F.dense_rank().over(by_revenue))
        .filter(F.col("revenue_rank") <= k)
        .select(
            "country_name",
            "year",
            "quarter",
            "customer_id",
            "customer_code",
            "account_tier",
            "total_revenue",
            "revenue_rank",
        )
        .orderBy("country_name", "year", "quarter", "revenue_rank", F.desc("total_revenue"), "customer_id")
    )


def monthly_product_running_total(star: Star, p: ReportParams) -> DataFrame:
    """Month revenue per product and its running total in the year: twelve rows at most."""
    monthly = (
        star.lines("product_id", "line_date", "net_amount")
        .groupBy("product_id", cal.year("line_date"), cal.month("line_date"), cal.month_name("line_date").alias("month_name"))
        .agg(total("net_amount").alias("monthly_revenue"))
    )
    so_far = (
        Window.partitionBy("product_id", "year")
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = monthly.withColumn("running_year_total", F.sum("monthly_revenue").over(so_far).cast(TOTAL))
    return (
        star.with_product_category(running, "product_sku", "product_name")
        .select(
            "category_name",
            "product_id",
            "product_sku",
            "product_name",
            "year",
            "month",
            "month_name",
            "monthly_revenue",
            "running_year_total",
        )
        .orderBy("category_name", "product_name", "product_id", "year", "month")
    )


def returns_per_order(star: Star) -> DataFrame:
    """Return cases, credit and units per order, whatever its status."""
    returned = star.returned_values(
        cases=F.count(F.lit(1)), credit=total("credit_amount"), returned=units("return_quantity")
    )
    return (
        returned.groupBy("order_id")
        .agg(units("cases").alias("cases"), total("credit").alias("credit"), units("returned").alias("returned"))
    )


def customer_360_candidate(star: Star, p: ReportParams) -> DataFrame:
    """Order and return figures per customer, the current rep and the revenue rank in the country."""
    bought = (
        star.order_values(net=total("net_amount"))
        .filter(NOT_CANCELLED)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            total("net").alias("lifetime_revenue"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    returned = (
        returns_per_order(star)
        .join(star["fact_sales_orders"].select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(units("cases").alias("cases"), total("credit").alias("credit"))
    )
    newest = F.max(F.struct("valid_from", "assignment_id", "sales_rep_id")).alias("newest")
    current = (
        star["rep_customer_assignments"]
        .filter(F.col("is_active") & cal.covers(F.lit(p.as_of)))
        .groupBy("customer_id")
        .agg(newest)
        .select("customer_id", "newest.sales_rep_id")
    )
    reps = star["dim_sales_reps"].select("sales_rep_id", F.col("rep_name").alias("assigned_rep_name"))
    profile = (
        star.with_customer_geo(
            bought, "country_name", customer=("customer_code", "customer_name", "account_tier")
        )
        .join(returned, "customer_id", "left")
        .join(current, "customer_id", "left")
        .join(reps, "sales_rep_id", "left")
        .select(
            "customer_id",
            "customer_code",
            "customer_name",
            "account_tier",
            "country_name",
            "assigned_rep_name",
            "order_count",
            "lifetime_revenue",
            ratio("lifetime_revenue", "order_count").alias("average_order_value"),
            "last_order_date",
            F.datediff(F.lit(p.as_of), "last_order_date").alias("days_since_last_order"),
            zero("cases", "bigint").alias("return_count"),
            zero("credit").alias("total_credit_amount"),
        )
    )
    place = "lifetime_revenue_rank_in_country"
    ranked = rank_by_amount(profile, ["country_name"], "lifetime_revenue", place, dense=True)
    return ranked.select(*profile.columns, place).orderBy("country_name", place, "customer_code")


def monthly_country_trend(star: Star, p: ReportParams) -> DataFrame:
    """Orders, revenue, change and running year revenue per country and month."""
    values = star.order_values(net=total("net_amount")).filter(NOT_CANCELLED)
    monthly = (
        star.with_customer_geo(values, "country_name")
        .groupBy(cal.year("order_date"), cal.month("order_date"), cal.month_name("order_date").alias("month_name"), "country_name")
        .agg(F.count(F.lit(1)).alias("order_volume"), total("net").alias("net_revenue"))
    )
    over_time = Window.partitionBy("country_name").orderBy("year", "month")
    in_year = (
        Window.partitionBy("country_name", "year")
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    trend = monthly.withColumn("previous_month_revenue", F.lag("net_revenue").over(over_time)).withColumn(
        "running_year_revenue", F.sum("net_revenue").over(in_year).cast(TOTAL)
    )
    change = F.col("net_revenue") - F.col("previous_month_revenue")
    return trend.select(
        "year",
        "month",
        "month_name",
        "country_name",
        "order_volume",
        "net_revenue",
        ratio("net_revenue", "order_volume").alias("average_order_value"),
        "previous_month_revenue",
        change.cast(TOTAL).alias("revenue_change"),
        percent(change, "previous_month_revenue").alias("revenue_change_percent"),
        "running_year_revenue",
    ).orderBy("country_name", "year", "month")
