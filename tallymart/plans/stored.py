"""Sums kept per order month, and the views that are answered from them.

Every stored table is additive over months of orders: an order, its lines and their returns all count in
the order's month, so new or late rows change the months of their orders and no others.  ``refresh``
finds these months from the parts that came or went between two releases of the mart and writes
them anew; a view then reads sums, never lines.

The sums hold keys, not names: attributes and costs come from the dimensions when a view is read.
Views are equal to those over the facts where references hold (``dq_foreign_key`` finds nothing).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.functions import calendar as cal
from tallymart.functions.money import total, units
from tallymart.operators import bitmaps
from tallymart.params import ReportParams
from tallymart.plans import views
from tallymart.plans.advanced import NOT_CANCELLED
from tallymart.sinks.releases import MONTH, Release, ReleaseStore
from tallymart.sources.mart import MONTHLY, ReleasedStar, mart_store
from tallymart.sources.star import Star

_TOTAL = "decimal(28,2)"
FACTS = tuple(t for t in MONTHLY if t != "fact_quotas")

#: Stored tables.  ``orders`` counts an order on its last day, ``order_months`` in each month of its lines.
STORED = {
    "sales_by_customer_day": "customer_id bigint, sales_rep_id bigint, day date, "
    f"net {_TOTAL}, sold bigint, orders bigint, order_months bigint, returned bigint",
    "sales_by_product_month": f"sales_rep_id bigint, product_id bigint, period_start_date date, net {_TOTAL}, "
    "sold bigint, returned bigint",
    "customers_of_rep_month": f"sales_rep_id bigint, period_start_date date, {bitmaps.SET}",
}


def stored_sums(spark: SparkSession, path: str) -> ReleaseStore:
    """The store of the sums under ``path``."""
    return ReleaseStore(spark, path, {t: StructType.fromDDL(ddl) for t, ddl in STORED.items()}, STORED)


def _valid_orders(mart: ReleasedStar, *cols: str) -> DataFrame:
    return mart.monthly("fact_sales_orders", "order_id", "order_status", *cols).filter(NOT_CANCELLED).drop("order_status")


def _returned(mart: ReleasedStar, *line: str) -> DataFrame:
    """Units returned per line, with the line's columns; months are those of orders on both sides."""
    per_line = mart.monthly("fact_returns", "line_item_id", "return_quantity").groupBy("line_item_id", MONTH).agg(
        units("return_quantity").alias("returned")
    )
    return per_line.join(mart.monthly("fact_order_line_items", "line_item_id", "order_id", *line), ["line_item_id", MONTH])


def sales_by_customer_day(mart: ReleasedStar) -> DataFrame:
    orders = _valid_orders(mart, "customer_id", "sales_rep_id")
    keys = [MONTH, "customer_id", "sales_rep_id"]
    lines = mart.monthly("fact_order_line_items", "order_id", "line_date", "net_amount", "quantity")
    days = lines.groupBy(MONTH, "order_id", F.col("line_date").alias("day")).agg(
        total("net_amount").alias("net"), units("quantity").alias("sold")
    )
    days = days.join(orders, [MONTH, "order_id"])

    def last_of(*span) -> Column:
        """Whether the row is the last day of its order in the span; an order without days has one row."""
        last = F.max("day").over(Window.partitionBy(MONTH, "order_id", *span))
        return F.col("day").eqNullSafe(last).cast("bigint")

    days = days.withColumn("orders", last_of()).withColumn("order_months", last_of(cal.month_start("day")))
    sold = days.groupBy(*keys, "day").agg(
        total("net").alias("net"), *(units(c).alias(c) for c in ("sold", "orders", "order_months"))
    )
    returned = (
        _returned(mart).groupBy(MONTH, "order_id").agg(units("returned").alias("returned"))
        .join(orders, [MONTH, "order_id"]).groupBy(*keys).agg(units("returned").alias("returned"))
    )
    return sold.unionByName(returned, allowMissingColumns=True)


def sales_by_product_month(mart: ReleasedStar) -> DataFrame:
    orders = _valid_orders(mart, "sales_rep_id")
    keys = [MONTH, "sales_rep_id", "product_id"]
    period = cal.month_start("line_date").alias("period_start_date")
    lines = mart.monthly("fact_order_line_items", "order_id", "product_id", "line_date", "net_amount", "quantity")
    sold = lines.join(orders, [MONTH, "order_id"]).groupBy(*keys, period).agg(
        total("net_amount").alias("net"), units("quantity").alias("sold")
    )
    returned = (
        _returned(mart, "product_id").groupBy(MONTH, "order_id", "product_id").agg(units("returned").alias("returned"))
        .join(orders, [MONTH, "order_id"]).groupBy(*keys).agg(units("returned").alias("returned"))
    )
    return sold.unionByName(returned, allowMissingColumns=True)


def customers_of_rep_month(mart: ReleasedStar) -> DataFrame:
    orders = _valid_orders(mart, "customer_id", "sales_rep_id")
    lines = mart.monthly("fact_order_line_items", "order_id", "line_date")
    months = lines.select(MONTH, "order_id", cal.month_start("line_date").alias("period_start_date")).distinct()
    bought = months.join(orders, [MONTH, "order_id"])
    return bitmaps.id_sets(bought, [MONTH, "sales_rep_id", "period_start_date"], "customer_id")


BUILD: dict[str, Callable[[ReleasedStar], DataFrame]] = {
    f.__name__: f for f in (sales_by_customer_day, sales_by_product_month, customers_of_rep_month)
}


#: Bytes of facts, as stored, whose sums are made in one pass.
PASS = 512 * 1024 * 1024


def _passes(mart: ReleaseStore, release: Release, months: set[str]) -> list[set[str]]:
    """The months in groups of at most ``PASS`` bytes of facts, or of one month.

    Sums of a month are made of its facts alone, so what a refresh has on disk at a time is bounded."""
    sizes, passes, room = mart.sizes(release, *FACTS), [], 0
    for month in sorted(months & sizes.keys()):  # a month of which all is gone has no sums
        if not passes or sizes[month] > room:
            passes.append(set())
            room = PASS
        passes[-1].add(month)
        room -= sizes[month]
    return passes


def _sums(mart: ReleaseStore, release: Release, months: set[str]) -> dict[str, list[DataFrame]]:
    stars = [ReleasedStar(mart, release, some) for some in _passes(mart, release, months)]
    return {n: [build(star) for star in stars] for n, build in BUILD.items()}


def refresh(spark: SparkSession, mart_path: str, path: str) -> tuple[Release, set[str]]:
    """Brings the sums under ``path`` up to the mart's current release; the release of the sums and the months written.

    Only facts of the changed months are read, in passes of bounded size.  All months are written the first time, and where the release
    that the sums stand at was removed.  Nothing is written if nothing changed.
    """
    mart, sums = mart_store(spark, mart_path), stored_sums(spark, path)
    now, done = mart.release(), sums.release()
    if now is None:
        raise LookupError(f"no release under {mart_path}")
    stands_at = None if done is None else done.notes["mart"]
    if stands_at == now.number:
        return done, set()
    notes = {"mart": now.number}
    if stands_at not in mart.numbers():
        every = now.months(*FACTS)
        return sums.publish(_sums(mart, now, every), notes), every
    months = mart.changed_months(mart.release(stands_at), now, *FACTS)
    return sums.replace_months(_sums(mart, now, months) if months else {}, months, notes), months


class StoredViews:
    """The views that are kept as snapshots, and the trend, over one release of the sums.

    ``star`` gives the dimensions and quotas; it should be of the mart's release that the sums stand at.
    """

    def __init__(self, sums: ReleaseStore, release: Release | None = None):
        self.sums, self.release = sums, release or sums.release()

    def _sold(self, table: str) -> DataFrame:
        """Rows of sales; those of returns alone have no revenue."""
        return self.sums.read(table, self.release).filter(F.col("net").isNotNull())

    def vw_sales_executive_summary(self, star: Star, p: ReportParams) -> DataFrame:
        keys = ["sales_rep_id", "period_start_date"]
        orders = self._sold("sales_by_customer_day").groupBy(
            "sales_rep_id", cal.month_start("day").alias("period_start_date")
        ).agg(units("order_months").alias("orders"), total("net").alias("net"))
        units_sold = self._sold("sales_by_product_month").groupBy(*keys, "product_id").agg(units("sold").alias("sold"))
        cost = star.with_product(units_sold, "unit_cost").groupBy(*keys).agg(
            total(F.col("sold") * F.col("unit_cost")).alias("cost")
        )
        # stacked, not joined: a null month stays
        return views.executive_figures(star, orders.unionByName(cost, allowMissingColumns=True).groupBy(*keys).agg(
            units("orders").alias("orders"), total("net").alias("net"), total("cost").alias("cost")
        ))

    def vw_customer_360(self, star: Star, p: ReportParams) -> DataFrame:
        since = F.col("day") >= cal.months_before(p.as_of, 12)
        sales = self.sums.read("sales_by_customer_day", self.release).groupBy("customer_id").agg(
            total("net").alias("lifetime"),
            units("orders").alias("orders"),
            F.max(F.when(F.col("orders") > 0, F.col("day"))).alias("last_order_date"),
            units("sold").alias("sold"),
            units(F.when(since, F.col("orders")).otherwise(0)).alias("recent_orders"),
            total(F.when(since, F.col("net")).otherwise(0)).alias("recent_net"),
            units("returned").alias("returned"),
        )
        return views.customer_profiles(star, p, sales.filter(F.col("lifetime").isNotNull()))

    def vw_product_performance(self, star: Star, p: ReportParams) -> DataFrame:
        sold = self.sums.read("sales_by_product_month", self.release).groupBy("product_id").agg(
            units("sold").alias("total_units_sold"), total("net").alias("net_revenue"), units("returned").alias("returned")
        )
        return views.product_figures(star, sold.filter(F.col("net_revenue").isNotNull()))

    def vw_rep_performance_scorecard(self, star: Star, p: ReportParams) -> DataFrame:
        """Customers of whole months come from the stored sets, those of the month of ``as_of`` from its days."""
        year, this_month = date(p.as_of.year, 1, 1), p.as_of.replace(day=1)
        quarter = cal.quarter_days(p.as_of.year, (p.as_of.month + 2) // 3)[0]
        days = self._sold("sales_by_customer_day").filter(F.col("day").between(F.lit(year), F.lit(p.as_of)))
        net = days.groupBy("sales_rep_id").agg(
            total(F.when(F.col("day") >= F.lit(quarter), F.col("net")).otherwise(0)).alias("qtd_net"),
            total("net").alias("ytd_net"),
        )
        period = F.col("period_start_date")
        whole = self.sums.read("customers_of_rep_month", self.release).filter(
            (period >= F.lit(year)) & (period < F.lit(this_month))
        ).select("sales_rep_id", "period_start_date", "bucket", "members")
        begun = days.filter(F.col("day") >= F.lit(this_month)).withColumn("period_start_date", F.lit(this_month))
        sets = whole.unionByName(bitmaps.id_sets(begun, ["sales_rep_id", "period_start_date"], "customer_id"))
        ytd = bitmaps.counts(sets, ["sales_rep_id"], "ytd_customers")
        qtd = bitmaps.counts(sets.filter(period >= F.lit(quarter)), ["sales_rep_id"], "qtd_customers")
        sales = net.join(ytd, "sales_rep_id", "left").join(qtd, "sales_rep_id", "left")
        return views.rep_figures(star, p, sales)

    def vw_monthly_trend(self, star: Star, p: ReportParams) -> DataFrame:
        sales = self._sold("sales_by_customer_day").groupBy(
            "customer_id", cal.month_start("day").alias("period_start_date")
        ).agg(units("order_months").alias("orders"), total("net").alias("net"))
        return views.trend_figures(star, sales)

    def all(self) -> dict[str, views.View]:
        """The views by name."""
        return {n: getattr(self, n) for n in VIEW_NAMES}

    def catalogue(self) -> dict[str, views.View]:
        """Every view: from the sums where they cover its keys and figures, else from the facts."""
        return views.VIEWS | self.all()


VIEW_NAMES = (
    "vw_sales_executive_summary",
    "vw_customer_360",
    "vw_product_performance",
    "vw_rep_performance_scorecard",
    "vw_monthly_trend",
)
