"""Writing the mart: full reload, physical layout, view registration, publication and snapshots."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schema
from tallymart.params import ReportParams
from tallymart.plans.quality import dq_over_returned_lines, dq_overlapping_assignments
from tallymart.plans.stored import StoredViews, refresh, stored_sums
from tallymart.plans.views import TIERS, VIEWS
from tallymart.sinks.releases import MONTH, NO_MONTH, Release
from tallymart.sources.mart import LOAD_ORDER, load_mart, open_mart
from tallymart.sources.star import Day, Star


def replace_all(star: Star, path: str) -> Release:
    """Replace the mart under ``path`` by the star's rows, all tables at once: readers see the former one until then."""
    return load_mart(star, path)


# -- layout ------------------------------------------------------------------

# The join key and the sort inside a bucket, per large table.  Orders and lines
# share key and bucket count, so their join needs no shuffle.
CLUSTERING: dict[str, tuple[str, tuple[str, ...]]] = {
    "fact_sales_orders": ("order_id", ("order_id",)),
    "fact_order_line_items": ("order_id", ("order_id",)),
    "fact_returns": ("line_item_id", ("line_item_id",)),
    "rep_customer_assignments": ("customer_id", ("customer_id", "valid_from")),
    "product_promotions": ("product_id", ("product_id", "valid_from")),
    "dim_customers": ("customer_id", ("customer_id",)),
    "dim_products": ("product_id", ("product_id",)),
}


# Tables kept in a folder per month, and the date whose month it is; lines go by their order's.
MONTHLY = {"fact_sales_orders": "order_date", "fact_order_line_items": "order_date", "fact_quotas": "quota_date"}


def layout_tables(star: Star, database: str, path: str, buckets: int) -> None:
    """Write the mart as catalog tables: facts by month, the large tables bucketed and sorted by their join key.

    ``buckets`` is for the size of the mart: a bucket of a month should be some
    hundred MB.  Rows are sent to their bucket before the write, so a bucket is
    one file a month and not one file per task.
    """
    spark = star["dim_regions"].sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in LOAD_ORDER:
        df = star[table].select(*schema.columns_of(table))
        if table in MONTHLY:
            if MONTHLY[table] not in df.columns:
                df = df.join(star["fact_sales_orders"].select("order_id", MONTHLY[table]), "order_id", "left")
            month = F.coalesce(F.trunc(MONTHLY[table], "month"), F.lit(NO_MONTH))
            df = df.select(*schema.columns_of(table), month.alias(MONTH))
        writer = df.write
        if table in CLUSTERING:
            key, order = CLUSTERING[table]
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*order)
        writer = writer.partitionBy(MONTH) if table in MONTHLY else writer
        writer.mode("overwrite").format("parquet").option("path", os.path.join(path, table)).saveAsTable(
            f"{database}.{table}"
        )


class LaidOutStar(Star):
    """The star over catalog tables; bounds of the order date prune the months of orders and lines."""

    def __init__(self, spark: SparkSession, database: str):
        self._table = lambda t: spark.table(f"{database}.{t}")
        super().__init__({t: (lambda t=t: self._table(t).select(*schema.columns_of(t))) for t in schema.TABLES})

    def _months(self, table: str, since: Day | None, until: Day | None) -> DataFrame:
        df = self._table(table)
        df = df if since is None else df.filter(F.col(MONTH) >= F.trunc(F.lit(since), "month"))
        df = df if until is None else df.filter(F.col(MONTH) <= F.lit(until))
        return df.select(*schema.columns_of(table))

    def orders_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        return self.dated(self._months("fact_sales_orders", since, until), since, until)

    def lines_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        return self._months("fact_order_line_items", since, until)


def load_layout(spark: SparkSession, database: str) -> Star:
    """The star over the catalog tables ``layout_tables`` wrote."""
    return LaidOutStar(spark, database)


def drop_layout(spark: SparkSession, database: str) -> None:
    """Forget the catalog tables; the files stay for plain reads."""
    for table in reversed(LOAD_ORDER):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")


# -- views -------------------------------------------------------------------


def register_views(star: Star, p: ReportParams) -> list[str]:
    """Create the temporary views, tier 1 first; replaces views of the same name."""
    names = []
    for tier in TIERS:
        for view in tier:
            view(star, p).createOrReplaceTempView(view.__name__)
            names.append(view.__name__)
    return names


def drop_views(spark: SparkSession) -> list[str]:
    """Drop the temporary views, tier 3 first; a missing view is no error."""
    dropped = []
    for tier in reversed(TIERS):
        for view in reversed(tier):
            if spark.catalog.dropTempView(view.__name__):
                dropped.append(view.__name__)
    return dropped


# View, when it is refreshed, how many days old its snapshot may be; a plain view keeps none.
REFRESH: tuple[tuple[str, str, int | None], ...] = (
    ("vw_sales_executive_summary", "daily", 1),
    ("vw_customer_360", "nightly", 1),
    ("vw_product_performance", "nightly", 1),
    ("vw_rep_performance_scorecard", "daily", 0),
    ("vw_monthly_trend", "on read", None),
    ("vw_returns_analysis", "on read", None),
)
SNAPSHOTS = tuple(name for name, _, days in REFRESH if days is not None)

# What must be settled before a view is published.
GATES = {
    "vw_rep_performance_scorecard": ("dq_overlapping_assignments", dq_overlapping_assignments),
    "vw_product_performance": ("dq_over_returned_lines", dq_over_returned_lines),
}


class PublicationBlocked(RuntimeError):
    """A check that gates a view has findings."""


class StaleSnapshot(LookupError):
    """No snapshot is as young as the view's tolerance asks."""


def materialize_views(
    star: Star,
    p: ReportParams,
    path: str,
    names: Iterable[str] = SNAPSHOTS,
    gated: bool = True,
    views: Mapping[str, Callable[[Star, ReportParams], DataFrame]] = VIEWS,
) -> list[str]:
    """Write a snapshot of each view under ``path/<view>/as_of=<day>``.

    Only the day's own partition is replaced; earlier snapshots stay.  Nothing
    is written while a check that gates one of the views has findings.
    """
    names, written = list(names), []
    for name in names if gated else ():
        check, run = GATES.get(name, (None, None))
        if check and not run(star, p).isEmpty():
            raise PublicationBlocked(f"{name} waits until {check} is empty")
    for name in names:
        target = os.path.join(path, name)
        snapshot = views[name](star, p).withColumn("as_of", F.lit(p.as_of))
        snapshot.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(target)
        written.append(target)
    return written


def refresh_views(
    spark: SparkSession,
    mart_path: str,
    sums_path: str,
    p: ReportParams,
    path: str,
    names: Iterable[str] = SNAPSHOTS,
    gated: bool = True,
) -> set[str]:
    """Snapshots of the mart's current release from its stored sums; the order months whose sums were written anew."""
    release, months = refresh(spark, mart_path, sums_path)
    star = open_mart(spark, mart_path, release.notes["mart"])
    stored = StoredViews(stored_sums(spark, sums_path), release)
    materialize_views(star, p, path, names, gated, stored.all())
    return months


def read_current(spark: SparkSession, path: str, name: str, today: date) -> DataFrame:
    """The newest snapshot of a view, which must be no older than the view's tolerance."""
    tolerance = {n: days for n, _, days in REFRESH}[name]
    found = spark.read.parquet(os.path.join(path, name)).filter(F.col("as_of") <= F.lit(today))
    newest = found.agg(F.max("as_of")).first()[0]
    if newest is None or (today - newest).days > tolerance:
        raise StaleSnapshot(f"the newest snapshot of {name} is of {newest}; it may be {tolerance} days old")
    return read_snapshot(spark, path, name, newest)


def read_snapshot(spark: SparkSession, path: str, name: str, as_of: date) -> DataFrame:
    """One snapshot of a view, of any age."""
    return spark.read.parquet(os.path.join(path, name)).filter(F.col("as_of") == F.lit(as_of)).drop("as_of")
