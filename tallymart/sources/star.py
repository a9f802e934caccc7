"""The star: twelve tables plus the few joins that nearly every report starts from."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schema

TableSource = DataFrame | Callable[[], DataFrame]
Day = date | Column

# Date-id columns of a mart that keys its facts to the date dimension, and the
# real date each one becomes.
DATE_IDS: dict[str, dict[str, str]] = {
    "fact_sales_orders": {"order_date_id": "order_date", "ship_date_id": "ship_date"},
    "fact_order_line_items": {"date_id": "line_date"},
    "fact_returns": {"date_id": "return_date"},
    "fact_quotas": {"date_id": "quota_date"},
}


class Star:
    """Named tables, planned when first asked for."""

    def __init__(self, tables: Mapping[str, TableSource]):
        missing = [t for t in schema.TABLES if t not in tables]
        if missing:
            raise ValueError(f"star lacks tables: {', '.join(missing)}")
        self._sources = dict(tables)
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            source = self._sources[name]
            self._tables[name] = source if isinstance(source, DataFrame) else source()
        return self._tables[name]

    # -- facts ---------------------------------------------------------------

    def lines(self, *cols: str) -> DataFrame:
        """Order lines with the given columns."""
        return self["fact_order_line_items"].select(*cols)

    def returns(self, *cols: str) -> DataFrame:
        """Returns with the given columns."""
        return self["fact_returns"].select(*cols)

    def with_order(self, lines: DataFrame, orders: DataFrame | None = None) -> DataFrame:
        """Attach columns of all or the given orders to rows of ``bare_lines``; the result holds ``line_date``."""
        return lines.join(self["fact_sales_orders"] if orders is None else orders, "order_id")

    def order_lines(
        self, since: Day | None = None, until: Day | None = None, orders: DataFrame | None = None
    ) -> DataFrame:
        """Every line with its order's columns; ``since`` and ``until`` bound the line date.

        ``orders`` may hold attributes of the order's customer and rep: attached to
        orders they cost a join of orders, attached to lines a join of lines.
        """
        return self.with_order(self.lines_between(since, until) if since or until else self.bare_lines(), orders)

    def orders_placed(self, *region: str, customer: tuple[str, ...] = ()) -> DataFrame:
        """Orders with region columns of their customer, and customer columns."""
        return self.with_customer_geo(self["fact_sales_orders"], *region, customer=customer)

    def lines_between(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        """Lines of the days from ``since`` to ``until``; a layout with bounds of line dates leaves out other folders."""
        return self.dated(self["fact_order_line_items"], since, until, "line_date")

    def bare_lines(self) -> DataFrame:
        """Lines that are yet to meet their order; need not hold the line date."""
        return self["fact_order_line_items"]

    def returned_values(self, *keys: str, **sums: Column) -> DataFrame:
        """Sums over returns per line or coarser, with the line's order and product and the given return columns.

        Returns are summed per line before they meet the lines.
        """
        needed = [c for c in schema.columns_of("fact_returns") if c != "return_id"]
        per_line = self["fact_returns"].select(*needed).groupBy("line_item_id", *keys)
        per_line = per_line.agg(*[c.alias(n) for n, c in sums.items()])
        lines = self["fact_order_line_items"].select("line_item_id", "order_id", "product_id", "line_date")
        return per_line.join(lines, "line_item_id")

    def sales_of(self, per_line: DataFrame) -> DataFrame:
        """Attach line and order columns to rows keyed by ``line_item_id``.

        Lines are cut down to the wanted ones before they meet their orders.
        """
        return self.with_order(per_line.join(self.bare_lines(), "line_item_id"))

    @staticmethod
    def dated(rows: DataFrame, since: Day | None, until: Day | None, day: str = "order_date") -> DataFrame:
        """Rows of the days from ``since`` to ``until``."""
        rows = rows if since is None else rows.filter(F.col(day) >= F.lit(since))
        return rows if until is None else rows.filter(F.col(day) <= F.lit(until))

    def orders_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        """Orders of the days from ``since`` to ``until``."""
        return self.dated(self["fact_sales_orders"], since, until)

    def lines_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        """Bare lines, at least those of orders of these days; a layout by month leaves out other months."""
        return self.bare_lines()

    def order_values(
        self,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        since: Day | None = None,
        until: Day | None = None,
        **sums: Column,
    ) -> DataFrame:
        """One row per order that has lines: order columns and sums over the lines.

        Lines are summed per order before the join, so an order with very many
        lines reaches the join as one row.  ``since`` and ``until`` bound the order date.
        """
        lines = self.lines_dated(since, until)
        lines = prepare(lines) if prepare else lines
        per_order = lines.groupBy("order_id").agg(*[c.alias(n) for n, c in sums.items()])
        return per_order.join(self.orders_dated(since, until), "order_id")

    def dated_values(
        self,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        since: Day | None = None,
        until: Day | None = None,
        **sums: Column,
    ) -> DataFrame:
        """As ``order_values`` but one row per order and line date, which ``since`` and ``until`` bound."""
        lines = self.lines_between(since, until)
        lines = prepare(lines) if prepare else lines
        per_day = lines.groupBy("order_id", "line_date").agg(*[c.alias(n) for n, c in sums.items()])
        return per_day.join(self["fact_sales_orders"], "order_id")

    # -- dimension attributes ------------------------------------------------

    def with_customer(self, df: DataFrame, *cols: str) -> DataFrame:
        """Attach customer columns by ``customer_id``."""
        return df.join(self["dim_customers"].select("customer_id", *cols), "customer_id")

    def with_region(self, df: DataFrame, *cols: str) -> DataFrame:
        """Attach region columns by ``region_id``, which is used up."""
        regions = self["dim_regions"].select("region_id", *cols)
        return df.join(regions, "region_id").drop("region_id")

    def with_customer_geo(self, df: DataFrame, *cols: str, customer: tuple[str, ...] = ()) -> DataFrame:
        """Attach region columns of the row's customer, and customer columns."""
        return self.with_region(self.with_customer(df, "region_id", *customer), *cols)

    def with_rep(self, df: DataFrame, *cols: str) -> DataFrame:
        """Attach rep columns by ``sales_rep_id``."""
        return df.join(self["dim_sales_reps"].select("sales_rep_id", *cols), "sales_rep_id")

    def with_product(self, df: DataFrame, *cols: str) -> DataFrame:
        """Attach product columns by ``product_id``."""
        return df.join(self["dim_products"].select("product_id", *cols), "product_id")

    def with_category(self, df: DataFrame, *cols: str) -> DataFrame:
        """Attach category columns by ``category_id``, which is used up."""
        categories = self["dim_categories"].select("category_id", *cols)
        return df.join(categories, "category_id").drop("category_id")

    def with_product_category(self, df: DataFrame, *product: str) -> DataFrame:
        """Attach ``category_name`` and product columns by ``product_id``."""
        return self.with_category(self.with_product(df, "category_id", *product), "category_name")


def _real_dates(table: str, df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Replace date ids by the dates they stand for."""
    for id_col, date_col in DATE_IDS.get(table, {}).items():
        if id_col in df.columns:
            days = calendar.select(F.col("date_id").alias(id_col), F.col("full_date").alias(date_col))
            df = df.join(days, id_col, "left").drop(id_col)
    return df


def load_star(spark: SparkSession, path: str) -> Star:
    """The star stored under ``path``: the current release of a mart, or one parquet directory per table.

    Columns of plain directories are read by name and brought to the declared
    types.  Facts may hold real dates or ids of the date dimension.
    """
    from tallymart.sources.mart import mart_store, open_mart  # they build on this module

    if mart_store(spark, path).numbers():
        return open_mart(spark, path)

    def read(table: str) -> Callable[[], DataFrame]:
        def plan() -> DataFrame:
            df = spark.read.parquet(os.path.join(path, table))
            if any(c in df.columns for c in DATE_IDS.get(table, {})):
                calendar = spark.read.parquet(os.path.join(path, "dim_date"))
                df = _real_dates(table, df, calendar)
            declared = schema.schema_of(table)
            return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])

        return plan

    return Star({table: read(table) for table in schema.TABLES})
