"""The mart as releases: loaded at once, added to by month, read as it was published."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schema
from tallymart.sinks.releases import MONTH, NO_MONTH, Release, ReleaseStore
from tallymart.sources.star import Day, Star

#: Tables kept in a folder per month and the date whose month it is; lines and returns go by their order's.
MONTHLY = {
    "fact_sales_orders": "order_date",
    "fact_order_line_items": "order_date",
    "fact_returns": "order_date",
    "fact_quotas": "quota_date",
}
#: Date columns whose first and last day per folder are known.
DATED = {"fact_order_line_items": ("line_date",), "fact_returns": ("return_date",)}
# Parents before children.
LOAD_ORDER = (
    "dim_regions",
    "dim_categories",
    "dim_date",
    "dim_sales_reps",
    "dim_customers",
    "dim_products",
    "rep_customer_assignments",
    "product_promotions",
    "fact_quotas",
    "fact_sales_orders",
    "fact_order_line_items",
    "fact_returns",
)


def mart_store(spark: SparkSession, path: str) -> ReleaseStore:
    """The store of a mart's releases under ``path``."""
    return ReleaseStore(spark, path, {t: schema.schema_of(t) for t in schema.TABLES}, MONTHLY, DATED)


def _month(day: str):
    return F.trunc(day, "month").alias(MONTH)


def _with_months(new: Mapping[str, DataFrame], orders: DataFrame, lines: DataFrame | None) -> dict[str, DataFrame]:
    """New rows with their month; ``orders`` and ``lines`` are those that were there, with theirs.

    A line whose order is not there and a return whose line is not there have no month.
    """
    found = dict(new)
    for table in ("fact_sales_orders", "fact_quotas"):
        if table in new:
            found[table] = new[table].select("*", _month(MONTHLY[table]))
    of_order = orders.select("order_id", MONTH)
    if "fact_sales_orders" in new:
        of_order = of_order.unionByName(found["fact_sales_orders"].select("order_id", MONTH))
    if "fact_order_line_items" in new:
        found["fact_order_line_items"] = new["fact_order_line_items"].join(of_order, "order_id", "left")
    if "fact_returns" in new:
        of_line = [] if lines is None else [lines.select("line_item_id", MONTH)]
        if "fact_order_line_items" in new:
            of_line.append(found["fact_order_line_items"].select("line_item_id", MONTH))
        known = of_line[0] if len(of_line) == 1 else of_line[0].unionByName(of_line[1])
        found["fact_returns"] = new["fact_returns"].join(known, "line_item_id", "left")
    return found


def load_mart(star: Star, path: str) -> Release:
    """A release of all of the star's rows.  Readers see the former release until every table is written."""
    spark = star["dim_regions"].sparkSession
    tables = {t: star[t].select(*schema.columns_of(t)) for t in LOAD_ORDER}
    nothing = tables["fact_sales_orders"].limit(0).select("order_id", F.lit(None).cast("date").alias(MONTH))
    return mart_store(spark, path).publish(_with_months(tables, nothing, None))


def append_to_mart(spark: SparkSession, path: str, new: Mapping[str, DataFrame]) -> Release:
    """The mart with new rows of some tables.  Lines may be of orders, and returns of lines, that were there.

    Reads the keys of former orders and lines where new lines or returns need their month.
    """
    store = mart_store(spark, path)
    now = store.release()
    orders, lines = (store.read(t, now) for t in ("fact_sales_orders", "fact_order_line_items"))
    return store.append(_with_months(new, orders, lines))


def replace_in_mart(spark: SparkSession, path: str, new: Mapping[str, DataFrame], months: Iterable[str]) -> Release:
    """The mart with whole months of orders, lines and returns written anew, for corrections of what was loaded.

    ``new`` has all three, with all rows of orders of these months; other months are not read.
    """
    wanted = ("fact_sales_orders", "fact_order_line_items", "fact_returns")
    if set(new) != set(wanted):
        raise ValueError(f"needs {', '.join(wanted)}")
    nothing = new["fact_sales_orders"].limit(0).select("order_id", F.lit(None).cast("date").alias(MONTH))
    found = _with_months(new, nothing, None)
    months = set(months)
    inside = {t: df.filter(F.coalesce(F.col(MONTH), F.lit(NO_MONTH)).cast("string").isin(*months)) for t, df in found.items()}
    return mart_store(spark, path).replace_months(inside, months)


class ReleasedStar(Star):
    """The star of one release, whatever is published later; bounds of order and line dates prune folders."""

    def __init__(self, store: ReleaseStore, release: Release, months: Iterable[str] | None = None):
        self.store, self.release = store, release
        self._only = None if months is None else set(months)
        super().__init__({t: (lambda t=t: self._columns(t, self._read(t))) for t in schema.TABLES})

    def _read(self, table: str, **days) -> DataFrame:
        # quotas are no fact of an order: they have months of their own
        only = self._only if table in MONTHLY and table != "fact_quotas" else None
        return self.store.read(table, self.release, only, **days)

    @staticmethod
    def _columns(table: str, df: DataFrame) -> DataFrame:
        return df.select(*schema.columns_of(table))

    def monthly(self, table: str, *cols: str) -> DataFrame:
        """Rows of a fact with the month of their order."""
        return self._read(table).select(*cols, MONTH)

    def _in_months(self, table: str, since: Day | None, until: Day | None) -> DataFrame:
        """A fact in the months of these order days."""
        rows = self._read(table)
        rows = rows if since is None else rows.filter(F.col(MONTH) >= F.trunc(F.lit(since), "month"))
        return self._columns(table, rows if until is None else rows.filter(F.col(MONTH) <= F.lit(until)))

    def orders_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        return self.dated(self._in_months("fact_sales_orders", since, until), since, until)

    def lines_dated(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        return self._in_months("fact_order_line_items", since, until)

    def lines_between(self, since: Day | None = None, until: Day | None = None) -> DataFrame:
        # a bound that is an expression is left to the filter on rows
        days = {k: v for k, v in (("since", since), ("until", until)) if isinstance(v, date)}
        lines = self._read("fact_order_line_items", **({"column": "line_date"} | days if days else {}))
        return self.dated(self._columns("fact_order_line_items", lines), since, until, "line_date")


def open_mart(
    spark: SparkSession, path: str, number: int | None = None, months: Iterable[str] | None = None
) -> ReleasedStar:
    """The star of a release, by default the current one; of some order months only if they are given."""
    store = mart_store(spark, path)
    release = store.release(number)
    if release is None:
        raise LookupError(f"no release under {path}")
    return ReleasedStar(store, release, months)


