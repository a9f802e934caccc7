"""The star derived from order-processing tables (region, nation, customer,
supplier, part, orders, lineitem).

Every source row is kept, under its own keys.  With ``spare_keys`` orders of one
account in a hundred are billed to the account before it, and one part in a
hundred is sold under the part before it, so that anti joins find something.
Keys are expressions of source columns, so no row has to be numbered.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schema
from tallymart.functions.money import MONEY
from tallymart.sources.generate import date_rows
from tallymart.sources.star import Day, Star

# Fixed values of the derived mart.
EPOCH = date(1995, 1, 1)
HANDOVER = date(1998, 1, 1)
JOB_TITLES = ("Rep grade 1", "Rep grade 2", "Rep grade 3", "Rep grade 4")
GROUPS = ("A", "B", "C", "D")
STATUSES = ("Active", "Inactive", "Prospect")
TIERS = ("Gold", "Silver", "Bronze")
TERMS = ("30 days", "45 days", "60 days", "In advance")
OPEN_STATES = ("Pending", "Confirmed", "Cancelled")
REASONS = ("Broken", "Late", "Other item", "Not wanted", "Faulty")
CORE_TYPES = ("ECONOMY", "STANDARD")
COST_FACTORS = {"PROMO": "2.4", "LARGE": "2.2"}
KEY_PRIME = 2147483647
KEY_FACTORS = (1000003, 998244)
PROMO_RATES = ("0.05", "0.07", "0.10", "0.12", "0.15")


def pick(index: Column, values: tuple[str, ...]) -> Column:
    """The value at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def hundredths(amount: Column) -> Column:
    """A non-negative amount held as double, in whole hundredths."""
    return F.floor(amount * 100 + 0.5)


def divided(num: Column, den: Column) -> Column:
    """Integer quotient rounded half-up, of non-negative integers."""
    return F.call_function("div", num * 2 + den, den * 2)


def as_money(cents: Column) -> Column:
    return (cents.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def type_key(p_type: Column) -> Column:
    """Category key: 60 bits of a digest of the type name."""
    return F.conv(F.substring(F.md5(p_type), 1, 15), 16, 10).cast("bigint")


class ConformedStar(Star):
    """The star over one directory of order-processing parquet files."""

    def __init__(self, spark: SparkSession, path: str, spare_keys: bool = False):
        self._spark = spark
        self._path = path
        self._spare_keys = spare_keys
        self._files: dict[str, DataFrame] = {}
        super().__init__({t: getattr(self, f"_{t}") for t in schema.TABLES})

    def _read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self._spark.read.parquet(os.path.join(self._path, f"{name}.parquet"))
        return self._files[name]

    @cached_property
    def _rep_count(self) -> Column:
        return self._read("supplier").select(F.count(F.lit(1))).scalar()

    def _spare(self, key: str) -> Column:
        """The key a row counts under; with spare keys every hundredth gives its rows to the one before."""
        k = F.col(key)
        return k - (k % 100 == 99).cast("bigint") if self._spare_keys else k

    @cached_property
    def _calendar(self) -> tuple[Column, Column]:
        """First and last day of the years in which there are orders."""
        orders = self._read("orders")
        first = orders.select(F.year(F.min("o_orderdate"))).scalar()
        last = orders.select(F.year(F.max("o_orderdate"))).scalar()
        return F.make_date(first, F.lit(1), F.lit(1)), F.make_date(last, F.lit(12), F.lit(31))

    def _base_rep(self, custkey: Column) -> Column:
        """The rep an account belongs to: nine tenths of the reps hold accounts."""
        return custkey % F.floor(self._rep_count * 9 / 10) + 1

    # -- dimensions ----------------------------------------------------------

    def _dim_regions(self) -> DataFrame:
        nations, regions = self._read("nation"), self._read("region")
        return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
            (F.col("n_nationkey") + 1).alias("region_id"),
            F.col("r_name").alias("country_name"),
            F.col("n_name").alias("region_name"),
            F.concat("n_name", F.lit(" Territory")).alias("territory_name"),
        )

    def _dim_categories(self) -> DataFrame:
        types = self._read("part").select("p_type").distinct()
        return types.select(
            type_key(F.col("p_type")).alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.when(F.col("p_type").isin(*CORE_TYPES), "Core").otherwise("Extended").alias("segment_name"),
            F.lit(None).cast("bigint").alias("parent_category_id"),
        )

    def _dim_date(self) -> DataFrame:
        return date_rows(self._spark, *self._calendar)

    def _dim_sales_reps(self) -> DataFrame:
        key = F.col("s_suppkey")
        hired = F.date_sub(F.lit(EPOCH), (key % 365).cast("int"))
        return self._read("supplier").select(
            (key + 1).alias("sales_rep_id"),
            F.concat(F.lit("REP"), F.lpad((key + 1).cast("string"), 6, "0")).alias("employee_code"),
            F.col("s_name").alias("rep_name"),
            hired.alias("hire_date"),
            pick(key % 4, JOB_TITLES).alias("job_title"),
            F.lit("Active").alias("sales_rep_status"),
            (key % 20 != 19).alias("is_active"),
            hired.alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
            (F.col("s_nationkey") + 1).alias("region_id"),
        )

    def _dim_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        number = (key + 1).cast("string")
        return self._read("customer").select(
            (key + 1).alias("customer_id"),
            F.concat(F.lit("CUST"), F.lpad(number, 8, "0")).alias("customer_code"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_type"),
            pick(key % 4, GROUPS).alias("customer_group"),
            pick(key % 3, STATUSES).alias("customer_status"),
            pick(key % 3, TIERS).alias("account_tier"),
            (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 10).cast(MONEY).alias("credit_limit"),
            F.concat(F.lit("Street "), number, F.lit(", City "), number).alias("billing_address"),
            F.lit(True).alias("is_active"),
            F.lit(EPOCH).cast("timestamp_ntz").alias("created_at"),
            (F.col("c_nationkey") + 1).alias("region_id"),
        )

    def _dim_products(self) -> DataFrame:
        key = F.col("p_partkey")
        factor = F.lit("1.5").cast("decimal(2,1)")
        for p_type, f in COST_FACTORS.items():
            factor = F.when(F.col("p_type") == p_type, F.lit(f).cast("decimal(2,1)")).otherwise(factor)
        cost = (F.col("p_retailprice").cast(MONEY) * factor).cast(MONEY)
        markup = F.when((key % 8).isin(0, 2), F.lit("3.5").cast("decimal(2,1)")).otherwise(
            F.lit("1.7").cast("decimal(2,1)")
        )
        return self._read("part").select(
            (key + 1).alias("product_id"),
            F.concat(F.lit("SKU"), F.lpad((key + 1).cast("string"), 8, "0")).alias("product_sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_size").alias("stock_level"),
            F.lit("Active").alias("product_status"),
            F.col("p_type").alias("product_type"),
            F.col("p_brand").alias("brand"),
            (key % 50 != 48).alias("is_active"),
            cost.alias("unit_cost"),
            (cost * markup).cast(MONEY).alias("list_price"),
            F.lit(EPOCH).alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
            type_key(F.col("p_type")).alias("category_id"),
        )

    # -- bridges -------------------------------------------------------------

    def _rep_customer_assignments(self) -> DataFrame:
        """A current window per customer; three in ten also have an earlier one,
        and some of those run on into the current window."""
        customer = F.col("c_custkey") + 1
        handed_over = customer % 10 < 3
        current = F.struct(
            (customer * 2).alias("assignment_id"),
            self._base_rep(F.col("c_custkey")).alias("sales_rep_id"),
            customer.alias("customer_id"),
            F.when(handed_over, F.lit(HANDOVER)).otherwise(F.lit(EPOCH)).alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
            F.lit(True).alias("is_active"),
        )
        earlier = F.struct(
            (customer * 2 + 1).alias("assignment_id"),
            ((customer + 5) % self._rep_count + 1).alias("sales_rep_id"),
            customer.alias("customer_id"),
            F.lit(EPOCH).alias("valid_from"),
            F.when(customer % 50 == 2, F.lit(date(1998, 1, 31))).otherwise(F.lit(date(1997, 12, 31))).alias("valid_to"),
            F.lit(False).alias("is_active"),
        )
        windows = F.when(handed_over, F.array(current, earlier)).otherwise(F.array(current))
        return self._read("customer").select(F.inline(windows))

    def _product_promotions(self) -> DataFrame:
        """One calendar month for three products in five, and an open-ended
        promotion that begins inside that month for one in ten."""
        product = F.col("p_partkey") + 1
        slot = (product % 5).cast("int")
        first = F.make_date(slot + 1996, (product % 12 + 1).cast("int"), F.lit(1))
        monthly = F.struct(
            (product * 2).alias("promotion_id"),
            first.alias("valid_from"),
            F.last_day(first).alias("valid_to"),
            pick(slot, PROMO_RATES).cast("decimal(5,4)").alias("discount_rate"),
            product.alias("product_id"),
        )
        open_ended = F.struct(
            (product * 2 + 1).alias("promotion_id"),
            F.date_add(first, 10).alias("valid_from"),
            F.lit(None).cast("date").alias("valid_to"),
            F.lit("0.20").cast("decimal(5,4)").alias("discount_rate"),
            product.alias("product_id"),
        )
        none = F.array().cast(
            "array<struct<promotion_id:bigint,valid_from:date,valid_to:date,"
            "discount_rate:decimal(5,4),product_id:bigint>>"
        )
        windows = F.concat(
            F.when(slot < 3, F.array(monthly)).otherwise(none),
            F.when(product % 10 == 0, F.array(open_ended)).otherwise(none),
        )
        return self._read("part").select(F.inline(windows))

    # -- facts ---------------------------------------------------------------

    def _fact_sales_orders(self) -> DataFrame:
        order_id = F.col("o_orderkey") + 1
        account = self._spare("o_custkey")
        ordered = F.col("o_orderdate").cast("date")
        status = (
            F.when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "P", "Partially Delivered")
            .otherwise(pick(F.col("o_orderkey") % 3, OPEN_STATES))
        )
        rep = self._base_rep(account)
        shipped = F.when(~status.isin("Pending", "Cancelled"), F.date_add(ordered, (order_id % 20 + 5).cast("int")))
        return self._read("orders").select(
            order_id.alias("order_id"),
            status.alias("order_status"),
            pick(order_id % 4, TERMS).alias("payment_terms"),
            F.lit("Sales Order").alias("document_type"),
            F.lit("Main").alias("sales_org"),
            F.when(order_id % 2 == 0, "Dealer").otherwise("Direct").alias("distribution_channel"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
            (account + 1).alias("customer_id"),
            F.when(order_id % 12 == 0, rep % self._rep_count + 1).otherwise(rep).alias("sales_rep_id"),
            ordered.alias("order_date"),
            shipped.alias("ship_date"),
        )

    @staticmethod
    def _line_key() -> Column:
        """The order id and a 62-bit digest of the line's other columns.

        Two multiply-and-add hashes in plain integer arithmetic, each part
        reduced first, so no value overflows; a collision would have to fall
        inside one order.
        """
        parts = [
            F.col("l_partkey"),
            F.col("l_suppkey"),
            hundredths(F.col("l_extendedprice")),
            F.col("l_linenumber").cast("bigint"),
            hundredths(F.col("l_quantity")),
            hundredths(F.col("l_discount") * 100),
            hundredths(F.col("l_tax") * 100),
            F.ascii("l_returnflag"),
            F.ascii("l_linestatus"),
            F.unix_date(F.col("l_shipdate").cast("date")),
        ]
        digests = []
        for factor in KEY_FACTORS:
            digest = F.lit(0).cast("bigint")
            for part in parts:
                digest = (digest * factor + part % KEY_PRIME) % KEY_PRIME
            digests.append(digest)
        return F.concat_ws("-", F.col("l_orderkey") + 1, digests[0] * KEY_PRIME + digests[1])

    @cached_property
    def _undated_lines(self) -> DataFrame:
        """Lines without their date, which is the order's."""
        # Whole units, rounded half-up; the price divides by the quantity as it is.
        quantity = hundredths(F.col("l_quantity"))
        gross, rate = hundredths(F.col("l_extendedprice")), hundredths(F.col("l_discount") * 100)
        return self._read("lineitem").select(
            self._line_key().alias("line_item_id"),
            F.floor(F.col("l_quantity") + 0.5).cast("int").alias("quantity"),
            as_money(divided(gross * 100, F.nullif(quantity, F.lit(0)))).alias("unit_price"),
            F.col("l_discount").cast("decimal(5,4)").alias("discount"),
            as_money(gross).alias("gross_amount"),
            as_money(divided(gross * (10000 - rate), F.lit(10000))).alias("net_amount"),
            (F.col("l_orderkey") + 1).alias("order_id"),
            (self._spare("l_partkey") + 1).alias("product_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_returnflag").alias("return_flag"),
        )

    def _order_dates(self) -> DataFrame:
        return self["fact_sales_orders"].select("order_id", "order_date")

    def _fact_order_line_items(self) -> DataFrame:
        # a line without its order stays, without a date
        dated = self._undated_lines.join(self._order_dates(), "order_id", "left")
        return dated.withColumnRenamed("order_date", "line_date").select(*schema.columns_of("fact_order_line_items"))

    @cached_property
    def _undated_returns(self) -> DataFrame:
        n = F.col("quantity")
        returned = (
            F.when((n == 1) & (F.col("line_number") == 1), 2)
            .when((F.col("line_number") % 2 == 0) & (n >= 2), F.floor(n / 2).cast("int"))
            .otherwise(1)
        )
        credit = (returned * F.col("unit_price") * (1 - F.col("discount"))).cast(MONEY)
        return (
            self._undated_lines
            .filter(F.col("return_flag") == "R")
            .select(
                F.col("line_item_id").alias("return_id"),
                F.lit("Open").alias("return_status"),
                returned.alias("return_quantity"),
                credit.alias("credit_amount"),
                pick((F.col("order_id") + F.col("line_number")) % 5, REASONS).alias("return_reason"),
                "line_item_id",
                "order_id",
                "product_id",
            )
        )

    def _fact_returns(self) -> DataFrame:
        dated = self._undated_returns.join(self._order_dates(), "order_id", "left")
        return dated.withColumnRenamed("order_date", "return_date").select(*schema.columns_of("fact_returns"))

    def _fact_quotas(self) -> DataFrame:
        """A monthly quota per rep for every month of the calendar."""
        rep = F.col("s_suppkey") + 1
        first, last = self._calendar
        months = self._read("supplier").select(
            rep.alias("sales_rep_id"),
            F.year(first).alias("first_year"),
            F.explode(F.sequence(first, last, F.make_interval(months=F.lit(1)))).alias("quota_date"),
        )
        rep, y, m = F.col("sales_rep_id"), F.year("quota_date"), F.month("quota_date")
        amount = (18000 + rep % 100 * 120 + m * 150 + (y - 1995) * 500) * 25
        return months.select(
            (rep * 1000 + (y - F.col("first_year")) * 12 + m).alias("quota_id"),
            amount.cast(MONEY).alias("quota_amount"),
            "sales_rep_id",
            "quota_date",
            F.lit("Monthly").alias("quota_period"),
        )

    # -- shared joins: the line date costs a join here, so add it only on demand

    def lines(self, *cols: str) -> DataFrame:
        if "line_date" in cols:
            return super().lines(*cols)
        return self._undated_lines.select(*cols)

    def returns(self, *cols: str) -> DataFrame:
        if "return_date" in cols:
            return super().returns(*cols)
        return self._undated_returns.select(*cols)

    def returned_values(self, *keys: str, **sums: Column) -> DataFrame:
        """A return comes from its line here and knows its order and product."""
        grouped = self._undated_returns.groupBy("order_id", "product_id", *keys)
        return grouped.agg(*[c.alias(n) for n, c in sums.items()])

    def with_order(self, lines: DataFrame, orders: DataFrame | None = None) -> DataFrame:
        return super().with_order(lines, orders).withColumn("line_date", F.col("order_date"))

    def bare_lines(self) -> DataFrame:
        return self._undated_lines.drop("line_number", "return_flag")

    def order_lines(
        self, since: Day | None = None, until: Day | None = None, orders: DataFrame | None = None
    ) -> DataFrame:
        orders = self["fact_sales_orders"] if orders is None else orders
        return self.with_order(self.bare_lines(), self.dated(orders, since, until))

    def dated_values(
        self,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        since: Day | None = None,
        until: Day | None = None,
        **sums: Column,
    ) -> DataFrame:
        return self.order_values(prepare, since, until, **sums).withColumn("line_date", F.col("order_date"))


def conform(spark: SparkSession, path: str, spare_keys: bool = False) -> ConformedStar:
    """The star over the order-processing parquet files under ``path``."""
    return ConformedStar(spark, path, spare_keys)
