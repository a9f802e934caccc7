"""A repeatable mart of any size, made from row numbers.

``spark.range`` numbers the rows, so no generator sorts or counts rows to find
a key.  Random picks are hashes of the key and a seed: the same arguments give
the same mart on any cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schema
from tallymart.functions.calendar import covers
from tallymart.functions.money import MONEY
from tallymart.operators.validity import newest_valid
from tallymart.sources.star import Star

# Fixed values of the generated mart.
TERRITORIES = {
    "Germany": (("Bavaria", "Munich"), ("Hesse", "Frankfurt"), ("Berlin", "Berlin"), ("North Rhine-Westphalia", "Cologne")),
    "France": (
        ("Ile-de-France", "Paris"),
        ("Auvergne-Rhone-Alpes", "Lyon"),
        ("Provence-Alpes-Cote d'Azur", "Marseille"),
        ("Nouvelle-Aquitaine", "Bordeaux"),
    ),
    "Austria": (("Vienna", "Vienna"), ("Styria", "Graz"), ("Upper Austria", "Linz"), ("Salzburg", "Salzburg")),
    "Switzerland": (("Zurich", "Zurich"), ("Geneva", "Geneva"), ("Basel-Stadt", "Basel"), ("Bern", "Bern")),
    "Netherlands": (
        ("North Holland", "Amsterdam"),
        ("South Holland", "Rotterdam"),
        ("Utrecht", "Utrecht"),
        ("North Brabant", "Eindhoven"),
    ),
}
SEGMENTS = {
    "Industrial Equipment": (
        "Machinery",
        "Safety Equipment",
        "Industrial Tools",
        "Pumps & Compressors",
        "Material Handling",
        "Spare Parts",
    ),
    "Office Supplies": (
        "Paper Products",
        "Writing Instruments",
        "Office Furniture",
        "Printing Supplies",
        "Desk Accessories",
        "Storage & Filing",
    ),
    "Technology Hardware": (
        "Laptops",
        "Monitors",
        "Accessories",
        "Keyboards",
        "Networking Devices",
        "Docking Solutions",
    ),
}
REP_FIRST = ["Ari", "Bela", "Caro", "Dani", "Eli", "Fay", "Gil", "Hana", "Ivo", "Jona"]
REP_LAST = ["Ahorn", "Birke", "Ceder", "Distel", "Eibe", "Farn", "Ginster", "Holder", "Iris", "Jasmin"]
JOB_TITLES = ["Sales Representative", "Senior Sales Representative", "Account Executive", "Key Account Manager"]
BUYER_FIRST = ["Kim", "Lou", "Max", "Nic", "Ola", "Pat", "Quin", "Ray", "Sam", "Toni", "Uli", "Val", "Wil", "Yuri", "Zoe"]
BUYER_LAST = [
    "Adler", "Buchfink", "Drossel", "Elster", "Falke", "Gans", "Habicht", "Ibis", "Kranich", "Lerche", "Meise",
    "Reiher", "Specht", "Taube", "Zeisig",
]
CUSTOMER_TYPES = ["Corporate", "SME", "Enterprise"]
CUSTOMER_GROUPS = ["Group A", "Group B", "Group C", "Group D"]
CUSTOMER_STATUSES = ["Active", "Inactive", "Prospect"]
LINES_OF_GOODS = ["Pro", "Plus", "Max", "Core", "Ultra", "Smart", "Prime", "Elite"]
DEAR_LINES = ("Pro", "Max")
GOODS = ["Press", "Helmet", "Paper", "Pen", "Laptop", "Monitor", "Dock", "Router"]
PRODUCT_TYPES = ["Industrial Machine", "Protective Gear", "Consumable", "Stationery", "Laptop", "Accessory"]
BRANDS = ["Brand A", "Brand B", "Brand C", "Brand D", "Brand E", "Brand F"]
PROMOTION_RATES = ["0.05", "0.07", "0.10", "0.12", "0.15"]
PAYMENT_TERMS = ["Net 30", "Net 45", "Net 60", "Prepaid"]
CHANNELS = ["Direct", "Dealer"]
SALES_ORG = "Main"
RETURN_REASONS = ["Damaged item", "Late delivery", "Wrong item delivered", "Customer changed mind", "Defective item"]
CALENDAR_START = date(2021, 1, 1)
TRADING_START = date(2022, 1, 1)
MAX_LINES = 4


@dataclass(frozen=True)
class MartSize:
    """Row counts; the defaults are the small demonstration mart."""

    reps: int = 50
    open_reps: int = 45  # reps that hold current assignments
    customers: int = 500
    reassigned: int = 150  # customers with an earlier window
    products: int = 200
    promotions: int = 120
    orders: int = 5000
    returns: int = 500


def _numbered(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


def _cycle(index: Column, values: list[str]) -> Column:
    """Values in turn for a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _step(n: Column, width: int) -> Column:
    """Zero-based index that moves on every ``width`` rows."""
    return F.floor((n - 1) / width)


def _hash_pick(key: Column, seed: int, tag: str, values: list[str]) -> Column:
    return _cycle(F.pmod(F.xxhash64(key, F.lit(seed), F.lit(tag)), F.lit(len(values))), values)


def _no_date() -> Column:
    return F.lit(None).cast("date")


# -- dimensions --------------------------------------------------------------


def gen_regions(spark: SparkSession) -> DataFrame:
    rows = [(country, region, f"{city} Territory") for country, areas in TERRITORIES.items() for region, city in areas]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], schema.schema_of("dim_regions"))


def gen_categories(spark: SparkSession) -> DataFrame:
    rows = [(name, segment) for segment, names in SEGMENTS.items() for name in names]
    return spark.createDataFrame([(i, *r, None) for i, r in enumerate(rows, 1)], schema.schema_of("dim_categories"))


def date_rows(spark: SparkSession, start: date | Column, end: date | Column) -> DataFrame:
    """One row per day, both ends included."""
    d = F.col("full_date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_number"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) < 5).alias("is_business_day"),
    )


def gen_date_dimension(spark: SparkSession, as_of: date, start: date = CALENDAR_START) -> DataFrame:
    return date_rows(spark, start, as_of)


def gen_sales_reps(spark: SparkSession, as_of: date, n: int = 50, regions: int = 20) -> DataFrame:
    i = F.col("n")
    hired = F.date_sub(F.lit(as_of), (i * 30).cast("int"))
    name = F.concat_ws(" ", _cycle(i - 1, REP_FIRST), _cycle(_step(i, 10), REP_LAST))
    return _numbered(spark, n).select(
        i.alias("sales_rep_id"),
        F.format_string("REP%03d", i).alias("employee_code"),
        name.alias("rep_name"),
        hired.alias("hire_date"),
        _cycle(i - 1, JOB_TITLES).alias("job_title"),
        F.lit("Active").alias("sales_rep_status"),
        F.lit(True).alias("is_active"),
        hired.alias("valid_from"),
        _no_date().alias("valid_to"),
        ((i - 1) % regions + 1).cast("int").alias("region_id"),
    )


def gen_customers(
    spark: SparkSession, as_of: date, n: int = 500, seed: int = 42, regions: int = 20, codes_from: int = 0
) -> DataFrame:
    """``codes_from`` is the highest customer code already given out."""
    i = F.col("n")
    name = F.concat_ws(" ", _hash_pick(i, seed, "first", BUYER_FIRST), _hash_pick(i, seed, "last", BUYER_LAST))
    credit = F.pmod(F.xxhash64(i, F.lit(seed), F.lit("credit")), F.lit(100000)) + 1000
    return _numbered(spark, n).select(
        i.alias("customer_id"),
        F.format_string("CUST%03d", i + codes_from).alias("customer_code"),
        name.alias("customer_name"),
        _cycle(i - 1, CUSTOMER_TYPES).alias("customer_type"),
        _cycle(i - 1, CUSTOMER_GROUPS).alias("customer_group"),
        _cycle(i - 1, CUSTOMER_STATUSES).alias("customer_status"),
        _cycle(i - 1, list(schema.ACCOUNT_TIERS)).alias("account_tier"),
        credit.cast(MONEY).alias("credit_limit"),
        F.concat(F.lit("Street "), i, F.lit(", City "), i).alias("billing_address"),
        F.lit(True).alias("is_active"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
        ((i - 1) % regions + 1).cast("int").alias("region_id"),
    )


def gen_products(spark: SparkSession, n: int = 200, categories: int = 18) -> DataFrame:
    i = F.col("n")
    line = _cycle(i - 1, LINES_OF_GOODS)
    cost = (i * F.lit("4.25").cast("decimal(3,2)") + 25).cast(MONEY)
    markup = F.when(line.isin(*DEAR_LINES), F.lit("3.50").cast("decimal(3,2)")).otherwise(
        F.lit("1.70").cast("decimal(3,2)")
    )
    return _numbered(spark, n).select(
        i.alias("product_id"),
        F.format_string("SKU%04d", i).alias("product_sku"),
        F.concat_ws(" ", line, _cycle(_step(i, 8), GOODS), i.cast("string")).alias("product_name"),
        (i % 250 + 20).cast("int").alias("stock_level"),
        F.lit("Active").alias("product_status"),
        _cycle(i - 1, PRODUCT_TYPES).alias("product_type"),
        _cycle(_step(i, 6), BRANDS).alias("brand"),
        F.lit(True).alias("is_active"),
        cost.alias("unit_cost"),
        (cost * markup).cast(MONEY).alias("list_price"),
        F.lit(CALENDAR_START).alias("valid_from"),
        _no_date().alias("valid_to"),
        ((i - 1) % categories + 1).cast("bigint").alias("category_id"),
    )


# -- bridges -----------------------------------------------------------------


def gen_assignments(spark: SparkSession, size: MartSize = MartSize()) -> DataFrame:
    """An open window for every customer, and a closed one for the first few."""
    i = F.col("n")
    opened = _numbered(spark, size.customers).select(
        i.alias("assignment_id"),
        ((i - 1) % size.open_reps + 1).alias("sales_rep_id"),
        i.alias("customer_id"),
        F.lit(TRADING_START).alias("valid_from"),
        _no_date().alias("valid_to"),
        F.lit(True).alias("is_active"),
    )
    closed = _numbered(spark, size.reassigned).select(
        (i + size.customers).alias("assignment_id"),
        ((i + 4) % size.reps + 1).alias("sales_rep_id"),
        i.alias("customer_id"),
        F.date_sub(F.lit(TRADING_START), ((i - 1) % 120 + 365).cast("int")).alias("valid_from"),
        F.date_sub(F.lit(TRADING_START), 1).alias("valid_to"),
        F.lit(False).alias("is_active"),
    )
    return opened.unionByName(closed)


def gen_promotions(spark: SparkSession, n: int = 120, products: int = 200) -> DataFrame:
    """Month-long promotions; year and month move on together."""
    i = F.col("n")
    first = F.make_date(((i - 1) % 4 + 2022).cast("int"), ((i - 1) % 12 + 1).cast("int"), F.lit(1))
    return _numbered(spark, n).select(
        i.alias("promotion_id"),
        first.alias("valid_from"),
        F.last_day(first).alias("valid_to"),
        _cycle(i - 1, PROMOTION_RATES).cast("decimal(5,4)").alias("discount_rate"),
        ((i - 1) * 3 % products + 1).alias("product_id"),
    )


# -- facts -------------------------------------------------------------------


def gen_quotas(reps: DataFrame, as_of: date) -> DataFrame:
    """A quota per rep and calendar month: each rep row is repeated per month."""
    months = F.sequence(F.lit(CALENDAR_START), F.trunc(F.lit(as_of), "month"), F.make_interval(months=F.lit(1)))
    rep, y, m = F.col("sales_rep_id"), F.year("quota_date"), F.month("quota_date")
    amount = rep * 120 + m * 150 + (y - CALENDAR_START.year) * 500 + 18000
    return reps.select("sales_rep_id", F.explode(months).alias("quota_date")).select(
        (rep * 10000 + (y - CALENDAR_START.year) * 12 + m).alias("quota_id"),
        amount.cast(MONEY).alias("quota_amount"),
        "sales_rep_id",
        "quota_date",
        F.lit("Monthly").alias("quota_period"),
    )


def gen_orders(spark: SparkSession, assignments: DataFrame, as_of: date, size: MartSize = MartSize()) -> DataFrame:
    """Orders handled by the rep assigned on the order date; each twelfth goes to the next rep."""
    i = F.col("n")
    trading_days = (as_of - TRADING_START).days - 25
    numbered = _numbered(spark, size.orders).select(
        "n",
        ((i - 1) % size.customers + 1).alias("customer_id"),
        F.date_add(F.lit(TRADING_START), ((i - 1) % trading_days).cast("int")).alias("order_date"),
    )
    windows = assignments.filter("is_active").select("customer_id", "sales_rep_id", "valid_from", "valid_to")
    assigned = numbered.join(windows, "customer_id").filter(covers(F.col("order_date")))
    rep = F.col("sales_rep_id")
    status = _cycle(i - 1, list(schema.ORDER_STATUSES))
    shipped = F.when(~status.isin("Pending", "Cancelled"), F.date_add("order_date", (i % 20 + 5).cast("int")))
    return assigned.select(
        i.alias("order_id"),
        status.alias("order_status"),
        _cycle(i - 1, PAYMENT_TERMS).alias("payment_terms"),
        F.lit("Sales Order").alias("document_type"),
        F.lit(SALES_ORG).alias("sales_org"),
        _cycle(i - 1, CHANNELS).alias("distribution_channel"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
        "customer_id",
        F.when(i % 12 == 0, rep % size.reps + 1).otherwise(rep).alias("sales_rep_id"),
        "order_date",
        shipped.alias("ship_date"),
    )


def _numbered_lines(orders: DataFrame, products: DataFrame, promotions: DataFrame, n_products: int) -> DataFrame:
    """Lines with ``n``, their number over all orders, known from the order number alone."""
    o, line = F.col("order_id"), F.col("line_no")
    earlier_in_round = (o - 1) % MAX_LINES
    bare = (
        orders.select("order_id", "order_date")
        .withColumn("line_no", F.explode(F.sequence(F.lit(1), earlier_in_round.cast("int") + 1)))
        .select(
            (_step(o, MAX_LINES) * 10 + F.floor(earlier_in_round * (earlier_in_round + 1) / 2) + line).alias("n"),
            "order_id",
            "line_no",
            F.col("order_date").alias("line_date"),
            ((o * 7 + line * 13) % n_products + 1).alias("product_id"),
            ((o + line) % 5 + 1).cast("int").alias("quantity"),
        )
    )
    rates = newest_valid(bare, promotions, key="product_id", day="line_date", value="discount_rate")
    turn = o + line
    usual = F.when(turn % 10 == 0, "0.15").when(turn % 6 == 0, "0.10").when(turn % 4 == 0, "0.05").otherwise("0.00")
    gross = F.col("quantity") * F.col("list_price")
    return (
        rates.join(products.select("product_id", "list_price"), "product_id")
        .withColumn("discount", F.coalesce("discount_rate", usual.cast("decimal(5,4)")))
        .select(
            "n",
            F.md5(F.col("n").cast("string")).alias("line_item_id"),
            "quantity",
            F.col("list_price").alias("unit_price"),
            "discount",
            gross.cast(MONEY).alias("gross_amount"),
            (gross * (1 - F.col("discount"))).cast(MONEY).alias("net_amount"),
            "order_id",
            "product_id",
            "line_date",
        )
    )


def gen_lines(orders: DataFrame, products: DataFrame, promotions: DataFrame, n_products: int = 200) -> DataFrame:
    """One to four lines per order; the newest promotion valid on the day sets the discount."""
    lines = _numbered_lines(orders, products, promotions, n_products)
    return lines.select(*schema.columns_of("fact_order_line_items"))


def gen_returns(
    orders: DataFrame, products: DataFrame, promotions: DataFrame, n: int = 500, n_products: int = 200
) -> DataFrame:
    """Returns of the first ``n`` lines."""
    i = F.col("n")
    lines = _numbered_lines(orders, products, promotions, n_products).filter(i <= n)
    returned = F.when((F.col("quantity") >= 4) & (i % 2 == 0), 2).otherwise(1)
    return lines.select(
        "line_item_id",
        F.col("line_item_id").alias("return_id"),
        F.lit("Open").alias("return_status"),
        returned.alias("return_quantity"),
        (returned * F.col("unit_price") * (1 - F.col("discount"))).cast(MONEY).alias("credit_amount"),
        _cycle(i - 1, RETURN_REASONS).alias("return_reason"),
        F.col("line_date").alias("return_date"),
    ).select(*schema.columns_of("fact_returns"))


def generate_star(spark: SparkSession, as_of: date, size: MartSize = MartSize(), seed: int = 42) -> Star:
    """The whole mart, each table built from the ones it refers to."""
    reps = gen_sales_reps(spark, as_of, size.reps)
    products = gen_products(spark, size.products)
    assignments = gen_assignments(spark, size)
    promotions = gen_promotions(spark, size.promotions, size.products)
    orders = gen_orders(spark, assignments, as_of, size)
    return Star(
        {
            "dim_regions": gen_regions(spark),
            "dim_categories": gen_categories(spark),
            "dim_date": gen_date_dimension(spark, as_of),
            "dim_sales_reps": reps,
            "dim_customers": gen_customers(spark, as_of, size.customers, seed),
            "dim_products": products,
            "rep_customer_assignments": assignments,
            "product_promotions": promotions,
            "fact_quotas": gen_quotas(reps, as_of),
            "fact_sales_orders": orders,
            "fact_order_line_items": gen_lines(orders, products, promotions, size.products),
            "fact_returns": gen_returns(orders, products, promotions, size.returns, size.products),
        }
    )
