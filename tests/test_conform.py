"""The star derived from order-processing tables: every row kept, under its own keys."""

from __future__ import annotations

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from tallymart import conform

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
MISSING_ORDER = 987_654_321


@pytest.fixture(scope="module")
def odd(spark, sf_dir, tmp_path_factory):
    """The given tables, and rows at the edges: a long order, large and fractional quantities, a line
    without its order, an order years later."""
    folder = tmp_path_factory.mktemp("odd")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE TABLE {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    db.execute("CREATE TABLE one AS SELECT * FROM lineitem LIMIT 1")
    db.execute("INSERT INTO lineitem SELECT * REPLACE (6000 AS l_linenumber, 1500 AS l_quantity) FROM one")
    db.execute("INSERT INTO lineitem SELECT * REPLACE (6001 AS l_linenumber, 0.5 AS l_quantity) FROM one")
    db.execute(f"INSERT INTO lineitem SELECT * REPLACE ({MISSING_ORDER} AS l_orderkey) FROM one")
    db.execute(
        "INSERT INTO orders SELECT * REPLACE (987654320 AS o_orderkey, TIMESTAMP '2005-03-04' AS o_orderdate)"
        " FROM orders LIMIT 1"
    )
    for t in TABLES:
        db.execute(f"COPY {t} TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return db, conform(spark, str(folder))


def test_facts_hold_every_source_row_and_their_totals(odd):
    db, star = odd
    lines = star["fact_order_line_items"]
    n, gross = db.sql("SELECT count(*), sum(round(l_extendedprice * 100))::BIGINT FROM lineitem").fetchall()[0]
    got = lines.agg(F.count("*").alias("n"), F.sum("gross_amount").alias("g"), F.countDistinct("line_item_id").alias("k")).first()
    assert (got["n"], int(got["g"] * 100)) == (n, gross)
    assert got["k"] == n
    assert star["fact_sales_orders"].count() == db.sql("SELECT count(*) FROM orders").fetchall()[0][0]
    returned = db.sql("SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'").fetchall()[0][0]
    assert star["fact_returns"].count() == returned


@pytest.mark.parametrize(
    ("table", "source"),
    [("dim_customers", "customer"), ("dim_products", "part"), ("dim_sales_reps", "supplier"), ("dim_regions", "nation")],
)
def test_dimensions_hold_every_source_row(odd, table, source):
    db, star = odd
    assert star[table].count() == db.sql(f"SELECT count(*) FROM {source}").fetchall()[0][0]


def test_a_line_without_its_order_stays_without_a_date(odd):
    _, star = odd
    rows = star["fact_order_line_items"].filter(F.col("order_id") == MISSING_ORDER + 1).collect()
    assert [r["line_date"] for r in rows] == [None]


def test_quantities_are_whole_and_prices_use_them_as_they_are(odd):
    db, star = odd
    price = db.sql("SELECT l_extendedprice FROM one").fetchall()[0][0]
    rows = star["fact_order_line_items"].filter("quantity = 1500 or unit_price > gross_amount").select("quantity", "unit_price")
    found = {r["quantity"]: float(r["unit_price"]) for r in rows.collect()}
    assert found[1500] == pytest.approx(price / 1500, abs=0.006)
    assert found[1] == pytest.approx(price * 2, abs=0.006)


def test_the_calendar_follows_the_orders(odd):
    _, star = odd
    days = star["dim_date"].agg(F.min("full_date").alias("a"), F.max("full_date").alias("b")).first()
    assert (days["a"], days["b"]) == (date(1995, 1, 1), date(2005, 12, 31))
    quotas = star["fact_quotas"]
    assert quotas.filter(F.year("quota_date") == 2005).count() == 12 * star["dim_sales_reps"].count()
    assert quotas.select("quota_id").distinct().count() == quotas.count()


def test_keys_move_only_if_asked_for(spark, sf_dir, odd):
    db, _ = odd
    asked = "SELECT count(DISTINCT o_custkey) FROM '{}/orders.parquet'".format(sf_dir)
    own = conform(spark, sf_dir)["fact_sales_orders"].select("customer_id").distinct()
    assert own.count() == db.sql(asked).fetchall()[0][0]
    moved = conform(spark, sf_dir, spare_keys=True)["fact_sales_orders"]
    assert moved.filter("(customer_id - 1) % 100 = 99").count() == 0
