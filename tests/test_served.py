"""Views published beside a mart: what another session reads, what is refused, what is brought back."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart import ReportParams, schema
from tallymart.params import ProfileLadder
from tallymart.plans import views
from tallymart.sinks.served import NEEDS, BrokenView, View, ViewStore, in_order, library
from tallymart.sources import generate
from tallymart.sources.mart import append_to_mart, load_mart
from tallymart.sources.star import Star

AS_OF, NEW = date(2024, 7, 1), date(2022, 9, 1)
P = ReportParams(as_of=AS_OF, name_parts=("Pro",), profile=ProfileLadder(new_days=20))
OPEN_RETURNS = View("open_returns", 1, "SELECT line_item_id, return_quantity FROM {fact_returns} WHERE return_status = 'Open'")
RETURNED = View("returned", 2, "SELECT count(*) AS n, sum(return_quantity) AS pieces FROM {open_returns}")


@pytest.fixture(scope="module")
def star(spark):
    size = generate.MartSize(reps=12, open_reps=11, customers=40, reassigned=10, products=30, orders=600, returns=100)
    return generate.generate_star(spark, AS_OF, size)


@pytest.fixture()
def store(spark, star, tmp_path):
    late = F.col("order_date") >= F.lit(NEW)
    new = {"fact_sales_orders": star["fact_sales_orders"].filter(late)}
    new["fact_order_line_items"] = star["fact_order_line_items"].join(new["fact_sales_orders"].select("order_id"), "order_id", "left_semi")
    old = {t: star[t].join(new[t].select(key), key, "left_anti") for t, key in (("fact_sales_orders", "order_id"), ("fact_order_line_items", "line_item_id"))}
    mart = str(tmp_path / "mart")
    load_mart(Star({t: old.get(t, star[t]) for t in schema.TABLES}), mart)
    made = ViewStore(spark, str(tmp_path / "views"), mart)
    made.added = lambda: append_to_mart(spark, mart, new)
    return made


def rows(df):
    return sorted(map(str, df.collect()))


def test_another_session_reads_views_over_what_was_added(spark, star, store):
    store.publish([*library(["vw_monthly_trend", "vw_base_orders"]), OPEN_RETURNS, RETURNED], P)
    before = rows(store.open()["vw_monthly_trend"])
    store.added()
    other = ViewStore(spark.newSession(), store.releases.path, store.mart)
    found = other.open()
    assert list(found) == ["open_returns", "vw_base_orders", "returned", "vw_summary_monthly_trend", "vw_monthly_trend"]
    assert rows(found["vw_monthly_trend"]) == rows(views.vw_monthly_trend(star, P)) != before
    assert found["returned"].first()["n"] == star["fact_returns"].filter("return_status = 'Open'").count()
    assert other.definitions()[1] == P
    assert other.register() == list(found)
    assert other.spark.sql("SELECT count(*) FROM vw_monthly_trend").first()[0] == len(rows(found["vw_monthly_trend"]))


@pytest.mark.parametrize(
    "broken",
    [
        View("odd", 2, "SELECT no_such_column FROM {fact_returns}"),
        View("odd", 2, "SELECT FROM WHERE {fact_returns}"),
        View("odd", 2, "SELECT * FROM {no_such_view}"),
        View("odd", 1, "SELECT * FROM {returned}"),  # of a later tier
        View("odd", 2, "SELECT * FROM {odd}"),
        View("odd", 2, "SELECT raise_error('fails as it runs') AS x FROM {fact_sales_orders}"),
        View("odd", 2),
        View("fact_returns", 2, "SELECT 1 AS one"),
    ],
)
def test_a_broken_view_leaves_the_former_release(store, broken):
    first = store.publish([OPEN_RETURNS, RETURNED], P)
    with pytest.raises(BrokenView):
        store.publish([OPEN_RETURNS, RETURNED, broken], P)
    assert store.releases.numbers() == [first.number] and list(store.open()) == ["open_returns", "returned"]


def test_tiers_go_in_reverse_and_come_back(store):
    first = store.publish([OPEN_RETURNS, RETURNED, *library(["vw_monthly_trend"])], P, smoke=False)
    with pytest.raises(BrokenView):
        store.drop_tier(2)  # vw_monthly_trend needs its summary
    assert store.drop_tier(3) == ["vw_monthly_trend"]
    assert store.drop_tier(2) == ["vw_summary_monthly_trend", "returned"]
    assert list(store.open()) == ["open_returns"]
    store.roll_back(first.number)
    assert [v.name for v in store.definitions()[0]] == ["open_returns", "returned", "vw_summary_monthly_trend", "vw_monthly_trend"]
    assert len(store.releases.numbers()) == 4


def test_needs_are_what_the_views_call():
    called = {n: set(v.__code__.co_names) & set(views.VIEWS) for n, v in views.VIEWS.items()}
    assert {n: set(c) for n, c in NEEDS.items()} == {n: c for n, c in called.items() if c}
    assert {v.name for v in in_order(library())} == set(views.VIEWS)


def test_no_views_were_published(store):
    with pytest.raises(LookupError):
        store.open()
