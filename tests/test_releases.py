"""Releases of the mart, sums kept per month, and views answered from them."""

from __future__ import annotations

import re
import time
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart import ReportParams, load_star, schema
from tallymart.operators import bitmaps
from tallymart.plans import aggregates, joins, quality, stored, views
from tallymart.sinks import writer
from tallymart.sinks.releases import CLEANUP, MONTH, ReleaseConflict, ReleaseStore
from tallymart.sources import generate
from tallymart.sources.mart import append_to_mart, load_mart, mart_store, open_mart, replace_in_mart
from tallymart.sources.star import Star

AS_OF = date(2024, 7, 1)
P = ReportParams(as_of=AS_OF)
FIRST, NEW = date(2023, 9, 1), date(2024, 6, 1)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The last ten months of a small generated mart, published."""
    path = str(tmp_path_factory.mktemp("whole"))
    size = generate.MartSize(reps=12, open_reps=11, customers=60, reassigned=20, products=40, orders=3000, returns=600)
    star = generate.generate_star(spark, AS_OF, size)
    orders = star["fact_sales_orders"].filter(F.col("order_date") >= F.lit(FIRST))
    lines = star["fact_order_line_items"].join(orders.select("order_id"), "order_id", "left_semi")
    # every fourth line comes back, a third of these late
    hashed = F.crc32(F.encode("line_item_id", "UTF-8"))
    returns = lines.filter(hashed % 4 == 0).select(
        F.concat(F.lit("R"), "line_item_id").alias("return_id"), F.lit("Open").alias("return_status"),
        F.lit(1).alias("return_quantity"), F.col("net_amount").alias("credit_amount"), F.lit("Late").alias("return_reason"),
        "line_item_id", F.when(hashed % 3 == 0, F.lit(AS_OF)).otherwise(F.date_add("line_date", 9)).alias("return_date"),
    )
    some = {
        "fact_sales_orders": orders,
        "fact_order_line_items": lines.select(*schema.columns_of("fact_order_line_items")),
        "fact_returns": returns,
        "fact_quotas": star["fact_quotas"].filter(F.col("quota_date") >= F.lit(FIRST)),
    }
    load_mart(Star({t: some.get(t, star[t]) for t in schema.TABLES}), path)
    return load_star(spark, path)


@pytest.fixture(scope="module")
def summed(spark, whole, tmp_path_factory):
    """The sums of the whole mart."""
    path = str(tmp_path_factory.mktemp("sums"))
    stored.refresh(spark, whole.store.path, path)
    return path


def _split(star: Star) -> tuple[Star, dict]:
    """The mart before the last month of orders and the last weeks' returns, and these rows."""
    new_orders = star["fact_sales_orders"].filter(F.col("order_date") >= F.lit(NEW))
    keys = new_orders.select("order_id")
    lines = star["fact_order_line_items"]
    of_new = lines.join(keys, "order_id", "left_semi")
    # late returns of two former months
    late = (F.col("return_date") == F.lit(AS_OF)) & F.col("line_item_id").isin(_lines_of(star, ("2023-11", "2024-02")))
    on_new = star["fact_returns"].join(of_new.select("line_item_id"), "line_item_id", "left_semi").select("return_id")
    returns = star["fact_returns"].withColumn("late", late).join(on_new.withColumn("new", F.lit(True)), "return_id", "left")
    is_late = F.col("late") | F.col("new").isNotNull()
    added = {
        "fact_sales_orders": new_orders,
        "fact_order_line_items": of_new,
        "fact_returns": returns.filter(is_late).select(*schema.columns_of("fact_returns")),
    }
    first = {
        "fact_sales_orders": star["fact_sales_orders"].filter(F.col("order_date") < F.lit(NEW)),
        "fact_order_line_items": lines.join(keys, "order_id", "left_anti"),
        "fact_returns": returns.filter(~is_late).select(*schema.columns_of("fact_returns")),
    }
    return Star({t: first.get(t, star[t]) for t in schema.TABLES}), added


def _lines_of(star: Star, months: tuple[str, ...]) -> list[str]:
    lines = star["fact_order_line_items"].join(star["fact_sales_orders"], "order_id")
    return [r[0] for r in lines.filter(F.date_format("order_date", "yyyy-MM").isin(*months)).select("line_item_id").collect()]


def _files(path: Path) -> set[str]:
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def _rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


def test_append_rewrites_the_changed_months_only(spark, whole, tmp_path):
    mart, sums = str(tmp_path / "mart"), tmp_path / "sums"
    base, added = _split(whole)
    load_mart(base, mart)
    _, first = stored.refresh(spark, mart, str(sums))
    before = _files(sums)
    assert stored.refresh(spark, mart, str(sums)) == (stored.stored_sums(spark, str(sums)).release(), set())
    append_to_mart(spark, mart, added)
    release, months = stored.refresh(spark, mart, str(sums))
    of_returns = (
        added["fact_returns"].join(whole["fact_order_line_items"], "line_item_id").join(whole["fact_sales_orders"], "order_id")
    )
    touched = added["fact_sales_orders"].select("order_date").union(of_returns.select("order_date"))
    want = {str(r[0]) for r in touched.select(F.trunc("order_date", "month")).distinct().collect()}
    assert months == want and 1 < len(want) < len(first)
    new = _files(sums) - before
    assert before <= _files(sums)  # nothing that was written is touched
    assert {re.search(rf"{MONTH}=([\d-]+)", f)[1] for f in new} == want
    assert len(new) == len(want) * len(stored.STORED)  # one file a month and table
    # months that did not change are read from the parts they were in
    for table, parts in release.tables.items():
        assert sorted(len(own) for own in parts.values()) == sorted([len(want), len(first - want)]), table
    star, answers = open_mart(spark, mart), stored.StoredViews(stored.stored_sums(spark, str(sums)), release)
    for name, view in answers.all().items():
        assert _rows(view(star, P)) == _rows(views.VIEWS[name](whole, P)), name


@pytest.mark.parametrize("as_of", [date(2024, 1, 1), date(2024, 2, 29), date(2023, 12, 17)])
def test_stored_views_on_other_days(spark, whole, summed, as_of):
    p = ReportParams(as_of=as_of)
    answers = stored.StoredViews(stored.stored_sums(spark, summed))
    for name in ("vw_customer_360", "vw_rep_performance_scorecard"):
        assert _rows(answers.all()[name](whole, p)) == _rows(views.VIEWS[name](whole, p)), name


def test_cancelled_later(spark, whole, tmp_path):
    """A correction rewrites its month; sums follow, and quotas and other months stay."""
    mart, sums = str(tmp_path / "mart"), str(tmp_path / "sums")
    load_mart(whole, mart)
    stored.refresh(spark, mart, sums)
    month = "2024-03-01"
    old = open_mart(spark, mart, months=[month])
    orders = old["fact_sales_orders"].withColumn("order_status", F.when(F.col("order_id") % 2 == 0, "Cancelled").otherwise(F.col("order_status")))
    new = {"fact_sales_orders": orders, **{t: old[t] for t in ("fact_order_line_items", "fact_returns")}}
    replace_in_mart(spark, mart, new, [month])
    release, months = stored.refresh(spark, mart, sums)
    assert months == {month}
    star = open_mart(spark, mart)
    assert star["fact_quotas"].count() == whole["fact_quotas"].count()
    assert star["fact_order_line_items"].count() == whole["fact_order_line_items"].count()
    answers = stored.StoredViews(stored.stored_sums(spark, sums), release)
    changed = views.vw_sales_executive_summary(star, P)
    assert _rows(answers.vw_sales_executive_summary(star, P)) == _rows(changed)
    assert _rows(changed) != _rows(views.vw_sales_executive_summary(whole, P))


def test_lines_of_several_months_and_without_a_day(spark, whole, tmp_path):
    """Orders whose lines lie in other months than they do, or have no date."""
    lines = whole["fact_order_line_items"].withColumn(
        "line_date", F.when(F.crc32(F.encode("line_item_id", "UTF-8")) % 7 == 0, F.lit(None)).otherwise(F.date_add("line_date", F.col("quantity") * 20))
    )
    odd = Star({t: lines if t == "fact_order_line_items" else whole[t] for t in schema.TABLES})
    load_mart(odd, str(tmp_path / "mart"))
    stored.refresh(spark, str(tmp_path / "mart"), str(tmp_path / "sums"))
    star, answers = open_mart(spark, str(tmp_path / "mart")), stored.StoredViews(stored.stored_sums(spark, str(tmp_path / "sums")))
    for name, view in answers.all().items():
        assert _rows(view(star, P)) == _rows(views.VIEWS[name](odd, P)), name


def test_a_stopped_load_leaves_the_former_mart(spark, whole, tmp_path):
    path = str(tmp_path)
    load_mart(whole, path)
    reader = load_star(spark, path)
    n = reader["fact_order_line_items"].count()
    broken = whole["fact_returns"].withColumn("return_quantity", F.raise_error(F.lit("stopped")).cast("int"))
    half = Star({t: broken if t == "fact_returns" else whole[t].limit(3) for t in schema.TABLES})
    with pytest.raises(Exception, match="stopped"):
        writer.replace_all(half, path)
    assert mart_store(spark, path).numbers() == [1]
    assert load_star(spark, path)["fact_order_line_items"].count() == n == reader["fact_order_line_items"].count()


def test_a_reader_keeps_its_release_and_old_ones_can_be_removed(spark, whole, tmp_path):
    path = str(tmp_path)
    writer.replace_all(whole, path)
    reader = load_star(spark, path)
    n = reader["fact_sales_orders"].count()
    writer.replace_all(Star({t: whole[t].limit(5) for t in schema.TABLES}), path)
    writer.replace_all(Star({t: whole[t].limit(4) for t in schema.TABLES}), path)
    assert reader["fact_sales_orders"].count() == n
    assert load_star(spark, path)["fact_sales_orders"].count() == 4
    store = mart_store(spark, path)
    assert store.remove(keep=2) == [1]
    assert store.numbers() == [2, 3] and open_mart(spark, path, 2)["fact_sales_orders"].count() == 5
    with pytest.raises(LookupError):
        open_mart(spark, path, 1)
    parts = {p.name for p in (tmp_path / "data" / "fact_sales_orders").iterdir()}
    assert len(parts) == 2


def test_sums_are_made_in_passes(spark, whole, summed, tmp_path, monkeypatch):
    """Passes of one month, or of some, give the sums of one pass."""
    sizes = whole.store.sizes(whole.release, *stored.FACTS)
    assert sizes.keys() == whole.release.months(*stored.FACTS) and min(sizes.values()) > 0
    for room, most in ((1, 1), (max(sizes.values()) * 4, 9)):
        monkeypatch.setattr(stored, "PASS", room)
        path = str(tmp_path / str(room))
        release, months = stored.refresh(spark, whole.store.path, path)
        assert months == set(sizes)
        sums, one = stored.stored_sums(spark, path), stored.stored_sums(spark, summed)
        for table, parts in release.tables.items():
            assert len(parts) > 1 and all(len(own) <= most for own in parts.values())
            assert sorted(m for own in parts.values() for m in own) == sorted(sizes)
            assert _rows(sums.read(table, release)) == _rows(one.read(table)), table


def _shuffle_files(spark) -> int:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_writers_leave_no_shuffle_files(spark, whole, tmp_path):
    """What a load and a refresh shuffled goes when each table is written, and the session's setting stays."""
    setting, before = spark.conf.get(CLEANUP, None), _shuffle_files(spark)
    load_mart(whole, str(tmp_path / "mart"))
    stored.refresh(spark, str(tmp_path / "mart"), str(tmp_path / "sums"))
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.5)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(CLEANUP, None) == setting
    written = _files(tmp_path)
    assert written and all(f.endswith(".zstd.parquet") for f in written)


def test_one_monthly_table_is_written_at_a_time(spark, whole, tmp_path, monkeypatch):
    at_work, most, write = set(), [], ReleaseStore._write

    def watched(self, table, df):
        at_work.add(table)
        most.append(sum(t in self.monthly for t in at_work))
        try:
            return write(self, table, df)
        finally:
            at_work.remove(table)

    monkeypatch.setattr(ReleaseStore, "_write", watched)
    load_mart(Star({t: whole[t].limit(3) for t in schema.TABLES}), str(tmp_path))
    assert len(most) == len(schema.TABLES) and max(most) == 1


def test_sums_whose_release_was_removed_are_written_whole(spark, whole, tmp_path):
    mart, sums = str(tmp_path / "mart"), str(tmp_path / "sums")
    load_mart(whole, mart)
    stored.refresh(spark, mart, sums)
    load_mart(whole, mart)
    mart_store(spark, mart).remove(keep=1)
    release, months = stored.refresh(spark, mart, sums)
    assert release.notes == {"mart": 2} and months == open_mart(spark, mart).release.months(*stored.FACTS)


def test_two_writers_cannot_publish_the_same_number(spark, whole, tmp_path):
    store = ReleaseStore(spark, str(tmp_path), {"dim_regions": schema.schema_of("dim_regions")})
    first = store.publish({"dim_regions": whole["dim_regions"]})
    with pytest.raises(ReleaseConflict):
        store._publish(first)
    assert store.numbers() == [1] and [f.name for f in (tmp_path / "releases").iterdir() if f.suffix == ".json" and f.name[0] == "_"] == []
    with pytest.raises(ValueError, match="no such tables"):
        store.append({"other": whole["dim_regions"]})


def _paths(df) -> set[str]:
    return {re.search(rf"{MONTH}=([\d-]+)", f)[1] for f in df.inputFiles() if "fact_order_line_items" in f}


def test_reports_of_line_dates_open_their_folders_only(spark, whole, tmp_path):
    """Lines are in the folder of their order's month; bounds of line dates choose the folders."""
    lines = whole["fact_order_line_items"].withColumn("line_date", F.date_add("line_date", F.col("quantity") * 3))
    odd = Star({t: lines if t == "fact_order_line_items" else whole[t] for t in schema.TABLES})
    load_mart(odd, str(tmp_path))
    star = open_mart(spark, str(tmp_path))
    every, p = _paths(star["fact_order_line_items"]), ReportParams(as_of=AS_OF, unsold_months=3)
    for report, since, until in (
        (views.vw_rep_performance_scorecard, date(2024, 1, 1), AS_OF),
        (aggregates.top_products_per_country, date(2023, 1, 1), date(2023, 12, 31)),
        (joins.unordered_products_12m, date(2024, 4, 1), None),
    ):
        got = report(star, p)
        held = lines.join(whole["fact_sales_orders"], "order_id").filter(F.col("line_date") >= F.lit(since))
        held = held if until is None else held.filter(F.col("line_date") <= F.lit(until))
        needed = {str(r[0]) for r in held.select(F.trunc("order_date", "month")).distinct().collect()}
        assert needed <= _paths(got) < every and len(_paths(got)) <= len(needed) + 1, report.__name__
        assert _rows(got) == _rows(report(odd, p)), report.__name__


def test_snapshots_from_the_sums(spark, whole, tmp_path):
    mart = whole.store.path
    months = writer.refresh_views(spark, mart, str(tmp_path / "sums"), P, str(tmp_path / "views"))
    assert months == whole.release.months(*stored.FACTS)
    later = ReportParams(as_of=AS_OF + timedelta(days=1))
    assert writer.refresh_views(spark, mart, str(tmp_path / "sums"), later, str(tmp_path / "views")) == set()
    for name in writer.SNAPSHOTS:
        got = writer.read_current(spark, str(tmp_path / "views"), name, later.as_of)
        assert _rows(got) == _rows(views.VIEWS[name](whole, later)), name


def test_stored_views_read_no_lines(spark, whole, summed):
    for name, view in stored.StoredViews(stored.stored_sums(spark, summed)).all().items():
        assert not any("/fact_order_line_items/" in f or "/fact_returns/" in f for f in view(whole, P).inputFiles()), name


def _line_scans(df) -> int:
    """Scans of lines' amounts in the executed plan; a subquery that is used again is planned once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len({n for n in re.findall(r"FileScan parquet \[[^\]]*net_amount#(\d+)", plan)})


def test_jobs_over_views_read_lines_once(spark, whole, summed):
    """The check of the sums reads lines for its base only; other views than the stored ones read facts."""
    answers = stored.StoredViews(stored.stored_sums(spark, summed)).catalogue()
    got = quality.dq_cancelled_exclusion(whole, P, answers=answers)
    assert _line_scans(got) == 1 < 4 <= _line_scans(quality.dq_cancelled_exclusion(whole, P))
    assert _rows(got) == _rows(quality.dq_cancelled_exclusion(whole, P)) and {r["diff"] for r in got.collect()} == {0}
    counts = views.view_smoke_counts(whole, P, answers=answers)
    assert _line_scans(counts) < _line_scans(views.view_smoke_counts(whole, P))
    assert _rows(counts) == _rows(views.view_smoke_counts(whole, P))
    assert answers["vw_returns_analysis"] is views.vw_returns_analysis


def test_sets_of_ids_merge(spark):
    rows = [(m, k, i) for m in range(3) for k in "ab" for i in (1, 2, 32_768, 32_769, 10**10, 40_000 + m, None, m if k == "a" else 7)]
    df = spark.createDataFrame(rows, "m int, k string, i long")
    sets = bitmaps.id_sets(df, ["m", "k"], "i")
    assert sets.count() == sets.select("m", "k", "bucket").distinct().count()
    got = {r["k"]: r["n"] for r in bitmaps.counts(sets, ["k"], "n").collect()}
    assert got == {k: len({i for _, own, i in rows if own == k and i is not None}) for k in "ab"}
    two = {r["k"]: r["n"] for r in bitmaps.counts(sets.filter("m < 2"), ["k"], "n").collect()}
    assert two == {k: len({i for m, own, i in rows if own == k and i is not None and m < 2}) for k in "ab"}
