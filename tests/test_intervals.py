"""Days and validity windows: every covering pair once, and no product of a key's days and windows."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallymart import conform, load_star, schema
from tallymart.functions.calendar import day_months_before, months_before
from tallymart.operators import intervals
from tallymart.plans import quality
from tallymart.sources.star import Star

START = date(2020, 1, 1)


def _day(n: int | None) -> date | None:
    return None if n is None else START + timedelta(days=n)


def _random_windows(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = [(0, "hot", -20_000, None), (1, "hot", 50, 50), (2, "hot", 60, 40), (3, "cold", None, 5), (4, "cold", -30_000, 40_000)]
    for i in range(5, n):
        first = rng.randint(-3000, 3000)
        size = rng.choice((0, 1, 30, 31, 32, 33, 1000, 1023, 1024, 1025, 2500, 40_000))
        out.append((i, rng.choice(("hot", "hot", "cold")), first, None if rng.random() < 0.1 else first + size))
    return out


def _windows(spark, rows):
    return spark.createDataFrame(
        [(i, k, _day(a), _day(b), i * 1.5) for i, k, a, b in rows], "promotion_id long, k string, valid_from date, valid_to date, rate double"
    )


def _covers(a, b, d) -> bool:
    return a is not None and d is not None and a <= d and (b is None or d <= b)


def test_every_covering_pair_once(spark):
    windows = _random_windows(120, 1)
    rng = random.Random(2)
    days = [(n, rng.choice(("hot", "cold", "none")), rng.choice((None, rng.randint(-4000, 4000)))) for n in range(200)]
    days += [(1000 + i, "hot", d) for i, d in enumerate((50, -20_000, -20_001, 0, -1, 32, 1024))]
    rows = spark.createDataFrame([(n, k, _day(d)) for n, k, d in days], "n long, k string, day date")
    got = intervals.covering(rows, _windows(spark, windows), "k", "day").select("n", "promotion_id").collect()
    want = [(n, i) for n, k, d in days for i, own, a, b in windows if own == k and _covers(a, b, d)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_bins_of_a_window_are_its_days(spark):
    """The bins do not overlap, hold the window's days and no other, and are few."""
    windows = _random_windows(150, 3)
    rows = intervals.binned_windows(_windows(spark, windows)).select("promotion_id", "width", "bin").collect()
    epoch = date(1970, 1, 1).toordinal()
    for i, _, a, b in windows:
        own = sorted((r["bin"] * r["width"], r["width"]) for r in rows if r["promotion_id"] == i)
        if a is None or (b is not None and b < a):
            assert own == []
            continue
        first, last = _day(a).toordinal() - epoch, (_day(b) or date(9999, 12, 31)).toordinal() - epoch
        assert own[0][0] == first and own[-1][0] + own[-1][1] == last + 1
        assert all(x + w == y for (x, w), (y, _) in zip(own, own[1:], strict=False))
        assert len(own) <= 2 * 31 * 3 + 90


def test_a_hot_key_is_not_multiplied_out(spark):
    """4,000 days and 4,000 windows of one key: 16 million pairs, of which two a day cover."""
    n = 4000
    windows = spark.range(n).select(
        F.col("id").alias("promotion_id"), F.lit("hot").alias("k"), F.date_add(F.lit(START), F.col("id").cast("int")).alias("valid_from"),
        F.date_add(F.lit(START), (F.col("id") + 1).cast("int")).alias("valid_to"), F.lit(1.0).alias("rate"),
    )
    rows = spark.range(n).select(F.col("id").alias("n"), F.lit("hot").alias("k"), F.date_add(F.lit(START), F.col("id").cast("int")).alias("day"))
    assert intervals.binned_days(rows, "day").count() == n * len(intervals.WIDTHS)
    assert intervals.binned_windows(windows).count() == 2 * n
    pairs = intervals.covering(rows, windows, "k", "day")
    assert pairs.count() == 2 * n - 1
    assert _most_joined(pairs) == 2 * n - 1
    newest = intervals.newest_covering(rows, windows, "k", "day", ("promotion_id", "rate"))
    assert newest.filter("promotion_id = n").count() == n
    assert _most_joined(newest) <= n * len(intervals.WIDTHS)


def _most_joined(df) -> int:
    """The most rows that a join of the executed plan gave out."""
    df.collect()
    plan, found = [df._jdf.queryExecution().executedPlan()], []
    while plan:
        node = plan.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            plan.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            plan.append(node.plan())
            continue
        if "Join" in name:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        plan.extend(children.apply(i) for i in range(children.size()))
    return max(found)


def test_newest_covering_window(spark):
    windows = _random_windows(100, 5)
    rng = random.Random(6)
    days = [(n, rng.choice(("hot", "cold", "none")), rng.choice((None, rng.randint(-3500, 4500)))) for n in range(300)]
    rows = spark.createDataFrame([(n, k, _day(d)) for n, k, d in days], "n long, k string, day date")
    got = {r["n"]: r["promotion_id"] for r in intervals.newest_covering(rows, _windows(spark, windows), "k", "day", ("promotion_id", "rate")).collect()}
    for n, k, d in days:
        valid = [(a, 10**9 if b is None else b, i) for i, own, a, b in windows if own == k and _covers(a, b, d)]
        assert got[n] == (max(valid)[2] if valid else None)
    assert len(got) == len(days)


def _broadcast(df) -> list[str]:
    """What the planned broadcasts of a query hold, as text."""
    plan, found = [df._jdf.queryExecution().sparkPlan()], []
    while plan:
        node = plan.pop()
        if node.nodeName() == "BroadcastHashJoin":
            side = node.left() if node.buildSide().toString() == "BuildLeft" else node.right()
            found.append(side.toString())
        children = node.children()
        plan.extend(children.apply(i) for i in range(children.size()))
    return found


def test_rows_made_of_windows_are_not_broadcast(spark, sf_dir):
    """Planned sizes are of files; a window may be many rows, and a planned broadcast is not taken back."""
    for name in ("rep_customer_mismatch", "promotion_on_line", "promotion_per_line"):
        held = _broadcast(entry.queries()[name](spark, sf_dir))
        assert not any("unix_date" in side for side in held), name


def test_keys_of_few_windows(spark, monkeypatch):
    """Keys of no, few and many windows, null keys, repeated rows: each way of meeting them gives the same."""
    rng = random.Random(8)
    windows = [(i, k, a, b) for i, (_, _, a, b) in enumerate(_random_windows(60, 9)) for k in (rng.choice("abcdefg"),)]
    windows += [(100, "a", 0, None), (100, "a", 0, None), (101, "b", None, 9), (102, "b", 9, 2), (103, None, 0, None)]
    windows += [(200 + i, "many", i, i + 3) for i in range(40)]
    days = [(n // 2, rng.choice((*"abcdefg", "many", "none", None)), rng.choice((None, rng.randint(-50, 60)))) for n in range(400)]
    rows = spark.createDataFrame([(n, k, _day(d)) for n, k, d in days], "n long, k string, day date")
    pairs = sorted((n, i) for n, k, d in days for i, own, a, b in windows if k is not None and own == k and _covers(a, b, d))
    newest = []
    for n, k, d in days:
        valid = [(a, 10**9 if b is None else b, i) for i, own, a, b in windows if k is not None and own == k and _covers(a, b, d)]
        newest.append((n, max(valid)[2] if valid else None))
    for few in (0, 1, 16, 100):
        monkeypatch.setattr(intervals, "FEW", few)
        got = intervals.covering(rows, _windows(spark, windows), "k", "day")
        assert got.columns == ["k", "n", "day", "promotion_id", "valid_from", "valid_to", "rate"]
        assert sorted(map(tuple, got.select("n", "promotion_id").collect())) == pairs, few
        got = intervals.newest_covering(rows, _windows(spark, windows), "k", "day", ("promotion_id", "rate"))
        assert got.columns == ["k", "day", "n", "promotion_id", "rate"]
        assert sorted(map(tuple, got.select("n", "promotion_id").collect()), key=str) == sorted(newest, key=str), few


def test_days_before(spark):
    for day in (date(2024, 3, 31), date(2024, 2, 29), date(2024, 1, 1), date(2023, 12, 31)):
        for n in (0, 1, 6, 12, 13):
            assert day_months_before(day, n) == spark.range(1).select(months_before(day, n)).first()[0]


# -- keys and dates --------------------------------------------------------------


def _facts(spark, star, **tables) -> Star:
    return Star({t: tables.get(t, star[t]) for t in schema.TABLES})


def test_every_table_is_scanned_once_for_all_keys(spark, sf_dir, tmp_path):
    star = conform(spark, sf_dir)
    for table in schema.TABLES:
        star[table].limit(3).write.parquet(f"{tmp_path}/{table}")
    plan = quality.dq_keys(load_star(spark, str(tmp_path)), entry.PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(schema.TABLES)
    assert plan.count("Exchange hashpartitioning") == 1


def test_keys_at_the_edges(spark, sf_dir):
    """Null and repeated keys, null references, a parent that is there twice."""
    star = conform(spark, sf_dir)
    regions = star["dim_regions"]
    twice = regions.unionByName(regions.limit(1)).unionByName(regions.limit(2).withColumn("region_id", F.lit(None).cast("int")))
    reps = star["dim_sales_reps"].withColumn("region_id", F.when(F.col("sales_rep_id") > 2, F.lit(-1)).cast("int"))
    odd = _facts(spark, star, dim_regions=twice, dim_sales_reps=reps)
    found = {(r["rule"], r["table_name"], r["constraint"]): r["violations"] for r in quality.dq_keys(odd, entry.PARAMS).collect()}
    assert found["primary key", "dim_regions", "region_id"] == 3
    assert found["unique", "dim_regions", "country_name, region_name, territory_name"] == 3
    assert found["reference", "dim_sales_reps", "region_id -> dim_regions.region_id"] == reps.filter("region_id = -1").count() > 0
    assert found["reference", "dim_customers", "region_id -> dim_regions.region_id"] == 0
    empty = _facts(spark, star, dim_categories=star["dim_categories"].limit(0))
    refs = {(r["table_name"], r["constraint"]): r["violations"] for r in quality.dq_foreign_key(empty, entry.PARAMS).collect()}
    assert refs["dim_products", "category_id -> dim_categories.category_id"] == star["dim_products"].count()


def test_gaps_of_the_calendar(spark, sf_dir):
    star = conform(spark, sf_dir)
    gone = (("1996-01-10", "1996-01-12"), ("1996-02-01", "1996-02-01"), ("1997-03-01", "1997-03-20"))
    calendar = star["dim_date"]
    for first, last in gone:
        calendar = calendar.filter(~F.col("full_date").between(first, last))
    got = quality.dq_date_gaps(_facts(spark, star, dim_date=calendar), entry.PARAMS).collect()
    holes = sorted((str(r["first_day"]), str(r["last_day"]), r["days"]) for r in got if r["source"] == "dim_date")
    assert holes == [(*g, n) for g, n in zip(gone, (3, 1, 20), strict=True)]
    used = {r[0] for r in star["fact_sales_orders"].select("order_date").distinct().collect()}
    missing = sorted(d for d in used if any(a <= str(d) <= b for a, b in gone))
    runs = sorted((r["first_day"], r["last_day"], r["days"]) for r in got if r["source"] == "fact_sales_orders.order_date")
    assert sum(n for *_, n in runs) == len(missing)
    assert all((b - a).days + 1 == n and a - timedelta(days=1) not in missing and b + timedelta(days=1) not in missing for a, b, n in runs)
