"""Operators against brute force on small skewed rows."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.functions.money import percent, ratio
from tallymart.operators.prefix import block, position_by, prefix_sum, rank_by_amount
from tallymart.operators.validity import newest_valid, overlapping

GROUPS = ["hot"] * 40 + ["a"] * 7 + ["b"] * 13


def _amount_rows(spark):
    """Group ``hot`` holds most rows and a third of them tie."""
    rows = []
    for i, g in enumerate(GROUPS):
        amount = Decimal("12345.67") if i % 3 == 0 else Decimal(i * 7919 % 50000) + Decimal(i % 100) / 100
        rows.append((i, g, amount))
    return rows, spark.createDataFrame(rows, "id bigint, g string, amount decimal(28,2)")


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("width", [1, 100, 10_000])
def test_rank_by_amount(spark, dense, width):
    rows, df = _amount_rows(spark)
    got = {r["id"]: r["place"] for r in rank_by_amount(df, ["g"], "amount", "place", dense, width).collect()}
    for i, g, amount in rows:
        ahead = [a for _, h, a in rows if h == g and a > amount]
        assert got[i] == 1 + len(set(ahead) if dense else ahead)


@pytest.mark.parametrize("width", [10, 10_000])
def test_position_by_breaks_ties_by_key(spark, width):
    rows, df = _amount_rows(spark)
    df = df.withColumn("second", F.col("id") % 2)
    got = {r["id"]: r["place"] for r in position_by(df, ["g"], ["amount", "second"], "id", "place", width).collect()}
    for i, g, amount in rows:
        mine = (-amount, -(i % 2), i)
        assert got[i] == 1 + sum(1 for j, h, a in rows if h == g and (-a, -(j % 2), j) < mine)


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_prefix_sum_over_blocks(spark, width):
    rows, df = _amount_rows(spark)
    df = df.withColumn("part", block("id", width))
    summed = prefix_sum(df, ["g"], [[("part", False)], [("id", False)]], "amount", "before")
    got = {r["id"]: r["before"] for r in summed.collect()}
    for i, g, _ in rows:
        assert got[i] == sum((a for j, h, a in rows if h == g and j < i), Decimal(0))


def _day(n: int | None) -> date | None:
    return None if n is None else date(2024, 1, 1) + timedelta(days=n)


WINDOWS = [
    # id, key, first day, last day
    (1, "hot", 0, 9),
    (2, "hot", 3, 4),
    (3, "hot", 3, None),
    (4, "hot", 3, 3),
    (5, "hot", 20, 25),
    (6, "cold", 0, 5),
    (7, "cold", 6, 8),
    (8, "cold", 8, 8),
]


def _windows(spark):
    rows = [(i, k, _day(a), _day(b), i / 100) for i, k, a, b in WINDOWS]
    return spark.createDataFrame(rows, "promotion_id bigint, k string, valid_from date, valid_to date, rate double")


def test_newest_valid(spark):
    asked = [(i, k, _day(i % 30)) for i in range(90) for k in ("hot", "cold", "none")]
    rows = spark.createDataFrame(asked, "n bigint, k string, day date")
    got = {(r["n"], r["k"]): r["promotion_id"] for r in newest_valid(rows, _windows(spark), "k", "day", "rate").collect()}
    assert len(got) == len(asked)
    for n, k, day in asked:
        open_ = [(a, b if b is not None else 10**6, i) for i, h, a, b in WINDOWS if h == k]
        valid = [w for w in open_ if _day(w[0]) <= day and (w[1] == 10**6 or day <= _day(w[1]))]
        assert got[(n, k)] == (max(valid)[2] if valid else None)


def test_overlapping_is_found_for_exactly_the_overlapped(spark):
    got = {r["promotion_id"]: r["earlier_promotion_id"] for r in overlapping(_windows(spark), "k", "promotion_id").collect()}
    ends = {i: b if b is not None else 10**6 for i, _, _, b in WINDOWS}
    expected = {}
    for i, k, a, _ in WINDOWS:
        before = [(ends[j], j) for j, h, c, _ in WINDOWS if h == k and c < a and ends[j] >= a]
        twins = [j for j, h, c, _ in WINDOWS if h == k and c == a and j < i]
        if before or twins:
            expected[i] = max(before)[1] if before else min(twins)
    assert got == expected


def test_ratios_round_once_and_survive_zero(spark):
    rows = [("0.05", "10.00"), ("-0.05", "10.00"), ("1.00", "3.00"), ("1.00", "0.00")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "n decimal(28,2), d decimal(28,2)")
    got = df.select(ratio("n", "d").alias("r"), percent("n", "d").alias("p")).collect()
    assert [r["r"] for r in got] == [Decimal("0.01"), Decimal("-0.01"), Decimal("0.33"), None]
    assert [r["p"] for r in got] == [Decimal("0.50"), Decimal("-0.50"), Decimal("33.33"), None]
