"""Joins of days with validity windows, without pairing all days of a key with all its windows.

Days are cut into bins of several widths, each width a multiple of the one before.  A day lies in one
bin of every width; a window is the union of a few bins that do not overlap, wide ones in its middle
and narrow ones at its edges.  So a day and a window that covers it share exactly one (key, bin), and a
day and a window that does not cover it share none: the join gives the covering pairs and nothing else,
and a key with very many rows is spread over its bins.

A key with few windows needs no bins: its windows are one row, which a day meets once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.calendar import closed_end, covers

#: Days of a bin, narrow to wide; a window that never ends has some 90 bins of the widest.
WIDTHS = (1, 32, 1024, 32768)

BIN = "array<struct<width:int,bin:int>>"


def _run(width: int, first: Column, last: Column) -> Column:
    """The bins of one width from number `first` to `last`; none if they cross."""
    bins = F.transform(F.sequence(first, last), lambda b: F.struct(F.lit(width).alias("width"), b.alias("bin")))
    return F.when(first <= last, bins).otherwise(F.array().cast(BIN))


def bins_of_day(day: str) -> Column:
    """The one bin of each width that holds the day."""
    number = F.unix_date(day)
    return F.array(*(F.struct(F.lit(w).alias("width"), F.floor(number / w).cast("int").alias("bin")) for w in WIDTHS))


def bins_of_window(first: str, last: Column) -> Column:
    """Bins that do not overlap and together are the days from `first` to `last`; none if they cross.

    At most two runs per width, each shorter than the next width holds bins; the widest fills the middle.
    """
    # what is left to cover, in days from `low` up to and without `high`
    low, high = F.unix_date(first), F.unix_date(last) + 1
    empty = low >= high
    parts = []
    for width, wider in zip(WIDTHS, WIDTHS[1:], strict=False):
        up = (F.ceil(low / wider) * wider).cast("int")
        down = (F.floor(high / wider) * wider).cast("int")
        inner = up < down  # a bin of the next width fits
        bin_of = lambda d: F.floor(d / width).cast("int")  # noqa: B023, E731 - used at once
        parts += [
            F.when(inner, _run(width, bin_of(low), bin_of(up) - 1)).otherwise(_run(width, bin_of(low), bin_of(high) - 1)),
            F.when(inner, _run(width, bin_of(down), bin_of(high) - 1)).otherwise(F.array().cast(BIN)),
        ]
        # without an inner bin nothing is left
        low, high = F.when(inner, up).otherwise(F.lit(0)), F.when(inner, down).otherwise(F.lit(0))
    widest = WIDTHS[-1]
    parts.append(_run(widest, F.floor(low / widest).cast("int"), F.floor(high / widest).cast("int") - 1))
    return F.when(empty, F.array().cast(BIN)).otherwise(reduce(F.concat, parts))


def binned_days(rows: DataFrame, day: str) -> DataFrame:
    """Each row once for each bin that holds its day, with columns width and bin; a row without a day has none."""
    return rows.filter(F.col(day).isNotNull()).select("*", F.inline(bins_of_day(day)))


def binned_windows(windows: DataFrame) -> DataFrame:
    """Each window once for each of its bins, with columns width and bin; an open end is the last day there is."""
    return windows.filter(F.col("valid_from").isNotNull()).select("*", F.inline(bins_of_window("valid_from", closed_end())))


#: Most windows that a key may have to be met as one row.
FEW = 16


def _by_key(windows: DataFrame, key: str, *kept: Column | str) -> DataFrame:
    """Rows (key, _own): the windows of a key as an array, cut at one more than ``FEW``, which marks a key of many."""
    held = windows.filter(F.col("valid_from") <= closed_end())
    place = F.row_number().over(Window.partitionBy(key).orderBy("valid_from"))
    some = held.withColumn("_place", place).filter(F.col("_place") <= FEW + 1)
    return some.groupBy(key).agg(F.collect_list(F.struct(*kept)).alias("_own"))


def _of_many(rows: DataFrame, by_key: DataFrame, key: str) -> DataFrame:
    """Rows, or windows, of the keys of many windows."""
    return rows.join(by_key.filter(F.size("_own") > FEW).select(key), key, "left_semi")


def _met(rows: DataFrame, others: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """A join that never broadcasts: both sides hold arrays or several rows a source row, so that their planned
    sizes, which are of compressed files, say nothing, and a broadcast once planned is not taken back."""
    return rows.join(others.hint("merge"), by, how)


def covering(rows: DataFrame, windows: DataFrame, key: str, day: str) -> DataFrame:
    """Every row with every window of its key that covers its day: an inner join.

    Apart from the key the two must have no column in common.  A row meets the windows of a key of few
    at once; for a key of many it is sent once a width, a window once a bin, and the join's output is the
    result, whatever the number of windows of a key that do not cover the day.
    """
    of_window = [c for c in windows.columns if c != key]
    by_key = _by_key(windows, key, *of_window)
    few = _met(rows, by_key.filter(F.size("_own") <= FEW), [key])
    covers_day = F.filter("_own", lambda w: covers(F.col(day), w["valid_from"], w["valid_to"]))
    few = few.select(key, *(c for c in rows.columns if c != key), F.inline(covers_day))
    days, bins = binned_days(_of_many(rows, by_key, key), day), binned_windows(_of_many(windows, by_key, key))
    return few.unionByName(_met(days, bins, [key, "width", "bin"]).drop("width", "bin"))


def newest_covering(
    rows: DataFrame, windows: DataFrame, key: str, day: str, values: Sequence[str]
) -> DataFrame:
    """``rows`` with ``values`` of the newest window of their key that covers their day, else null: a left join.

    Newest is the latest ``valid_from``, then the longest, then the highest values in their order.  A row
    meets the windows of a key of few at once.  Those of a key of many are reduced to the newest of each bin
    before they meet any day, so a day meets at most one window a width; there the answer depends on key and
    day alone and is found once per distinct pair.
    """
    rank = F.struct("valid_from", closed_end().alias("valid_to"), *values)
    by_key = _by_key(windows, key, "valid_from", closed_end().alias("valid_to"), *values)
    columns = [key, day, *(c for c in rows.columns if c not in (key, day))]
    newest = [F.col(f"_newest.{v}").alias(v) for v in values]
    covers_day = F.filter("_own", lambda w: covers(F.col(day), w["valid_from"], w["valid_to"]))
    few = _met(rows, by_key, [key], "left").filter(F.coalesce(F.size("_own"), F.lit(0)) <= FEW)
    few = few.select(*columns, F.array_max(covers_day).alias("_newest")).select(*columns, *newest)

    by = [key, "width", "bin"]
    best = binned_windows(_of_many(windows, by_key, key)).groupBy(*by).agg(F.max(rank).alias("_newest"))
    of_many = _of_many(rows, by_key, key)
    asked = of_many.select(key, day).distinct()
    found = _met(binned_days(asked, day), best, by).groupBy(key, day).agg(F.max("_newest").alias("_newest"))
    return few.unionByName(of_many.join(found.select(key, day, *newest), [key, day], "left").select(*columns, *values))
