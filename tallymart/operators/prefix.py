"""Ordered sums within groups that may be too large for one task.

``sum() over (partition by g order by k)`` sorts a whole group in one task.
Here the order is cut into levels, coarse to fine.  Totals of each level run
ahead of the next, so a task only ever orders the entries of one level inside
one entry of the level above.  Levels are expressions of the row, not sampled
boundaries: a task that is run again gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1_000_000


def prefix_sum(
    df: DataFrame, group: Sequence[str], levels: Sequence[Sequence[tuple[str, bool]]], weight: str, out: str
) -> DataFrame:
    """``df`` with ``out``: the sum of ``weight`` over rows ordered before it in its group.

    ``levels`` holds, coarse to fine, lists of (column, descending).  The
    columns of all levels together must order the rows of a group uniquely and
    hold no NULL.
    """

    def path(depth: int) -> list[str]:
        return [*group, *(c for level in levels[:depth] for c, _ in level)]

    last = len(levels) - 1
    rows = totals = _summed(df, path(last), levels[last], weight, out)
    kind = dict(df.dtypes)[weight]
    for depth in range(last - 1, -1, -1):
        # The last entry of a window knows its total: read it off there, so that
        # totals and rows come from the same shuffle.  It is the same shuffle only
        # if the totals read all columns, so they add a zero made from them.
        nothing = F.xxhash64(*df.columns) % 1 if depth == last - 1 else F.lit(0)
        whole = (F.col(out) + F.col(weight) + nothing).cast(kind if kind == "bigint" else "decimal(38,2)")
        blocks = totals.filter("_last").select(*path(depth + 1), whole.alias(weight))
        totals = _summed(blocks, path(depth), levels[depth], weight, out)
        ahead = totals.select(*path(depth + 1), F.col(out).alias("_ahead"))
        rows = rows.join(ahead, path(depth + 1)).withColumn(out, F.col(out) + F.col("_ahead")).drop("_ahead")
    return rows.drop("_last")


def _summed(
    df: DataFrame, keys: Sequence[str], level: Sequence[tuple[str, bool]], weight: str, out: str
) -> DataFrame:
    """``df`` with ``out``, the weight ahead of a row among its keys, and a mark on the last row."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in level]
    window = Window.partitionBy(*keys).orderBy(*order)
    ahead = F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.coalesce(ahead, F.lit(0))).withColumn(
        "_last", F.lead(F.lit(True)).over(window).isNull()
    )


def block(key: str, width: int = BLOCK) -> Column:
    """Coarse level of an integer key: at most ``width`` distinct keys share one."""
    return F.floor(F.col(key) / width)


def rank_by_amount(
    df: DataFrame, group: Sequence[str], amount: str, out: str, dense: bool = False, width: int = 10_000
) -> DataFrame:
    """``df`` with its rank by descending ``amount`` (two decimals) in its group; ties share a rank.

    Rows are first reduced to distinct amounts with their counts, so a tie of
    any size is one entry.  A block of ``width`` units holds at most
    ``100 * width`` distinct amounts.  Rows and amounts both stem from ``df``:
    the mark makes the amounts read all its columns, so the shuffles below are
    the same for both and run once.
    """
    mark = F.max(F.xxhash64(*df.columns)).alias("_mark")
    amounts = df.groupBy(*group, amount).agg(F.count(F.lit(1)).alias("_n"), mark)
    if dense:
        amounts = amounts.withColumn("_n", F.lit(1).cast("bigint"))
    amounts = amounts.withColumn("_block", F.floor(F.col(amount) / width))
    ranked = prefix_sum(amounts, group, [[("_block", True)], [(amount, True)]], "_n", "_ahead_of_it")
    rank = F.when(F.col("_mark").isNotNull(), (F.col("_ahead_of_it") + 1).cast("bigint"))
    ranks = ranked.select(*group, amount, rank.alias(out))
    return df.join(ranks, [*group, amount])


def position_by(
    df: DataFrame, group: Sequence[str], amounts: Sequence[str], key: str, out: str, width: int = 10_000
) -> DataFrame:
    """``df`` with its place by descending ``amounts``, then ascending integer ``key``, which is unique.

    Rows that tie on all amounts are cut into blocks of the key.
    """
    shaped = (
        df.withColumn("_one", F.lit(1).cast("bigint"))
        .withColumn("_block", F.floor(F.col(amounts[0]) / width))
        .withColumn("_keys", block(key))
    )
    levels = [[("_block", True)], [*((a, True) for a in amounts), ("_keys", False)], [(key, False)]]
    placed = prefix_sum(shaped, group, levels, "_one", out)
    return placed.withColumn(out, (F.col(out) + 1).cast("bigint")).drop("_one", "_block", "_keys")
