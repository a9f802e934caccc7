"""Operators on validity windows: newest valid row, overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.calendar import closed_end
from tallymart.operators.intervals import newest_covering


def newest_valid(
    rows: DataFrame, windows: DataFrame, key: str, day: str, value: str, id_col: str = "promotion_id"
) -> DataFrame:
    """``rows`` with the id and value of the newest window of its key that covers its day, null where none does.

    Newest is the latest ``valid_from``, then the longest, then the highest id.
    """
    return newest_covering(rows, windows, key, day, (id_col, value))


def overlapping(windows: DataFrame, key: str, id_col: str) -> DataFrame:
    """Windows that start while an earlier window of the same key is still open.

    One row per such window with one earlier window, not one row per pair: of
    the windows from earlier days that are still open the one that lasts
    longest, else the lowest id that starts on the same day.  Windows are first
    reduced to one per key and first day, so the ordered pass holds at most one
    row per day of a key.
    """
    reach = F.max(F.struct(closed_end().alias("last_day"), F.col(id_col).alias("id"))).alias("reach")
    starts = windows.groupBy(key, "valid_from").agg(reach, F.min(id_col).alias("first_id"))
    before = Window.partitionBy(key).orderBy("valid_from").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("longest", F.max("reach").over(before))
    still_open = F.when(F.col("longest.last_day") >= F.col("valid_from"), F.col("longest.id"))
    same_day = F.when(F.col("first_id") < F.col(id_col), F.col("first_id"))
    found = windows.select(key, "valid_from", id_col).join(
        starts.select(key, "valid_from", "first_id", still_open.alias("still_open")), [key, "valid_from"]
    )
    return found.select(key, id_col, F.coalesce("still_open", same_day).alias(f"earlier_{id_col}")).filter(
        F.col(f"earlier_{id_col}").isNotNull()
    )
