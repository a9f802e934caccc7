"""Exact counts of distinct ids that can be merged: sets of ids as bitmaps.

Ids are cut into buckets of 32,768; a set is a row per bucket with a bitmap of 4 kB.  The union of
sets is the OR of their bitmaps, so sets stored per month count any range of months.  Meant for dense ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SET = "bucket bigint, members binary"


def id_sets(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Rows (keys, bucket, members): the ids that occur with each key.  A null id is in no set."""
    bucket = F.bitmap_bucket_number(F.col(id_col)).alias("bucket")
    members = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_col))).alias("members")
    return rows.filter(F.col(id_col).isNotNull()).groupBy(*keys, bucket).agg(members)


def union(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets of each key."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def counts(sets: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Number of distinct ids in the union of the sets of each key."""
    return union(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("members")).cast("bigint").alias(out))
