"""Exact distinct counts that roll up: bitmaps of whole-number ids by day, merged to any coarser grain without the facts.

A bitmap holds 32,768 ids of a bucket (4 kB); a day has a row for each bucket in which an id occurs. Ids should be
dense, as keys of a dimension are; hash others to a dimension's numbers first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, keys: Sequence[str], who: str) -> DataFrame:
    """keys, bucket, ids: which ids occur for each combination of keys; nulls don't. Aggregated before the shuffle."""
    rows = df.where(F.col(who).isNotNull()).select(*keys, F.bitmap_bucket_number(F.col(who)).alias("bucket"), F.bitmap_bit_position(F.col(who)).alias("_bit"))
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_bit").alias("ids"))


def rolled_up(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys and the number of distinct ids over all bitmaps of these keys."""
    by_bucket = maps.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("_n"))
    return by_bucket.groupBy(*keys).agg(F.sum("_n").alias(name))
