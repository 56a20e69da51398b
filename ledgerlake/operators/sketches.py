"""Limits of outliers from mergeable sketches of quantiles (KLL).

A sketch of a key's values is small, is made beside the rows (partial aggregation) and merges with any other. So
history is kept as one sketch a key and day, each day's rows are read once, and limits for the next
batch come from merging sketches, not from facts. Up to SIZE values in a key quantiles are exact; beyond that
their rank is off by about 2.3 / SIZE^0.9 (0.13 %) with 99 % certainty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import store

SIZE = 4096
#: How many spreads of the middle half a value may lie above the third quartile.
SPREADS = 1.5


def sketched(df: DataFrame, keys: Sequence[str], value: Column, size: int = SIZE) -> DataFrame:
    """keys, n, sketch: one sketch of log1p(value) for each combination of keys; nulls don't count."""
    return df.groupBy(*keys).agg(F.count(F.log1p(value)).alias("n"), F.kll_sketch_agg_double(F.log1p(value), F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.where("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(q: float) -> Column:
    """Of the column `sketch`; null where there are no values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))


def fence(low: Column, high: Column, spreads: float) -> Column:
    """The most that log1p of a value may be, from its quartiles."""
    return (high + F.lit(spreads) * (high - low)).alias("fence")


def limits(sketches: DataFrame, key: str, spreads: float = SPREADS) -> DataFrame:
    """(key, fence), a row for each key."""
    return sketches.select(key, fence(quantile(0.25), quantile(0.75), spreads))


def marked(df: DataFrame, key: str, value: str, fences: DataFrame, name: str = "outlier") -> DataFrame:
    """df with a mark of values above the fence of their key; without a key, a fence or a value nothing is marked, and no row is dropped.

    Fences are sent to all tasks, as keys are few (countries), so that rows aren't shuffled by key.
    """
    side = fences.select(F.col(key).alias("_fenced"), F.col("fence").alias("_fence"))
    out = df.join(F.broadcast(side), F.col(key) == F.col("_fenced"), "left")
    return out.withColumn(name, F.coalesce(F.log1p(F.col(value)) > F.col("_fence"), F.lit(False))).drop("_fenced", "_fence")


class History:
    """Sketches by day (or another period that loads bring whole) in a folder. A day that comes again replaces itself, so that a replayed load changes nothing."""

    def __init__(self, spark: SparkSession, path: str, key: str, day: str, value: str):
        self.spark, self.path, self.key, self.day, self.value = spark, path, key, day, value

    def add(self, facts: DataFrame) -> None:
        """Days of facts come whole: the sketch of a day is that of these rows."""
        store.replace_partitions(sketched(facts, [self.key, self.day], F.col(self.value)), self.path, [self.day])

    def upto(self, until: Column | None = None) -> DataFrame:
        """key, n, sketch over the days for which the condition holds (none: all); only their partitions are read."""
        days = self.spark.read.parquet(self.path)
        return merged(days if until is None else days.where(until), [self.key])
