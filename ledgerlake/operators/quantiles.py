"""Exact quantiles of groups, as SQL's discrete ones: the value at rank ceil(share * n) among a group's n values.

Equal values of a group are counted first, beside the rows; what is shuffled and sorted is a group's distinct values with
their counts. Nothing is held whole in memory: windows spill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantiles(df: DataFrame, keys: Sequence[str], value: Column, rows: str | None = None, **percents: int) -> DataFrame:
    """keys, the number of rows as `rows` (if named) and each quantile, given in whole percents. Nulls don't count; without values quantiles are null."""
    counts = df.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("_rows")).withColumn("_c", F.when(F.col("_v").isNull(), 0).otherwise(F.col("_rows")))
    by = Window.partitionBy(*keys)
    ranked = counts.withColumns({"_upto": F.sum("_c").over(by.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)), "_n": F.sum("_c").over(by)})
    rank = lambda p: F.greatest(F.floor((F.col("_n") * p + 99) / 100), F.lit(1))
    found = [F.min(F.when(F.col("_upto") >= rank(p), F.col("_v"))).alias(name) for name, p in percents.items()]
    return ranked.groupBy(*keys).agg(*([F.sum("_rows").alias(rows)] if rows else []), *found)
