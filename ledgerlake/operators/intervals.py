"""Sums of what is valid at each month, from states with a beginning and an end, by a sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_sums(states: DataFrame, keys: Sequence[str], start: str, until: str, last: DataFrame | Sequence[str], **sums: Column) -> DataFrame:
    """keys, month and each sum over the states that are valid in that month: from `start` on, before `until` (null: to the end).

    A state adds its values where it begins and takes them off where it ends; what is added and taken off
    in a month is summed first, and running sums over each key's months give what is valid then. So two rows a state are
    aggregated, however many months it lasts, and what is sorted is months times keys. States are read once. Values are whole numbers.
    `last` says how far each of its keys (some of `keys`) goes, in the column `last`; given as names alone, keys go to their latest
    beginning. Months without a valid state (the first sum, a count) have no row.
    """
    ends = F.array(F.struct(F.col(start).alias("month"), F.lit(1).alias("sign")), F.struct(F.col(until).alias("month"), F.lit(-1).alias("sign")))
    moves = states.select(*keys, *[c.cast("long").alias(n) for n, c in sums.items()], F.inline(ends)).where("month IS NOT NULL")
    moves = moves.groupBy(*keys, "month").agg(F.max(F.when(F.col("sign") > 0, F.col("month"))).alias("_start"), *[F.sum(F.col("sign") * F.col(n)).alias(n) for n in sums])
    moves = moves.join(last, [c for c in last.columns if c != "last"]) if isinstance(last, DataFrame) else moves.withColumn("last", F.max("_start").over(Window.partitionBy(*last)))
    by_month = Window.partitionBy(*keys).orderBy("month")
    running = moves.where("month <= last").withColumns({**{n: F.sum(n).over(by_month.rowsBetween(Window.unboundedPreceding, 0)) for n in sums}, "_next": F.lead("month").over(by_month)})
    running = running.where(F.col(next(iter(sums))) > 0).withColumn("_until", F.coalesce("_next", "last"))
    each = running.withColumn("month", F.explode(F.sequence("month", "_until", F.expr("INTERVAL 1 MONTH"))))
    return each.where("_next IS NULL OR month < _next").select(*keys, "month", *sums)
