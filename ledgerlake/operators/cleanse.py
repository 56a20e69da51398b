"""Cleansing: the latest row of a key, dimensions cut to what facts ask for, orphan marks, outlier limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.quantiles import quantiles
from ledgerlake.operators.sketches import SPREADS, fence, marked

#: Bytes of a dimension that may be sent to all tasks.
SMALL = 32 << 20


def latest_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row of each key: the greatest by the order, which should be total. Aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.`{c}`").alias(c) for c in rest]).select(*df.columns)


def asked_for(dim: DataFrame, key: str, facts: DataFrame, fact_key: str) -> DataFrame:
    """The rows of a dimension whose keys some fact has: a semi join, so each stays once."""
    keys = facts.where(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias(key)).distinct()
    return dim.join(keys, key, "left_semi")


def enriched(facts: DataFrame, fact_key: str, dim: DataFrame, key: str, orphan: str | None = None, cut: bool = False, **columns: Column | None) -> DataFrame:
    """facts with columns of the dimension (a default stands where the key is unknown) and a mark of unknown keys.

    With `cut` the dimension is first cut to the keys in use, for large dimensions and few facts, which are then
    read twice. Either way its size decides how the planner joins.
    """
    side = (asked_for(dim, key, facts, fact_key) if cut else dim).select(F.col(key).alias("_key"), F.lit(True).alias("_known"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    out = facts.join(side, F.col(fact_key) == F.col("_key"), "left")
    out = out.withColumns({c: F.col(f"_d_{c}") if d is None else F.coalesce(F.col(f"_d_{c}"), d) for c, d in columns.items()})
    if orphan:
        out = out.withColumn(orphan, F.col("_known").isNull())
    return out.drop("_key", "_known", *[f"_d_{c}" for c in columns])


def sized(dim: DataFrame, most: int = SMALL) -> DataFrame:
    """dim, to be sent to all tasks if its rows, which are measured once, take at most so many bytes as text; else as it is.

    Streams don't adapt their plans to sizes as batches do: the static side of a join is measured when the stream starts.
    """
    size = dim.agg(F.sum(F.octet_length(F.to_json(F.struct(*dim.columns))))).first()[0] or 0
    return F.broadcast(dim) if size <= most else dim


def flagged(df: DataFrame, key: str, value: str, spreads: float = SPREADS, name: str = "outlier") -> DataFrame:
    """df with marks of the values that lie far above the others of their key, by exact quartiles of df itself."""
    quarters = quantiles(df, [key], F.log1p(F.col(value)), low=25, high=75)
    return marked(df, key, value, quarters.select(key, fence(F.col("low"), F.col("high"), spreads)), name)
