"""Detectors: one function for batch and stream; streams add a watermark before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliding(df: DataFrame, ts: str, keys: list[str], *aggregates: Column, size: str, slide: str, late: str | None = None) -> DataFrame:
    """Aggregates of sliding windows `w` by keys. With `late`, the rows of a stream that come after a window is over by so much don't count in it."""
    df = df.withWatermark(ts, late) if late else df
    return df.groupBy(F.window(F.col(ts), size, slide).alias("w"), *keys).agg(*aggregates)


def bursts(df: DataFrame, key: str, ts: str, size: str = "30 minutes", slide: str = "10 minutes", least: int = 3, late: str | None = None) -> DataFrame:
    """Sliding windows in which a key has at least `least` events."""
    w = sliding(df, ts, [key], F.count("*").alias("n_events"), F.round(F.sum("amount"), 2).alias("total"), size=size, slide=slide, late=late)
    return w.where(F.col("n_events") >= least).select(key, F.col("w.start").alias("window_start"), "n_events", "total")


def burst_stream(df: DataFrame, key: str, ts: str, late: str = "10 minutes", **how) -> DataFrame:
    return bursts(df, key, ts, late=late, **how)
