"""Sharding by rendezvous hashing, in DataFrame functions only.

Nulls: a null key is a key of its own; a null text has no bytes. Rows with equal keys
share a shard. Fully equal rows are counted before anything is dealt out, so a key that
holds a third of all rows costs one row there. Empty tables give empty results. Other columns are
kept by assigned(), which replaces one named as its result; the query takes none of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import expanded, table


def _score(key: Column, shard: Column, weight: Column) -> Column:
    """Weighted rendezvous score: weight / -ln(u), u in (0, 1) from the hash of key and shard."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard.cast("int")), 11).cast("double") + 0.5) / float(1 << 53)
    return weight / -F.log(u)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard in 0 .. len(weights)-1 with the largest score; a new shard takes rows only into itself."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), lambda s: F.struct(_score(key, s, F.get(w, s)).alias("score"), s.alias("shard"))))
    return best["shard"].cast("int")


def assigned(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """df with the shard of each row; no shuffle."""
    return df.withColumn(out, shard_of(F.col(key), weights))


def slotted(df: DataFrame, shard: str, order: Sequence[str], rows_per_bucket: int = 50_000) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the column `slot`, which df doesn't have yet.

    Shards split into hash buckets: rows are numbered in a bucket, buckets follow each other,
    so no task holds a whole shard. Equal rows are grouped first and expanded at the end, long runs piece by piece.
    """
    cols = list(df.columns)
    n, b, s, at, size, start, inner, copy = (f"_lls_{x}" for x in ("n", "bucket", "shard", "at", "size", "from", "in", "copy"))
    runs = df.groupBy(*cols).agg(F.count("*").alias(n))
    buckets = max(16, -(-df.count() // rows_per_bucket))
    runs = runs.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    per = runs.groupBy(shard, b).agg(F.sum(n).alias(size))
    before = Window.partitionBy(shard).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(shard).alias(s), F.col(b).alias(at), F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(shard, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.withColumn(inner, F.coalesce(F.sum(n).over(inside), F.lit(0)))
    numbered = numbered.join(per, (F.col(shard) == F.col(s)) & (F.col(b) == F.col(at)))
    return expanded(numbered, n, copy, list(order)).select(*cols, (F.col(start) + F.col(inner) + F.col(copy)).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str, shards: int = 24) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = assigned(assigned(rows, "doc_id", [1.0] * shards), "doc_id", [1.0] * (shards + 1), "grown_shard")
    out = slotted(rows, "shard", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")
