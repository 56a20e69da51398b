"""Mixing sources to target weights, in DataFrame functions only.

Sizes are words; a null or empty text has size 0 and is taken 0 words, whatever its copies.
A null source is a source of its own, last in order. Equal rows share their copies. An
empty table gives an empty result. Columns of the input stay in emitted().
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import count_words, saved, table

P = "_llm_"
#: Source tables up to this many rows are broadcast; larger ones join by AQE's choice.
BROADCAST_SOURCES = 20_000


def targets(docs: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """A row per source: P+source, P+source_size, P+target.

    Targets are level * weight, but cap * size where that is less; the sources that stop at
    their cap are a prefix in the order of cap / weight, so one pass over sources finds the level.
    """
    per = docs.groupBy(F.col(P + "source")).agg(F.sum(P + "size").alias(P + "source_size"))
    order = Window.orderBy(F.col(P + "source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = per.withColumn("w", F.get(w, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    per = per.withColumn("cap", cap * F.col(P + "source_size")).withColumn("r", F.col("cap") / F.col("w"))
    before = Window.orderBy("r", F.col(P + "source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = share * F.sum(P + "source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    # The first source whose cap isn't below the level of those from it on sets the level of the rest.
    final = F.min(F.when(F.col("r") >= F.col("level"), F.struct("r", "level"))).over(whole)["level"]
    return per.select(P + "source", P + "source_size", F.least(F.col("cap"), F.coalesce(final * F.col("w"), F.col("cap"))).alias(P + "target"))


def unit_hash(*parts: Column, seed: str) -> Column:
    """A number in [0, 1) from MD5 of the parts: the same in every engine and run."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "mix") -> DataFrame:
    """docs with what a plan needs of each row: P+source, P+size and P+u, in [0, 1) by the row's key and text."""
    u = unit_hash(F.col(key), F.md5(F.coalesce(F.col(text), F.lit(""))), seed=seed)
    return docs.withColumns({P + "source": F.col("source"), P + "size": count_words(F.col(text)), P + "u": u})


def planned(rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """rows of sized() with P+source_size, P+target and P+copies: floor(rate) plus a Bernoulli copy."""
    t = saved(targets(rows, weights, share, cap), "mix-targets").withColumnRenamed(P + "source", P + "of")
    side = F.broadcast(t) if t.count() <= BROADCAST_SOURCES else t
    df = rows.join(side, F.col(P + "source").eqNullSafe(F.col(P + "of")), "left").drop(P + "of")
    rate = F.when(F.col(P + "source_size") > 0, F.col(P + "target") / F.col(P + "source_size")).otherwise(0.0)
    return df.withColumn(P + "copies", (F.floor(rate) + F.when(F.col(P + "u") < rate - F.floor(rate), 1).otherwise(0)).cast("int"))


def emitted(docs: DataFrame, **how) -> DataFrame:
    """Each row of docs as many times as the plan says, with the columns of docs."""
    df = planned(sized(docs), **how).where(F.col(P + "copies") > 0)
    df = df.withColumn(P + "copy", F.explode(F.sequence(F.lit(1), F.col(P + "copies"))))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Texts are read once: what the plan needs of them is a few numbers a row.
    rows = saved(sized(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text", "source"), "mix-sizes")
    df = planned(rows)
    return df.select("doc_id", F.col(P + "size").alias("size"), F.col(P + "source_size").alias("source_size"), F.col(P + "target").alias("target"), (F.col(P + "copies") * F.col(P + "size")).alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
o AS (SELECT *, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
q AS (SELECT *, cap / w AS r, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM o WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (SELECT level FROM q WHERE r >= level ORDER BY r, level LIMIT 1) AS final FROM q),
g AS (SELECT source, source_size, least(cap, coalesce(final * w, cap)) AS target FROM f),
j AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  CAST(('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(t)), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) * size AS taken FROM j
"""
