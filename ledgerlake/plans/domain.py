"""Logical views of the domain over the base tables. Dimensions are left to the planner's size-based broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.tables import load


def bank(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (load(spark, sf, t) for t in ("orders", "customer", "nation"))
    df = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return df.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("client"), F.col("o_orderdate").alias("ts"), F.col("n_name").alias("country"), F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))


def insurance(spark: SparkSession, sf: str) -> DataFrame:
    li, s, n = (load(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    df = li.join(s, li.l_suppkey == s.s_suppkey, "left").join(n, s.s_nationkey == n.n_nationkey, "left")
    return df.select(F.col("l_suppkey").alias("product"), F.col("l_shipdate").alias("ts"), F.col("n_name").alias("country"), (F.col("l_returnflag") == "R").alias("is_claim"), F.col("l_linestatus").alias("status"), F.col("l_quantity").cast("int").alias("days"), F.col("l_extendedprice").alias("amount"))


def mobile(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    receiver = (F.col("user_id") * 7 + 3) % 150
    return e.select(F.col("event_id").alias("id"), "ts", F.col("user_id").alias("sender"), receiver.alias("receiver"), (F.col("user_id") % 25).alias("from_country"), (receiver % 25).alias("to_country"), F.col("event_type").alias("operator"), (F.col("event_type") == "error").alias("failed"), F.col("value").alias("amount"))
