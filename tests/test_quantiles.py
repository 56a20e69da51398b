"""Exact quantiles where groups are too large for sketches, against the SQL."""

import duckdb
from pyspark.sql import functions as F

from ledgerlake.operators.cleanse import flagged
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.plans import atoms, catalogue

SF = "/root/testdata/sf0.001"


def written(spark, tmp_path):
    """120,000 lines with as many quantities, in two flags; the other tables as given."""
    n = 120_000
    li = spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 10).alias("l_suppkey"), F.when(F.col("id") % 4 == 0, "N").otherwise("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.when(F.col("id") % 1000 != 7, (F.pmod(F.col("id") * 7919, F.lit(n)) + 1).cast("double")).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"), F.lit("1998-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    li.repartition(6).write.parquet(f"{tmp_path}/lineitem.parquet")
    for t in ("supplier", "nation"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return con


def test_large_groups_equal_their_sql(spark, tmp_path):
    con = written(spark, tmp_path)
    for part, name in ((atoms, "agg_percentiles"), (catalogue, "kpi_claim_time")):
        cur = con.execute(part.ORACLES[name])
        got = part.QUERIES[name](spark, str(tmp_path)).select(*[c[0] for c in cur.description])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(cur.fetchall(), key=repr), name


def test_ranks_nulls_and_repeats(spark):
    rows = [(k, v) for k in range(1, 60) for v in range(k)] + [(60, 5)] * 9 + [(60, 7), (61, None), (61, None), (None, 3)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: tuple(r)[1:] for r in quantiles(df, ["k"], F.col("v"), "n", low=0, p25=25, p90=90, high=100).collect()}
    assert all(got[k] == (k, 0, -(-k // 4) - 1, -(-k * 9 // 10) - 1, k - 1) for k in range(1, 60))
    assert (got[60], got[61], got[None]) == ((10, 5, 5, 5, 7), (2, None, None, None, None), (1, 3, 3, 3, 3))


def test_limits_of_large_keys_are_exact(spark):
    """Keys of 30,000 values that lie close about their fences."""
    n, v = 30_000, F.pmod(F.col("id") * 7919, F.lit(30_000))
    df = spark.range(2 * n).select((F.col("id") % 2).alias("k"), F.when(v < n // 2, v + 1).otherwise(v + n).cast("double").alias("v")).repartition(8)
    got = {(r.k, r.v) for r in flagged(df, "k", "v", spreads=0.01).where("outlier").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT id % 2 AS k, CASE WHEN id * 7919 % {n} < {n // 2} THEN id * 7919 % {n} + 1 ELSE id * 7919 % {n} + {n} END::DOUBLE AS v FROM range({2 * n}) r(id)")
    want = con.execute("WITH q AS (SELECT k AS g, quantile_disc(ln(1 + v), 0.75) AS q3, quantile_disc(ln(1 + v), 0.25) AS q1 FROM t GROUP BY 1) SELECT DISTINCT k, v FROM t JOIN q ON k = g WHERE ln(1 + v) > q3 + 0.01 * (q3 - q1)").fetchall()
    assert want and got == set(want)
