"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import half_up, masked, pseudonym, ratio
from ledgerlake.operators.cleanse import flagged, latest_by
from ledgerlake.operators.contracts import Contract, Rule, split
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.plans.domain import bank, insurance, mobile
from ledgerlake.sources.tables import load
from ledgerlake.streaming.detect import bursts

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

BANK = "bank AS (SELECT o_orderkey AS id, o_custkey AS client, o_orderdate AS ts, n_name AS country, o_orderpriority AS type, o_orderstatus AS status, o_totalprice AS amount FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"
INS = "ins AS (SELECT l_suppkey AS product, l_shipdate AS ts, n_name AS country, l_returnflag = 'R' AS is_claim, l_linestatus AS status, CAST(floor(l_quantity) AS INT) AS days, l_extendedprice AS amount FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey)"
MOB = "mob AS (SELECT event_id AS id, ts, user_id AS sender, (user_id * 7 + 3) % 150 AS receiver, user_id % 25 AS from_country, ((user_id * 7 + 3) % 150) % 25 AS to_country, event_type AS operator, event_type = 'error' AS failed, value AS amount FROM events)"


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


@query(f"""WITH {BANK}, {INS}, {MOB}, u AS (
SELECT CAST(ts AS DATE) AS day, country, 'bank' AS flow, amount, status = 'F' AS failed FROM bank
UNION ALL SELECT CAST(ts AS DATE), country, CASE WHEN is_claim THEN 'claim' ELSE 'premium' END, amount, FALSE FROM ins
UNION ALL SELECT CAST(ts AS DATE), CAST(from_country AS VARCHAR), 'mobile', amount, failed FROM mob)
SELECT day, country, flow, CAST(count(*) AS BIGINT) AS n_ops, CAST(count_if(failed) AS BIGINT) AS n_failed, round(sum(amount), 2) AS total FROM u GROUP BY ALL""")
def kpi_daily_volume(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("ts").alias("day")
    b = bank(spark, sf).select(day, "country", F.lit("bank").alias("flow"), "amount", (F.col("status") == "F").alias("failed"))
    i = insurance(spark, sf).select(day, "country", F.when(F.col("is_claim"), "claim").otherwise("premium").alias("flow"), "amount", F.lit(False).alias("failed"))
    m = mobile(spark, sf).select(day, F.col("from_country").cast("string").alias("country"), F.lit("mobile").alias("flow"), "amount", "failed")
    return b.unionByName(i).unionByName(m).groupBy("day", "country", "flow").agg(F.count("*").alias("n_ops"), F.count_if("failed").alias("n_failed"), F.round(F.sum("amount"), 2).alias("total"))


@query(f"""WITH {INS}, m AS (SELECT country, date_trunc('month', ts)::DATE AS month, round(coalesce(sum(amount) FILTER (is_claim), 0), 2) AS claims, round(coalesce(sum(amount) FILTER (NOT is_claim), 0), 2) AS premiums FROM ins GROUP BY ALL),
y AS (SELECT *, round(sum(claims) OVER w, 2) AS ytd_claims, round(sum(premiums) OVER w, 2) AS ytd_premiums FROM m WINDOW w AS (PARTITION BY country, year(month) ORDER BY month ROWS UNBOUNDED PRECEDING))
SELECT country, month, claims, premiums, CASE WHEN ytd_premiums > 0 THEN round(ytd_claims / ytd_premiums, 4) END AS ytd_loss_ratio FROM y""")
def kpi_loss_ratio(spark: SparkSession, sf: str) -> DataFrame:
    amount = lambda claim: F.round(F.coalesce(F.sum(F.when(F.col("is_claim") == claim, F.col("amount"))), F.lit(0.0)), 2)
    m = insurance(spark, sf).groupBy("country", F.to_date(F.date_trunc("month", "ts")).alias("month")).agg(amount(True).alias("claims"), amount(False).alias("premiums"))
    w = Window.partitionBy("country", F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    ytd = lambda c: F.round(F.sum(c).over(w), 2)
    return m.withColumns({"_c": ytd("claims"), "_p": ytd("premiums")}).select("country", "month", "claims", "premiums", ratio(F.col("_c"), F.col("_p")).alias("ytd_loss_ratio"))


@query(f"""WITH {INS} SELECT country, CAST(count(*) AS BIGINT) AS n_claims, quantile_disc(days, 0.5) AS p50_days, quantile_disc(days, 0.9) AS p90_days FROM ins WHERE is_claim GROUP BY country""")
def kpi_claim_time(spark: SparkSession, sf: str) -> DataFrame:
    return quantiles(insurance(spark, sf).where("is_claim"), ["country"], F.col("days"), "n_claims", p50_days=50, p90_days=90)


@query(f"""WITH {BANK} SELECT country, date_trunc('month', ts)::DATE AS month, CAST(count(DISTINCT client) AS BIGINT) AS clients, CASE WHEN count(DISTINCT client) > 0 THEN floor(sum(CAST(round(amount * 100) AS BIGINT)) / 100::DOUBLE / count(DISTINCT client) * 100 + 0.5) / 100 END AS arpu FROM bank GROUP BY ALL""")
def kpi_arpu(spark: SparkSession, sf: str) -> DataFrame:
    g = bank(spark, sf).groupBy("country", F.to_date(F.date_trunc("month", "ts")).alias("month"))
    n = F.countDistinct("client")
    return g.agg(n.alias("clients"), half_up(F.sum(F.round(F.col("amount") * 100).cast("long")) / 100 / n).alias("arpu"))


@query(f"""WITH {MOB}, u AS (SELECT CAST(ts AS DATE) AS day, sender AS who FROM mob UNION ALL SELECT CAST(ts AS DATE), receiver FROM mob),
a AS (SELECT day, CAST(count(DISTINCT who) AS BIGINT) AS active_users FROM u GROUP BY day), f AS (SELECT CAST(ts AS DATE) AS day, round(sum(amount), 2) AS total, CAST(count_if(failed) AS BIGINT) AS n_failed FROM mob GROUP BY 1)
SELECT day, active_users, total, n_failed FROM a JOIN f USING (day)""")
def kpi_mobile_flow(spark: SparkSession, sf: str) -> DataFrame:
    m = mobile(spark, sf).withColumn("day", F.to_date("ts"))
    a = m.select("day", F.explode(F.array("sender", "receiver")).alias("who")).groupBy("day").agg(F.countDistinct("who").alias("active_users"))
    f = m.groupBy("day").agg(F.round(F.sum("amount"), 2).alias("total"), F.count_if("failed").alias("n_failed"))
    return a.join(f, "day")


@query(f"""WITH {MOB}, w AS (SELECT date_trunc('week', ts)::DATE AS week, from_country, to_country, round(sum(amount), 2) AS total FROM mob WHERE from_country <> to_country GROUP BY ALL)
SELECT w.week, w.from_country, w.to_country, w.total, p.total AS previous FROM w LEFT JOIN w p ON w.week = p.week + INTERVAL 7 DAY AND w.from_country = p.from_country AND w.to_country = p.to_country""")
def kpi_corridors(spark: SparkSession, sf: str) -> DataFrame:
    w = mobile(spark, sf).where("from_country <> to_country").groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week"), "from_country", "to_country").agg(F.round(F.sum("amount"), 2).alias("total"))
    p = w.select(F.date_add("week", 7).alias("week"), "from_country", "to_country", F.col("total").alias("previous"))
    return w.join(p, ["week", "from_country", "to_country"], "left")


@query("""WITH s AS (SELECT l_suppkey AS loan, date_trunc('month', l_shipdate)::DATE AS month, l_extendedprice AS outstanding, l_returnflag = 'R' AS defaulted,
row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS n FROM lineitem),
v AS (SELECT *, lead(month) OVER (PARTITION BY loan ORDER BY month) AS until FROM s WHERE n = 1), b AS (SELECT min(month) AS a, max(month) AS z FROM v),
m AS (SELECT unnest(generate_series(a, z, INTERVAL 1 MONTH))::DATE AS as_of FROM b)
SELECT as_of, round(sum(outstanding), 2) AS portfolio, round(coalesce(sum(outstanding) FILTER (defaulted), 0), 2) AS bad FROM m JOIN v ON as_of >= month AND (until IS NULL OR as_of < until) GROUP BY as_of""")
def kpi_npl(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").withColumn("month", F.to_date(F.date_trunc("month", "l_shipdate")))
    s = latest_by(li, ["l_suppkey", "month"], F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice"))
    s = s.withColumn("until", F.lead("month").over(Window.partitionBy("l_suppkey").orderBy("month")))
    last = s.agg(F.max("month").alias("z"))  # one row
    s = s.crossJoin(F.broadcast(last)).withColumn("to", F.coalesce(F.date_sub("until", 1), F.col("z")))
    s = s.withColumn("as_of", F.explode(F.sequence("month", F.to_date(F.date_trunc("month", "to")), F.expr("INTERVAL 1 MONTH"))))
    return s.groupBy("as_of").agg(F.round(F.sum("l_extendedprice"), 2).alias("portfolio"), F.round(F.coalesce(F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))), F.lit(0.0)), 2).alias("bad"))


@query(f"""WITH {MOB}, s AS (SELECT unnest([0, 10, 20]) AS k), w AS (SELECT sender, time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(k) AS window_start, amount FROM mob, s)
SELECT sender, window_start, CAST(count(*) AS BIGINT) AS n_events, round(sum(amount), 2) AS total FROM w GROUP BY ALL HAVING count(*) >= 2""")
def detect_burst(spark: SparkSession, sf: str) -> DataFrame:
    out = bursts(mobile(spark, sf), "sender", "ts", least=2)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"""WITH {BANK} SELECT country, type, CAST(count(*) AS BIGINT) AS n_ops, CAST(count_if(status = 'F') AS BIGINT) AS n_failed, round(avg(amount), 2) AS mean FROM bank WHERE status IN ('O', 'F') GROUP BY ALL HAVING count(*) > 1""")
def agg_by_country_type(spark: SparkSession, sf: str) -> DataFrame:
    return bank(spark, sf).where(F.col("status").isin("O", "F")).groupBy("country", "type").agg(F.count("*").alias("n_ops"), F.count_if(F.col("status") == "F").alias("n_failed"), F.round(F.avg("amount"), 2).alias("mean")).where("n_ops > 1")


@query(f"""WITH {BANK}, q AS (SELECT country, quantile_disc(ln(1 + amount), 0.25) AS q1, quantile_disc(ln(1 + amount), 0.75) AS q3 FROM bank GROUP BY country)
SELECT id, b.country, amount, coalesce(ln(1 + amount) > q3 + 0.5 * (q3 - q1), FALSE) AS outlier FROM bank b LEFT JOIN q USING (country)""")
def outlier_flags(spark: SparkSession, sf: str) -> DataFrame:
    b = bank(spark, sf)
    return flagged(b, "country", "amount", 0.5).select("id", "country", "amount", "outlier")


@query("""SELECT c_custkey AS client, substr(regexp_replace(c_name, '\\s', '', 'g'), 1, 4) || '****' || right(regexp_replace(c_name, '\\s', '', 'g'), 4) AS masked_name, sha256('salt' || c_custkey::VARCHAR) AS pseudonym FROM customer""")
def str_mask_hash(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("client"), masked(F.col("c_name")).alias("masked_name"), pseudonym(F.col("c_custkey"), "salt").alias("pseudonym"))


@query("""WITH r AS (SELECT o_orderkey AS id, concat_ws(',', CASE WHEN o_totalprice % 7 < 1 THEN 'MISSING_STATUS' END, CASE WHEN o_totalprice % 7 >= 1 AND o_orderstatus NOT IN ('O', 'F') THEN 'INVALID_STATUS' END, CASE WHEN o_totalprice < 5000 THEN 'NEGATIVE_AMOUNT' END) AS reasons FROM orders)
SELECT id, reasons FROM r WHERE reasons <> ''""")
def reject_records(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    raw = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.when(price % 7 >= 1, F.col("o_orderstatus")).alias("status"), (price - 5000).alias("amount"))
    _, rejected = split(raw, Contract([Rule("required", "status"), Rule("one_of", "status", ("O", "F")), Rule("at_least", "amount", 0)]))
    return rejected.select("id", "reasons")


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM t WHERE n = 1""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    out = latest_by(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(f"""WITH {BANK}, g AS (SELECT country, client, round(sum(amount), 2) AS total FROM bank GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY total DESC, client) AS place FROM g) SELECT country, client, total, CAST(place AS INT) AS place FROM r WHERE place <= 10""")
def win_top10_per_country(spark: SparkSession, sf: str) -> DataFrame:
    g = bank(spark, sf).groupBy("country", "client").agg(F.round(F.sum("amount"), 2).alias("total"))
    return g.withColumn("place", F.row_number().over(Window.partitionBy("country").orderBy(F.desc("total"), "client"))).where("place <= 10")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def join_anti_orphans(spark: SparkSession, sf: str) -> DataFrame:
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL""")
def json_extract_props(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")).agg(F.count("*").alias("n"))
