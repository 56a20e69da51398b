"""Single operators as queries over the base tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import masked, money, positive, present, ratio, sql_money
from ledgerlake.operators.cleanse import asked_for, enriched, latest_by
from ledgerlake.operators.contracts import Contract, Rule, file_stats, quality_metrics, reject_records, split, without_personal
from ledgerlake.operators.ingest import Ingestion
from ledgerlake.operators.policies import Policy
from ledgerlake.operators.quantiles import quantiles
from ledgerlake.plans.silver import countries, silver_fx_rates, to_eur
from ledgerlake.plans import silver
from ledgerlake.sources.scratch import new_place
from ledgerlake.sources.tables import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


# scans, projections, filters


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal IS NOT NULL AND c_acctbal > 100")
def scan_filter_in(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer")
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_acctbal").isNotNull() & (F.col("c_acctbal") > 100)).select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'")
def scan_prune_range(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    return load(spark, sf, "orders").where((d >= F.lit("1997-01-01").cast("timestamp_ntz")) & (d < F.lit("1997-04-01").cast("timestamp_ntz"))).select("o_orderkey", "o_orderdate", "o_totalprice")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'failed' ELSE 'other' END AS status, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'UNKNOWN') AS priority FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority NOT IN ('5-LOW')")
def project_case_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("o_orderstatus")
    df = load(spark, sf, "orders").where((s != "P") & ~F.col("o_orderpriority").isin("5-LOW"))
    return df.select("o_orderkey", F.when(s == "O", "open").when(s == "F", "failed").otherwise("other").alias("status"), F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")), F.lit("UNKNOWN")).alias("priority"))


@query("SELECT c_custkey, nullif(trim(CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE ' ' || c_mktsegment END), '') AS segment FROM customer")
def project_blank_null(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment")))
    return load(spark, sf, "customer").select("c_custkey", present(raw).alias("segment"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN round(s_acctbal / (s_suppkey % 5), 4) END AS per_unit, s_acctbal / nullif(s_suppkey % 7, 0) AS unrounded, coalesce(CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END > 1000, FALSE) AS rich FROM supplier")
def guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    k, b = F.col("s_suppkey"), F.col("s_acctbal")
    return load(spark, sf, "supplier").select("s_suppkey", ratio(b, k % 5).alias("per_unit"), (b / F.nullif(k % 7, F.lit(0))).alias("unrounded"), F.coalesce(F.when(k % 3 > 0, b) > 1000, F.lit(False)).alias("rich"))


@query("SELECT count(*)::BIGINT AS n FROM region")
def scan_count(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "region").agg(F.count("*").alias("n"))


# aggregates

LINE = "lineitem"


@query(f"SELECT l_returnflag, l_linestatus, {sql_money('CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0 END')} AS discounted, avg(CASE WHEN l_discount > 0.05 THEN l_quantity END) AS mean_quantity, CAST(sum(CAST(l_quantity > 25 AS INT)) AS BIGINT) AS n_large FROM lineitem GROUP BY ALL")
def agg_conditional(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("l_discount") > 0.05
    return load(spark, sf, LINE).groupBy("l_returnflag", "l_linestatus").agg(money(F.when(low, F.col("l_extendedprice")).otherwise(0)).alias("discounted"), F.avg(F.when(low, F.col("l_quantity"))).alias("mean_quantity"), F.sum((F.col("l_quantity") > 25).cast("int")).alias("n_large"))


@query("SELECT l_returnflag, CAST(count(*) FILTER (WHERE l_tax > 0.04) AS BIGINT) AS n_taxed, CAST(count_if(l_discount = 0) AS BIGINT) AS n_full FROM lineitem GROUP BY 1")
def agg_filter_clause(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT l_returnflag, count(*) FILTER (WHERE l_tax > 0.04) AS n_taxed, count_if(l_discount = 0) AS n_full FROM {l} GROUP BY 1", l=load(spark, sf, LINE))


@query("SELECT date_trunc('month', ts)::DATE AS month, CAST(count(DISTINCT user_id) AS BIGINT) AS users, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds FROM events GROUP BY 1")
def agg_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy(F.to_date(F.date_trunc("month", "ts")).alias("month")).agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("kinds"))


@query("SELECT l_returnflag, quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1")
def agg_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return quantiles(load(spark, sf, LINE), ["l_returnflag"], F.col("l_quantity"), p50=50, p90=90)


@query("WITH d AS (SELECT l_suppkey, l_shipdate::DATE AS day, avg(l_quantity) AS mean, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_suppkey, round(sum(mean * n) / sum(n), 6) AS mean, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY l_suppkey")
def agg_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """A weighted mean over a finer grain: two levels of grouping."""
    d = load(spark, sf, LINE).groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(F.avg("l_quantity").alias("mean"), F.count("*").alias("n"))
    return d.groupBy("l_suppkey").agg(F.round(F.sum(F.col("mean") * F.col("n")) / F.sum("n"), 6).alias("mean"), F.sum("n").alias("n"))


@query("SELECT l_partkey, greatest(sum(l_quantity), avg(l_quantity) * 12) AS paid FROM lineitem GROUP BY l_partkey")
def agg_greatest(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, LINE).groupBy("l_partkey").agg(F.greatest(F.sum("l_quantity"), F.avg("l_quantity") * 12).alias("paid"))


@query("SELECT min(ts) AS first, max(ts) AS last FROM (SELECT o_orderdate AS ts FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events)")
def agg_bounds(spark: SparkSession, sf: str) -> DataFrame:
    times = [load(spark, sf, t).select(F.col(c).alias("ts")) for t, c in (("orders", "o_orderdate"), (LINE, "l_shipdate"), ("events", "ts"))]
    return times[0].unionByName(times[1]).unionByName(times[2]).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("SELECT o_custkey, list_sort(list_distinct(list(o_orderpriority))) AS priorities, len(list_distinct(list(o_orderstatus)))::INT AS n FROM orders GROUP BY 1")
def agg_collect_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("priorities"), F.size(F.collect_set("o_orderstatus")).alias("n"))


@query("SELECT event_type, CAST(max(epoch(TIMESTAMP '2024-12-31 00:00:00') - floor(epoch(ts))) AS BIGINT) AS latency_s FROM events GROUP BY 1")
def agg_latency(spark: SparkSession, sf: str) -> DataFrame:
    now = F.unix_timestamp(F.lit("2024-12-31 00:00:00").cast("timestamp"))
    return load(spark, sf, "events").groupBy("event_type").agg(F.max(now - F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("latency_s"))


@query("SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 2")
def having_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, LINE).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 2")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, LINE).dropDuplicates(["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM orders) AND o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'O')")
def scalar_subquery(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT o_orderkey, o_totalprice FROM {o} WHERE o_totalprice > (SELECT 1.5 * avg(o_totalprice) FROM {o}) AND o_orderdate = (SELECT max(o_orderdate) FROM {o} WHERE o_orderstatus = 'O')", o=load(spark, sf, "orders"))


# windows


@query("WITH m AS (SELECT DISTINCT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month FROM lineitem) SELECT *, lead(month) OVER (PARTITION BY l_suppkey ORDER BY month) AS until FROM m")
def win_lead_validity(spark: SparkSession, sf: str) -> DataFrame:
    m = load(spark, sf, LINE).select("l_suppkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).distinct()
    return m.withColumn("until", F.lead("month").over(Window.partitionBy("l_suppkey").orderBy("month")))


@query(f"WITH m AS (SELECT l_suppkey, date_trunc('month', l_shipdate)::DATE AS month, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY ALL) SELECT *, CAST(sum(q) OVER (PARTITION BY l_suppkey, year(month) ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ytd, month = max(month) OVER (PARTITION BY l_suppkey) AS is_latest FROM m")
def win_ytd_latest(spark: SparkSession, sf: str) -> DataFrame:
    m = load(spark, sf, LINE).groupBy("l_suppkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    year = Window.partitionBy("l_suppkey", F.year("month")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumns({"ytd": F.sum("q").over(year), "is_latest": F.col("month") == F.max("month").over(Window.partitionBy("l_suppkey"))})


@query("SELECT o_custkey, n, CAST(row_number() OVER (ORDER BY n DESC, o_custkey) AS BIGINT) AS place FROM (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1)")
def win_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    """A rank over all rows without a window in one task: rows are numbered within counts, which are few, and counts follow each other."""
    g = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    sizes = g.groupBy("n").agg(F.count("*").alias("many"))
    before = sizes.select("n", F.coalesce(F.sum("many").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("n").orderBy("o_custkey"))
    return g.withColumn("_in", inside).join(before, "n").select("o_custkey", "n", (F.col("before") + F.col("_in")).cast("long").alias("place"))


# joins


@query("SELECT o_orderkey, o_custkey, coalesce(c_mktsegment, 'UNKNOWN') AS segment, c_custkey IS NULL AS orphan FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 1000) ON o_custkey = c_custkey")
def join_left_orphans(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").where("c_acctbal >= 1000").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return enriched(load(spark, sf, "orders"), "o_custkey", c, "c_custkey", "orphan", segment=F.lit("UNKNOWN")).select("o_orderkey", "o_custkey", "segment", "orphan")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def join_semi_restrict(spark: SparkSession, sf: str) -> DataFrame:
    big = load(spark, sf, "orders").where("o_totalprice > 450000")
    return asked_for(load(spark, sf, "customer"), "c_custkey", big, "o_custkey").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_anti_urgent(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return load(spark, sf, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey")


@query(silver.with_ctes("countries", "fx") + " SELECT o_orderkey, currency, round(o_totalprice / per_eur, 2) AS eur FROM orders JOIN customer ON o_custkey = c_custkey JOIN countries ON c_nationkey = nation LEFT JOIN fx USING (currency) WHERE fx.day = o_orderdate::DATE")
def join_fx_lookup(spark: SparkSession, sf: str) -> DataFrame:
    home = load(spark, sf, "customer").join(countries(spark, sf), F.col("c_nationkey") == F.col("nation")).select(F.col("c_custkey").alias("o_custkey"), "currency")
    o = load(spark, sf, "orders").join(home, "o_custkey").withColumn("day", F.to_date("o_orderdate"))
    return to_eur(o, silver_fx_rates(spark, sf), "day", eur="o_totalprice").select("o_orderkey", "currency", "eur")


@query("SELECT n_name, p_type, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def join_star(spark: SparkSession, sf: str) -> DataFrame:
    """A fact with three dimensions, pre-aggregated by their keys so that few rows meet them."""
    f = load(spark, sf, LINE).groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("k"))
    s, n, p = load(spark, sf, "supplier"), load(spark, sf, "nation"), load(spark, sf, "part")
    df = f.join(s, f.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(p, f.l_partkey == p.p_partkey)
    return df.groupBy("n_name", "p_type").agg(F.sum("k").alias("n"))


@query("WITH l AS (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1) SELECT DISTINCT o_custkey, o_orderdate::DATE AS day, max(o_totalprice) OVER (PARTITION BY o_custkey) AS most FROM orders JOIN l USING (o_custkey, o_orderdate)")
def join_groupwise_latest(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    last = latest_by(o.select("o_custkey", "o_orderdate", "o_totalprice"), ["o_custkey"], F.col("o_orderdate"), F.col("o_totalprice"))
    return last.select("o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("most"))


@query("WITH p AS (SELECT l_partkey, sum(l_quantity) AS paid FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, paid FROM lineitem JOIN p USING (l_partkey) WHERE l_returnflag = 'R' AND l_quantity * 10 > paid")
def join_claims_premiums(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, LINE)
    paid = li.where("l_returnflag <> 'R'").groupBy("l_partkey").agg(F.sum("l_quantity").alias("paid"))
    return li.where("l_returnflag = 'R'").join(paid, "l_partkey").where("l_quantity * 10 > paid").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "paid")


@query("WITH h AS (SELECT user_id, list_sort(list_distinct(list(CAST(event_id % 25 AS BIGINT)))) AS seen FROM events GROUP BY 1) SELECT c_custkey, list_sort(list_distinct(coalesce(seen, []) || [CAST(c_nationkey AS BIGINT)])) AS usual, len(list_distinct(coalesce(seen, []) || [CAST(c_nationkey AS BIGINT)]))::INT AS n FROM customer LEFT JOIN h ON user_id = c_custkey")
def join_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Where a client lives and was seen: a left join and a union of arrays."""
    seen = load(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.collect_set(F.col("event_id") % 25).alias("seen"))
    home = F.array(F.col("c_nationkey").cast("long"))
    usual = F.array_union(F.coalesce("seen", F.array().cast("array<bigint>")), home)
    return load(spark, sf, "customer").join(seen, "c_custkey", "left").select("c_custkey", F.sort_array(usual).alias("usual"), F.size(usual).alias("n"))


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 480000 GROUP BY 1), b AS (SELECT user_id AS k, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, CAST(coalesce(a.n, 0) AS BIGINT) AS n_orders, CAST(coalesce(b.n, 0) AS BIGINT) AS n_errors FROM a FULL OUTER JOIN b ON a.k = b.k")
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    a = load(spark, sf, "orders").where("o_totalprice > 480000").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    b = load(spark, sf, "events").where("event_type = 'error'").groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n_errors"))
    return a.join(b, "k", "full").fillna(0, ["n_orders", "n_errors"])


# sets, sorts


@query("SELECT o_orderkey AS id, o_totalprice AS amount, o_orderpriority AS priority, NULL::VARCHAR AS operator FROM orders UNION ALL BY NAME SELECT event_id AS id, value AS amount, event_type AS operator FROM events")
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"))
    e = load(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("operator"), F.col("value").alias("amount"))
    return o.unionByName(e, allowMissingColumns=True)


@query("SELECT c_mktsegment, c_custkey, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey LIMIT 100")
def sort_limit(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal").orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey").limit(100)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def top_5(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


# scalar functions


@query("SELECT n_nationkey, concat_ws('-', n_name, lpad(CAST(n_regionkey AS VARCHAR), 2, '0')) AS label, starts_with(n_name, 'NATION_1') AS starts, substr(n_name, 1, 4) AS head, right(n_name, 4) AS tail, regexp_replace(n_name || ' x', '\\s', '', 'g') AS tight FROM nation")
def str_functions(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_name")
    return load(spark, sf, "nation").select("n_nationkey", F.concat_ws("-", n, F.lpad(F.col("n_regionkey").cast("string"), 2, "0")).alias("label"), n.startswith("NATION_1").alias("starts"), F.substring(n, 1, 4).alias("head"), F.substring(n, -4, 4).alias("tail"), F.regexp_replace(F.concat(n, F.lit(" x")), r"\s", "").alias("tight"))


@query("SELECT event_id, date_trunc('week', ts)::DATE AS week, date_trunc('month', ts)::DATE AS month, CAST(hour(ts) AS INT) AS hour, CAST(year(ts) AS INT) AS year, CAST(dayofyear(ts) AS INT) AS day_of_year, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week, (ts::DATE - INTERVAL 30 DAY)::DATE AS month_ago, (ts::DATE + INTERVAL 7 DAY)::DATE AS next_week, (date_trunc('month', ts) - INTERVAL 12 MONTH)::DATE AS year_ago FROM events")
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    d, month = F.to_date("ts"), F.trunc(F.to_date("ts"), "month")
    return load(spark, sf, "events").select("event_id", F.to_date(F.date_trunc("week", "ts")).alias("week"), month.alias("month"), F.hour("ts").alias("hour"), F.year("ts").alias("year"), F.dayofyear("ts").alias("day_of_year"), F.dayofweek("ts").alias("day_of_week"), F.date_sub(d, 30).alias("month_ago"), F.date_add(d, 7).alias("next_week"), F.add_months(month, -12).alias("year_ago"))


@query("SELECT o_orderkey, list_filter([o_custkey % 3, o_custkey % 5, NULL], lambda x: x > 0) AS positive, list_sort(list_distinct([o_custkey % 3, o_custkey % 5] || [o_custkey % 7])) AS u, list_contains([o_custkey % 3, o_custkey % 5], 2) AS has_two, array_to_string([o_orderstatus, o_orderpriority], ',') AS joined, [o_custkey % 3, o_custkey % 5][1] AS first, len(list_distinct([o_custkey % 3, o_custkey % 5]))::INT AS n FROM orders")
def array_functions(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_custkey")
    two = F.array(k % 3, k % 5)
    return load(spark, sf, "orders").select(
        "o_orderkey", F.filter(F.array_compact(F.array(k % 3, k % 5, F.lit(None).cast("long"))), lambda x: x > 0).alias("positive"), F.sort_array(F.array_union(two, F.array(k % 7))).alias("u"), F.array_contains(two, 2).alias("has_two"),
        F.array_join(F.array("o_orderstatus", "o_orderpriority"), ",").alias("joined"), F.get(two, 0).alias("first"), F.size(F.array_distinct(F.flatten(F.array(two, two)))).alias("n"),
    )


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'BOG' WHEN 1 THEN 'BCRG' END AS regulator, coalesce(CASE n_regionkey WHEN 0 THEN 'BOG' WHEN 1 THEN 'BCRG' END, 'BCEAO') AS or_default FROM nation")
def map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    known = F.create_map(F.lit(0), F.lit("BOG"), F.lit(1), F.lit("BCRG"))[F.col("n_regionkey")]
    return load(spark, sf, "nation").select("n_nationkey", known.alias("regulator"), F.coalesce(known, F.lit("BCEAO")).alias("or_default"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"user\":' || user_id || ',\"type\":\"' || event_type || '\"}' AS packed, event_type AS unpacked FROM events")
def json_functions(spark: SparkSession, sf: str) -> DataFrame:
    packed = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")))
    return load(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), packed.alias("packed"), F.from_json(packed, "user bigint, type string")["type"].alias("unpacked"))


@query("SELECT p_partkey, unnest(['size', 'price']) AS measure, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS value FROM part")
def unpivot_stack(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", F.stack(F.lit(2), F.lit("size"), F.col("p_size").cast("double"), F.lit("price"), F.col("p_retailprice")).alias("measure", "value"))


@query("SELECT p_partkey, try_cast(CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'N/A' END AS INT) AS size, try_cast(p_name AS DATE) AS bad_day, DATE '1998-02-03' AS day, CAST(p_retailprice AS VARCHAR) IS NOT NULL AS shown FROM part")
def cast_functions(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise("N/A")
    return load(spark, sf, "part").select("p_partkey", text.try_cast("int").alias("size"), F.to_date(F.try_to_timestamp("p_name", F.lit("yyyy-MM-dd"))).alias("bad_day"), F.to_date(F.lit("03/02/1998"), "dd/MM/yyyy").alias("day"), F.col("p_retailprice").cast("string").isNotNull().alias("shown"))


@query("SELECT p_partkey, round(ln(1 + p_retailprice), 9) AS l, round(sin(p_size), 9) AS s, abs(p_size - 25) AS a, -p_size AS minus, greatest(p_size, 25) AS g, least(p_size, 25) AS m FROM part")
def math_functions(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_size")
    return load(spark, sf, "part").select("p_partkey", F.round(F.log1p("p_retailprice"), 9).alias("l"), F.round(F.sin(n), 9).alias("s"), F.abs(n - 25).alias("a"), (-n).alias("minus"), F.greatest(n, F.lit(25)).alias("g"), F.least(n, F.lit(25)).alias("m"))


# contracts and policies


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with faults planted by key."""
    k = F.col("o_orderkey")
    o = load(spark, sf, "orders").join(load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey")
    o = o.join(countries(spark, sf), F.col("c_nationkey") == F.col("nation"))
    return o.select(
        k.alias("key"), F.when(k % 11 != 0, k).alias("id"), "country", F.when(k % 13 == 0, "EUR").otherwise(F.col("currency")).alias("currency"), F.when(k % 17 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(k % 19 == 0, "?").otherwise(F.col("o_orderstatus")).alias("status"), F.when(k % 23 == 0, "SHOP").otherwise("BANK").alias("entity"), F.when(k % 29 == 0, "torn line").alias("torn"), F.when(k % 31 == 0, "  ").otherwise(F.col("c_name")).alias("name"), (k % 5).alias("file"), F.col("o_orderdate").alias("ts"),
    )


DIRTY = "d0 AS (SELECT o_orderkey AS k, n_name AS country, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 13 = 0 THEN 'EUR' WHEN n_regionkey = 0 THEN 'GHS' ELSE 'XOF' END AS currency, CASE WHEN o_orderkey % 17 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount, CASE WHEN o_orderkey % 19 = 0 THEN '?' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 23 = 0 THEN 'SHOP' ELSE 'BANK' END AS entity, CASE WHEN o_orderkey % 29 = 0 THEN 'torn line' END AS torn, o_orderkey % 5 AS file, n_regionkey, CASE WHEN o_orderkey % 31 = 0 THEN '  ' ELSE c_name END AS name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), dirty AS (SELECT *, concat_ws(',', CASE WHEN torn IS NOT NULL THEN 'MALFORMED_ROW' END, CASE WHEN id IS NULL THEN 'MISSING_ID' END, CASE WHEN trim(name) = '' THEN 'MISSING_NAME' END, CASE WHEN country NOT IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5', 'NATION_6', 'NATION_7', 'NATION_8', 'NATION_9') THEN 'INVALID_COUNTRY_CODE' END, CASE WHEN entity NOT IN ('BANK', 'INSURANCE') THEN 'INVALID_ENTITY_TYPE' END, CASE WHEN status NOT IN ('O', 'F', 'P') THEN 'INVALID_STATUS' END, CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN country IN ('NATION_0', 'NATION_1') AND currency <> CASE WHEN country = 'NATION_0' THEN 'GHS' ELSE 'XOF' END THEN 'CURRENCY_COUNTRY_MISMATCH' END) AS reasons FROM d0)"
CONTRACT = Contract(
    [
        Rule("parsed", "torn"), Rule("required", "id"), Rule("required", "name"), Rule("one_of", "country", [f"NATION_{k}" for k in range(10)], "INVALID_COUNTRY_CODE"), Rule("one_of", "entity", ("BANK", "INSURANCE"), "INVALID_ENTITY_TYPE"),
        Rule("one_of", "status", ("O", "F", "P")), Rule("at_least", "amount", 0), Rule("goes_with", "currency", ("country", {"NATION_0": "GHS", "NATION_1": "XOF"})),
    ],
    personal=["name"],
)


@query(f"WITH {DIRTY} SELECT country, CAST(count(*) AS BIGINT) AS n FROM dirty WHERE reasons = '' GROUP BY 1")
def contract_valid(spark: SparkSession, sf: str) -> DataFrame:
    return split(dirty(spark, sf), CONTRACT)[0].groupBy("country").agg(F.count("*").alias("n"))


@query(f"WITH {DIRTY} SELECT 'bank' AS dataset, 'file-' || file AS source_file, country, CAST(id AS VARCHAR) AS record_id, reasons, CASE WHEN torn IS NULL THEN status END AS raw_status, CASE WHEN torn IS NULL THEN currency END AS raw_currency, NULL::VARCHAR AS raw_name, torn AS raw_text FROM dirty WHERE reasons <> ''")
def contract_rejects(spark: SparkSession, sf: str) -> DataFrame:
    bad = split(dirty(spark, sf), CONTRACT)[1]
    out = reject_records(bad, CONTRACT, "bank", "id", "country", F.concat(F.lit("file-"), F.col("file").cast("string")))
    field = lambda c: F.get_json_object("raw_record", f"$.{c}")
    return out.withColumns({"raw_status": field("status"), "raw_currency": field("currency"), "raw_name": field("name"), "raw_text": F.when(~F.col("raw_record").startswith("{"), F.col("raw_record"))}).drop("raw_record")


@query(f"WITH {DIRTY} SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM dirty WHERE reasons <> '') GROUP BY 1")
def contract_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    bad = split(dirty(spark, sf), CONTRACT)[1]
    return bad.select(F.explode(F.split("reasons", ",")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH {DIRTY} SELECT file, CAST(count(*) AS BIGINT) AS rows_read, CAST(count_if(reasons = '') AS BIGINT) AS rows_valid, CAST(count_if(reasons <> '') AS BIGINT) AS rows_rejected FROM dirty GROUP BY 1")
def contract_file_stats(spark: SparkSession, sf: str) -> DataFrame:
    return file_stats(*split(dirty(spark, sf), CONTRACT), "file")


@query(f"WITH {DIRTY}, b AS (SELECT *, (k % 3)::INT AS batch_id, len(string_split(reasons, ',')) AS n FROM dirty) SELECT 'bank' AS dataset, batch_id, CAST(count(*) AS BIGINT) AS rows_read, CAST(count_if(reasons = '') AS BIGINT) AS rows_valid, CAST(count_if(reasons <> '') AS BIGINT) AS rows_rejected, CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(sum(CASE WHEN reasons = '' THEN 0 ELSE n END) AS BIGINT) AS n_reasons, CAST(count_if(reasons = '') AS BIGINT) AS n_stamped FROM b GROUP BY batch_id")
def audit_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """The audit table of three loads, of which the second comes twice, beside the stamped rows that they left."""
    into, raw = Ingestion(spark, new_place(spark, "ingested"), "bank", CONTRACT), dirty(spark, sf).withColumn("k", F.col("key"))
    for batch in (0, 1, 2, 1):
        into.load(raw.where(F.col("k") % 3 == batch).drop("k", "key"), batch, "file")
    stamped = into.valid().where("_ingested_at IS NOT NULL").groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("n_stamped"))
    return into.log().drop("ingested_at").join(stamped, "batch_id")


@query("SELECT 'orders' AS dataset, n_name AS country, CAST(count(*) AS BIGINT) AS n_rows, '{\"failed\":' || count_if(o_orderstatus = 'F') || ',\"large\":' || count_if(o_totalprice > 400000) || '}' AS flags FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def contract_quality(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(countries(spark, sf), F.col("c_nationkey") == F.col("nation"))
    df = o.select("country", (F.col("o_orderstatus") == "F").alias("failed"), (F.col("o_totalprice") > 400_000).alias("large"))
    return quality_metrics(df, "orders", "country", ["failed", "large"])


@query("SELECT c_custkey, substr(c_name, 1, 4) || '****' || right(c_name, 4) AS c_name_masked, sha256('salt' || c_name) AS c_name_hash, c_nationkey FROM customer")
def contract_personal(spark: SparkSession, sf: str) -> DataFrame:
    return without_personal(load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), ["c_name"], "salt")


@query("SELECT c_custkey, substr(c_name, 1, 4) || '****' || right(c_name, 4) AS c_name, c_nationkey FROM customer WHERE c_nationkey IN (3, 4) OR c_mktsegment = 'BUILDING'")
def policy_view(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of some countries or of one segment, without balances, with masked names."""
    rows = [F.col("c_nationkey").isin(3, 4), F.col("c_mktsegment") == "BUILDING"]
    return Policy(rows, denied=["c_acctbal"], hidden=["c_name"]).view(load(spark, sf, "customer")).drop("c_mktsegment")


@query("SELECT * FROM customer WHERE 1 = 0")
def policy_denied(spark: SparkSession, sf: str) -> DataFrame:
    return Policy().view(load(spark, sf, "customer"))


@query("SELECT c_custkey, CASE WHEN length(v) >= 12 THEN left(v, 4) || '****' || right(v, 4) ELSE '****' END AS shown, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS denominator FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS v FROM customer)")
def mask_short_values(spark: SparkSession, sf: str) -> DataFrame:
    """A value of fewer than twelve characters shows nothing of itself."""
    v = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment"))
    return load(spark, sf, "customer").select("c_custkey", masked(v).alias("shown"), positive(F.col("c_acctbal")).alias("denominator"))
