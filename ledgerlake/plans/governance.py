"""Tags and policies that follow them, lineage as plans tell it, exact counts that roll up, pruning, exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import half_up
from ledgerlake.operators import store, tags
from ledgerlake.operators.distincts import bitmaps, rolled_up
from ledgerlake.operators.lineage import sources
from ledgerlake.operators.sketches import History, limits
from ledgerlake.plans import gold, reports, silver
from ledgerlake.sources.scratch import new_place
from ledgerlake.sources.tables import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


#: Tags by table and column: personal values, what a regulator asks for, and terms of the glossary.
TAGS = {
    "customer": {"c_name": ["personal.name"], "c_acctbal": ["personal.balance", "regulatory.prudential"], "c_custkey": ["term.client"], "c_mktsegment": ["term.segment"]},
    "supplier": {"s_name": ["personal.name"], "s_acctbal": ["regulatory.prudential"], "s_suppkey": ["term.branch"]},
    "orders": {"o_totalprice": ["regulatory.aml"], "o_custkey": ["term.client"]},
    "events": {"user_id": ["term.client"], "value": ["regulatory.aml"]},
}


def with_tags(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tags.tagged(load(spark, sf, name), TAGS.get(name, {}))


@query("SELECT c_custkey AS client, substr(c_name, 1, 4) || '****' || right(c_name, 4) AS holder, n_name AS country, CAST(count(o_orderkey) AS BIGINT) AS n_orders FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey WHERE n_regionkey = 1 GROUP BY ALL")
def policy_from_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Clients of a region with their orders: columns are renamed, written, read again and joined before the policy finds them by their tags. Balances are denied, names masked."""
    c = with_tags(spark, sf, "customer").withColumnsRenamed({"c_name": "holder", "c_acctbal": "held"}).select(F.col("c_custkey").alias("client"), "holder", "held", "c_nationkey")
    c.write.parquet(place := new_place(spark, "tagged"))
    c = spark.read.parquet(place).join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    seen = tags.policy(c, [F.col("n_regionkey") == 1], denied=["regulatory.prudential"], hidden=["personal"]).view(c)
    n = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("client")).agg(F.count("*").alias("n_orders"))
    return seen.join(n, "client", "left").select(*[c for c in seen.columns if c in ("client", "holder", "held")], F.col("n_name").alias("country"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS source, '{c}' AS name, '{tag}' AS tag, CAST(count({c}) AS BIGINT) AS n_values, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM {t}" for t, columns in TAGS.items() for c, of in columns.items() for tag in of))
def tag_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """How many values stand under each tag: one pass over a table, by the tags that its columns carry."""
    parts = []
    for name in TAGS:
        df = with_tags(spark, sf, name)
        of = tags.tags_of(df)
        one = df.agg(*[x for c in of for x in (F.count(c).alias(f"n_{c}"), F.count_distinct(c).alias(f"d_{c}"))])
        told = F.array(*[F.struct(F.lit(name).alias("source"), F.lit(c).alias("name"), F.lit(t).alias("tag"), F.col(f"n_{c}").alias("n_values"), F.col(f"d_{c}").alias("n_distinct")) for c, ts in of.items() for t in ts])
        parts.append(one.select(F.inline(told)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Tables whose plans are asked for their sources.
MADE = {f.__name__: f for part in (silver, gold, reports) for f in part.QUERIES.values() if f.__name__.startswith(("silver_", "gold_", "report_"))}

# What the plans are to say, as fixed values to compare with: sources of each table.
EXPECTED = """
silver_fx_rates: events orders
silver_clients: customer nation region
silver_branches: nation region supplier
silver_products: part
silver_accounts: customer events nation orders region
silver_bank: customer events nation orders region supplier
silver_insurance: lineitem nation part region supplier
silver_mobile: customer events nation orders region
silver_loans: events lineitem nation orders region supplier
gold_daily_volume: customer events lineitem nation orders part region supplier
gold_npl: events lineitem nation orders region supplier
gold_arpu: customer events lineitem nation orders region supplier
gold_loss_ratio: lineitem nation part region supplier
gold_claim_time: lineitem nation part region supplier
gold_mobile_flow: customer events nation orders region
gold_corridors: customer events nation orders region
report_banking: events lineitem nation orders region supplier
report_insurance: lineitem nation part region supplier
report_breaches: events lineitem nation orders part region supplier
"""


@query("WITH e AS (SELECT split_part(x, ': ', 1) AS target, unnest(string_split(split_part(x, ': ', 2), ' ')) AS source FROM (SELECT unnest(string_split('" + EXPECTED.strip() + "', chr(10))) AS x)), n AS (" + " UNION ALL ".join(f"SELECT '{t}' AS source, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")) + ") SELECT target, source, split_part(target, '_', 1) AS layer, n_rows FROM e JOIN n USING (source)")
def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Which base tables each cleansed table, metric and report reads, as its plan says, with the rows there."""
    edges = [(target, source, target.split("_")[0]) for target, f in MADE.items() for source in sources(f(spark, sf))]
    counts = None
    for name in sorted({s for _, s, _ in edges}):
        one = load(spark, sf, name).agg(F.lit(name).alias("source"), F.count("*").alias("n_rows")).select("source", "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return spark.createDataFrame(edges, "target string, source string, layer string").join(counts, "source")


SEEN = f"seen AS (SELECT account AS client, day, country FROM ({silver.ORACLES['silver_bank']}) UNION ALL SELECT sender, day, sender_country FROM ({silver.ORACLES['silver_mobile']}) WHERE sender_country IS NOT NULL)"


@query(f"WITH {SEEN} SELECT 'month' AS grain, date_trunc('month', day)::DATE AS month, country, CAST(count(DISTINCT client) AS BIGINT) AS clients FROM seen GROUP BY ALL UNION ALL SELECT 'year', date_trunc('year', day)::DATE, NULL, count(DISTINCT client) FROM seen GROUP BY ALL UNION ALL SELECT 'all', NULL, country, count(DISTINCT client) FROM seen GROUP BY ALL")
def bi_clients_rolled_up(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct active clients by month and country, by year, and by country: three grains of one table of daily bitmaps; facts are read once."""
    b = silver.silver_bank(spark, sf).select(F.col("account").alias("client"), "day", "country")
    m = silver.silver_mobile(spark, sf).where("sender_country IS NOT NULL").select(F.col("sender").alias("client"), "day", F.col("sender_country").alias("country"))
    bitmaps(b.unionByName(m), ["day", "country"], "client").write.parquet(place := new_place(spark, "active-clients"))
    daily = spark.read.parquet(place)
    at = lambda unit: F.to_date(F.date_trunc(unit, "day")).alias("month")
    grain = lambda name, df, *keys: rolled_up(df, keys, "clients").select(F.lit(name).alias("grain"), *[F.col(k) if k in keys else F.lit(None).cast(t).alias(k) for k, t in (("month", "date"), ("country", "string"))], "clients")
    return grain("month", daily.withColumn("month", at("month")), "month", "country").unionByName(grain("year", daily.withColumn("month", at("year")), "month")).unionByName(grain("all", daily, "country"))


PAST = "1999-01-01"


@query(f"WITH b AS (SELECT country, ln(1 + amount_eur) AS v FROM ({silver.ORACLES['silver_bank']}) WHERE month < DATE '{PAST}') SELECT country, CAST(count(v) AS BIGINT) AS n, floor((quantile_disc(v, 0.75) + 1.5 * (quantile_disc(v, 0.75) - quantile_disc(v, 0.25))) * 1000000 + 0.5) / 1000000 AS fence FROM b GROUP BY country")
def limits_of_history(spark: SparkSession, sf: str) -> DataFrame:
    """Limits of outliers from what came before a month: months are sketched in two loads, the second of which brings some again, and merged without the facts."""
    b = silver.silver_bank(spark, sf).select("country", "month", "amount_eur")
    h = History(spark, new_place(spark, "sketches"), "country", "month", "amount_eur")
    h.add(b.where("month < '1998-01-01'"))
    h.add(b.where("month >= '1997-06-01'"))
    past = h.upto(F.col("month") < PAST)
    return past.select("country", "n").join(limits(past, "country"), "country").withColumn("fence", half_up(F.col("fence"), 6))


@query(f"WITH b AS ({silver.ORACLES['silver_bank']}) SELECT country, currency, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(amount_eur * 100) AS BIGINT)) AS BIGINT) AS cents FROM b WHERE country IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2) GROUP BY ALL")
def scan_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """A cleansed table partitioned by country, read through the countries of one region: partitions of others aren't opened."""
    store.append(silver.silver_bank(spark, sf).select("id", "amount_eur", "currency", "country"), place := new_place(spark, "by-country"), ["country"])
    region = silver.countries(spark, sf).join(load(spark, sf, "region").where("r_regionkey = 2").select(F.col("r_name").alias("region")), "region").select("country")
    rows = spark.read.parquet(place).join(region, "country")
    return rows.groupBy("country", "currency").agg(F.count("*").alias("n"), F.sum(F.round(F.col("amount_eur") * 100).cast("long")).alias("cents"))


@query(f"SELECT regulator, CAST(count(*) AS BIGINT) AS n, CAST(count_if(breach) AS BIGINT) AS breaches, CAST(1 AS BIGINT) AS files FROM ({reports.ORACLES['report_insurance']}) GROUP BY regulator")
def export_by_regulator(spark: SparkSession, sf: str) -> DataFrame:
    """The insurance report as one CSV file for each regulator, read back."""
    store.export_csv(reports.report_insurance(spark, sf), place := new_place(spark, "export"), "regulator")
    rows = spark.read.option("header", True).option("inferSchema", True).csv(place).withColumn("file", F.col("_metadata.file_path"))
    return rows.groupBy("regulator").agg(F.count("*").alias("n"), F.count_if("breach").alias("breaches"), F.count_distinct("file").alias("files"))


@query(f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(greatest(count(*) - 5, 0) AS BIGINT) AS left_out, CAST(least(count(*), 5) AS BIGINT) AS told FROM ({reports.ORACLES['report_insurance']})")
def export_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The insurance report's summary as JSON: all rows are counted, the first are told."""
    told = json.loads(store.summary_json(reports.report_insurance(spark, sf).orderBy("regulator", "country", "product", "branch"), most=5))
    return spark.createDataFrame([(told["count"], told["left_out"], len(told["rows"]))], "n long, left_out long, told long")


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1")
def store_reset(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is dropped is gone, and made anew by the next load alone."""
    path, o = new_place(spark, "reset"), load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    store.insert_new(o, path, ["o_orderkey"])
    store.drop(spark, path)
    store.insert_new(o.where("o_orderkey % 2 = 0"), path, ["o_orderkey"])
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))
