"""Cleansed tables over the base tables, each with the SQL that gives the same rows.

The base tables lack some of the domain's columns. What stands for them: currency by region (GHS for region 0,
else XOF); every fifth customer has a second, newer version, every tenth of them without a segment; customers in
debt have no open account, so that their operations are orphans; a product is a type of part sold in a country.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import working_days
from ledgerlake.operators.cleanse import enriched, flagged, latest_by
from ledgerlake.sources.tables import load

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# The peg of the franc, and the course of the cedi over the year.
XOF_PER_EUR, GHS_PER_EUR, GHS_SWING = 655.957, 14.6, 0.03
DEFAULT_RATE, UNKNOWN = 0.12, "UNKNOWN"

CTE = {
    "countries": "SELECT n_nationkey AS nation, n_name AS country, r_name AS region, CASE WHEN n_regionkey = 0 THEN 'GHS' ELSE 'XOF' END AS currency FROM nation JOIN region ON n_regionkey = r_regionkey",
    "fx": f"SELECT d::DATE AS day, currency, CASE currency WHEN 'XOF' THEN {XOF_PER_EUR}::DOUBLE ELSE round({GHS_PER_EUR}::DOUBLE * (1 + {GHS_SWING}::DOUBLE * sin(2 * pi() * dayofyear(d) / 365)), 6) END AS per_eur FROM (SELECT unnest(generate_series((SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events))::DATE), (SELECT greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events))::DATE), INTERVAL 1 DAY)) AS d), (SELECT unnest(['XOF', 'GHS']) AS currency)",
    "clients": "SELECT client, coalesce(segment, 'UNKNOWN') AS segment, country, region, currency, balance, version FROM (SELECT c_custkey AS client, CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS segment, c_nationkey, c_acctbal AS balance, CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS version FROM customer) JOIN countries ON c_nationkey = nation",
    "accounts": "SELECT client AS account, segment, country, currency, balance, round(balance / per_eur, 2) AS balance_eur FROM clients JOIN (SELECT currency, per_eur FROM fx WHERE day = (SELECT max(day) FROM fx)) USING (currency) WHERE balance >= 0",
    "bank": "SELECT o_orderkey AS id, o_orderdate AS ts, o_orderdate::DATE AS day, date_trunc('month', o_orderdate)::DATE AS month, o_custkey AS account, coalesce(a.segment, 'UNKNOWN') AS segment, k.country, k.currency, o_orderpriority AS type, o_orderstatus AS status, o_totalprice AS amount, round(o_totalprice / per_eur, 2) AS amount_eur, floor(o_totalprice * 0.1 + 0.5) / 100 AS fee, round(floor(o_totalprice * 0.1 + 0.5) / 100 / per_eur, 2) AS fee_eur, a.account IS NULL AS orphan, o_custkey // 12 AS branch, s_suppkey IS NULL AS orphan_branch FROM orders JOIN customer ON o_custkey = c_custkey JOIN countries k ON c_nationkey = nation LEFT JOIN accounts a ON a.account = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey // 12 LEFT JOIN fx ON fx.day = o_orderdate::DATE AND fx.currency = k.currency",
    "lines": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_returnflag DESC, l_linestatus DESC, l_tax DESC, l_discount DESC) AS n FROM lineitem) WHERE n = 1",
}


def with_ctes(*names: str) -> str:
    """WITH clause of these and of what they stand on."""
    needs: dict[str, list[str]] = {"clients": ["countries"], "accounts": ["fx", "countries", "clients"], "bank": ["countries", "fx", "clients", "accounts"]}
    order = list(dict.fromkeys(x for n in names for x in (*needs.get(n, ()), n)))
    return "WITH " + ", ".join(f"{n} AS ({CTE[n]})" for n in order)


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


def cents(c: Column) -> Column:
    """c rounded half up to cents by plain arithmetic, which every engine does alike."""
    return F.floor(c * 100 + 0.5) / 100


def countries(spark: SparkSession, sf: str) -> DataFrame:
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    ghana = F.when(F.col("n_regionkey") == 0, "GHS").otherwise("XOF")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("country"), F.col("r_name").alias("region"), ghana.alias("currency"))


@query(with_ctes("fx") + " SELECT * FROM fx")
def silver_fx_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Units of each currency for a euro, by day of the span of orders and events."""
    ends = lambda name, ts: load(spark, sf, name).agg(F.min(ts).cast("date").alias("a"), F.max(ts).cast("date").alias("b"))
    span = ends("orders", "o_orderdate").unionByName(ends("events", "ts")).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    cedi = F.round(F.lit(GHS_PER_EUR) * (1 + F.lit(GHS_SWING) * F.sin(2 * F.pi() * F.dayofyear("day") / 365)), 6)
    return days.select("day", F.lit(XOF_PER_EUR).alias("XOF"), cedi.alias("GHS")).unpivot("day", ["XOF", "GHS"], "currency", "per_eur")


def to_eur(df: DataFrame, rates: DataFrame, day: str, **amounts: str) -> DataFrame:
    """df with each amount (new name = column) in euros at the rate of its day; null where there is none. Rates, two a day, are sent to all tasks."""
    fx = rates.select(F.col("day").alias("_day"), F.col("currency").alias("_currency"), "per_eur")
    df = df.join(F.broadcast(fx), (F.col(day) == F.col("_day")) & (F.col("currency") == F.col("_currency")), "left")
    return df.withColumns({new: F.round(F.col(old) / F.col("per_eur"), 2) for new, old in amounts.items()}).drop("_day", "_currency", "per_eur")


@query(with_ctes("clients") + " SELECT * FROM clients")
def silver_clients(spark: SparkSession, sf: str) -> DataFrame:
    """The latest version of each client, with defaults."""
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("client"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    newer = c.where("client % 5 = 0").withColumns({"segment": F.when(F.col("client") % 10 != 0, F.col("segment")), "version": F.lit(2)})
    last = latest_by(c.withColumn("version", F.lit(1)).unionByName(newer), ["client"], F.col("version"))
    return last.join(countries(spark, sf), "nation").select("client", F.coalesce("segment", F.lit(UNKNOWN)).alias("segment"), "country", "region", "currency", "balance", "version")


@query(with_ctes("countries") + " SELECT s_suppkey AS branch, s_name AS name, country, region, coalesce(s_acctbal > 1000, FALSE) AS active FROM supplier JOIN countries ON s_nationkey = nation")
def silver_branches(spark: SparkSession, sf: str) -> DataFrame:
    s = load(spark, sf, "supplier").join(countries(spark, sf), F.col("s_nationkey") == F.col("nation"))
    return s.select(F.col("s_suppkey").alias("branch"), F.col("s_name").alias("name"), "country", "region", F.coalesce(F.col("s_acctbal") > 1000, F.lit(False)).alias("active"))


@query("SELECT p_partkey AS product, coalesce(nullif(trim(p_brand), ''), 'UNKNOWN') AS name, coalesce(CASE WHEN p_size > 10 THEN p_size / 1000.0::DOUBLE END, 0.0) AS rate FROM part")
def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    rate = F.when(F.col("p_size") > 10, F.col("p_size") / 1000.0)
    return load(spark, sf, "part").select(F.col("p_partkey").alias("product"), F.coalesce(F.nullif(F.trim("p_brand"), F.lit("")), F.lit(UNKNOWN)).alias("name"), F.coalesce(rate, F.lit(0.0)).alias("rate"))


@query(with_ctes("accounts") + " SELECT * FROM accounts")
def silver_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Open accounts, with balances in euros at the last day's rate."""
    fx = silver_fx_rates(spark, sf)
    last = fx.groupBy("currency").agg(F.max_by("per_eur", "day").alias("per_eur"))
    c = silver_clients(spark, sf).where("balance >= 0").join(last, "currency")
    return c.select(F.col("client").alias("account"), "segment", "country", "currency", "balance", F.round(F.col("balance") / F.col("per_eur"), 2).alias("balance_eur"))


FENCED = "fences AS (SELECT {2} AS fc, quantile_disc(ln(1 + {1}), 0.75) + 1.5 * (quantile_disc(ln(1 + {1}), 0.75) - quantile_disc(ln(1 + {1}), 0.25)) AS fence FROM {0} GROUP BY 1)"


@query(with_ctes("bank") + ", " + FENCED.format("bank", "amount_eur", "country") + " SELECT bank.*, coalesce(ln(1 + amount_eur) > fence, FALSE) AS outlier FROM bank LEFT JOIN fences ON country = fc")
def silver_bank(spark: SparkSession, sf: str, mark: bool = True) -> DataFrame:
    """Bank operations: the latest of each id, enriched by home, account and branch, in euros, orphans and outliers marked (without `mark` outliers aren't)."""
    o = load(spark, sf, "orders")
    o = latest_by(o.unionByName(o.where("o_orderkey % 7 = 0")), ["o_orderkey"], F.col("o_orderdate"), F.col("o_totalprice"))
    o = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"), F.col("o_custkey").alias("account"), F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    out = built_bank(o, *bank_dimensions(spark, sf))
    return flagged(out, "country", "amount_eur") if mark else out


def bank_dimensions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(homes of clients, accounts, branches, rates)"""
    home = load(spark, sf, "customer").select(F.col("c_custkey").alias("client"), F.col("c_nationkey").alias("nation")).join(countries(spark, sf), "nation")
    return home.select("client", "country", "currency"), silver_accounts(spark, sf).select("account", "segment"), silver_branches(spark, sf).select("branch"), silver_fx_rates(spark, sf)


def built_bank(ops: DataFrame, home: DataFrame, accounts: DataFrame, branches: DataFrame, fx: DataFrame, cut: bool = False) -> DataFrame:
    """Cleansed operations from (id, ts, account, type, status, amount), in a batch or within a micro-batch, which cuts large dimensions to its keys."""
    ops = ops.withColumn("branch", F.floor(F.col("account") / 12))
    ops = enriched(ops, "account", home, "client", cut=cut, country=None, currency=None)
    ops = enriched(ops, "account", accounts.withColumnRenamed("account", "_account"), "_account", "orphan", cut=cut, segment=F.lit(UNKNOWN))
    ops = enriched(ops, "branch", branches.withColumnRenamed("branch", "_branch"), "_branch", "orphan_branch")
    fee, day = (F.floor(F.col("amount") * 0.1 + 0.5) / 100).alias("fee"), F.to_date("ts")
    ops = ops.select("id", "ts", day.alias("day"), F.trunc(day, "month").alias("month"), "account", "segment", "country", "currency", "type", "status", "amount", fee, "orphan", "branch", "orphan_branch")
    return to_eur(ops, fx, "day", amount_eur="amount", fee_eur="fee")


INSURANCE = """ins AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_shipdate AS ts, c.country, coalesce(p_type, 'UNKNOWN') AS line, CASE WHEN p_type LIKE 'S%' THEN 'IARD' ELSE 'VIE' END AS branch, p.sold, l_returnflag <> 'R' AS premium, l_returnflag = 'R' AS claim, l_returnflag = 'R' AND l_linestatus = 'F' AS claim_paid, CAST(floor(l_quantity) AS INT) AS days, l_extendedprice AS amount
FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN countries c ON s_nationkey = nation LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN (SELECT country, p_type, count(*) AS sold FROM lines JOIN supplier ON l_suppkey = s_suppkey JOIN countries ON s_nationkey = nation JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO' GROUP BY ALL) p USING (country, p_type))"""


@query(with_ctes("countries", "lines") + f", {INSURANCE}, " + FENCED.format("ins", "amount", "country") + " SELECT ins.* EXCLUDE (sold), CAST(coalesce(sold, 0) AS BIGINT) AS sold, sold IS NULL AS orphan_product, coalesce(ln(1 + amount) > fence, FALSE) AS outlier FROM ins LEFT JOIN fences ON country = fc")
def silver_insurance(spark: SparkSession, sf: str, mark: bool = True) -> DataFrame:
    """Insurance operations with their product, by country and line. Products, types by countries, are sent to all tasks."""
    branch = silver_branches(spark, sf).select("branch", "country")
    li = latest_lines(spark, sf)
    li = enriched(li, "l_suppkey", branch, "branch", country=None)
    li = enriched(li, "l_partkey", load(spark, sf, "part"), "p_partkey", p_type=None)
    products = li.where("p_type <> 'PROMO'").groupBy("country", "p_type").agg(F.count("*").alias("sold"))
    li = li.join(F.broadcast(products), ["country", "p_type"], "left")
    claim = F.col("l_returnflag") == "R"
    out = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_shipdate").alias("ts"), "country", F.coalesce("p_type", F.lit(UNKNOWN)).alias("line"),
        F.when(F.col("p_type").startswith("S"), "IARD").otherwise("VIE").alias("branch"), (~claim).alias("premium"), claim.alias("claim"), (claim & (F.col("l_linestatus") == "F")).alias("claim_paid"),
        F.col("l_quantity").cast("int").alias("days"), F.col("l_extendedprice").alias("amount"), F.coalesce("sold", F.lit(0)).cast("long").alias("sold"), F.col("sold").isNull().alias("orphan_product"),
    )
    return flagged(out, "country", "amount") if mark else out


def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The greatest row of each key: the order has all other columns, so that rows are shuffled once and hold nothing twice."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus", "l_tax", "l_discount"]
    return load(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.struct(*order)).alias("_best")).select("l_orderkey", "l_linenumber", "_best.*")


@query(with_ctes("fx", "clients") + """, m AS (SELECT event_id AS id, ts, user_id AS sender, (user_id * 7 + 3) % 1600 AS receiver, event_type AS operator, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status, value AS amount FROM events),
mob AS (SELECT m.*, s.country AS sender_country, r.country AS receiver_country, coalesce(s.segment, 'UNKNOWN') AS sender_segment, s.client IS NULL AS orphan_sender, r.client IS NULL AS orphan_receiver, s.country || '-' || r.country AS corridor, coalesce(s.country <> r.country, FALSE) AS cross_border, date_trunc('week', ts)::DATE AS week, CAST(hour(ts) AS INT) AS hour, ts::DATE AS day, s.currency, round(amount / per_eur, 2) AS amount_eur FROM m LEFT JOIN clients s ON s.client = sender LEFT JOIN clients r ON r.client = receiver LEFT JOIN fx ON fx.day = ts::DATE AND fx.currency = s.currency), """ + FENCED.format("mob", "amount_eur", "sender_country") + " SELECT mob.*, coalesce(ln(1 + amount_eur) > fence, FALSE) AS outlier FROM mob LEFT JOIN fences ON sender_country = fc")
def silver_mobile(spark: SparkSession, sf: str, mark: bool = True) -> DataFrame:
    """Mobile payments: one dimension in two roles, in euros at the rate of the sender's currency, outliers marked by the sender's country."""
    c, t = silver_clients(spark, sf), F.col("event_type")
    m = load(spark, sf, "events").select(F.col("event_id").alias("id"), "ts", F.col("user_id").alias("sender"), ((F.col("user_id") * 7 + 3) % 1600).alias("receiver"), t.alias("operator"), F.when(t == "error", "FAILED").when(t == "signup", "PENDING").otherwise("SUCCESS").alias("status"), F.col("value").alias("amount"))
    role = lambda who: c.select("client", "currency", F.col("country").alias(f"{who}_country"), F.col("segment").alias(f"{who}_segment"))
    m = enriched(m, "sender", role("sender"), "client", "orphan_sender", sender_country=None, sender_segment=F.lit(UNKNOWN), currency=None)
    m = enriched(m, "receiver", role("receiver"), "client", "orphan_receiver", receiver_country=None)
    a, b = F.col("sender_country"), F.col("receiver_country")
    m = m.withColumns({"corridor": F.concat(a, F.lit("-"), b), "cross_border": F.coalesce(a != b, F.lit(False)), "week": F.to_date(F.date_trunc("week", "ts")), "hour": F.hour("ts"), "day": F.to_date("ts")})
    out = to_eur(m, silver_fx_rates(spark, sf), "day", amount_eur="amount")
    return flagged(out, "sender_country", "amount_eur") if mark else out


@query(with_ctes("countries", "fx", "lines") + f""", p AS (SELECT *, floor(l_extendedprice / 12 * 100 + 0.5) / 100 AS due, floor(l_extendedprice * l_discount * 100 + 0.5) / 100 AS paid, CASE WHEN l_tax > 0.02 THEN l_tax ELSE {DEFAULT_RATE}::DOUBLE END AS rate FROM lines),
loan AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_suppkey AS loan, l_shipdate::DATE AS day, country, countries.currency, due, round(due / per_eur, 2) AS due_eur, paid, round(paid / per_eur, 2) AS paid_eur, rate, floor(paid * rate / (1 + rate) * 100 + 0.5) / 100 AS interest, round(floor(paid * rate / (1 + rate) * 100 + 0.5) / 100 / per_eur, 2) AS interest_eur, coalesce(CASE WHEN s_acctbal >= 0 THEN s_acctbal END, 0.0) AS outstanding, NOT coalesce(s_acctbal >= 0, FALSE) AS orphan, l_returnflag = 'R' OR CAST(floor(l_quantity) AS INT) * 3 > 90 AS bad FROM p JOIN supplier ON l_suppkey = s_suppkey JOIN countries ON s_nationkey = nation LEFT JOIN fx ON fx.day = l_shipdate::DATE AND fx.currency = countries.currency), """ + FENCED.format("loan", "due_eur", "country") + " SELECT loan.*, coalesce(ln(1 + due_eur) > fence, FALSE) AS outlier FROM loan LEFT JOIN fences ON country = fc")
def silver_loans(spark: SparkSession, sf: str, mark: bool = True) -> DataFrame:
    """Repayments: what is outstanding comes from the loan's account, 0 where there is none; a missing rate has a default; amounts in euros too, outliers by what was due."""
    homes = load(spark, sf, "supplier").join(countries(spark, sf), F.col("s_nationkey") == F.col("nation")).select("s_suppkey", "country", "currency", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("outstanding"))
    li = enriched(latest_lines(spark, sf), "l_suppkey", homes, "s_suppkey", country=None, currency=None, outstanding=None)
    rate, paid = F.when(F.col("l_tax") > 0.02, F.col("l_tax")).otherwise(DEFAULT_RATE), cents(F.col("l_extendedprice") * F.col("l_discount"))
    bad = (F.col("l_returnflag") == "R") | (F.col("l_quantity").cast("int") * 3 > 90)
    li = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_suppkey").alias("loan"), F.to_date("l_shipdate").alias("day"), "country", "currency", cents(F.col("l_extendedprice") / 12).alias("due"), paid.alias("paid"), rate.alias("rate"),
        cents(paid * rate / (1 + rate)).alias("interest"), F.coalesce("outstanding", F.lit(0.0)).alias("outstanding"), F.col("outstanding").isNull().alias("orphan"), bad.alias("bad"),
    )
    out = to_eur(li, silver_fx_rates(spark, sf), "day", due_eur="due", paid_eur="paid", interest_eur="interest")
    return flagged(out, "country", "due_eur") if mark else out


@query("""SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS day, CAST(floor(l_quantity) AS INT) - 3 AS days, CAST(CASE WHEN floor(l_quantity) - 3 > 0 THEN len(list_filter(generate_series(l_shipdate::DATE - (CAST(floor(l_quantity) AS INT) - 4), l_shipdate::DATE, INTERVAL 1 DAY), lambda d: dayofweek(d) NOT IN (0, 6))) ELSE 0 END AS INT) AS working_days FROM lineitem""")
def date_working_days(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), (F.col("l_quantity").cast("int") - 3).alias("days"))
    return li.withColumn("working_days", working_days(F.col("day"), F.col("days")))
