"""Detectors on streams over feeds that arrive in lots, with the SQL that gives the same rows.

Each query lands its lots one by one; a lot is a micro-batch of its own, and the query goes on from its checkpoint. The SQL
says which rows are late: by the lot that they came in and the watermark that the lots before it had left.

What stands for the time of day that orders lack: orders come one a second by their key, and an order's lines are posted
a minute apart. The second line of every fifth order comes a lot late. A claim is for the sum insured, price times quantity.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ledgerlake.functions.expressions import MICRO, half_up
from ledgerlake.operators import store
from ledgerlake.operators.cleanse import sized
from ledgerlake.operators.contracts import Contract, Rule, split, without_personal
from ledgerlake.operators.sketches import History, limits, marked
from ledgerlake.plans import alerts
from ledgerlake.plans.alerts import CLAIM_RATIO, LATE, PREMIUMS_A_YEAR
from ledgerlake.plans.gold import nations, parity
from ledgerlake.plans.silver import bank_dimensions, built_bank, with_ctes
from ledgerlake.sources.scratch import new_place
from ledgerlake.sources.tables import load
from ledgerlake.streaming.feeds import Feed, lots_by_time
from ledgerlake.streaming.topics import dead_letters, typed
from ledgerlake.streaming.totals import DailyTotals

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

LOTS, CLAIM_LOTS, DAYS = 4, 5, 365


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


def sql_lots(rows: str, n: int, late: str = "FALSE") -> str:
    """A query over the view `rows`, which has ts, with lots_by_time()'s column."""
    return f"SELECT r.*, CAST(floor((epoch_us(ts) - a) * {n} / (b - a + 1)) AS INT) + CASE WHEN {late} THEN 1 ELSE 0 END AS lot FROM {rows} r, (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM {rows})"


POSTED = "posted AS (SELECT l_orderkey || '-' || l_linenumber AS id, o_custkey AS account, n_name AS country, CASE WHEN o_custkey % 2 = 0 THEN 'BANK' ELSE 'MICROFINANCE' END AS entity, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey + 60 * l_linenumber) AS ts, CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'INTERNATIONAL_WIRE' WHEN '3-MEDIUM' THEN 'DEPOSIT' WHEN '4-NOT SPECIFIED' THEN 'WITHDRAWAL' ELSE 'PAYMENT' END AS type, CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'FAILED' ELSE 'REVERSED' END AS status, CASE WHEN n_regionkey = 0 THEN l_extendedprice / 5 / 15.0::DOUBLE ELSE l_extendedprice * 10 / 655.957::DOUBLE END AS eur, l_linenumber = 2 AND l_orderkey % 5 = 0 AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"


def posted(spark: SparkSession, sf: str) -> DataFrame:
    """Bank operations with their lots: the lines of orders."""
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("account"), F.col("c_nationkey").alias("nation"))
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account"), "o_orderpriority", "o_orderstatus")
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").join(o, "l_orderkey")
    li = li.join(c, "account", "left").join(nations(spark, sf, "nation", "country"), "nation", "left")
    p, s, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("l_extendedprice")
    kind = F.when(p == "1-URGENT", "TRANSFER").when(p == "2-HIGH", "INTERNATIONAL_WIRE").when(p == "3-MEDIUM", "DEPOSIT").when(p == "4-NOT SPECIFIED", "WITHDRAWAL").otherwise("PAYMENT")
    status = F.when(s == "O", "SUCCESS").when(s == "F", "FAILED").otherwise("REVERSED")
    midnight = F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))
    ops = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "account", "country", parity("account"), F.timestamp_seconds(midnight + F.col("l_orderkey") + 60 * F.col("l_linenumber")).alias("ts"), kind.alias("type"), status.alias("status"),
        F.when(F.col("_r") == 0, price / 5 / alerts.GHS_PER_EUR).otherwise(price * 10 / alerts.XOF_PER_EUR).alias("eur"), ((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 5 == 0)).alias("late"),
    )
    return lots_by_time(ops, "ts", LOTS, F.col("late")).drop("late")


def upserted(sink: str, to_alerts: Callable[[DataFrame], DataFrame], batch: DataFrame, number: int) -> None:
    """A batch's windows become alerts that replace those of their id: windows come again as they grow, and a replayed batch changes nothing."""
    rows = to_alerts(batch).withColumn("day", F.to_date("window_start"))
    store.upsert(rows, sink, ["alert_id"], ["day"], new_place(batch.sparkSession, "staging"))


def kept_alerts(spark: SparkSession, sink: str, shape: DataFrame) -> DataFrame:
    """What the sink holds in the columns of `shape`; no row where no alert was raised."""
    return (spark.read.schema(shape.schema).parquet(sink) if store.exists(spark, sink) else shape.where("false")).select(*shape.columns)


def windowed(spark: SparkSession, sf: str, windows: Callable[..., DataFrame], to_alerts: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Sliding windows of the posted operations in update mode, as alerts by id."""
    feed, sink, mark = Feed(posted(spark, sf), "lot", name), new_place(spark, name), new_place(spark, f"{name}-checkpoint")
    start = lambda: windows(feed.stream(), late=LATE).writeStream.outputMode("update").option("checkpointLocation", mark).foreachBatch(partial(upserted, sink, to_alerts))
    feed.each(start)
    return kept_alerts(spark, sink, to_alerts(windows(spark.createDataFrame([], feed.schema))))


def sql_windows(where: str) -> str:
    """CTEs up to `k`: posted rows that hold `where` in the windows that weren't over when they came."""
    return f"""{POSTED}, r AS ({sql_lots('posted', LOTS, 'late')}), f AS (SELECT * FROM r WHERE {where}),
marks AS (SELECT lot, max(max(ts)) OVER (ORDER BY lot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS mark FROM f GROUP BY lot),
k AS (SELECT * FROM (SELECT f.*, mark, {alerts.START} FROM f JOIN marks USING (lot), {alerts.SLIDES}) WHERE mark IS NULL OR ws + INTERVAL 5 MINUTE > mark)"""


@query(f"""WITH {sql_windows("eur > 500000 / 655.957::DOUBLE AND status <> 'FAILED'")}, g AS (SELECT account, country, entity, ws, count(*) AS n, floor(sum(CAST(round(eur * 1000000) AS BIGINT)) / 1000000::DOUBLE * 100 + 0.5) / 100 AS eur, max(ts) AS last, list_sort(list_distinct(list(id))) AS ids FROM k GROUP BY ALL HAVING count(*) >= 3)
SELECT sha256(concat_ws('|', 'LARGE_TXN_BURST', account, ws)) AS alert_id, 'LARGE_TXN_BURST' AS rule_code, 'HIGH' AS severity, country, entity, 'ACCOUNT' AS subject_type, account::VARCHAR AS subject_id, last AS event_time, ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, eur AS amount_eur, n::INT AS n_ops, ids, '{{"min_count":"3"}}' AS details FROM g""")
def stream_large_burst(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts of large operations: windows grow from lot to lot until they are over."""
    return windowed(spark, sf, alerts.large_windows, alerts.burst_alerts, "stream-bursts")


@query(f"""WITH {sql_windows("status = 'SUCCESS'")}, held AS (SELECT n_name AS country, sum(CASE WHEN n_regionkey = 0 THEN c_acctbal / 15.0::DOUBLE ELSE c_acctbal END) AS deposits FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0 GROUP BY 1),
g AS (SELECT country, ws, lot, sum(CAST(round(CASE WHEN type = 'DEPOSIT' THEN -eur ELSE eur END * 1000000) AS BIGINT)) AS net, count(*) AS n, max(ts) AS last FROM k GROUP BY ALL),
c AS (SELECT country, ws, lot, sum(net) OVER w / 1000000::DOUBLE AS net, sum(n) OVER w AS n, max(last) OVER w AS last FROM g WINDOW w AS (PARTITION BY country, ws ORDER BY lot))
SELECT sha256(concat_ws('|', 'LIQUIDITY_COVERAGE', country, ws)) AS alert_id, 'LIQUIDITY_COVERAGE' AS rule_code, 'CRITICAL' AS severity, country, 'BANK' AS entity, 'COUNTRY' AS subject_type, country AS subject_id, last AS event_time, ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, floor(net * 100 + 0.5) / 100 AS amount_eur, n::INT AS n_ops, []::VARCHAR[] AS ids, '{{"threshold_pct":"1.0"}}' AS details
FROM c JOIN held USING (country) WHERE deposits > 0 AND net / deposits > 0.01 QUALIFY row_number() OVER (PARTITION BY country, ws ORDER BY lot DESC) = 1""")
def stream_liquidity(spark: SparkSession, sf: str) -> DataFrame:
    """Outflows of a country's banks against its deposits; an alert stays as last raised, also where later deposits make up for it."""
    held = sized(alerts.reserves(spark, sf))
    return windowed(spark, sf, alerts.flow_windows, lambda w: alerts.liquidity_alerts(w, held), "stream-liquidity")


@query(alerts.ORACLES["alert_unusual_country"])
def stream_unusual_country(spark: SparkSession, sf: str) -> DataFrame:
    """Payments of the last week as a stream, joined with profiles of what came before: home and countries seen. Append mode, no state."""
    m = alerts.mobile(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    m = m.crossJoin(F.broadcast(m.agg((F.max("ts") - F.expr("INTERVAL 7 DAYS")).alias("cut"))))  # one row
    home = load(spark, sf, "customer").select(F.col("c_custkey").alias("sender"), F.col("c_nationkey").alias("nation")).join(nations(spark, sf, "nation", "home"), "nation").select("sender", "home")
    seen = m.where("ts < cut").groupBy("sender").agg(F.collect_set("country").alias("seen"))
    profiles = home.join(seen, "sender", "left").select("sender", "home", F.array_union(F.array("home"), F.coalesce("seen", F.array().cast("array<string>"))).alias("usual"))
    profiles = sized(profiles)
    feed = Feed(lots_by_time(m.where("ts >= cut").drop("cut"), "ts", LOTS - 1), "lot", "payments")
    sink, mark = new_place(spark, "abroad"), new_place(spark, "abroad-checkpoint")

    def unusual(payments: DataFrame) -> DataFrame:
        hits = payments.where("status <> 'FAILED'").join(profiles, "sender").where(~F.array_contains("usual", F.col("country")))
        return hits.select(*alerts.country_record())

    feed.live(lambda: unusual(feed.stream()).writeStream.outputMode("append").format("parquet").option("checkpointLocation", mark).option("path", sink), every="1 second")
    return kept_alerts(spark, sink, unusual(spark.createDataFrame([], feed.schema)))


INSURED = "insured AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey AS client, n_name AS country, 'INSURER' AS entity, l_shipdate AS ts, l_shipdate::DATE AS day, l_returnflag <> 'R' AS premium, CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_quantity ELSE l_extendedprice END AS eur, l_returnflag <> 'R' AND l_linenumber = 3 AS late FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey)"


def insured(spark: SparkSession, sf: str) -> DataFrame:
    """Insurance operations with their lots."""
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    li = load(spark, sf, "lineitem").join(s, "l_suppkey", "left").join(nations(spark, sf, "nation", "country"), "nation", "left")
    premium, ts = F.col("l_returnflag") != "R", F.col("l_shipdate").cast("timestamp")
    rows = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_partkey").cast("long").alias("client"), "country", F.lit("INSURER").alias("entity"), ts.alias("ts"), F.to_date(ts).alias("day"), premium.alias("premium"),
        F.when(premium, F.col("l_extendedprice")).otherwise(F.col("l_extendedprice") * F.col("l_quantity")).alias("eur"), (premium & (F.col("l_linenumber") == 3)).alias("late"),
    )
    return lots_by_time(rows, "ts", CLAIM_LOTS, F.col("late")).drop("late")


def claims_in(totals: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims of clients whose premiums (key, total, n) they pass by far, as alerts."""
    a_year = F.greatest(F.col("total") / MICRO, F.col("total") / MICRO / F.col("n") * PREMIUMS_A_YEAR)
    paid = totals.where("total > 0").select("client", half_up(a_year).alias("paid"))
    return claims.join(paid, "client").where(F.col("eur") > CLAIM_RATIO * F.col("paid")).select(*alerts.claim_record())


def judged(paid: DailyTotals, sink: str, batch: DataFrame, number: int) -> None:
    """Claims of a batch against the premiums of history, of earlier batches and of its own, over the year that ends with the latest day known."""
    premiums = batch.where("premium")
    latest = batch.agg(F.max("day").alias("d")).unionByName(paid.before(number).agg(F.max("day").alias("d"))).agg(F.max("d")).first()[0]
    year: Column = F.col("day") >= F.date_sub(F.lit(latest), DAYS)
    rows = claims_in(paid.upto(number, premiums, year), batch.where("NOT premium")).withColumn("year", F.year("event_time"))
    store.upsert(rows.dropDuplicates(["alert_id"]), sink, ["alert_id"], ["year"], new_place(batch.sparkSession, "staging"))
    paid.put(premiums, number)


@query(f"""WITH {INSURED}, r AS ({sql_lots('insured', CLAIM_LOTS, 'late')}), p AS (SELECT client, day, lot, CAST(round(eur * 1000000) AS BIGINT) AS eur FROM r WHERE premium),
upto AS (SELECT lot, greatest(max(day), (SELECT max(day) FROM p WHERE p.lot < r.lot)) AS latest FROM r WHERE lot > 0 GROUP BY lot),
t AS (SELECT u.lot, client, sum(eur)::BIGINT AS total, count(*) AS n FROM p JOIN upto u ON p.lot <= u.lot AND day >= latest - {DAYS} GROUP BY ALL),
y AS (SELECT lot, client, floor(greatest(total / 1000000::DOUBLE, total / 1000000::DOUBLE / n * 12) * 100 + 0.5) / 100 AS paid FROM t WHERE total > 0)
SELECT DISTINCT sha256(concat_ws('|', 'CLAIM_GT_3X_PREMIUM', id)) AS alert_id, 'CLAIM_GT_3X_PREMIUM' AS rule_code, 'HIGH' AS severity, country, entity, 'CUSTOMER' AS subject_type, client::VARCHAR AS subject_id, ts AS event_time, NULL::TIMESTAMP AS window_start, NULL::TIMESTAMP AS window_end, round(eur, 2) AS amount_eur, 1 AS n_ops, [id] AS ids, '{{"premiums_12m_eur":"' || paid::DECIMAL(18, 2)::VARCHAR || '"}}' AS details
FROM (SELECT * FROM r WHERE NOT premium AND lot > 0 QUALIFY count(*) OVER (PARTITION BY id) = 1) c JOIN y USING (lot, client) WHERE eur > 3 * paid""")
def stream_claim_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Claims against premiums that three sources add up to: history (the first lot), batches before, and the batch itself. Ids that stand for several claims are left out."""
    rows = insured(spark, sf)
    once = rows.where("NOT premium AND lot > 0").groupBy("id").agg(F.count("*").alias("c")).where("c = 1").select("id")
    stream = rows.where("lot > 0")
    stream = stream.where("premium").unionByName(stream.where("NOT premium").join(once, "id", "left_semi"))
    paid = DailyTotals(spark, new_place(spark, "premiums"), "client", "day", "eur")
    paid.put(rows.where("premium AND lot = 0"))
    feed, sink, mark = Feed(stream, "lot", "claims"), new_place(spark, "claims"), new_place(spark, "claims-checkpoint")
    feed.each(lambda: feed.stream().writeStream.option("checkpointLocation", mark).foreachBatch(partial(judged, paid, sink)))
    empty = spark.createDataFrame([], feed.schema)
    return kept_alerts(spark, sink, claims_in(paid.upto(0, empty.where("premium")), empty))


MESSAGE = "id bigint, account bigint, amount double, status string, type string, ts timestamp, holder string"
MESSAGES_FIT = Contract([Rule("parsed", "corrupt"), Rule("required", "id"), Rule("required", "holder"), Rule("one_of", "status", ("O", "F", "P")), Rule("at_least", "amount", 0)], personal=["holder"])
SALT = "ledger"


def posted_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text messages with their lots. By key: some are torn, hold no number, a negative one or a blank holder; every fiftieth comes again a lot later."""
    k, c = F.col("o_orderkey"), load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    o = load(spark, sf, "orders").join(c, "o_custkey")
    amount = F.when(k % 41 == 0, "N/A").when(k % 29 == 0, (-F.col("o_totalprice")).cast("string")).otherwise(F.col("o_totalprice").cast("string"))
    fields = {"id": k.cast("string"), "account": F.col("o_custkey").cast("string"), "amount": amount, "status": F.col("o_orderstatus"), "type": F.col("o_orderpriority"), "ts": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), "holder": F.when(k % 37 == 0, "  ").otherwise(F.col("c_name"))}
    value = F.when(k % 43 == 0, "{torn").otherwise(F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()])))
    m = o.select(F.lit("raw-bank").alias("topic"), (k % 8).cast("int").alias("partition"), k.alias("offset"), F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + k).alias("timestamp"), value.alias("value"))
    m = lots_by_time(m, "timestamp", LOTS)
    again = m.where("offset % 50 = 0").withColumns({"lot": F.col("lot") + 1, "offset": F.col("offset") + 1_000_000_000})
    return m.unionByName(again)


def to_silver(sinks: dict[str, str], dims: tuple[DataFrame, ...], fences: DataFrame, batch: DataFrame, number: int) -> None:
    """A micro-batch of messages as a small batch: parsed, judged by the contract, masked, built as batches build it, inserted by key.

    Rejected messages replace the batch's own partition of dead letters; rows that are there by key stay. So a replayed batch changes nothing.
    """
    spark, parsed = batch.sparkSession, typed(batch, StructType.fromDDL(MESSAGE)).persist()
    valid, rejected = split(parsed, MESSAGES_FIT)
    store.replace_partitions(dead_letters(rejected, "bank", "id").withColumn("batch", F.lit(number)), sinks["dead"], ["batch"])
    plain = without_personal(valid.select("id", "account", "amount", "status", "type", "ts", "holder"), ["holder"], SALT)
    built = built_bank(plain.drop("holder_masked", "holder_hash"), *dims, cut=True).join(plain.select("id", "holder_masked", "holder_hash").dropDuplicates(["id"]), "id")
    built = marked(built, "country", "amount_eur", fences)
    built.write.parquet(staged := new_place(spark, "micro-batch"))  # read several times below
    store.insert_new(spark.read.schema(built.schema).parquet(staged), sinks["silver"], ["id"], ["month"], within=True)
    store.drop(spark, staged)
    parsed.unpersist()


def silver_feed(spark: SparkSession, sf: str) -> tuple[Feed, dict[str, str], Callable[[], DataStreamWriter]]:
    """(feed of lots from the second on, folders of what is written, the query): limits come from the first lot's days, sketched as history."""
    messages = posted_messages(spark, sf)
    sinks = {name: new_place(spark, f"stream-{name}") for name in ("silver", "dead", "history", "checkpoint")}
    dims = []
    for d in bank_dimensions(spark, sf):  # worked out once for all batches
        d.write.parquet(place := new_place(spark, "dimension"))
        dims.append(spark.read.schema(d.schema).parquet(place))
    past = split(typed(messages.where("lot = 0"), StructType.fromDDL(MESSAGE)), MESSAGES_FIT)[0]
    history = History(spark, sinks["history"], "country", "month", "amount_eur")
    history.add(built_bank(past.select("id", "account", "amount", "status", "type", "ts"), *dims))
    limits(history.upto(), "country").write.parquet(fences := new_place(spark, "fences"))
    feed = Feed(messages.where("lot > 0"), "lot", "messages")
    handler = partial(to_silver, sinks, tuple(dims), spark.read.parquet(fences))
    return feed, sinks, lambda: feed.stream().writeStream.option("checkpointLocation", sinks["checkpoint"]).foreachBatch(handler)


STREAMED = (
    "m AS (SELECT o_orderkey AS k, bank.*, c_name AS holder, CAST(floor((epoch_us(TIMESTAMP '2024-01-01' + to_seconds(o_orderkey)) - a) * 4 / (b - a + 1)) AS INT) AS lot, o_orderkey % 43 = 0 AS torn, o_orderkey % 41 = 0 AS unfit, o_orderkey % 37 = 0 AS nameless, o_orderkey % 29 = 0 AS negative FROM bank JOIN orders ON id = o_orderkey JOIN customer ON o_custkey = c_custkey, (SELECT min(epoch_us(TIMESTAMP '2024-01-01' + to_seconds(o_orderkey))) AS a, max(epoch_us(TIMESTAMP '2024-01-01' + to_seconds(o_orderkey))) AS b FROM orders))"
)


@query(with_ctes("bank") + f""", {STREAMED}, v AS (SELECT * FROM m WHERE NOT (torn OR unfit OR nameless OR negative)),
q AS (SELECT country AS fc, quantile_disc(ln(1 + amount_eur), 0.75) + 1.5 * (quantile_disc(ln(1 + amount_eur), 0.75) - quantile_disc(ln(1 + amount_eur), 0.25)) AS fence FROM v WHERE lot = 0 GROUP BY 1)
SELECT id, ts, month, account, segment, country, currency, type, status, amount, amount_eur, fee, fee_eur, orphan, orphan_branch, coalesce(ln(1 + amount_eur) > fence, FALSE) AS outlier, left(holder, 4) || '****' || right(holder, 4) AS holder_masked, sha256('{SALT}' || holder) AS holder_hash FROM v LEFT JOIN q ON country = fc WHERE lot > 0 OR k % 50 = 0""")
def stream_silver_bank(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through contract, masks and the silver builder, lot by lot; repeats in later lots are found by key, limits are those of history."""
    feed, sinks, start = silver_feed(spark, sf)
    feed.each(start)
    out = spark.read.parquet(sinks["silver"])
    return out.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.to_date("month").alias("month"), "account", "segment", "country", "currency", "type", "status", "amount", "amount_eur", "fee", "fee_eur", "orphan", "orphan_branch", "outlier", "holder_masked", "holder_hash")


@query(with_ctes("bank") + f""", {STREAMED}, d AS (SELECT concat_ws(',', CASE WHEN torn OR unfit THEN 'MALFORMED_ROW' END, CASE WHEN torn THEN 'MISSING_ID' END, CASE WHEN torn OR nameless THEN 'MISSING_HOLDER' END, CASE WHEN negative AND NOT torn AND NOT unfit THEN 'NEGATIVE_AMOUNT' END) AS reasons, CASE WHEN lot > 0 THEN 1 ELSE 0 END + CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END AS times FROM m WHERE torn OR unfit OR nameless OR negative)
SELECT reasons, sum(times)::BIGINT AS n, (sum(sum(times)) OVER ())::BIGINT AS n_all FROM d WHERE times > 0 GROUP BY reasons""")
def stream_silver_dead(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of the same stream by reason: every copy of a bad message is one."""
    feed, sinks, start = silver_feed(spark, sf)
    feed.each(start)
    by = spark.read.parquet(sinks["dead"]).groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))
    return by.crossJoin(F.broadcast(by.agg(F.sum("n").alias("n_all"))))  # one row
