"""Files, merges and streams as queries: each writes into a new place of the shared folder and returns what is there."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.expressions import half_up
from ledgerlake.operators import store
from ledgerlake.operators.contracts import Contract, Rule, split
from ledgerlake.plans.domain import mobile
from ledgerlake.plans.silver import countries
from ledgerlake.sources import files
from ledgerlake.sources.scratch import new_place
from ledgerlake.sources.tables import load
from ledgerlake.streaming.detect import burst_stream
from ledgerlake.streaming.topics import dead_letters, first_seen, typed

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


def landed_orders(spark: SparkSession, sf: str) -> str:
    """CSV files of orders by country, some rows with values that don't parse; returns their folder."""
    home = load(spark, sf, "customer").join(countries(spark, sf), F.col("c_nationkey") == F.col("nation")).select(F.col("c_custkey").alias("o_custkey"), F.col("country").alias("of"))
    k = F.col("o_orderkey")
    o = load(spark, sf, "orders").join(home, "o_custkey").select(k.cast("string").alias("id"), F.when(k % 31 == 0, "N/A").otherwise(F.col("o_totalprice").cast("string")).alias("amount"), F.date_format("o_orderdate", files.STAMP).alias("ts"), F.col("o_orderstatus").alias("status"), "of")
    root = new_place(spark, "landing")
    o.write.partitionBy("of").option("header", True).csv(f"{root}/orders")
    return root


SCHEMA = "id bigint, amount double, ts timestamp, status string"


@query("SELECT 'of=' || n_name AS folder, CAST(count(*) AS BIGINT) AS n, CAST(count_if(o_orderkey % 31 = 0) AS BIGINT) AS corrupt, CAST(sum(CASE WHEN o_orderkey % 31 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS cents, max(o_orderdate) AS last FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_1', 'NATION_2') GROUP BY 1")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two countries alone, with a schema; rows that don't fit are kept as text and named by their file."""
    root = landed_orders(spark, sf)
    rows = files.read_csv(spark, [f"{root}/orders/of=NATION_1", f"{root}/orders/of=NATION_2"], StructType.fromDDL(SCHEMA))
    folder = F.element_at(F.split(files.SOURCE, "/"), -2)
    return rows.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"), F.count(files.CORRUPT).alias("corrupt"), F.sum(F.round(F.col("amount") * 100).cast("long")).alias("cents"), F.max("ts").cast("timestamp_ntz").alias("last"))


@query("SELECT 'of=' || n_name AS country, CAST(count(*) AS BIGINT) AS n, CAST(count_if(o_orderkey % 31 = 0) AS BIGINT) AS corrupt, CAST(sum(CASE WHEN o_orderkey % 31 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS cents, TRUE AS filled, CAST(0 AS BIGINT) AS aged FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_3', 'NATION_4') GROUP BY 1")
def csv_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """The files of two countries as listed, read: names, sizes and ages come from the listing, which passes by what is too young."""
    root = landed_orders(spark, sf)
    found = files.landed(spark, root, "orders", ["of=NATION_3", "of=NATION_4"]).collect()  # a row a file
    aged = files.landed(spark, root, "orders", ["of=NATION_3", "of=NATION_4"], older_than_s=3600).count()
    rows = files.read_csv(spark, [r.path for r in found], StructType.fromDDL(SCHEMA))
    country = F.element_at(F.split(files.SOURCE, "/"), -2).alias("country")
    return rows.groupBy(country).agg(F.count("*").alias("n"), F.count(files.CORRUPT).alias("corrupt"), F.sum(F.round(F.col("amount") * 100).cast("long")).alias("cents")).withColumns({"filled": F.lit(all(r.size > 0 and r.path.endswith(".csv") for r in found)), "aged": F.lit(aged).cast("long")})


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of orders that overlap: the second has a third of the first again, with other amounts."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1 OR o_orderkey % 6 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 1 END * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1")
def store_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    """What is there by key stays; the last load again changes nothing."""
    path, (a, b) = new_place(spark, "inserted"), halves(spark, sf)
    for part in (a, b, b):
        store.insert_new(part, path, ["o_orderkey"], ["o_orderpriority"])
    return totals(spark.read.parquet(path))


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 6 = 0 THEN o_totalprice + 1 ELSE o_totalprice END * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1")
def store_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path, (a, b) = new_place(spark, "upserted"), halves(spark, sf)
    for part in (a, b, b):
        store.upsert(part, path, ["o_orderkey"], ["o_orderpriority"], new_place(spark, "staging"))
    return totals(spark.read.parquet(path))


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(o_totalprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 200 ELSE 100 END) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1")
def store_replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    path, o = new_place(spark, "replaced"), load(spark, sf, "orders")
    store.append(o, path, ["o_orderpriority"])
    store.replace_partitions(o.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["o_orderpriority"])
    return totals(spark.read.parquet(path))


@query("SELECT 'events' AS name, CAST(count(*) AS BIGINT) AS n FROM events UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders")
def store_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of a folder by their names, with their rows."""
    root = new_place(spark, "schema")
    for name in ("orders", "nation", "events"):
        store.append(load(spark, sf, name), f"{root}/{name}")
    counts = [spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("name"), F.count("*").alias("n")).select("name", "n") for name in store.tables(spark, root)]
    return reduce(DataFrame.unionByName, counts)


def totals(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


def drained(stream: DataFrame, spark: SparkSession, mode: str = "append", each=None, name: str = "stream") -> DataFrame:
    """Everything that a stream gives by now, from a sink in the shared folder; one checkpoint for each query."""
    sink = new_place(spark, name)
    writer = stream.writeStream.trigger(availableNow=True).outputMode(mode).option("checkpointLocation", new_place(spark, f"{name}-checkpoint"))
    running = writer.foreachBatch(partial(each, sink)).start() if each else writer.format("parquet").option("path", sink).start()
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(sink)


def topic(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of text messages made of events: every fiftieth comes twice, some don't parse, some have no id."""
    e, k = load(spark, sf, "events"), F.col("event_id")
    value = F.to_json(F.struct(F.when(k % 37 != 0, k.cast("string")).alias("event_id"), F.col("user_id").cast("string").alias("user_id"), F.when(k % 41 == 0, "N/A").otherwise(F.col("value").cast("string")).alias("value")))
    value = F.when(k % 43 == 0, "{torn").otherwise(value)
    m = e.select(F.concat(F.lit("raw-"), F.col("event_type")).alias("topic"), (k % 8).cast("int").alias("partition"), k.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), value.alias("value"))
    twice = m.where("offset % 50 = 0").withColumn("offset", F.col("offset") + 10_000_000)
    place = new_place(spark, "topic")
    m.unionByName(twice).coalesce(1).write.parquet(place)
    return spark.readStream.schema(m.schema).parquet(place)


MESSAGES = "m AS (SELECT 'raw-' || event_type AS topic, event_id, user_id, value, event_id % 50 = 0 AS twice, event_id % 43 = 0 AS torn, event_id % 41 = 0 AS unfit, event_id % 37 = 0 AS nameless FROM events)"


@query(f"WITH {MESSAGES} SELECT topic, CAST(sum(CASE WHEN twice AND (torn OR nameless) THEN 2 ELSE 1 END) AS BIGINT) AS n FROM m GROUP BY topic")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Messages seen before are dropped by their id; those without one are told apart by their place."""
    return drained(first_seen(topic(spark, sf), ["event_id"]), spark, name="dedup").groupBy("topic").agg(F.count("*").alias("n"))


MESSAGE = "event_id bigint, user_id bigint, value double"
FIT = Contract([Rule("parsed", "corrupt"), Rule("required", "event_id")])


def parsed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    seen = first_seen(topic(spark, sf), ["event_id"]).withColumnRenamed("value", "text").withColumn("value", F.col("text"))
    return split(typed(seen, StructType.fromDDL(MESSAGE)).withColumn("value_number", F.col("value")).withColumn("value", F.col("text")), FIT)


@query(f"WITH {MESSAGES} SELECT topic, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM m WHERE NOT torn AND NOT unfit AND NOT nameless GROUP BY topic")
def stream_valid(spark: SparkSession, sf: str) -> DataFrame:
    good = drained(parsed(spark, sf)[0], spark, name="valid")
    return good.groupBy("topic").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value_number") * 100).cast("long")).alias("cents"))


@query(f"WITH {MESSAGES} SELECT array_to_string(list_filter([CASE WHEN torn OR unfit THEN 'MALFORMED_ROW' END, CASE WHEN torn OR nameless THEN 'MISSING_EVENT_ID' END], lambda x: x IS NOT NULL), ',') AS reasons, CAST(sum(CASE WHEN twice AND (torn OR nameless) THEN 2 ELSE 1 END) AS BIGINT) AS n FROM m WHERE torn OR unfit OR nameless GROUP BY 1")
def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    bad = drained(dead_letters(parsed(spark, sf)[1], "events", "event_id"), spark, name="dead")
    return bad.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query("WITH s AS (SELECT unnest([0, 10, 20]) AS k), w AS (SELECT user_id AS sender, time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(k) AS window_start, value FROM events, s) SELECT sender, window_start, CAST(count(*) AS BIGINT) AS n_events, floor(sum(value) * 100 + 0.5) / 100 AS total FROM w GROUP BY ALL HAVING count(*) >= 2")
def stream_bursts(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding windows over a stream: windows come again as they grow, and replace themselves by key."""
    m = mobile(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    place = new_place(spark, "payments")
    m.coalesce(1).write.parquet(place)
    stream = burst_stream(spark.readStream.schema(m.schema).parquet(place), "sender", "ts", least=2)

    def each(sink: str, batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("part", F.to_date("window_start"))
        store.upsert(rows, sink, ["sender", "window_start"], ["part"], new_place(batch.sparkSession, "staging"))

    out = drained(stream, spark, "update", each, "bursts")
    return out.select("sender", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_events", half_up(F.col("total")).alias("total"))
