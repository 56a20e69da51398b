"""Vectors, plans, files and streams of the library."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.expressions import half_up, masked, money, present, pseudonym, ratio, working_days
from ledgerlake.operators import store
from ledgerlake.operators.cleanse import asked_for, enriched, flagged, latest_by
from ledgerlake.operators.contracts import Contract, Rule, reject_records, split, without_personal
from ledgerlake.operators.policies import Policy
from ledgerlake.operators.sketches import History, limits, marked, quantile
from ledgerlake.plans import gold
from ledgerlake.plans.domain import mobile
from ledgerlake.plans.reports import as_of
from ledgerlake.sources import files
from ledgerlake.streaming.detect import burst_stream, bursts
from ledgerlake.streaming.topics import first_seen, typed

SF = "/root/testdata/sf0.001"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize("end,days,want", [("2026-06-15", 1, 1), ("2026-06-15", 3, 1), ("2026-06-14", 2, 0), ("2026-06-19", 7, 5), ("2026-06-19", 0, 0), ("2026-06-19", None, 0), ("2026-06-19", -3, 0)])
def test_working_days(spark, end, days, want):
    assert one(spark, working_days(F.lit(end).cast("date"), F.lit(days).cast("int"))) == want


def test_masks_and_pseudonyms(spark):
    assert [one(spark, masked(F.lit(v))) for v in ("FR76 3000 6000 0112", "short", "elevenchars", "", None)] == ["FR76****0112", "****", "****", "****", None]
    assert one(spark, present(F.lit("  "))) is None and one(spark, present(F.lit(" a "))) == "a"
    with pytest.raises(ValueError):
        pseudonym(F.lit("x"), "")


def test_ratios_and_money(spark):
    assert [one(spark, ratio(F.lit(1.0), F.lit(d))) for d in (3.0, 0.0, -2.0, None)] == [0.3333, None, None, None]
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert df.agg(money(F.col("v"))).first()[0] == 0.3 and df.where("v IS NULL").agg(money(F.col("v"))).first()[0] is None
    assert one(spark, half_up(F.lit(2.675))) == 2.68


def test_as_of_is_the_month_of_the_day_before(spark):
    day = datetime.date
    assert [one(spark, as_of(d)) for d in (day(2026, 7, 1), day(2026, 7, 2), day(2026, 1, 1))] == [day(2026, 6, 1), day(2026, 7, 1), day(2025, 12, 1)]


def test_latest_and_enriched(spark):
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, None, "only"), (None, 1, "nobody")], "k int, v int, t string")
    assert {tuple(r) for r in latest_by(rows, ["k"], F.col("v"), F.col("t")).collect()} == {(1, 2, "new"), (2, None, "only"), (None, 1, "nobody")}
    dim = spark.createDataFrame([(1, "a"), (9, "z")], "id int, name string")
    got = enriched(rows, "k", dim, "id", "orphan", name=F.lit("UNKNOWN")).select("k", "name", "orphan")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "a", False), (1, "a", False), (2, "UNKNOWN", True), (None, "UNKNOWN", True)], key=repr)
    plan = asked_for(dim, "id", rows, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and [r.id for r in asked_for(dim, "id", rows, "k").collect()] == [1]


def test_outliers_are_marked_and_kept(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [*range(90, 110), 10**9]] + [("b", None), (None, 5.0)], "c string, v double")
    got = flagged(df, "c", "v").collect()
    assert len(got) == 23 and [r.v for r in got if r.outlier] == [1e9]
    history = spark.createDataFrame([("a", 1.0)], "c string, fence double")
    assert sum(r.outlier for r in marked(df, "c", "v", history).collect()) == 21


def test_limits_of_history_merge_and_keep_their_rank(spark, tmp_path):
    """Days are sketched once; merged, their quartiles are off by less than the sketch's error; a replayed day changes nothing."""
    facts = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"))
    h = History(spark, str(tmp_path / "h"), "c", "d", "v")
    h.add(facts.where("d < '2026-01-21'"))
    h.add(facts.where("d >= '2026-01-21'"))
    h.add(facts.where("d = '2026-01-05'"))
    assert {r.c: r.n for r in h.upto().collect()} == {"a": 40_000, "b": 80_000}
    assert sum(r.n for r in h.upto(F.col("d") < "2026-01-03").collect()) == 6_000
    for q in (0.25, 0.75):
        at = h.upto().select("c", quantile(q).alias("at"))
        below = facts.join(at, "c").groupBy("c").agg(F.avg((F.log1p("v") <= F.col("at")).cast("int")).alias("rank"))
        assert all(abs(r["rank"] - q) < 0.005 for r in below.collect())
    scans = limits(h.upto(), "c")._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans == 1


CONTRACT = Contract(
    [Rule("parsed", "torn"), Rule("required", "id"), Rule("required", "iban"), Rule("one_of", "country", ("CI", "GH"), "INVALID_COUNTRY_CODE"), Rule("one_of", "entity", ("BANK",), "INVALID_ENTITY_TYPE"), Rule("one_of", "status", ("O", "F")), Rule("at_least", "amount", 0), Rule("goes_with", "currency", ("country", {"CI": "XOF", "GH": "GHS"}))],
    ["iban"],
)
ROWS = [(1, "O", 1.0, "CI", "BANK", "XOF", None, "x" * 16), (None, "?", -1.0, "FR", "SHOP", "EUR", "torn", "x"), (2, None, None, "GH", None, "XOF", None, "y y"), (3, "F", 0.0, "FR", "BANK", "EUR", None, "   ")]


def test_contract_keeps_every_reason_in_order(spark):
    df = spark.createDataFrame(ROWS, "id int, status string, amount double, country string, entity string, currency string, torn string, iban string")
    valid, bad = split(df, CONTRACT)
    assert [r.id for r in valid.collect()] == [1] and "torn" not in valid.columns
    assert {r.id: r.reasons for r in bad.collect()} == {None: "MALFORMED_ROW,MISSING_ID,INVALID_COUNTRY_CODE,INVALID_ENTITY_TYPE,INVALID_STATUS,NEGATIVE_AMOUNT", 2: "CURRENCY_COUNTRY_MISMATCH", 3: "MISSING_IBAN,INVALID_COUNTRY_CODE"}
    raw = {r.record_id: r.raw_record for r in reject_records(bad, CONTRACT, "bank", "id", "country", F.lit("f.csv")).collect()}
    assert raw[None] == "torn" and "iban" not in raw["2"] and '"country":"GH"' in raw["2"]
    hidden = without_personal(df, ["iban"], "s").where("id = 1").first()
    assert hidden.iban_masked == "xxxx****xxxx" and len(hidden.iban_hash) == 64 and "iban" not in hidden.asDict()


def test_policy_denies_unless_allowed(spark):
    df = spark.createDataFrame([("CI", "secret-account"), ("GH", "secret-account"), (None, "z")], "country string, iban string")
    assert Policy().view(df).collect() == []
    assert [tuple(r) for r in Policy([F.col("country") == "CI"], hidden=["iban"]).view(df).collect()] == [("CI", "secr****ount")]
    assert Policy([F.col("country") == "CI"], denied=["iban"]).view(df).columns == ["country"]


def test_csv_keeps_what_does_not_fit(spark, tmp_path):
    folder = tmp_path / "bank" / "CI"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,amount,day\n1,2.5,2026-01-02\n2,N/A,2026-01-02\n3\n")
    (folder / "empty.csv").write_text("")
    (folder / "note.txt").write_text("x")
    df = files.read_csv(spark, str(folder / "a.csv"), StructType.fromDDL("id int, amount double, day date")).cache()
    assert {r.id: r[files.CORRUPT] for r in df.collect()} == {1: None, 2: "2,N/A,2026-01-02", 3: "3"}
    assert df.where(F.col(files.CORRUPT).isNotNull()).count() == 2 and df.first()[files.SOURCE].endswith("a.csv")
    assert [(r.country, r.size > 0) for r in files.landed(spark, str(tmp_path), "bank", ["CI"]).collect()] == [("CI", True)]
    assert files.landed(spark, str(tmp_path), "bank", older_than_s=3600).collect() == []
    assert files.archived(spark, str(folder / "a.csv"), str(tmp_path / "done")) and files.archived(spark, str(folder / "a.csv"), str(tmp_path / "done"))


def test_store(spark, tmp_path):
    kind, path = "k int, p string, v int", str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), kind)
    there = lambda: {(r.k, r.p, r.v) for r in spark.read.parquet(path).collect()}
    store.insert_new(rows((1, "a", 1), (2, "b", 1)), path, ["k"], ["p"])
    store.insert_new(rows((2, "b", 9), (3, "b", 1), (3, "b", 2)), path, ["k"], ["p"])
    assert {(k, p) for k, p, _ in there()} == {(1, "a"), (2, "b"), (3, "b")} and (2, "b", 1) in there()
    store.upsert(rows((3, "b", 7), (4, "c", 7)), path, ["k"], ["p"], str(tmp_path / "s"))
    assert there() == {(1, "a", 1), (2, "b", 1), (3, "b", 7), (4, "c", 7)}
    store.replace_partitions(rows((5, "b", 5)), path, ["p"])
    assert there() == {(1, "a", 1), (5, "b", 5), (4, "c", 7)}
    store.export_csv(spark.read.parquet(path), str(tmp_path / "csv"), "p")
    assert sorted(p.parent.name for p in (tmp_path / "csv").glob("p=*/*.csv")) == ["p=a", "p=b", "p=c"]
    told = json.loads(store.summary_json(spark.read.parquet(path).orderBy("k"), most=2))
    assert (told["count"], told["left_out"], [r["k"] for r in told["rows"]]) == (3, 1, [1, 4])
    assert store.exists(spark, path)
    store.drop(spark, path)
    assert not store.exists(spark, path)


def test_failed_operations_count_but_add_no_amount(spark):
    rows = gold.gold_daily_volume(spark, SF).where("n_failed = n_ops").collect()
    assert rows and all(r.total is None and r.mean is None for r in rows)


def test_burst_stream_equals_batch(spark, tmp_path):
    m = mobile(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    m.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(m.schema).parquet(str(tmp_path / "in"))
    q = burst_stream(stream, "sender", "ts", least=2).writeStream.format("memory").queryName("found_bursts").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("found_bursts").collect()} == {tuple(r) for r in bursts(m, "sender", "ts", least=2).collect()}


def test_late_copies_pass_once_the_watermark_is_over(spark, tmp_path):
    """A copy within the lateness is dropped in a later batch too; a message later than that is dropped itself."""
    kind = "topic string, partition int, offset long, timestamp timestamp, value string"
    day = lambda h, m: datetime.datetime(2026, 1, 1, h, m)
    batches = [[(1, day(8, 0), '{"id":"a"}'), (2, day(8, 1), '{"id":" "}')], [(3, day(8, 5), '{"id":"a"}'), (4, day(9, 0), '{"id":"b"}')], [(5, day(9, 30), '{"id":"a"}'), (6, day(8, 2), '{"id":"c"}')]]
    for batch in batches:
        spark.createDataFrame([("t", 0, o, t, v) for o, t, v in batch], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = first_seen(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), ["id"])
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    got = {r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {1, 2, 4, 5} == got


def test_typed_messages(spark):
    df = spark.createDataFrame([('{"id":"1","at":"2026-01-02T03:04:05","d":"2026-01-02","x":"1.5"}',), ('{"id":"3.7","x":" "}',), ("{torn",), (None,), ('{"d":"02/01/2026"}',)], "value string")
    got = typed(df, StructType.fromDDL("id int, at timestamp, d date, x double")).collect()
    assert [r.corrupt is None for r in got[:3]] == [True, False, False] and got[4].corrupt is not None
    assert (got[0].id, got[0].x, got[0].d) == (1, 1.5, datetime.date(2026, 1, 2)) and got[0].at is not None and got[1].id is None and got[1].x is None
