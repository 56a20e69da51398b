"""Tags, lineage, bitmaps, sweeps, pruning and audited loads on planted rows."""

import datetime
import random

from pyspark.sql import functions as F

from ledgerlake.operators import tags
from ledgerlake.operators.contracts import Contract, Rule
from ledgerlake.operators.distincts import bitmaps, rolled_up
from ledgerlake.operators.ingest import Ingestion
from ledgerlake.operators.intervals import valid_sums
from ledgerlake.operators.lineage import sources
from ledgerlake.plans import governance

SF = "/root/testdata/sf0.001"


def test_tags_stay_with_renamed_columns(spark):
    df = tags.tagged(spark.createDataFrame([(1, "FR76 3000 6000 0112", "Kofi Mensah Annan")], "id int, iban string, name string"), {"iban": ["personal.account"], "name": ["personal.name"]})
    df = tags.tagged(df, {"iban": ["regulatory"]}).withColumnRenamed("iban", "x").select("x", F.col("name").alias("y"), F.upper("name").alias("z"), "id")
    assert tags.tags_of(df) == {"x": ["personal.account", "regulatory"], "y": ["personal.name"]}
    assert tags.with_tag(df, "personal") == ["x", "y"] and tags.with_tag(df, "personal.name") == ["y"] and tags.with_tag(df, "person") == []
    seen = tags.policy(df, [F.lit(True)], denied=["regulatory"], hidden=["personal"]).view(df)
    assert seen.columns == ["y", "z", "id"] and seen.first().y == "Kofi****nnan"
    assert tags.policy(df, []).view(df).collect() == []


def test_lineage_follows_the_plan(spark):
    orders, nation = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "nation"))
    assert sources(orders.select("o_custkey")) == {"orders": {"o_custkey"}}
    joined = orders.join(nation, F.col("o_custkey") % 25 == F.col("n_nationkey")).groupBy("n_name").agg(F.sum("o_totalprice"))
    assert sources(joined) == {"orders": {"o_custkey", "o_totalprice"}, "nation": {"n_nationkey", "n_name"}}
    assert sources(spark.range(3)) == {}


def test_bitmaps_count_exactly_at_any_grain(spark):
    r = random.Random(3)
    rows = [(r.randrange(5), r.choice("ab"), r.choice([None, r.randrange(200_000), r.randrange(50)])) for _ in range(3000)] + [(9, "c", None)]
    df = spark.createDataFrame(rows, "day int, country string, who long")
    maps = bitmaps(df, ["day", "country"], "who")
    for keys in (["day", "country"], ["country"], []):
        want = df.where("who IS NOT NULL").groupBy(*keys).agg(F.count_distinct("who").alias("n"))
        assert sorted(map(tuple, rolled_up(maps, keys, "n").collect())) == sorted(map(tuple, want.collect()))


def test_sweep_equals_exploded_months(spark):
    r, day = random.Random(4), lambda m: datetime.date(2024 + m // 12, m % 12 + 1, 1)
    rows = []
    for k in range(60):
        at = r.randrange(12)
        until = r.choice([None, at + 1 + r.randrange(6)])
        rows.append((r.choice("ab"), r.choice("xy"), day(at), None if until is None else day(until), r.randrange(100)))
    states = spark.createDataFrame(rows, "c string, e string, a date, b date, v long")
    last = spark.createDataFrame([("a", day(14)), ("b", day(11))], "c string, last date")
    want = {}
    for c, e, a, b, v in rows:
        for m in map(day, range(20)):
            if a <= m and (b is None or m < b) and m <= day({"a": 14, "b": 11}[c]):
                n, total = want.get((c, e, m), (0, 0))
                want[c, e, m] = (n + 1, total + v)
    got = valid_sums(states, ["c", "e"], "a", "b", last, n=F.lit(1), total=F.col("v"))
    late = {k for k in want if k[2] > day({"a": 14, "b": 11}[k[0]])}
    assert {(r.c, r.e, r.month): (r.n, r.total) for r in got.where(F.col("month") <= day(14)).collect() if not (r.c == "b" and r.month > day(11))} == {k: v for k, v in want.items() if k not in late}


def test_partitions_of_other_countries_are_pruned(spark):
    plan = governance.scan_pruned(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_loads_are_audited_in_one_scan_and_once(spark, tmp_path):
    fit = Contract([Rule("parsed", "torn"), Rule("required", "id")])
    raw = lambda *r: spark.createDataFrame(list(r), "id string, torn string, file string")
    into = Ingestion(spark, str(tmp_path), "t", fit)
    assert into.load(raw(("1", None, "a"), (" ", None, "a"), (None, "x,", "b")), 0, "file")["rows_rejected"] == 2
    for _ in range(2):
        into.load(raw(("2", None, "c")), 1, "file")
    into.load(raw(), 2)
    assert {(r.batch_id, r.rows_read, r.rows_valid, r.rows_rejected, r.files, r.n_reasons) for r in into.log().collect()} == {(0, 3, 1, 2, 2, 3), (1, 1, 1, 0, 1, 0), (2, 0, 0, 0, 0, 0)}
    assert sorted(r.id for r in into.valid().collect()) == ["1", "2"] and sorted(r.reasons for r in into.rejected().collect()) == ["MALFORMED_ROW,MISSING_ID", "MISSING_ID"]
    assert "torn" not in into.valid().columns and all(r._ingested_at and r._batch_id is not None for r in into.written().collect())
