"""Feeds, late rows, windows that come again, replayed batches, and sums and limits that streams share with history."""

import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.cleanse import sized
from ledgerlake.plans import alerts, streams
from ledgerlake.streaming.feeds import Feed, caught_up, lots_by_time
from ledgerlake.streaming.totals import DailyTotals

SF = "/root/testdata/sf0.001"
OPS = "id string, account long, country string, entity string, ts timestamp, type string, status string, eur double, lot int"


def op(lot, k, hour, minute, status="SUCCESS"):
    return (f"o{k}", 1, "CI", "BANK", datetime.datetime(2026, 1, 1, hour, minute), "TRANSFER", status, 800.0, lot)


def run(spark, tmp_path, rows):
    feed = Feed(spark.createDataFrame(rows, OPS).repartition(3), "lot", "planted")
    sink, mark = str(tmp_path / "sink"), str(tmp_path / "mark")
    start = lambda: alerts.large_windows(feed.stream(), late=alerts.LATE).writeStream.outputMode("update").option("checkpointLocation", mark).foreachBatch(partial(streams.upserted, sink, alerts.burst_alerts))
    told = feed.each(start)
    return {r.window_start: (r.n_ops, tuple(r.ids)) for r in spark.read.parquet(sink).collect()}, told, feed


def test_windows_grow_over_batches_and_late_rows_are_left_out(spark, tmp_path):
    rows = [op(0, 1, 12, 4), op(0, 2, 12, 4), op(1, 3, 12, 4), op(1, 9, 12, 4, "FAILED"), op(2, 4, 12, 3), op(2, 5, 13, 0), op(3, 6, 12, 4)]
    got, told, feed = run(spark, tmp_path, rows)
    at = lambda m: datetime.datetime(2026, 1, 1, 12, m)
    # o4 comes within the lateness and joins the windows that hold it; o6 comes after 12:50 and joins none
    assert got == {at(m): (4, ("o1", "o2", "o3", "o4")) if m < 4 else (3, ("o1", "o2", "o3")) for m in range(5)}
    assert feed.lots == [0, 1, 2, 3] and sum(t["rows"] for t in told) == 7 and len({t["batch"] for t in told if t["rows"]}) == 4


def test_posted_operations_have_late_rows(spark):
    """The registered streams' rows come in five lots, some of them after their windows are over."""
    rows = streams.posted(spark, "/root/testdata/sf0.01").where("status = 'SUCCESS'")
    marks = {r.lot: r.last for r in rows.groupBy("lot").agg(F.max("ts").alias("last")).collect()}
    late = [r for r in rows.where("lot > 0").collect() if r.ts + datetime.timedelta(minutes=5) <= max(m for k, m in marks.items() if k < r.lot) - datetime.timedelta(minutes=10)]
    assert len(marks) == 5 and late


def test_a_replayed_batch_changes_nothing(spark):
    """The last batch's commit is taken away, as if the driver had died before it: Spark runs that batch again."""
    feed, sinks, start = streams.silver_feed(spark, SF)
    feed.each(start)
    read = lambda: [sorted(map(str, spark.read.parquet(sinks[k]).collect())) for k in ("silver", "dead")]
    before = read()
    path = spark._jvm.org.apache.hadoop.fs.Path
    commits = path(f"{sinks['checkpoint']}/commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(int(s.getPath().getName()) for s in fs.listStatus(commits) if s.getPath().getName().isdigit())
    for name in (f"{last}", f".{last}.crc"):
        fs.delete(path(commits, name), False)
    again = caught_up(start())
    assert [t["batch"] for t in again if t["rows"]] == [last] and read() == before and before[0] and before[1]


def test_totals_of_history_batches_and_now(spark, tmp_path):
    shape = "client long, day date, eur double"
    day = lambda d: datetime.date(2026, 1, d)
    rows = lambda *r: spark.createDataFrame(list(r), shape)
    paid = DailyTotals(spark, str(tmp_path / "paid"), "client", "day", "eur")
    assert paid.upto(0, rows((1, day(1), 2.0))).collect()[0].total == 2_000_000  # nothing written yet
    paid.put(rows((1, day(1), 10.0), (2, day(1), 5.0)))
    for _ in range(2):  # a replay counts once
        paid.put(rows((1, day(2), 20.0), (1, day(2), 1.0)), 0)
    assert {(r.client, r.total, r.n) for r in paid.upto(1, rows((1, day(3), 30.0))).collect()} == {(1, 61_000_000, 4), (2, 5_000_000, 1)}
    assert {(r.client, r.total) for r in paid.upto(0, rows((1, day(2), 20.0), (1, day(2), 1.0))).collect()} == {(1, 31_000_000), (2, 5_000_000)}
    assert {(r.client, r.total) for r in paid.upto(1, rows((3, day(3), None)), F.col("day") >= day(2)).collect()} == {(1, 21_000_000), (3, None)}


def test_only_small_dimensions_are_sent_to_all_tasks(spark):
    dim = spark.range(1000).withColumn("name", F.lit("x" * 50))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(sized(dim)) and not hinted(sized(dim, most=10_000)) and hinted(sized(dim.where("false"), most=0))


def test_lots_span_the_time(spark):
    df = spark.range(100).select(F.timestamp_seconds("id").alias("ts"), (F.col("id") == 10).alias("late"))
    got = lots_by_time(df, "ts", 4, F.col("late"))
    assert [r["count"] for r in got.groupBy("lot").count().orderBy("lot").collect()] == pytest.approx([25, 25, 25, 25], abs=2)
    assert got.where("late").first().lot == 1 and lots_by_time(df.where("false"), "ts", 4).collect() == []
