"""Feeds of files that arrive one lot after the other, and queries that run over them with one checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerlake.sources.scratch import new_place


class Feed:
    """Rows dealt to lots by a number; land(k) opens lot k to streams by one rename of its folder, so that it is seen whole."""

    def __init__(self, rows: DataFrame, by: str, name: str):
        self.spark, self.by, self.schema = rows.sparkSession, by, rows.drop(by).schema
        self.staged, self.open = new_place(self.spark, f"{name}-staged"), new_place(self.spark, f"{name}-feed")
        rows.write.partitionBy(by).parquet(self.staged)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        self.fs = path(self.staged).getFileSystem(self.spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(path(self.open))
        names = [s.getPath().getName() for s in self.fs.listStatus(path(self.staged))]
        self.lots = sorted(int(n.removeprefix(f"{by}=")) for n in names if n.startswith(f"{by}="))

    def land(self, lot: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        if not self.fs.rename(path(f"{self.staged}/{self.by}={lot}"), path(f"{self.open}/lot-{lot}")):
            raise OSError(f"lot {lot} can't be moved to {self.open}")

    def stream(self, **options: str) -> DataFrame:
        return self.spark.readStream.schema(self.schema).options(recursiveFileLookup="true", **options).parquet(self.open)

    def each(self, *starts: Callable[[], DataStreamWriter]) -> list[dict]:
        """Land each lot and let the queries take all there is, one after the other; returns the progress of their batches.

        A query is started anew for each lot and goes on from its checkpoint, as after a restart.
        """
        told = []
        for lot in self.lots:
            self.land(lot)
            for start in starts:
                told += caught_up(start())
        return told


    def live(self, start: Callable[[], DataStreamWriter], every: str) -> list[dict]:
        """Land the lots under a query that keeps running and looks for more so often; it is stopped when it has taken the last one."""
        query = start().trigger(processingTime=every).start()
        try:
            for lot in self.lots:
                self.land(lot)
                query.processAllAvailable()
            return [{"batch": p["batchId"], "rows": p["numInputRows"]} for p in query.recentProgress]
        finally:
            query.stop()


def caught_up(writer: DataStreamWriter) -> list[dict]:
    """Run a query until it has taken all that has arrived; an error of the query is raised here."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return [{"batch": p["batchId"], "rows": p["numInputRows"]} for p in query.recentProgress]


def lots_by_time(rows: DataFrame, ts: str, n: int, late: object = None) -> DataFrame:
    """rows with `lot`: 0 to n - 1 by equal parts of the time they span, one more for rows that are `late` (a condition).

    The span is one row, which the planner may send to all tasks.
    """
    second = F.unix_micros(F.col(ts))
    span = rows.agg(F.min(second).alias("_a"), F.max(second).alias("_b"))
    part = F.floor((second - F.col("_a")) * n / (F.col("_b") - F.col("_a") + 1)).cast("int")
    rows = rows.crossJoin(F.broadcast(span)).withColumn("lot", part if late is None else part + F.when(late, 1).otherwise(0))
    return rows.drop("_a", "_b")
