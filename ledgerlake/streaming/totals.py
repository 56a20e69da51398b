"""Sums by key and day that history, what streams have written and the batch at hand add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import micros
from ledgerlake.operators import store

HISTORY = -1


class DailyTotals:
    """key, day, total (whole millionths), n in a folder, a partition for each batch.

    A batch that is replayed replaces its own partition, and what it sees of others is what came before it: it gives
    what it gave. Rows are aggregated by key and day before they are written.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, day: str, value: str):
        self.spark, self.path, self.key, self.day, self.value = spark, path, key, day, value

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key, self.day).agg(micros(F.col(self.value)).alias("total"), F.count(self.value).alias("n"))

    def put(self, rows: DataFrame, batch: int = HISTORY) -> None:
        store.replace_partitions(self.of(rows).withColumn("batch", F.lit(batch)), self.path, ["batch"])

    def before(self, batch: int) -> DataFrame:
        """What history and earlier batches have written."""
        shape = f"{self.key} long, {self.day} date, total long, n long, batch int"
        there = self.spark.read.schema(shape).parquet(self.path) if store.exists(self.spark, self.path) else self.spark.createDataFrame([], shape)
        return there.where(F.col("batch") < batch).drop("batch")

    def upto(self, batch: int, rows: DataFrame, days: Column | None = None) -> DataFrame:
        """key, total, n over all that came by this batch, whose rows are `rows`, on the days for which the condition holds."""
        both = self.before(batch).unionByName(self.of(rows))
        both = both if days is None else both.where(days)
        return both.groupBy(self.key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
