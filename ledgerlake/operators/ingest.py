"""Loads of raw rows under a contract: one pass that stamps, judges, counts and writes, and an audit table of what it counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import store
from ledgerlake.operators.contracts import Contract

AUDIT = "dataset string, rows_read long, rows_valid long, rows_rejected long, files long, n_reasons long, ingested_at timestamp, batch_id int"


class Ingestion:
    """Valid and rejected rows of a dataset in one table, apart by folder, and an audit row for each load.

    Rows carry `_ingested_at` and `_batch_id`. Counts are observed while the rows are written, so that a load reads its source once.
    A load that comes again with its batch id replaces itself in both tables: nothing counts twice.
    """

    def __init__(self, spark: SparkSession, root: str, dataset: str, contract: Contract):
        self.spark, self.rows, self.audit, self.dataset, self.contract = spark, f"{root}/rows", f"{root}/audit", dataset, contract

    def load(self, raw: DataFrame, batch_id: int, source: str | None = None) -> dict:
        """Write a batch; returns its audit row. `source` is a column with the name of a row's file."""
        if raw.isEmpty():  # the planner leaves an empty frame's observation out
            counts, n_files = dict.fromkeys(("rows_read", "rows_rejected", "n_reasons"), 0) | {"ingested_at": None}, 0
        else:
            counts = self._written(raw, batch_id)
            n_files = self.written(batch_id).agg(F.count_distinct(source)).first()[0] if source else 0
        row = {"dataset": self.dataset, "rows_read": counts["rows_read"], "rows_valid": counts["rows_read"] - counts["rows_rejected"], "rows_rejected": counts["rows_rejected"], "files": n_files, "n_reasons": counts["n_reasons"], "ingested_at": counts["ingested_at"], "batch_id": batch_id}
        store.replace_partitions(self.spark.createDataFrame([tuple(row.values())], AUDIT), self.audit, ["batch_id"])
        return row

    def _written(self, raw: DataFrame, batch_id: int) -> dict:
        """Stamp, judge, count and write in one pass; the counts."""
        seen, bad = Observation(), F.col("_rejected")
        told = raw.withColumn("_reasons", self.contract.reasons()).withColumns({"_rejected": F.size("_reasons") > 0, "_ingested_at": F.current_timestamp(), "_batch_id": F.lit(batch_id)})
        told = told.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.coalesce(F.count_if(bad), F.lit(0)).alias("rows_rejected"), F.coalesce(F.sum(F.size("_reasons")), F.lit(0)).cast("long").alias("n_reasons"), F.max("_ingested_at").alias("ingested_at"))
        store.replace_partitions(told, self.rows, ["_batch_id", "_rejected"])
        return seen.get

    def written(self, batch_id: int | None = None) -> DataFrame:
        rows = self.spark.read.parquet(self.rows).withColumn("_rejected", F.col("_rejected").cast("boolean"))
        return rows if batch_id is None else rows.where(F.col("_batch_id") == batch_id)

    def valid(self) -> DataFrame:
        return self.written().where("NOT _rejected").drop("_reasons", "_rejected", *([self.contract.corrupt] if self.contract.corrupt else []))

    def rejected(self) -> DataFrame:
        return self.written().where("_rejected").withColumn("reasons", F.array_join("_reasons", ",")).drop("_reasons", "_rejected")

    def log(self) -> DataFrame:
        return self.spark.read.schema(AUDIT).parquet(self.audit)
