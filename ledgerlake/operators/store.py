"""Tables of Parquet files: merging by key, replacing partitions, appending, exporting. Plain Spark writers, no log of commits."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there))


def tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables (folders) of a schema."""
    there = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = there.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(there)
    return sorted(s.getPath().getName() for s in listed if s.isDirectory() and s.getPath().getName()[0] not in "._")


def unseen(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new whose key isn't in old, one for each key: what a merge inserts. Only keys of old are read."""
    return new.dropDuplicates(list(keys)).join(old.select(*keys).distinct(), list(keys), "left_anti")


def upserted(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with the rows of new in the place of those with their keys."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def insert_new(new: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = (), within: bool = False) -> None:
    """Append what isn't there by key; a replay appends nothing. With `within`, keys are looked for in the partitions of new alone, where they stay."""
    spark = new.sparkSession
    if exists(spark, path):
        old = spark.read.schema(new.schema).parquet(path)
        old = old.join(new.select(*partitions).distinct(), list(partitions), "left_semi") if within else old
        rows = unseen(new, old, keys)
    else:
        rows = new.dropDuplicates(list(keys))
    append(rows, path, partitions)


def append(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    clustered(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Rewrite the partitions that df has rows of, and no others."""
    clustered(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def upsert(new: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], staging: str) -> None:
    """Put the rows of new in the place of those with their keys, in the partitions of new alone.

    Keys don't move between partitions. What is read and rewritten goes by a staging folder, as one
    plan can't read what it overwrites; new rows are worked out once, however dear they are.
    """
    spark = new.sparkSession
    if exists(spark, path):
        new.write.parquet(f"{staging}/new")
        new = spark.read.schema(new.schema).parquet(f"{staging}/new")
        touched = new.select(*partitions).distinct()
        old = spark.read.schema(new.schema).parquet(path).join(touched, list(partitions), "left_semi")
        upserted(new, old, keys).write.parquet(f"{staging}/all")
        replace_partitions(spark.read.parquet(f"{staging}/all"), path, partitions)
        drop(spark, staging)
    else:
        replace_partitions(new, path, partitions)


def clustered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """df dealt out so that each task writes few partitions, one after the other; large partitions are split by adaptive execution."""
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions) if partitions else df


def drop(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def export_csv(df: DataFrame, path: str, by: str) -> None:
    """One CSV file with a header for each value of a column; reports are small."""
    df.repartition(F.col(by)).sortWithinPartitions(*[c for c in (by, *df.columns)]).write.mode("overwrite").option("header", True).partitionBy(by).csv(path)


def summary_json(df: DataFrame, most: int = 1000) -> str:
    """An ordered frame as one JSON document: `count` of all its rows, the first `most` of them, and how many are left out."""
    count = df.count()
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct(*df.columns))).limit(most).collect()]
    return json.dumps({"count": count, "left_out": count - len(rows), "rows": rows})
