"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
import weakref

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators between words: space and \t to \r.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set, a temporary one, which only a local master can share."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-ledgerlake-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows of texts that are handed to Python at a time, and bytes of any rows.
TEXT_ROWS, BATCH_BYTES = 1000, 4 << 20


def bound_batches(df: DataFrame) -> DataFrame:
    """df, of a session that from now on hands rows to Python in smaller batches, unless it has a setting of its own.

    Spark's default of 10,000 rows is meant for numbers; so many texts take a worker's and Arrow's memory several times over.
    So do Spark's 64 MB a batch where rows hold many tokens: Arrow's buffers double as they grow, for each task of an executor.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.max{}PerBatch"
    if int(conf.get(key.format("Records"))) == 10_000:
        conf.set(key.format("Records"), str(TEXT_ROWS))
    if conf.get(key.format("Bytes")) == "67108864b":
        conf.set(key.format("Bytes"), f"{BATCH_BYTES}b")
    return df


#: Where the frames that saved() returned were written, by the identity of their plan.
_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_TABLES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    return out


def bucketed(df: DataFrame, name: str, by: str, n: int) -> DataFrame:
    """As saved(), in n buckets by a column: what is grouped or joined by it with as many partitions isn't shuffled again."""
    spark, table_name = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/ledgerlake/{table_name}"
    df.write.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).option("compression", "zstd").saveAsTable(table_name)
    out = spark.table(table_name)
    _PLACES[out], _TABLES[out] = path, table_name
    return out


def discard(*frames: DataFrame) -> None:
    """Remove what saved() and bucketed() wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        if named := _TABLES.pop(df, None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {named}")
        if path := _PLACES.pop(df, None):
            there = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(there, True)


#: Copies of a row that one task expands at a time.
PIECE = 10_000


def expanded(df: DataFrame, count: str, out: str, by: list[str]) -> DataFrame:
    """Each row of df as many times as `count` says, numbered from 0 in `out`.

    A row that stands for many is cut into pieces, which are dealt out by `by` and their place before they are expanded,
    so that no task expands a run of copies alone.
    """
    n, piece = F.col(count), "_llp_from"
    few = df.where(n <= PIECE).withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    many = df.where(n > PIECE).withColumn(piece, F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(PIECE).cast("long"))))
    many = many.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(piece, *by))
    many = many.withColumn(out, F.explode(F.sequence(F.col(piece), F.least(F.col(piece) + PIECE, n) - 1))).drop(piece)
    return few.unionByName(many)


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1 and so on for size[0] places, then the same for the next."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def lower_ascii(c: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def replaced(c: Column, chars: str, by: str) -> Column:
    """c with each of these characters replaced; plain searches, faster than patterns or translate."""
    for x in chars:
        c = F.replace(c, F.lit(x), F.lit(by))
    return c


def words(c: Column) -> Column:
    """Array of maximal runs of characters other than SPACE; a null text has none."""
    even = replaced(F.coalesce(c, F.lit("")), SPACES[1:], " ")
    return F.array_remove(F.split(even, " ", -1), "")


def count_words(c: Column) -> Column:
    return F.size(words(c)).cast("long")
