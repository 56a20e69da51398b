"""Landing files: CSV with a schema, discovery by country, lineage, archives."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT, SOURCE = "_corrupt_record", "_source_file"
STAMP, DAY = "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd"


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Rows of CSV files with a header. A row that doesn't fit the schema keeps its text in CORRUPT and nulls where it
    fails; SOURCE names the row's file. Every column is parsed, whichever are asked for, so that the corrupt text is always
    filled; Spark wants the rows cached or saved before a query asks for that text alone."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.option("timestampFormat", STAMP).option("dateFormat", DAY).option("enforceSchema", True).option("columnPruning", False).csv(paths)
    return df.withColumn(SOURCE, F.col("_metadata.file_path"))


def landed(spark: SparkSession, root: str, dataset: str, countries: Iterable[str] | None = None, older_than_s: float = 0.0) -> DataFrame:
    """(path, size, modified, country) of the CSV files of a dataset, by the folders of the countries asked for alone.

    Empty files and those younger than older_than_s are passed by: they may still be written.
    """
    where = [f"{root}/{dataset}/{c}" for c in countries] if countries is not None else [f"{root}/{dataset}/*"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(where).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    old = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("modified") >= F.lit(older_than_s)
    return files.where((F.col("size") > 0) & old).withColumn("country", F.element_at(F.split("path", "/"), -2)).orderBy("path")


def archived(spark: SparkSession, path: str, to: str) -> bool:
    """Move a file into a folder; again does nothing. Tells whether the file is there afterwards."""
    old, folder = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(to)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    new = spark._jvm.org.apache.hadoop.fs.Path(folder, old.getName())
    fs.mkdirs(folder)
    if fs.exists(old) and not fs.exists(new):
        fs.rename(old, new)
    return bool(fs.exists(new))
