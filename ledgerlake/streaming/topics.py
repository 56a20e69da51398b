"""Streams of text messages: keys, duplicates, typed parsing, rejects. The same functions serve batches.

A message has topic, partition, offset, timestamp (of arrival) and value (JSON text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampType

from ledgerlake.functions.expressions import present


def message_key(fields: Sequence[str]) -> Column:
    """The first of these JSON fields that isn't blank, or else the message's place."""
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return F.coalesce(*[present(F.get_json_object("value", f"$.{f}")) for f in fields], place)


def first_seen(messages: DataFrame, fields: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """Messages without those whose key came before, within the lateness by time of arrival (business times span months)."""
    keyed = messages.withColumn("message_key", message_key(fields)).withWatermark("timestamp", late)
    return keyed.dropDuplicatesWithinWatermark(["topic", "message_key"])


def typed(messages: DataFrame, schema: StructType) -> DataFrame:
    """messages with the fields of the schema, and `corrupt`: the text where it isn't JSON or a field doesn't fit its type.

    Fields are read as text and cast with try_cast, so that a bad value makes a null and a mark instead of an error.
    """
    text = StructType([f.__class__(f.name, StringType()) for f in schema.fields])
    raw = messages.withColumn("_raw", F.from_json("value", text)).withColumn("_json", F.try_parse_json("value").isNotNull())

    def fitted(name: str, kind) -> Column:
        c = present(F.col(f"_raw.{name}"))
        if isinstance(kind, TimestampType):
            return F.try_to_timestamp(c)
        if isinstance(kind, DateType):
            return F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
        return c.try_cast(kind)

    fields = {f.name: fitted(f.name, f.dataType) for f in schema.fields}
    lost = [present(F.col(f"_raw.{n}")).isNotNull() & c.isNull() for n, c in fields.items()]
    bad = ~F.col("_json")
    for x in lost:
        bad = bad | x
    return raw.withColumns(fields | {"corrupt": F.when(F.coalesce(bad, F.lit(True)), F.col("value"))}).drop("_raw", "_json")


def dead_letters(rejected: DataFrame, dataset: str, key: str) -> DataFrame:
    """Rejected messages with all reasons and where they came from."""
    return rejected.select(F.lit(dataset).alias("dataset"), "topic", "partition", "offset", F.col(key).cast("string").alias("record_id"), F.split("reasons", ",").alias("reasons"), F.col("value").alias("raw_value"))
