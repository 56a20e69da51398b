"""Pipeline over documents: five stages, each reading what the one before it wrote.

A stage keeps rows with the columns of documents as they are, but for the last:
* toxicity: rows whose score is below one half; null and empty texts have the score of a text without words.
* quality_rules: rows whose text passes every rule; null, empty and short texts go.
* ngram_jaccard: one row of each group of linked texts, that of the least (id, class, row hash); rows with a null
  id or without words stay, repeated rows are one.
* mixing: each row as many times as its source's rate and its own hash say; a null source is one of its own.
* sentencepiece: a row of digests for each row, copies included; a null text is empty.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import jaccard, mixing, quality, sentencepiece, toxicity
from ledgerlake.llm.common import saved, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(docs)


STAGES = [("toxicity", toxic_out), ("quality_rules", quality_rules), ("ngram_jaccard", near_duplicates), ("mixing", mix), ("sentencepiece", encode)]

#: The field's scores and the tokenizer can't be written in SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
