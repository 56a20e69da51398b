"""op3: the cascade saves work, and the verdicts leave clean documents alone."""

import duckdb
import pytest

from pyspark.sql import functions as F

from ledgerlake.llm import quality
from ledgerlake.llm.quality import Rule

DOC = "doc_id long, text string, _llq_n_words string"


def test_a_measure_stands_in_its_branch_alone(spark):
    boom = Rule("boom", lambda t, m: F.raise_error(F.concat(F.lit("measured: "), t)).isNotNull())
    first = Rule("short", lambda t, m: F.length(t) < 5)
    docs = spark.createDataFrame([("abc",), ("de",)], "text string")
    assert docs.where(quality.cascade([first, boom], F.col("text")).isNull()).collect() == []
    with pytest.raises(Exception, match="measured"):
        docs.where(quality.cascade([boom, first], F.col("text")).isNull()).collect()


def test_order_is_by_rejections_per_cost(spark):
    slow = Rule("slow", lambda t, m: F.aggregate(F.sequence(F.lit(1), F.lit(3000)), F.length(t).cast("long"), lambda a, x: (a * 31 + x) % 1_000_003) < 0)
    docs = spark.createDataFrame([("x" * (k % 7),) for k in range(1500)], "text string")
    half, few = Rule("half", lambda t, m: F.length(t) < 4), Rule("few", lambda t, m: F.length(t) < 1)
    costly_half = Rule("costly_half", lambda t, m: slow.fails(t, m) | (F.length(t) < 4))
    assert [r.name for r in quality.ordered(docs, "text", [costly_half, few, half])][0] == "half"
    assert [r.name for r in quality.ordered(docs, "text", [costly_half, half])] == ["half", "costly_half"]
    assert quality.ordered(docs.limit(0), "text", [few, half]) == [few, half]


def letters(n):
    """n different words."""
    return ["w" + "".join("abcdefghij"[int(d)] for d in str(k)) for k in range(n)]


EDGES = [(1, None, "c"), (2, "", None), (3, "a b\na b\n", "c"), (3, "a b\na b\n", "c"), (None, "x " * 60, None), (5, " ".join(letters(60)), "c"), (6, "# " * 60, "c"), (7, " ".join(letters(30_000)), "c"), (8, " ".join(f"n{k}" for k in range(1000, 1060)), "c")]


def test_edges(spark, tmp_path):
    spark.createDataFrame(EDGES, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.op3_quality_rules(spark, str(tmp_path)).collect()}
    chars = lambda n: sum(map(len, letters(n)))
    assert got == {(1, 0, 0, 0, 0, 0, True, False), (2, 0, 0, 0, 0, 0, True, False), (3, 4, 4, 0, 1, 0, True, False), (None, 60, 60, 0, 0, 60, True, False), (5, 60, chars(60), 0, 0, 0, False, True), (6, 60, 60, 60, 0, 60, True, False), (7, 30_000, chars(30_000), 0, 0, 0, False, True), (8, 60, 300, 0, 0, 0, False, False)}
    docs = spark.createDataFrame(EDGES, DOC)
    assert sorted((r.doc_id, r["_llq_n_words"]) for r in quality.keep(docs).collect()) == [(5, "c"), (7, "c")]


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    good = {i for (i,) in duckdb.connect().execute(f"SELECT doc_id FROM '{sf}/labels.parquet' GROUP BY 1 HAVING min(quality) = 1").fetchall()}
    rows = [r for r in quality.op3_quality_rules(spark, sf).collect() if r.doc_id in good]
    lost = [r.doc_id for r in rows if not r.kept and not r.base_failed]
    print("clean documents", len(rows), "lost beside the base rules", len(lost))
    assert rows and not lost
