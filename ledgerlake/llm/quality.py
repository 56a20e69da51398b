"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule carries its own measure, an expression of the text that stands inside the rule's branch:
a text that one rule rejects never pays for the measures of the rules after it. Each rule's
cost and rejections are taken on a sample, from the text, and the rules are ordered by
rejections per second. The order changes what a cascade costs, never its verdict.

Nulls: a null text has no words, so it fails the word count. Empty tables give empty results
and leave the rules in their order. Repeated rows are judged each on its own. Other columns
stay, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, count_words, replaced, table, words

#: Characters that count as symbols (fixed values).
SYMBOLS = "#*$%&|<>"
P = "_llq_"
#: Rows of the sample that the order is estimated on, about.
SAMPLE_ROWS = 2000


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def word_chars(t: Column) -> Column:
    return F.length(t) - outside(t, SPACES)


def outside(t: Column, chars: str) -> Column:
    """How many of these ASCII characters a text has."""
    return (F.octet_length(t) - F.octet_length(replaced(t, chars, ""))).cast("long")


def lines(t: Column) -> Column:
    return F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(t: Column) -> Column:
    return bound(lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def total_length(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("long"), lambda a, s: a + F.length(s))


def n_repeat_words(t: Column) -> Column:
    """Words in 3-word windows that are found twice or more."""

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        # Sorted by their words, equal windows stand side by side.
        return F.when(F.size(w) >= 3, F.sort_array(F.transform(at, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("at")))))

    def covered(s: Column) -> Column:
        same = lambda x, y: x["w"] == F.coalesce(y["w"], F.lit(""))
        twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        start = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(F.array_sort(F.transform(twice, lambda x: x["at"])), start, lambda a, at: F.struct(at.alias("last"), (a["n"] + F.least(F.lit(3), at - a["last"])).alias("n")), lambda a: a["n"])

    return F.coalesce(bound(words(t), lambda w: bound(windows(w), covered)), F.lit(0)).cast("long")


#: Measures that the query returns too.
MEASURES = {"n_words": count_words, "word_chars": word_chars, "n_symbols": lambda t: outside(t, SYMBOLS), "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


def of_text(t: Column) -> Callable[[str], Column]:
    """Each measure as an expression of the text."""
    return lambda name: MEASURES[name](t)


@dataclass(frozen=True)
class Rule:
    """fails(text, measure) tells whether a text that isn't null breaks the rule; integers only, so that any engine decides alike.

    measure(name) is an expression of the text, or the column that already holds what it gives.
    """

    name: str
    fails: Callable[[Column, Callable[[str], Column]], Column]


BASE = (
    Rule("few_words", lambda t, m: m("n_words") < 50),
    Rule("repeats", lambda t, m: 100 * m("n_repeat_words") > 50 * m("n_words")),
)
FURTHER = (
    Rule("symbols", lambda t, m: 10 * m("n_symbols") > m("n_words")),
    Rule("dup_lines", lambda t, m: bound(lines(t), lambda x: 100 * (total_length(x) - total_length(F.array_distinct(x))) > 50 * total_length(x))),
    Rule("word_length", lambda t, m: bound(F.struct(m("word_chars").alias("c"), m("n_words").alias("n")), lambda x: (x["c"] < 2 * x["n"]) | (x["c"] > 20 * x["n"]))),
    Rule("digits", lambda t, m: 2 * outside(t, "0123456789") > m("word_chars")),
)


def seconds(sample: DataFrame, c: Column) -> tuple[float, int]:
    """(time, rows for which c holds) of one pass over the sample, compiled code and all."""
    took, n = [], 0
    for _ in range(2):
        began = time.perf_counter()
        n = sample.agg(F.count_if(c)).first()[0]
        took.append(time.perf_counter() - began)
    return min(took), n


def ordered(docs: DataFrame, text: str, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second of their measure, best first; ties keep their order."""
    sample = docs.select(F.col(text).alias("t")).sample(min(1.0, sample_rows / max(1, docs.count())), seed=7).select(text_of(F.col("t")).alias("t")).persist()
    try:
        if sample.isEmpty():
            return list(rules)
        idle = seconds(sample, F.length("t") < 0)[0]
        gain = {}
        for r in rules:
            took, rejected = seconds(sample, r.fails(F.col("t"), of_text(F.col("t"))))
            gain[r.name] = rejected / max(took - idle, 1e-3)
        return sorted(rules, key=lambda r: -gain[r.name])
    finally:
        sample.unpersist()


def cascade(rules: Sequence[Rule], text: Column, measure: Callable[[str], Column] | None = None) -> Column:
    """Name of the first rule that fails, or null; the measures of later rules aren't worked out then."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(r.fails(text, measure or of_text(text)), F.lit(r.name)).otherwise(out)
    return out


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = (*BASE, *FURTHER), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that pass every rule, with the columns of docs; base rules are ordered like the others."""
    return docs.where(cascade(ordered(docs, text, rules, sample_rows), text_of(F.col(text))).isNull())


def judged(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the base measures, P+base_failed and P+failed (base, a further rule's name, or null)."""
    t, there = text_of(F.col(text)), lambda name: F.col(P + name)
    df = docs.withColumns({P + k: f(t) for k, f in MEASURES.items()})
    # The base measures are returned, so rules read them; what isn't returned stays in its rule's branch.
    base = BASE[0].fails(t, there) | BASE[1].fails(t, there)
    rules = ordered(docs, text, FURTHER, sample_rows)
    df = df.withColumn(P + "base_failed", base)
    return df.withColumn(P + "failed", F.when(F.col(P + "base_failed"), F.lit("base")).otherwise(cascade(rules, t, there)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return df.select("doc_id", *[F.col(P + c).alias(c) for c in out], F.col(P + "failed").isNull().alias("kept"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
f AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM g),
p AS (SELECT rid, count(DISTINCT i + k) AS n_repeat FROM f, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS BIGINT) AS n_digits,
  CAST(length(array_to_string(ls, '')) AS BIGINT) AS line_chars, CAST(length(array_to_string(list_distinct(ls), '')) AS BIGINT) AS own_chars,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN p USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR coalesce(100 * (line_chars - own_chars) > 50 * line_chars, FALSE)
       OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_digits > word_chars) AS kept FROM b
"""
