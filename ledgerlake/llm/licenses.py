"""License scan by ordered signature rules, in DataFrame functions only.

Texts are normalised to lower-case words with one space between. A rule is a regular
expression with a keyword: it runs only on texts that hold the keyword. A hit inside the
interval of a hit of higher priority is suppressed. Hits are swept once, by their start, with
the farthest stop so far of each priority. Null and empty texts have no words and no hits;
repeated rows are scanned each on its own; other columns stay. No shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, table
from .signatures import Signature, signatures

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
P = "_lll_"
#: Values gathered before a fold begins another part.
PART = 256
HITS = "array<struct<start:int,stop:int,level:int,priority:int,label:string,base:boolean>>"
RULES = "array<struct<label:string,pattern:string,keyword:string,priority:int,base:boolean,level:int>>"


def normalised(text: Column) -> Column:
    """Lower-case words of the text with one space between."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, " "))


def nothing(kind: str) -> list[Column]:
    """The fields of a fold's state that gather values: full parts, and the last part. Appending copies an array, so that parts are short."""
    return [F.array().cast(f"array<{kind}>").alias("parts"), F.array().cast(kind).alias("part")]


def appended(a: Column, x: Column, when: Column | None = None) -> list[Column]:
    """These fields with one more value (where the condition holds)."""
    when = F.lit(True) if when is None else when
    full = when & (F.size(a["part"]) >= PART)
    return [F.when(full, F.array_append(a["parts"], a["part"])).otherwise(a["parts"]).alias("parts"), F.when(full, F.array(x)).when(when, F.array_append(a["part"], x)).otherwise(a["part"]).alias("part")]


def gathered(a: Column) -> Column:
    return F.flatten(F.array_append(a["parts"], a["part"]))


def _hits(norm: Column, rule: Column) -> Column:
    """Each match of a rule; what splits off before a match tells where it starts."""
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
    gaps = F.split(norm, rule["pattern"], -1)
    begin = F.struct(F.lit(0).alias("at"), *nothing("array<struct<start:int,stop:int>>"))

    def step(a, x):
        start = a["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        return F.struct(stop.alias("at"), *appended(a, F.struct(start.alias("start"), stop.alias("stop"))))

    pairs = F.filter(F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("hit"))), lambda x: x["hit"].isNotNull())
    spans = F.aggregate(pairs, begin, step, gathered)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), rule["level"].alias("level"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["base"].alias("base")))


def unsuppressed(hits: Column, levels: int) -> Column:
    """The hits that lie in no hit of higher priority; level 0 is the highest.

    In order of start, then of stop from the farthest on, a hit can only lie in those before it.
    """
    key = lambda h: F.struct(h["start"].alias("start"), (-h["stop"]).alias("far"), h["level"].alias("level"), h.alias("hit"))
    swept = F.array_sort(F.transform(hits, key))
    none = F.array_repeat(F.lit(-1), levels)

    def step(a, x):
        inside = (x["level"] > 0) & (F.array_max(F.slice(a["far"], 1, F.greatest(x["level"], F.lit(1)))) >= x["hit"]["stop"])
        far = F.transform(a["far"], lambda v, k: F.when(k == x["level"], F.greatest(v, x["hit"]["stop"])).otherwise(v))
        return F.struct(far.alias("far"), *appended(a, x["hit"], ~inside))

    return F.aggregate(swept, F.struct(none.alias("far"), *nothing(HITS)), step, gathered)


def scanned(docs: DataFrame, text: str = "text", rules: Sequence[Signature] | None = None) -> DataFrame:
    """docs with P+norm, P+hits (all) and P+kept (what suppression leaves)."""
    rules = signatures() if rules is None else list(rules)
    order = sorted({r.priority for r in rules}, reverse=True)
    # One literal, folded once; hundreds of struct expressions would slow the planner.
    book = F.from_json(F.lit(json.dumps([asdict(r) | {"level": order.index(r.priority)} for r in rules])), RULES)
    norm, none = F.col(P + "norm"), F.array().cast(HITS)
    # Plain searches, which end at the first keyword found; most texts hold none.
    keywords = F.array(*[F.lit(k) for k in gate({r.keyword for r in rules})])
    asked = F.filter(book, lambda r: F.contains(norm, r["keyword"]))
    df = docs.withColumn(P + "norm", normalised(F.col(text)))
    df = df.withColumn(P + "hits", F.when(F.exists(keywords, lambda k: F.contains(norm, k)), F.flatten(F.transform(asked, lambda r: _hits(norm, r)))).otherwise(none))
    hits = F.col(P + "hits")
    return df.withColumn(P + "kept", F.when(F.size(hits) > 0, unsuppressed(hits, max(1, len(order)))).otherwise(none))


def gate(keywords: set[str]) -> list[str]:
    """Keywords without those that hold another one: a text with a keyword has one of these."""
    return sorted(k for k in keywords if not any(o != k and o in k for o in keywords))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    norm, hits, kept = (F.col(P + c) for c in ("norm", "hits", "kept"))
    base = F.filter(hits, lambda h: h["base"])
    df = df.select(
        "doc_id",
        (F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1)).cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        norm.alias("norm"),
        F.array_min(F.transform(base, lambda h: h["start"])).alias("a"),
        F.array_max(F.transform(base, lambda h: h["start"])).alias("b"),
        F.array_sort(F.array_distinct(F.transform(base, lambda h: h["label"]))).alias("of_base"),
        F.transform(kept, lambda h: h["label"]).alias("of_kept"),
        (F.coalesce(F.array_max(F.transform(kept, lambda h: h["priority"])), F.lit(0)) / 100.0).alias("score"),
    )
    before = lambda c: F.regexp_count(F.substring(F.col("norm"), F.lit(1), F.col(c)), F.lit(" ")).cast("long")
    return df.select(
        "doc_id", "n_words", "n_base", F.when(F.col("a").isNotNull(), before("a")).alias("first_word"), F.when(F.col("b").isNotNull(), before("b")).alias("last_word"),
        F.array_join("of_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("of_base", "of_kept")), ",").alias("labels"), "score",
    )
