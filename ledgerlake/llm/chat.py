"""Chat formatting by rotation of perspectives, in DataFrame functions only.

Each participant of a dialogue is the assistant once; the others are then users with their
names. A row of the result is one message as one perspective sees it, with the place of the
rendered message in the whole rendered dialogue and the span to train on (the text and its
end mark where the assistant speaks, else null). Offsets count code points. Joined in order
of position, the rows of a perspective are the whole dialogue.

System messages are context: no perspective, never trained on. A null speaker is a user
without a name and has no perspective. A dialogue without participants is rendered once,
with a null perspective. A message with a null conversation is a dialogue of its own. A null
text is empty. Null turns come last; ties of turn are in order of speaker (null first), then of
the text's md5; repeated rows are all rendered. An empty table gives no rows.

Positions are worked out without the texts: sums within blocks of turns, then over blocks, so
that a long dialogue is spread over tasks. Rows grow with participants times messages, which
is what the rotation asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import expanded, table

#: Turns in a block of the sums.
BLOCK = 256
START, STOP = "<|im_start|>", "<|im_end|>"


def safe(c: Column) -> Column:
    """Text that can't be taken for a mark of the format."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def seen_as() -> Column:
    """What a speaker is in a perspective."""
    return F.when(F.col("speaker") == "system", "system").when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")


def header() -> Column:
    name = F.coalesce(F.concat(F.lit(" name="), F.regexp_replace(safe(F.col("speaker")), r"\s", " ")), F.lit(""))
    return F.concat(F.lit(START), F.col("seen_as"), F.when(F.col("seen_as") == "user", name).otherwise(""), F.lit("\n"))


def is_participant(c: Column) -> Column:
    return F.coalesce(c != "system", F.lit(False))


def placed(m: DataFrame) -> DataFrame:
    """m (conv, turn, speaker, mark, size, copies) for each perspective, with position and start of the first copy."""
    who = m.where(is_participant(F.col("speaker"))).select("conv", F.col("speaker").alias("perspective")).distinct()
    df = m.join(who, "conv", "left").withColumn("seen_as", seen_as()).withColumn("head", F.length(header()).cast("long"))
    df = df.withColumn("length", F.col("head") + F.col("size") + len(STOP) + 1).withColumn("block", F.floor(F.col("turn") / BLOCK))
    key = ["conv", "perspective"]
    before = (Window.unboundedPreceding, -1)
    over = Window.partitionBy(*key).orderBy(F.col("block").asc_nulls_last()).rowsBetween(*before)
    sums = df.groupBy(*key, "block").agg(F.sum("copies").alias("k"), F.sum(F.col("copies") * F.col("length")).alias("s"))
    sums = sums.select(F.struct(*key, "block").alias("at"), F.coalesce(F.sum("k").over(over), F.lit(0)).alias("k0"), F.coalesce(F.sum("s").over(over), F.lit(0)).alias("s0"))
    within = Window.partitionBy(*key, "block").orderBy(F.col("turn").asc_nulls_last(), F.col("speaker").asc_nulls_first(), "mark").rowsBetween(*before)
    df = df.withColumn("k1", F.coalesce(F.sum("copies").over(within), F.lit(0))).withColumn("s1", F.coalesce(F.sum(F.col("copies") * F.col("length")).over(within), F.lit(0)))
    return df.join(sums, F.struct(*key, "block").eqNullSafe(F.col("at"))).withColumn("position", F.col("k0") + F.col("k1")).withColumn("start", F.col("s0") + F.col("s1"))


def rotated(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """(conv, perspective, position, turn, speaker, seen_as, rendered, start, stop, train_start, train_stop) of messages."""
    body = safe(F.coalesce(F.col(text), F.lit("")))
    m = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(speaker).alias("speaker"), body.alias("body"))
    key = ["conv", "turn", "speaker", "mark"]
    full = m.where("conv IS NOT NULL").withColumn("mark", F.md5("body"))
    thin = full.select(*key, F.length("body").cast("long").alias("size")).groupBy(*key, "size").agg(F.count("*").alias("copies"))
    at = placed(thin)
    texts = full.groupBy(*key).agg(F.max("body").alias("body")).select(*[F.col(k).alias(f"t_{k}") for k in key], "body")
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in key]
    many = expanded(at.join(texts, same), "copies", "copy", key)
    many = many.withColumn("position", F.col("position") + F.col("copy")).withColumn("start", F.col("start") + F.col("copy") * F.col("length"))
    alone = m.where("conv IS NULL").withColumn("perspective", F.when(is_participant(F.col("speaker")), F.col("speaker"))).withColumn("seen_as", seen_as())
    alone = alone.withColumn("position", F.lit(0).cast("long")).withColumn("start", F.lit(0).cast("long"))
    common = ["conv", "perspective", "position", "turn", "speaker", "seen_as", "body", "start"]
    df = many.select(*common).unionByName(alone.select(*common))
    df = df.withColumn("head", header()).withColumn("rendered", F.concat("head", "body", F.lit(STOP + "\n"))).withColumn("stop", F.col("start") + F.length("rendered"))
    trained = F.col("seen_as") == "assistant"
    spans = [F.when(trained, F.col("start") + F.length("head")).alias("train_start"), F.when(trained, F.col("stop") - 1).alias("train_stop")]
    return df.select("conv", "perspective", "position", "turn", "speaker", "seen_as", "rendered", "start", "stop", *spans)


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


ORACLE = r"""
WITH m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
d AS (SELECT *, CASE WHEN conv_id IS NULL THEN 'r' || rid ELSE 'c' || conv_id END AS dialogue FROM m),
w AS (SELECT DISTINCT dialogue, speaker AS perspective FROM d WHERE speaker <> 'system'),
s AS (SELECT d.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS seen_as
  FROM d LEFT JOIN w USING (dialogue)),
h AS (SELECT *, '<|im_start|>' || seen_as || CASE WHEN seen_as = 'user' AND speaker IS NOT NULL
  THEN ' name=' || regexp_replace(replace(speaker, '<|', '< |'), '\s', ' ', 'g') ELSE '' END || chr(10) AS head FROM s),
r AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS rendered FROM h),
o AS (SELECT *, CAST(row_number() OVER p - 1 AS BIGINT) AS "position", CAST(sum(length(rendered)) OVER p AS BIGINT) AS stop FROM r
  WINDOW p AS (PARTITION BY dialogue, perspective ORDER BY turn NULLS LAST, speaker NULLS FIRST, md5(body), rid ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, "position", turn, speaker, seen_as, rendered, CAST(stop - length(rendered) AS BIGINT) AS "start", stop,
  CASE WHEN seen_as = 'assistant' THEN CAST(stop - length(rendered) + length(head) AS BIGINT) END AS train_start,
  CASE WHEN seen_as = 'assistant' THEN stop - 1 END AS train_stop FROM o
"""
