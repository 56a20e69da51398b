"""Hard negatives of anchors by blocked products of whole numbers.

Anchors are taken in blocks of ANCHORS rows. A block is sent to the tasks, which multiply it with the blocks of
candidates that they hold, in double precision (exact below 2^53; whole numbers of 64 bits beyond that). The first
pass keeps the best rows of an anchor's own label, task by task, and merges what tasks found by their rank; the
second pass, which knows the positives' scores, keeps the best rows of other labels in each positive's window.
The work is anchors times rows, as the search asks; vectors aren't shuffled, only what tasks keep of them, which is
bounded for an anchor. A lost task is done again from written blocks.

Scores are whole numbers. Higher ones come first, equal ones by the smaller id, equal ids by their row. An anchor's own
row is neither positive nor negative, other rows with its id are. Repeated rows are anchors and candidates each.
Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of unlike
lengths aren't compared; those without components have product 0. An anchor without positives gives no rows, as does a
positive whose window is empty (every one of a negative score, as the window then is). Empty tables give no rows; other columns take no part.
A score that doesn't fit a long raises an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, saved, shared_dir, table
from .vectors import EXACT, blocks, finite, matrix

POSITIVES, NEGATIVES, SCALE = 5, 10, 256.0
#: In hundredths, how much of the positive's score a negative has at least and at most.
WINDOW = (30, 90)
#: Anchors sent at a time (2 MB with 64 components), and scores worked out at a time by a task.
ANCHORS, TILE = 4096, 1 << 20


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all rows, as whole numbers of 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return a.astype(np.int64) @ x.astype(np.int64).T
    whole = np.array([[int(v) for v in r] for r in a], object).reshape(a.shape) @ np.array([[int(v) for v in r] for r in x], object).reshape(x.shape).T
    if any(abs(v) >= 2**63 for v in whole.ravel()):
        raise ValueError("a score doesn't fit a long")
    return whole.astype(np.int64)


def best(score: np.ndarray, fit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k greatest scores among those that fit; of equal ones the first columns."""
    low = np.iinfo(np.int64).min
    score = np.where(fit, score, low)
    if score.shape[1] > k:
        kth = np.partition(score, -k, axis=1)[:, -k][:, None]
        above = score > kth
        level = (score == kth) & fit
        fit = fit & (above | (level & (level.cumsum(1) <= k - above.sum(1)[:, None])))
    return np.nonzero(fit)


class Kept:
    """The k best (score, id, row) of each list so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64)] * 4

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        who, score, ids, rows = (np.concatenate(p) for p in zip(self.rows, (who, score, ids, rows)))
        order = np.lexsort((rows, ids, -score, who))
        who, score, ids, rows = who[order], score[order], ids[order], rows[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < self.k
        self.rows = [x[keep] for x in (who, score, ids, rows)]


def scan(batches: Iterator[pa.RecordBatch], anchors: dict[int, tuple[np.ndarray, ...]], k: int, found: Callable) -> Iterator[pa.RecordBatch]:
    """What a task keeps: anchors by dimension are (places, rows, labels, vectors); found() adds a tile's finds."""
    kept = Kept(k)
    for batch in batches:
        for j in range(batch.num_rows):
            dim = batch.column("dim")[j].as_py()
            if dim not in anchors:
                continue
            ids, labels, rows = (batch.column(c)[j].values.to_numpy() for c in ("id", "label", "row"))
            x = matrix(batch.column("kind")[j].as_py(), batch.column("vectors")[j].as_py(), dim, len(ids))
            order = np.lexsort((rows, ids))
            ids, labels, rows, x = ids[order], labels[order], rows[order], x[order]
            step = max(1, TILE // len(ids))
            for s in range(0, len(anchors[dim][0]), step):
                place, own, label, a = (v[s : s + step] for v in anchors[dim])
                found(kept, place, own, label, products(a, x), ids, labels, rows)
    who, score, ids, rows = kept.rows
    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (who, score, ids, rows)], ["list", "score", "id", "row"])


def mined(df: DataFrame, is_anchor: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: float = SCALE, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; is_anchor is a condition on the id."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))).withColumn("row", F.monotonically_increasing_id())
    packed = blocks(rows, "v", ["id", "label", "row"], "negative-rows", scale)
    asked = saved(numbered_anchors(packed, is_anchor, anchors), "negative-anchors")
    place = f"{shared_dir(spark)}/ledgerlake/negatives-{uuid.uuid4().hex}"
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for lot in sorted(r["lot"] for r in asked.select("lot").distinct().collect()):
        part = asked.where(F.col("lot") == lot).select("id", "row", "label", "dim", "vector").collect()  # `anchors` rows at most
        block_of_negatives(packed, part, positives, negatives, window, out).write.parquet(f"{place}/lot={lot}")
    discard(asked, packed)
    return spark.read.schema(out).parquet(f"{place}/*") if part_exists(spark, place) else spark.createDataFrame([], out)


def part_exists(spark: SparkSession, place: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(place)
    return bool(there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there))


def numbered_anchors(packed: DataFrame, is_anchor: Callable[[Column], Column], size: int) -> DataFrame:
    """Anchors one by one with their vectors, dealt to lots of at most `size` by their order in their task."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(batch.num_rows):
                dim, n = batch.column("dim")[j].as_py(), len(batch.column("id")[j])
                x = matrix(batch.column("kind")[j].as_py(), batch.column("vectors")[j].as_py(), dim, n)
                at = np.flatnonzero(batch.column("asked")[j].values.to_numpy(zero_copy_only=False))
                take = [batch.column(c)[j].values.take(pa.array(at)) for c in ("id", "label", "row")]
                vectors = pa.array([v.tobytes() for v in x[at].astype(np.float64)], pa.binary())
                yield pa.RecordBatch.from_arrays([*take, pa.array([dim] * len(at), pa.int32()), vectors], ["id", "label", "row", "dim", "vector"])

    asked = packed.withColumn("asked", F.transform("id", is_anchor)).mapInArrow(unpack, "id long, label long, row long, dim int, vector binary")
    written = saved(asked.withColumn("n", F.monotonically_increasing_id()), "negative-anchor-rows")
    # n counts up within a task from a multiple of 2^33; tasks' counts give each its first number
    tasks = written.groupBy((F.shiftrightunsigned("n", 33)).alias("task")).agg(F.count("*").alias("c")).orderBy("task").collect()  # two numbers a task
    first, so_far = [], 0
    for r in tasks:
        first.append((r["task"], so_far))
        so_far += r["c"]
    side = F.broadcast(written.sparkSession.createDataFrame(first, "task long, first long"))
    number = F.col("first") + F.col("n").bitwiseAND(F.lit(2**33 - 1))
    return written.withColumn("task", F.shiftrightunsigned("n", 33)).join(side, "task").withColumn("lot", (number / size).cast("long")).drop("n", "task", "first")


def block_of_negatives(packed: DataFrame, part: list, positives: int, negatives: int, window: tuple[int, int], out: str) -> DataFrame:
    """The rows of one block of anchors."""
    spark = packed.sparkSession
    place, dims = np.arange(len(part)), np.array([r["dim"] for r in part])
    own, label = (np.array([r[c] for r in part], np.int64) for c in ("row", "label"))
    sent = {int(d): (place[dims == d], own[dims == d], label[dims == d], np.stack([np.frombuffer(part[p]["vector"], np.float64) for p in place[dims == d]])) for d in np.unique(dims)}
    shape = "list long, score long, id long, row long"
    columns = packed.select("dim", "kind", "vectors", "id", "label", "row")
    merged = lambda found, k: found.withColumn("rank", F.row_number().over(Window.partitionBy("list").orderBy(F.desc("score"), "id", "row"))).where(F.col("rank") <= k)

    def same_label(kept, place, own, label, score, ids, labels, rows) -> None:
        a, x = best(score, (label[:, None] == labels) & (own[:, None] != rows), positives)
        kept.add(place[a], score[a, x], ids[x], rows[x])

    found = merged(columns.mapInArrow(lambda b: scan(b, sent, positives, same_label), shape), positives).collect()  # `positives` an anchor at most
    least, most = np.zeros((2, positives, len(part)), np.int64)
    there = np.zeros((positives, len(part)), bool)
    for r in found:
        # 100 * negative within [30, 90] * positive, as bounds of the negative alone
        j, p = r["rank"] - 1, r["list"]
        least[j, p], most[j, p], there[j, p] = -(-window[0] * r["score"] // 100), window[1] * r["score"] // 100, True

    def in_window(kept, place, own, label, score, ids, labels, rows) -> None:
        other = label[:, None] != labels
        for j in range(positives):
            fit = other & there[j, place][:, None] & (score >= least[j, place][:, None]) & (score <= most[j, place][:, None])
            a, x = best(score, fit, negatives)
            kept.add(place[a] * positives + j, score[a, x], ids[x], rows[x])

    chosen = merged(columns.mapInArrow(lambda b: scan(b, sent, negatives, in_window), shape), negatives)
    pairs = [(r["list"] * positives + r["rank"] - 1, part[r["list"]]["id"], r["id"], r["score"]) for r in found]
    side = F.broadcast(spark.createDataFrame(pairs, "list long, anchor_id long, positive_id long, positive_score long"))  # `positives` an anchor at most
    return chosen.join(side, "list").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).to(spark.createDataFrame([], out).schema)


def relabelled(df: DataFrame) -> DataFrame:
    """Every seventh id with the next label."""
    return df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(relabelled(table(spark, sf_dir, "embeddings")), lambda c: c % 100 == 0)


ORACLE = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor({SCALE:g}::DOUBLE * e)::BIGINT) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS MATERIALIZED (SELECT a.row, a.vec_id AS anchor_id, a.label = b.label AS same, b.row AS other, b.vec_id, list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.row <> b.row AND len(a.x) = len(b.x)),
p AS (SELECT row, anchor_id, vec_id AS positive_id, other, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other) <= {POSITIVES})
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.row, p.other ORDER BY score DESC, vec_id, s.other))::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.row = s.row AND NOT same AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score QUALIFY rank <= {NEGATIVES}"""
