"""Centroid clustering of vectors of whole numbers, exact in every step, with screening by block norms.

A vector is compressed once to the norms of its segments. By Cauchy and Schwarz the product of a vector
and a centroid is no more than the product of their norms, segment by segment, so that
|x|^2 + |c|^2 - 2 * sum(|x_s| * |c_s|) is a lower bound of their squared distance. The centroid of least bound is
measured first; of the others only those whose bound isn't above the best distance so far are measured, in
whole numbers. Norms are rounded up and bounds down, so that screening never changes a result.

A round is one pass over written blocks without a shuffle of vectors: tasks return a count and a sum of each
centroid's vectors, and the driver gets k * dim sums. The rounds keep nothing but centroids; a lost task is done again.

Rows whose vector is null, of another length, or holds a null or non-finite component take no part. Repeated
rows count each time and are all returned. Initial centroids are the rows with the least hashes of their ids;
rows with equal ids stand in the order of their vectors, rows with a null id last. With fewer rows than k each
is a centroid, equal ones too; equal distances go to the smaller number, and a centroid without rows stays as it is.
An empty table gives no rows. Other columns take no part, whatever their names. Whole numbers of 2^27 or
more raise an error, as their distances need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table
from .vectors import blocks, finite, matrix

K, ROUNDS, DIM, SCALE, SALT = 40, 5, 64, 256.0, "2:"
SEGMENTS = 16
#: Components below this make squared distances that fit a long.
MOST = 2**27


def segment_norms(x: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """Norms of consecutive segments, rounded up to single precision."""
    parts = np.array_split(x.astype(np.float64) ** 2, min(segments, x.shape[1]), axis=1)
    return np.nextafter(np.sqrt(np.stack([p.sum(1) for p in parts], 1)).astype(np.float32), np.float32(np.inf))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a vector or to rows, in whole numbers."""
    gap = x.astype(np.int64) - c
    return np.einsum("nd,nd->n", gap, gap)


def nearest(x: np.ndarray, norms: np.ndarray, centroids: np.ndarray, centroid_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of each row, and how many distances were measured."""
    squares = np.add.outer((x.astype(np.float64) ** 2).sum(1), (centroids.astype(np.float64) ** 2).sum(1))
    low = squares * (1 - 1e-12) - 2 * (norms.astype(np.float64) @ centroid_norms.astype(np.float64).T) - 1
    guess = low.argmin(1)
    who, best, measured = guess.copy(), distances(x, centroids[guess]), len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((low[:, k] <= best) & (guess != k))
        d = distances(x[rows], centroids[k])
        nearer = (d < best[rows]) | ((d == best[rows]) & (k < who[rows]))
        who[rows[nearer]], best[rows[nearer]] = k, d[nearer]
        measured += len(rows)
    return who, best, measured


def clustered(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: float = SCALE, salt: str = SALT, segments: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """(a row per vector: key, cluster, distance; a row per centroid: cluster, centroid, n, inertia), both written."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where((F.size("v") == dim) & finite(F.col("v")))
    first = rows.select("v", F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    centroids = np.floor(scale * np.array([r["v"] for r in first], np.float64).reshape(len(first), dim)).astype(np.int64)
    packed = blocks(rows, "v", ["id"], "centroid-vectors", scale)
    packed = saved(packed.mapInArrow(lambda batches: with_norms(batches, segments), "kind string, vectors binary, id array<bigint>, norms binary"), "centroid-norms")

    def moved(c: np.ndarray) -> np.ndarray:
        sums = packed.select("kind", "vectors", F.size("id").alias("n"), "norms").mapInArrow(lambda b: partial_sums(b, c, segments), "cluster int, n long, sums array<bigint>")
        whole = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(dim)]).alias("sums"))
        out = c.copy()
        for r in whole.collect():  # k rows at most
            out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
        return out

    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids)
    last = centroids
    found = saved(packed.mapInArrow(lambda b: assigned(b, last, segments), "id long, cluster int, distance long").withColumnRenamed("id", key), "centroid-assigned")
    at = spark.createDataFrame([(j, c) for j, c in enumerate(centroids.tolist())], "cluster int, centroid array<bigint>")
    return found, saved(found.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("inertia")).join(at, "cluster", "right").select("cluster", "centroid", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("inertia", F.lit(0).cast("long")).alias("inertia")), "centroids")


def with_norms(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, datas, ids = batch.column("kind").to_pylist(), batch.column("vectors"), batch.column("id")
        norms = []
        for j, kind in enumerate(kinds):
            x = matrix(kind, datas[j].as_py(), batch.column("dim")[j].as_py(), len(ids[j]))
            if np.abs(x.astype(np.float64)).max(initial=0) >= MOST:
                raise ValueError(f"a component times the scale reaches {MOST}: squared distances need not fit a long")
            norms.append(segment_norms(x, segments).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("kind"), datas, ids, pa.array(norms, pa.binary())], ["kind", "vectors", "id", "norms"])


def each_block(batches: Iterator[pa.RecordBatch], sizes: str, dim: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, place in it, vectors, norms) of every block."""
    for batch in batches:
        for j in range(batch.num_rows):
            n = len(batch.column(sizes)[j]) if sizes == "id" else batch.column(sizes)[j].as_py()
            yield batch, j, matrix(batch.column("kind")[j].as_py(), batch.column("vectors")[j].as_py(), dim, n), np.frombuffer(batch.column("norms")[j].as_py(), np.float32).reshape(n, -1)


def partial_sums(batches: Iterator[pa.RecordBatch], c: np.ndarray, segments: int) -> Iterator[pa.RecordBatch]:
    """Of each centroid that has vectors in this task, their count and sums."""
    count, sums, c_norms = np.zeros(len(c), np.int64), np.zeros_like(c), segment_norms(c, segments)
    for _, _, x, norms in each_block(batches, "n", c.shape[1]):
        who, _, _ = nearest(x, norms, c, c_norms)
        order = np.argsort(who, kind="stable")
        there, start = np.unique(who[order], return_index=True)
        sums[there] += np.add.reduceat(x[order].astype(np.int64), start, axis=0)
        count += np.bincount(who, minlength=len(c))
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at]), pa.array(list(sums[at]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])


def assigned(batches: Iterator[pa.RecordBatch], c: np.ndarray, segments: int) -> Iterator[pa.RecordBatch]:
    c_norms = segment_norms(c, segments)
    for batch, j, x, norms in each_block(batches, "id", c.shape[1]):
        who, best, _ = nearest(x, norms, c, c_norms)
        yield pa.RecordBatch.from_arrays([batch.column("id")[j].values, pa.array(who, pa.int32()), pa.array(best)], ["id", "cluster", "distance"])


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    total = centroids.agg(F.sum("inertia").alias("inertia"))
    sha = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    side = centroids.select("cluster", F.col("inertia").alias("cluster_inertia"), sha.alias("centroid_sha256")).crossJoin(F.broadcast(total))  # one row; K rows in all
    return found.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle() -> str:
    """The same by plain SQL: every distance in whole numbers, rounds as common table expressions."""
    gap = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    nearest_of = lambda c: f"SELECT id, any_value(x) AS x, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT v.id, v.x, c.k, {gap} AS d FROM v, {c} c) GROUP BY id"
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor({SCALE:g}::DOUBLE * e)::BIGINT) AS x FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {DIM})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SALT}' || vec_id)) - 1 AS k, x FROM v ORDER BY k LIMIT {K})",
    ]
    for i in range(ROUNDS):
        parts.append(f"a{i} AS MATERIALIZED ({nearest_of(f'c{i}')})")
        parts.append(f"m{i} AS (SELECT k, list(m ORDER BY p) AS x FROM (SELECT k, p, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (SELECT k, p, sum(x[p])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {DIM + 1}) r(p) GROUP BY k, p)) GROUP BY k)")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (k))")
    parts.append(f"a AS MATERIALIZED ({nearest_of(f'c{ROUNDS}')})")
    return f"WITH {', '.join(parts)} SELECT vec_id, a.k::INT AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a JOIN v USING (id) JOIN c{ROUNDS} c ON a.k = c.k"


ORACLE = oracle()


def screened(x: np.ndarray, centroids: np.ndarray, segments: int = SEGMENTS) -> float:
    """The share of all distances that nearest() measures."""
    return nearest(x, segment_norms(x, segments), centroids, segment_norms(centroids, segments))[2] / max(1, len(x) * len(centroids))
