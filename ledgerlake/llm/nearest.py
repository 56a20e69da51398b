"""Nearest neighbours by inner product with anisotropic four-bit codes.

Codebooks are fitted on a bounded sample (SAMPLE rows); every row is encoded, two codes to a
byte. Each block of rows is scanned by table, a byte at a time, for each block of queries. What the code leaves
out of a row (its gap, a norm) bounds by how much the exact product can pass the approximate
one: by |q| times the gap in the worst case, and by |q| times the gap over the root of the
dimension in standard deviations. Rows that may reach the k-th best by `sure` deviations are
scored exactly on the original vectors, however many they are; the k-th best is known from
the block's first rows by code (where the sample alone leaves many) and from the sample, whichever is more. sure=None takes the
worst case, which makes the search exact; the default's recall is measured in the tests.

Vectors that are null, zero, hold null or non-finite components, or aren't of the commonest
length take no part. Rows with a null id take none either. A query's own row is no candidate,
other rows with its id and vector are; repeated rows are queries and candidates each. Ties go
to the smaller id. Empty tables give empty results; other columns take no part.

Blocks are cut by bytes. One block of queries after the other is sent to all tasks, which read the
blocks of rows where they are written: vectors are shuffled once, into blocks, whatever the number of
queries, and no join copies them. The work is queries times rows, as the search asks.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import bound_batches, discard, saved, table

SAMPLE, SUB, CENTRES = 8192, 2, 16
#: Bytes of vectors in a block, and the fewest blocks of rows.
BLOCK_BYTES, LEAST_BLOCKS = 16 << 20, 32
#: Rows that are encoded or looked up at a time, the most queries and the most products that are looked at at a time.
LOT, ASKED, CELLS = 1024, 128, 4 << 20


class Quantiser:
    """Product codes whose loss weighs the residual along the vector eta times the rest."""

    def __init__(self, dim: int, threshold: float = 0.2):
        self.dim, self.parts = dim, -(-dim // SUB)
        self.eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
        self.books = np.zeros((self.parts, CENTRES, SUB))

    def _split(self, x: np.ndarray) -> np.ndarray:
        pad = np.zeros((len(x), self.parts * SUB))
        pad[:, : self.dim] = x
        return pad.reshape(len(x), self.parts, SUB)

    def encode(self, x: np.ndarray, passes: int = 2) -> np.ndarray:
        """Codes of the rows, lot by lot, as the distances to all centres take some hundred times a vector."""
        return np.concatenate([np.zeros((0, self.parts), np.uint8), *(self._encoded(x[a : a + LOT], passes) for a in range(0, len(x), LOT))])

    def _encoded(self, x: np.ndarray, passes: int) -> np.ndarray:
        xs = self._split(x)
        u = xs / np.linalg.norm(x, axis=1)[:, None, None]
        gap = xs[:, :, None, :] - self.books[None]
        along, far = np.einsum("npks,nps->npk", gap, u), (gap**2).sum(3)
        codes = far.argmin(2)
        rows = np.arange(len(x))
        total = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(1)
        for _ in range(passes):
            for p in range(self.parts):
                rest = total - along[rows, p, codes[:, p]]
                codes[:, p] = (far[:, p] + (self.eta - 1) * (rest[:, None] + along[:, p]) ** 2).argmin(1)
                total = rest + along[rows, p, codes[:, p]]
        return codes.astype(np.uint8)

    def fit(self, x: np.ndarray, rounds: int = 6) -> Quantiser:
        xs = self._split(x)
        u = xs / np.linalg.norm(x, axis=1)[:, None, None]
        start = np.linspace(0, len(x) - 1, CENTRES).astype(int)
        self.books = np.stack([xs[np.argsort(xs[:, p, 0], kind="stable")[start], p] for p in range(self.parts)])
        for _ in range(rounds):
            codes = self.encode(x)
            along = np.einsum("nps,nps->np", xs - self.books[np.arange(self.parts), codes], u)
            total = along.sum(1)
            for p in range(self.parts):
                rest = total - along[:, p]
                for k in range(CENTRES):
                    m = codes[:, p] == k
                    if not m.any():
                        continue
                    a, b = u[m, p], xs[m, p]
                    left = m.sum() * np.eye(SUB) + (self.eta - 1) * a.T @ a
                    right = b.sum(0) + (self.eta - 1) * (a * ((a * b).sum(1) + rest[m])[:, None]).sum(0)
                    self.books[p, k] = np.linalg.solve(left, right)
        return self

    def gaps(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """By row, the most by which scan() can miss the product with a query of norm one."""
        left = np.linalg.norm((self._split(x) - self.books[np.arange(self.parts), codes]).reshape(len(x), -1), axis=1)
        return left + (self.parts + 4) * 2.0**-23 * (np.linalg.norm(x, axis=1) + left)

    def scan(self, queries: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """By row of packed codes and query, approximate products by one table look-up for two parts."""
        tables = np.einsum("qps,pks->pkq", self._split(queries), self.books)
        tables = np.pad(tables, ((0, self.parts % 2), (0, 0), (0, 0)))
        tables = (tables[1::2, :, None] + tables[::2, None]).reshape(-1, CENTRES**2, len(queries)).astype(np.float32)
        out = np.zeros((len(pairs), len(queries)), dtype=np.float32)
        for a in range(0, len(pairs), LOT):
            for found, codes in zip(tables, pairs[a : a + LOT].T):
                out[a : a + LOT] += found[codes]
        return out


def products(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, lot: int = 32768) -> np.ndarray:
    """Products of the pairs q[a], x[b], each summed in the same order, so that equal rows tie."""
    return np.concatenate([np.zeros(0), *(np.einsum("nd,nd->n", q[a[s : s + lot]], x[b[s : s + lot]]) for s in range(0, len(a), lot))])


def packed(codes: np.ndarray) -> bytes:
    """Two codes to a byte."""
    even = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
    return (even[:, ::2] | even[:, 1::2] << 4).tobytes()


def best_of_block(quantiser: Quantiser, q: np.ndarray, qrows: np.ndarray, known: np.ndarray, x: np.ndarray, rows: np.ndarray, ids: np.ndarray, pairs: np.ndarray, gaps: np.ndarray, k: int, sure: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query place, row place, score) of the k best rows of a block for each query, none below `known`; and how many were scored exactly."""
    near = quantiser.scan(q, pairs)
    reach = (1.0 if sure is None else min(1.0, sure / np.sqrt(quantiser.dim))) * np.linalg.norm(q, axis=1)
    # single precision, widened by more than it rounds
    most = near + (reach * (1 + 2.0**-20)).astype(np.float32) * (gaps[:, None] * (1 + 2.0**-20)).astype(np.float32)

    def within(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and another row that may reach the query's least; not(<) also keeps what overflowed to NaN."""
        single = np.finfo(np.float32)
        wide = np.minimum(least - np.abs(np.where(np.isfinite(least), least, 0)) * 2.0**-21 - quantiser.dim * single.tiny, single.max)
        b, a = np.nonzero(~(most < wide.astype(np.float32)))
        other = qrows[a] != rows[b]
        return a[other], b[other]

    least = known
    a, b = within(least)
    if len(a) > 4 * k * len(q):
        # the k-th exact score among the first by code: the block's k-th is no lower
        first = np.argpartition(-near, min(2 * k, len(ids)) - 1, axis=0)[: 2 * k].T
        places = np.repeat(np.arange(len(q)), first.shape[1])
        score = np.where(qrows[:, None] != rows[first], products(q, x, places, first.ravel()).reshape(first.shape), -np.inf)
        if score.shape[1] >= k:
            least = np.maximum(least, -np.sort(-score, axis=1)[:, k - 1])
            a, b = within(least)
    score = products(q, x, a, b)
    fine = score >= least[a]
    n, a, b, score = len(a), a[fine], b[fine], score[fine]
    order = np.lexsort((rows[b], ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    kept = np.arange(len(a)) - np.searchsorted(a, a) < k
    return a[kept], b[kept], score[kept], n


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    df = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return df.where(F.coalesce(fine, F.lit(False))).withColumn("row", F.monotonically_increasing_id())


def search(df: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20, sure: float | None = 4.0, counts: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each row for which is_query(id column) holds.

    With counts, instead a row per pair of blocks: n_scored of n_pairs were scored exactly.
    """
    kind = np.float32 if isinstance(df.schema[vector].dataType.elementType, FloatType) else np.float64
    rows = saved(usable(bound_batches(df), key, vector), "ann-vectors")
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim, total = (lengths[0]["d"], lengths[0]["count"]) if lengths else (1, 0)
    rows = rows.where(F.size("v") == dim)
    few = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("row", "v").collect()
    quantiser, some = Quantiser(dim), np.array([r["v"] for r in few], dtype=float).reshape(len(few), dim)
    some_rows = np.array([r["row"] for r in few], dtype=np.int64)
    if few:
        quantiser.fit(some)
    size = dim * np.dtype(kind).itemsize
    n_blocks = max(LEAST_BLOCKS, -(-total * size // BLOCK_BYTES))
    n_asks = max(1, -(-rows.where(is_query(F.col("id"))).count() * size // BLOCK_BYTES))

    def taken(part: pd.DataFrame) -> tuple[np.ndarray, dict]:
        part = part.sort_values("row")
        x = np.array(part["v"].tolist(), dtype=kind)
        return x.astype(float), {"block": [part["block"].iloc[0]], "rows": [part["row"].to_numpy(np.int64).tobytes()], "ids": [part["id"].to_numpy(np.int64).tobytes()], "vectors": [x.tobytes()]}

    def pack_rows(part: pd.DataFrame) -> pd.DataFrame:
        x, out = taken(part)
        codes = quantiser.encode(x)
        return pd.DataFrame(out | {"codes": [packed(codes)], "gaps": [quantiser.gaps(x, codes).tobytes()]})

    def pack_queries(part: pd.DataFrame) -> pd.DataFrame:
        # the k-th best in the sample is no more than the k-th best of all rows
        x, out = taken(part)
        known = np.full(len(x), -np.inf)
        own = np.frombuffer(out["rows"][0], np.int64)
        for a in range(0, len(x), 256) if len(some) > k else ():
            near = np.where(own[a : a + 256, None] == some_rows[None], -np.inf, x[a : a + 256] @ some.T)
            slack = 2 * dim * 2.0**-52 * np.linalg.norm(x[a : a + 256], axis=1) * np.linalg.norm(some, axis=1).max()
            known[a : a + 256] = -np.partition(-near, k - 1, axis=1)[:, k - 1] - slack
        return pd.DataFrame(out | {"known": [known.tobytes()]})

    shape = "block long, rows binary, ids binary, vectors binary"
    dealt = lambda x, n: x.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)))
    # in a fixed number of parts, each of some blocks: a task of the writer holds few at a time, and a task of the scan reads few
    by_block = lambda x, n: dealt(x, n).repartition(n, "block").groupBy("block")
    blocks = saved(by_block(rows, n_blocks).applyInPandas(pack_rows, f"{shape}, codes binary, gaps binary"), "ann-rows")
    asks = saved(by_block(rows.where(is_query(F.col("id"))), n_asks).applyInPandas(pack_queries, f"{shape}, known binary"), "ann-queries")
    discard(rows)

    def scan(lots):
        for lot in lots:
            for rows, ids, vectors, codes, gaps, qrows, qids, queries, known in lot.itertuples(index=False):
                rows, ids, qrows, qids = (np.frombuffer(b, np.int64) for b in (rows, ids, qrows, qids))
                gaps, known, codes = np.frombuffer(gaps), np.frombuffer(known), np.frombuffer(codes, np.uint8).reshape(len(rows), -1)
                x, q = (np.frombuffer(b, kind).reshape(-1, dim).astype(float) for b in (vectors, queries))
                n, step = 0, max(1, min(ASKED, CELLS // len(x)))
                for a in range(0, len(q), step):
                    who, what, score, scored = best_of_block(quantiser, q[a : a + step], qrows[a : a + step], known[a : a + step], x, rows, ids, codes, gaps, k, sure)
                    n += scored
                    if not counts:
                        yield pd.DataFrame({"query_row": qrows[a : a + step][who], "query_id": qids[a : a + step][who], "vec_id": ids[what], "vec_row": rows[what], "score": score})
                if counts:
                    yield pd.DataFrame({"n_scored": [n], "n_pairs": [len(q) * len(x)]})

    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")

    def answered(ask: int) -> DataFrame:
        """The blocks of rows against one block of queries, which alone is sent to tasks."""
        asked = asks.where(F.col("block") == ask).select(F.col("rows").alias("qrows"), F.col("ids").alias("qids"), F.col("vectors").alias("queries"), "known")
        pairs = blocks.drop("block").crossJoin(F.broadcast(asked))
        if counts:
            return pairs.mapInPandas(scan, "n_scored long, n_pairs long")
        found = pairs.mapInPandas(scan, "query_row long, query_id long, vec_id long, vec_row long, score double")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    with split_as(df.sparkSession, n_blocks):
        done = [saved(answered(ask), "ann-found") for ask in range(n_asks)]
    discard(blocks, asks)
    return reduce(DataFrame.unionByName, done)


@contextmanager
def split_as(spark: SparkSession, parts: int):
    """Files are read in about so many parts meanwhile, however few cores there are and however small the files."""
    settings = {"spark.sql.files.minPartitionNum": str(parts), "spark.sql.files.openCostInBytes": "0"}
    before = {c: spark.conf.get(c, None) for c in settings}
    try:
        for c, v in settings.items():
            spark.conf.set(c, v)
        yield
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda c: c % 20 == 0)
