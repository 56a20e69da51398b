"""Vectors of whole numbers in blocks, as the operators on embeddings share them.

A block is one row that holds some thousand vectors of one length, so that a task hands numpy whole
matrices. Components are floor(scale * x), x in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Whole numbers up to here are exact in double precision.
EXACT = 2**53


def finite(v: Column) -> Column:
    """Whether a vector is there and no component is null, NaN or infinite."""
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them; beyond 32 bits they stay doubles."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def blocks(rows: DataFrame, vector: str, longs: Sequence[str], name: str, scale: float = 256.0) -> DataFrame:
    """Written blocks: dim, kind (numpy's name of the type), vectors (bytes) and the columns `longs` as arrays.

    rows holds these columns as long, and vectors that are finite(). Every row is in one block.
    """
    shape = "dim int, kind string, vectors binary, " + ", ".join(f"{c} array<bigint>" for c in longs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            size = lists.value_lengths().to_numpy()
            x = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(size)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                part = narrow(x.reshape(len(size), dim) if len(at) == len(size) else x[(ends[at] - dim)[:, None] + np.arange(dim)])
                kept = [batch.column(k + 1).take(pa.array(at)) for k in range(len(longs))]
                lists_of = [pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), c) for c in kept]
                yield pa.RecordBatch.from_arrays([pa.array([int(dim)], pa.int32()), pa.array([part.dtype.name]), pa.array([part.tobytes()], pa.binary()), *lists_of], ["dim", "kind", "vectors", *longs])

    return saved(rows.select(F.col(vector).alias("v"), *longs).mapInArrow(pack, shape), name)


def matrix(kind: str, data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(kind)).reshape(n, dim)
