"""op4 against brute force: repeated rows, ties, near copies, and recall where the scan prunes."""

import tracemalloc
from collections import defaultdict

import duckdb
import numpy as np

from ledgerlake.llm import nearest

KIND = "vec_id long, embedding array<float>"


def brute(rows, is_query, k=20):
    """Sorted (query id, rank, id, score) of every query row."""
    out = []
    for a, (i, v) in enumerate(rows):
        if is_query(i):
            near = sorted((-float(np.dot(v, w)), j) for b, (j, w) in enumerate(rows) if b != a)[:k]
            out += [(i, r, j, round(-s, 9)) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def test_repeated_rows_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 8).astype(np.float32).astype(float)) for i in range(1, 160)]
    rows += [rows[19], rows[19], rows[39], (20, rows[5][1])]  # ids repeat, with and without their vectors
    rows = [(i, v) for i, v in rows if v.any()]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], KIND)
    assert found(nearest.search(df, lambda c: c % 20 == 0, sure=None)) == brute(rows, lambda i: i % 20 == 0)


def test_fewer_candidates_than_asked(spark):
    rows = [(20, np.array([1.0, 0.0])), (20, np.array([1.0, 0.0])), (3, np.array([0.5, 0.5]))]
    extra = [(4, None, "x"), (5, [0.0, 0.0], "x"), (6, [float("nan"), 1.0], "x"), (7, [None, 1.0], "x"), (8, [1.0], "x"), (None, [1.0, 1.0], "x")]
    df = spark.createDataFrame([(i, v.tolist(), "y") for i, v in rows] + extra, KIND + ", score string")
    assert found(nearest.search(df, lambda c: c % 20 == 0)) == [(20, 1, 20, 1.0), (20, 1, 20, 1.0), (20, 2, 3, 0.5), (20, 2, 3, 0.5)]


def recall(spark, x, every, **how):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KIND).repartition(8)
    got = defaultdict(set)
    for r in nearest.search(df, lambda c: c % every == 0, **how).collect():
        got[r.query_id].add(r.vec_id)
    near = x @ x[::every].T
    hits = 0
    for k, i in enumerate(range(0, len(x), every)):
        s = near[:, k].copy()
        s[i] = -np.inf
        hits += len(got[i] & set(np.lexsort((np.arange(len(x)), -s))[:20].tolist()))
    scored = nearest.search(df, lambda c: c % every == 0, counts=True, **how).groupBy().sum("n_scored", "n_pairs").first()
    return hits / (20 * len(range(0, len(x), every))), scored[0] / scored[1]


def vectors(n, seed):
    x = np.random.default_rng(seed).normal(size=(n, 64))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)


def test_recall_where_the_scan_prunes(spark):
    got, share = recall(spark, vectors(40_000, 5), 200)
    print("recall", got, "scored exactly", share)
    assert got >= 0.99 and share < 0.2


def test_near_copies_are_told_apart(spark):
    x = vectors(20_000, 7)
    x[::3] = x[0] + 0.02 * np.random.default_rng(1).normal(size=x[::3].shape) / 8  # a third lie close together
    x[30:60] = x[30]  # equal rows tie
    got, share = recall(spark, x.astype(np.float32).astype(float), 200)
    print("recall", got, "scored exactly", share)
    assert got >= 0.99 and share < 0.3


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(i, np.array(v, dtype=float)) for i, v in duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall() if v]
    assert found(nearest.op4_nearest_neighbours(spark, sf)) == brute(rows, lambda i: i % 20 == 0)


def test_blocks_of_queries_follow_each_other(spark, monkeypatch):
    """Several blocks of queries and rows give what brute force gives, and what is returned joins nothing: no block is copied for a join."""
    monkeypatch.setattr(nearest, "BLOCK_BYTES", 640)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 8).astype(np.float32).astype(float)) for i in range(1, 900)]
    rows = [(i, v) for i, v in rows if v.any()]
    got = nearest.search(spark.createDataFrame([(i, v.tolist()) for i, v in rows], KIND), lambda c: c % 20 == 0, sure=None)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and plan.count("Relation") == 3
    assert found(got) == brute(rows, lambda i: i % 20 == 0)


def test_encoding_is_bounded_in_memory():
    x = vectors(20_000, 2)
    quantiser = nearest.Quantiser(64).fit(x[:500])
    tracemalloc.start()
    codes = quantiser.encode(x)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6 and len(codes) == len(x) and (codes[7000:7100] == quantiser.encode(x[7000:7100])).all()
