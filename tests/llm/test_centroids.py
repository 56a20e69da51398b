"""op11 against its SQL and plain loops; what screening leaves out and what it must not."""

import hashlib

import duckdb
import numpy as np

from ledgerlake.llm import centroids as c

SF = "/root/testdata/sf0.01"


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cur = con.execute(c.ORACLE)
    got = c.op11_centroid_clustering(spark, SF)
    assert got.columns == [d[0] for d in cur.description] and sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def plain(rows, k, rounds):
    """(id, cluster, distance) of each row by plain loops; ids are distinct."""
    x = {i: [int(np.floor(256.0 * e)) for e in v] for i, v in rows}
    now = [x[i] for i in sorted(x, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(now))
    for _ in range(rounds):
        of = {i: near(v)[1] for i, v in x.items()}
        groups = [[x[i] for i in x if of[i] == j] for j in range(len(now))]
        now = [[sum(col) // len(g) for col in zip(*g)] if g else m for g, m in zip(groups, now)]
    return sorted((i, near(v)[1], near(v)[0]) for i, v in x.items())


def test_equals_plain_loops(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(-20, 180)]  # many ties
    df = spark.createDataFrame([(v, i) for i, v in rows], "embedding array<double>, vec_id long").repartition(5)
    found, centres = c.clustered(df, k=12, rounds=4, dim=6, segments=3)
    assert sorted(map(tuple, found.select("vec_id", "cluster", "distance").collect())) == plain(rows, 12, 4)
    assert [r.cluster for r in centres.orderBy("cluster").collect()] == list(range(12)) and sum(r.n for r in centres.collect()) == len(rows)


def test_repeats_nulls_and_clashing_columns(spark):
    same = [1.0, -0.001]
    rows = [(1, same, 0), (1, same, 0), (2, same, 0), (None, [9.0, 9.0], 0), (4, None, 0), (5, [1.0], 0), (6, [1.0, None], 0), (7, [float("nan"), 1.0], 0), (8, [float("inf"), 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, cluster int")
    df = df.withColumn("distance", df["cluster"]).withColumn("id", df["cluster"])
    found, centres = c.clustered(df, k=40, rounds=2, dim=2)
    # four rows, four centroids: the three equal ones tie, and the first takes all
    assert sorted((r.vec_id or 0, r.cluster, r.distance) for r in found.collect()) == [(0, 3, 0), (1, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert sorted((r.cluster, r.n, tuple(r.centroid)) for r in centres.collect()) == [(0, 3, (256, -1)), (1, 0, (256, -1)), (2, 0, (256, -1)), (3, 1, (2304, 2304))]
    found, centres = c.clustered(df.where("false"))
    assert found.columns == ["vec_id", "cluster", "distance"] and found.collect() == [] and centres.collect() == []


def test_bounds_never_pass_the_distance_and_screen_where_norms_differ():
    rng = np.random.default_rng(4)
    x = rng.integers(-(2**26), 2**26, (500, 64))
    m = np.r_[x[:20], -x[20:40]]
    who, best, _ = c.nearest(x, c.segment_norms(x), m, c.segment_norms(m))
    every = np.array([c.distances(np.repeat(m, 1, 0), v) for v in x])
    assert (best == every.min(1)).all() and (who == every.argmin(1)).all()
    # topics that differ in where their weight lies: nearly all is screened off
    weight = rng.integers(1, 40, (40, 16))
    at = rng.integers(0, 40, 2000)
    y = (rng.normal(size=(2000, 64)).round(1) + np.repeat(weight[at], 4, axis=1) * 10).astype(np.int64)
    assert c.screened(y, np.repeat(weight, 4, axis=1) * 10) < 0.05
