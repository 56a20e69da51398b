"""op13 against its SQL and plain loops: ties, repeated rows, blocks of anchors, scores beyond doubles."""

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import negatives as n

KIND = "vec_id long, label long, embedding array<double>"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    cur = con.execute(n.ORACLE)
    got = n.op13_hard_negatives(spark, sf)
    assert got.columns == [d[0] for d in cur.description] and sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def plain(rows, every, scale):
    """Sorted results by plain loops; equal ids are told apart by their place."""
    x = [(i, y, [int(np.floor(scale * e)) for e in v], place) for place, (i, y, v) in enumerate(rows)]
    out = []
    for i, y, v, place in (r for r in x if r[0] % every == 0):
        score = [(-sum(a * b for a, b in zip(v, w)), j, p, z) for j, z, w, p in x if p != place and len(w) == len(v)]
        for s, j, _, _ in sorted(r for r in score if r[3] == y)[: n.POSITIVES]:
            fit = sorted(r for r in score if r[3] != y and 30 * -s <= 100 * -r[0] <= 90 * -s)[: n.NEGATIVES]
            out += [(i, j, k, m, -s, -t) for k, (t, m, _, _) in enumerate(fit, 1)]
    return sorted(out)


def test_ties_repeats_lengths_and_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-2, 4, 4).astype(float).tolist()) for i in range(-30, 200)]
    rows += [rows[30], rows[30], rows[50], (20, 1, [1.0, 2.0, 3.0])] + [(k, k % 2, [2.0, 2.0, 2.0]) for k in range(200, 230)]
    rows += [(1000 + k, 2, [1.0, 1.0, 1.0, 1.0]) for k in range(120)]  # one frequent vector
    bad = [(None, 1, [1.0] * 4), (10, None, [1.0] * 4), (20, 1, None), (40, 1, [1.0, None, 1.0, 1.0]), (60, 1, [1.0, float("nan"), 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, KIND).selectExpr("*", "'x' AS score", "1 AS row", "2 AS list", "3 AS id", "4 AS dim").repartition(4)
    for size in (n.ANCHORS, 7):
        got = n.mined(df, lambda c: c % 10 == 0, scale=1.0, anchors=size)
        assert sorted(map(tuple, got.collect())) == plain(rows, 10, 1.0)


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(6)
    for top in (2**27, 2**30):  # products to 2^57 and 2^63
        rows = [(i, i % 2, rng.integers(top - 9, top, 4).astype(float).tolist()) for i in range(40)]
        got = n.mined(spark.createDataFrame(rows, KIND), lambda c: c % 10 == 0, scale=1.0, window=(30, 100))
        sure = [r for r in got.collect()]
        x = {i: [int(e) for e in v] for i, _, v in rows}
        assert sure and all(r.positive_score == sum(a * b for a, b in zip(x[r.anchor_id], x[r.positive_id])) and r.negative_score == sum(a * b for a, b in zip(x[r.anchor_id], x[r.negative_id])) for r in sure)


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(0, 1, [1.0]), (7, 2, [1.0])], KIND)
    assert n.mined(df, lambda c: c % 100 == 0).collect() == []  # no positive
    empty = n.mined(df.where("false"), lambda c: c % 100 == 0)
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    alone = spark.createDataFrame([(0, 1, [1.0]), (5, 1, [-1.0]), (7, 2, [-0.5])], KIND)
    assert n.mined(alone, lambda c: c % 100 == 0).collect() == []  # a negative positive score has no window
