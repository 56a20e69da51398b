"""op5 recomputed in plain Python; op6 by its contract."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from ledgerlake.llm import common, mixing, sharding

SF = "/root/testdata/sf0.01"


def shard(key, weights):
    best = None
    for s, w in enumerate(weights):
        h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", s), seed=h)
        u = ((h >> 11) + 0.5) / float(1 << 53)
        best = max(best or (-math.inf, 0), (w / -math.log(u), s))
    return best[1]


def test_long_runs_are_expanded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(common, "PIECE", 10)
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10), ("d", 11)], "k string, n long")
    got = common.expanded(df, "n", "copy", ["k"])
    assert got.columns == ["k", "n", "copy"]
    assert sorted((r.k, r.copy) for r in got.collect()) == [(k, c) for k, n in (("a", 25), ("b", 1), ("c", 10), ("d", 11)) for c in range(n)]
    named = sharding.slotted(spark.createDataFrame([(1, "x", 7, 8)] * 30 + [(2, "y", 7, 8)], "id int, _n string, _size int, shard int"), "shard", ["id"])
    assert sorted(r.slot for r in named.collect()) == list(range(31)) and named.columns == ["id", "_n", "_size", "shard", "slot"]


EDGES = [(1, None), (2, ""), (None, "é"), (None, "é"), (4, "same")] + [(3, "hot")] * 400


@pytest.mark.parametrize("edges", [True, False])
def test_shards_equal_plain_version(spark, tmp_path, edges):
    sf = str(tmp_path) if edges else SF
    rows = EDGES if edges else duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    if edges:
        spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, shard string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sharding.op5_sharding(spark, sf).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key", shard(i, [1.0] * 24), shard(i, [1.0] * 25)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_share_keys(spark):
    got = Counter(r.shard for r in sharding.assigned(spark.range(20_000).withColumnRenamed("id", "k"), "k", [1.0, 3.0]).collect())
    assert abs(got[1] / 20_000 - 0.75) < 0.02


def test_mix_keeps_to_its_targets(spark, tmp_path):
    rows = [(k, "word " * (k % 90), ["a", "b", None, "d"][k % 4 if k % 3 else 0], "x") for k in range(3000)] + [(7, None, "a", "x"), (None, "w w", "e", "x"), (None, "w w", "e", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, size string").write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op6_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sorted(map(repr, got)) == sorted(map(repr, mixing.op6_mixing(spark, str(tmp_path)).collect()))
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len((t or "").split())
    targets = {r.source_size: r.target for r in got}
    assert targets.keys() == set(size.values()) and abs(sum(targets[n] for n in size.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(t <= 2 * n + 1e-9 for n, t in targets.items()) and all(r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0 for r in got)
    taken = Counter()
    for r in got:
        taken[r.source_size] += r.taken
    assert all(abs(taken[n] - targets[n]) <= 0.1 * targets[n] for n in targets if n > 10_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    many = Counter(r.doc_id for r in mixing.emitted(docs).collect())
    by = {r.doc_id: r.taken // r.size for r in got if r.size and r.doc_id is not None and r.doc_id != 7}
    assert all(many[i] == n for i, n in by.items()) and mixing.emitted(docs).columns == docs.columns
