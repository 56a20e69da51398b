"""op1 against all pairs: a table, planted clusters that open groups, shared passages, edges; and the stage that keeps one of each."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, jaccard, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingled(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain(rows):
    """(id, size of set, least id reachable) of each row, by counting what pairs share."""
    sets = [shingled(t) if i is not None else set() for i, t in rows]
    holders, top = defaultdict(list), list(range(len(rows)))

    def root(k):
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for k, s in enumerate(sets):
        both = defaultdict(int)
        for t in s:
            for j in holders[t]:
                both[j] += 1
            holders[t].append(k)
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                top[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(shingled(t)), least[root(k)] if i is not None else None) for k, (i, t) in enumerate(rows)), key=repr)


def query(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cno string, g int").write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in jaccard.op1_ngram_jaccard_join(spark, str(tmp_path)).collect()), key=repr)


def test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert sorted((tuple(r) for r in jaccard.op1_ngram_jaccard_join(spark, sf).collect()), key=repr) == plain(rows)


def planted():
    r = random.Random(4)
    vocab = [f"w{k}" for k in range(3000)]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    texts = [prose(r.randrange(5, 150)) for _ in range(150)]
    passage = prose(60)
    texts += [prose(n) + passage + prose(n) for n in (0, 2, 4, 6, 8, 10, 20, 40) for _ in range(8)]  # from near copies to a shared passage
    for edits in (1, 2, 3, 4, 5, 6):  # a cluster around the limit: some pairs link, some don't
        base = texts[-1] if edits == 1 else base
        for _ in range(30):
            t = list(base)
            for _ in range(edits):
                t[r.randrange(len(t))] = r.choice(vocab)
            texts.append(t)
    return [(k, " ".join(t)) for k, t in enumerate(texts)] + [(1000 + k, " ".join(texts[k])) for k in range(0, 300, 3)]


@pytest.mark.parametrize("rounds", [1, 4])
def test_clusters_open_groups(spark, tmp_path, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    seen, opened = [], jaccard.Join.opened
    monkeypatch.setattr(jaccard.Join, "opened", lambda self, may, groups: seen.append(may.count()) or opened(self, may, groups))
    rows = planted()
    assert query(spark, rows, tmp_path) == plain(rows)
    print("classes that open groups", seen)


def joined_rows(spark, after):
    """Most rows that a join made in the executions after this one."""
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    for e in (x.executionId() for x in map(store.executionsList().apply, range(store.executionsList().size()))):
        if e > after:
            nodes, values = store.planGraph(e).allNodes(), store.executionMetrics(e)
            for n in map(nodes.apply, range(nodes.size())):
                for m in map(n.metrics().apply, range(n.metrics().size())):
                    if "Join" in n.name() and m.name() == "number of output rows" and (v := values.get(m.accumulatorId())).isDefined():
                        most = max(most, int(v.get().replace(",", "")))
    return most


def test_texts_just_under_the_limit_do_not_meet_at_what_they_share(spark, tmp_path):
    r = random.Random(8)
    base = [f"b{k}" for k in range(150)]
    rows = [(k, " ".join(f"x{k}-{j}" if j in at else w for j, w in enumerate(base))) for k in range(300) for at in [set(r.sample(range(2, 148, 6), 6))]]
    rows += [(1000 + k, f"{t} end") for k, t in rows[:20]] + [(2000, " ".join(base)), (2001, " ".join(["one", "two", *base[2:]]))]
    last = spark._jsparkSession.sharedState().statusStore().executionsList()
    after = max((last.apply(k).executionId() for k in range(last.size())), default=-1)
    assert query(spark, rows, tmp_path) == plain(rows)
    assert joined_rows(spark, after) < 40 * len(rows)


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"), (None, None), (7, "a b c d e"), (7, "a b c d e"), (7, "other words stand right here"), (0, "other words stand right here"), (8, "É é İ"), (9, "é É İ"), (10, "x " * 40_000), (11, "x x x x x x"), (12, "end\x0bof\x0cword\x85s one"), (13, " ".join(map(str, range(40_000)))), (14, " ".join(map(str, range(39_000))))]


def test_edges(spark, tmp_path):
    assert query(spark, EDGES, tmp_path) == plain(EDGES)
    assert query(spark, [], tmp_path / "none") == []


def test_sets_are_those_of_the_words():
    texts = [t or "" for _, t in EDGES] + ["", "a b c d e f A B C D E F", "ab c d e f", "a bc d e f"]
    tokens, sizes = [], []
    for _, _, data, ends in shingles.lots(pa.array(texts)):
        t, e = shingles.sets(data, ends, 5)
        tokens += [x.tolist() for x in np.split(t, e[:-1])]
        sizes += np.diff(np.r_[0, e]).tolist()
    assert sizes == [len(shingled(t)) for t in texts]
    for text, own in zip(texts, tokens):
        assert own == sorted(set(own))
        for other, its in zip(texts, tokens):
            assert len(set(own) & set(its)) == len(shingled(text) & shingled(other))


def test_sliced_batches():
    whole = pa.array(["skip this one", "a b c d e f", "", "g h i j k l"])
    parts = [(data.tobytes().decode(), ends.tolist()) for _, _, data, ends in shingles.lots(whole.slice(1, 3))]
    assert parts == [("a b c d e fg h i j k l", [11, 11, 22])]


REPEATED = [(1, "alpha beta gamma delta epsilon", "x"), (1, "one two three four five", "y"), (1, "one two three four five", "z"), (2, "one two three four five", "x"), (2, "six seven eight nine ten", "x"), (3, "six seven eight nine ten", "x"), (4, "", "x"), (4, "", "x"), (4, None, "y"), (4, "red green", "x"), (None, "red green", "x"), (5, "red green", "x"), (6, "lone", "x"), (6, "lone", "x")]


def test_deduplicated_keeps_one_row_of_each_component(spark):
    got = jaccard.deduplicated(spark.createDataFrame(REPEATED, "doc_id long, text string, row string"))
    want = [(1, "alpha beta gamma delta epsilon"), (1, "one two three four five"), (2, "six seven eight nine ten"), (4, ""), (4, ""), (4, None), (4, "red green"), (None, "red green"), (6, "lone")]
    assert got.columns == ["doc_id", "text", "row"] and sorted(map(repr, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(repr, want))


def test_words_that_collide_in_polynomials_differ():
    """Thue-Morse words and their complements, whole and in blocks, and words that differ by the order of their blocks."""
    bit = lambda k: bin(k).count("1") % 2
    made = [b"".join((b"a", b"b")[bit(k) ^ flip] * times for k in range(2**n)) for n in range(3, 14) for flip in (0, 1) for times in (1, 8)]
    made += [b"abcdefgh" * 3 + b"ABCDEFGI", b"abcdefgi" + b"abcdefgh" * 3, b"a" * 8, b"a" * 16, b"a" * 7, b"a" * 9]
    data, ends = np.frombuffer(b" ".join(made), np.uint8), np.array([sum(map(len, made)) + len(made) - 1])
    hashes, count = shingles.words(data, ends)
    assert count.tolist() == [len(made)] and len(set(hashes.tolist())) == len({m.lower() for m in made})


def test_batches_for_python_are_bounded_in_bytes(spark):
    """Rows with many tokens (a class beside a block of members) are handed over by a few MB, not by 64 MB."""
    df = common.bound_batches(spark.range(0, 120, 1, 1).select(F.sequence(F.col("id"), F.col("id") + 49_999).alias("m")))

    @F.arrow_udf("array<bigint>")
    def told(m: pa.Array) -> pa.Array:
        return pa.array([[len(m), m.nbytes]] * len(m), pa.list_(pa.int64()))

    seen = [r["x"] for r in df.select(told("m").alias("x")).collect()]
    assert len(seen) == 120
    assert max(size for _, size in seen) < 3 * common.BATCH_BYTES
