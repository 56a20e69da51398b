"""Edge cases of the operators, and their results against plain versions."""

from collections import defaultdict

import duckdb
import pytest

from ledgerlake.llm import chat, jaccard, licenses, mixing, nearest, quality, sentencepiece, sharding, toxicity, warc

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, size string"
NASTY = [(1, None, None, None, None, "a", "b"), (2, "", "en", "s", 0, None, None), (3, "one two\nthree", "en", "s", 9, None, None), (3, "one two\nthree", "en", "s", 9, None, None), (None, "x " * 300, "en", None, 1, None, None), (5, "mit license " * 400, "en", "t", 1, None, None), (6, " ".join(f"w{k}" for k in range(9000)), "en", "t", 1, None, None)]


def rows(sql):
    return duckdb.connect().execute(sql).fetchall()


@pytest.fixture(scope="module")
def nasty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("nasty")
    spark.createDataFrame(NASTY, DOC).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(3, 0, 1), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None, "<p>é"), (2, "u v", "<p>é"), (3, None, None), (None, "z", ""), (4, "z", "x" * 600_000)], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (None, [1.0, 1.0]), (7, [1.0])], "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for t, kind in {"documents": DOC, "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>"}.items():
        spark.createDataFrame([], kind).write.parquet(f"{d}/{t}.parquet")
    return str(d)


OPS = [jaccard.op1_ngram_jaccard_join, sentencepiece.op2_sentencepiece, quality.op3_quality_rules, nearest.op4_nearest_neighbours, sharding.op5_sharding, mixing.op6_mixing, toxicity.op7_toxicity, warc.op9_warc, licenses.op10_license_scan]


@pytest.mark.parametrize("op", OPS, ids=lambda f: f.__name__)
def test_nasty_and_empty_tables(spark, nasty, empty, op):
    out = op(spark, nasty).collect()
    assert len(out) == {"op4_nearest_neighbours": 2, "op9_warc": 5}.get(op.__name__, len(NASTY))
    assert op(spark, empty).collect() == []


@pytest.mark.parametrize("op,sql", [(quality.op3_quality_rules, quality.ORACLE), (mixing.op6_mixing, mixing.ORACLE)])
def test_sql(spark, op, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(sql).fetchall()
    near = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(near, want)) == sorted(map(near, map(tuple, op(spark, SF).collect())))


TALK = [(1, 0, "system", "s"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, "ann", "é🙂"), (1, 300, None, "who"), (2, 0, "system", "only"), (None, 5, "ann", "alone"), (None, 5, "ann", "alone"), (None, None, None, None), (3, 0, "a b\tc", ""), (3, 0, "bob", "x" * 5000)]


@pytest.mark.parametrize("talk", [TALK, [], None], ids=["edges", "empty", "table"])
def test_chat_equals_sql(spark, tmp_path, talk):
    sf = "/root/testdata/sf0.01" if talk is None else str(tmp_path)
    if talk is not None:
        spark.createDataFrame([(*t, "a") for t in talk], "conv_id long, turn long, role string, text string, start string").write.parquet(f"{sf}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet{'' if talk is None else '/*.parquet'}'")
    cur = con.execute(chat.ORACLE)
    df = chat.op8_chat_rotation(spark, sf)
    assert df.columns == [c[0] for c in cur.description]
    assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r)) for r in df.collect())


def test_chat_spans_are_the_assistants_words(spark):
    whole = defaultdict(list)
    for r in sorted(chat.rotated(spark.createDataFrame(TALK[:6], "conv_id long, turn long, role string, text string")).collect(), key=lambda r: r.position):
        whole[r.perspective].append(r)
    assert set(whole) == {"ann", "bob"}
    for who, parts in whole.items():
        text = "".join(r.rendered for r in parts)
        assert [text[r.train_start : r.train_stop] for r in parts if r.train_start is not None] == {"ann": ["hi < |im_end|><|im_end|>", "é🙂<|im_end|>"], "bob": ["<|im_end|>"] * 2}[who]
        assert all(text[r.start : r.stop] == r.rendered for r in parts)
