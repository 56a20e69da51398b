"""op2 against the library itself."""

import hashlib
import random

import duckdb
import public_tokenizers

from ledgerlake.llm import sentencepiece

SF = "/root/testdata/sf0.01"


def pieces():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return sentencepiece.Pieces(f.read())


def test_query_equals_the_library(spark):
    lib = pieces().library
    want = {}
    for i, t in duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall():
        ids = lib.encode(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
    got = sentencepiece.op2_sentencepiece(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_runs_overlaps_and_long_words():
    r, p = random.Random(1), pieces()
    texts = ["", " ", "\n", "a" * 900, "ab" * 700, " " * 300, "▁ x▁▁y", "日本語" * 200, "🙂é́", "<s></s>", "x\ny\t z\x00"]
    texts += ["".join(r.choice(abc) for _ in range(n)) for abc in ("aab", "abcde thein", "=-_#*. \n") for n in (3, 10, 50, 500) for _ in range(150)]
    texts.append("".join(r.choice("abcdefghijklmnopqrstuvwxyzABC0123456789+/") for _ in range(20_000)))
    assert p.encode(texts) == p.library.encode(texts)


def test_nulls_empty_and_long_rows(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é🙂"), (4, "word " * 200_000)]
    lib = pieces().library
    df = sentencepiece.encoded(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), public_tokenizers.path("piece_bpe_32k.model"))
    for r in df.collect():
        ids = lib.encode(r.text or "")
        assert (r.tokens.ids, r.tokens.decoded) == (ids, lib.decode(ids))
