"""op12 against the library itself."""

import hashlib
import random

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import bpe

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def expected(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return ids, lib.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, lib):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for i, t in duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall():
        ids, text = expected(lib, t)
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(text))
    got = bpe.op12_bpe(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_edges_and_extra_columns(spark, lib, monkeypatch):
    r = random.Random(2)
    texts = [None, "", " ", "\n\n x", "a  b", "don't I'll 'S ''s 's", "<|endoftext|>", "a  <|endoftext|>\n<|endoftext|><|endoftext", "!<|endoftext|>!", "日本語 текст é🙂 ½²٣", "a 　b  c", "\x00\x1c\x7f\u0085x"]
    texts += ["x" * 60_000, " " * 30_000 + "y", "ab" * 30_000, "word " * 50_000, "".join(r.choice("abcdefXYZ0123456789+/") for _ in range(20_000))]
    texts += ["".join(r.choice(" \n\t'se12é漢!<|>") for _ in range(r.randrange(60))) for _ in range(300)]
    rows = [(k if k % 9 else None, t, 1.0, "w") for k, t in enumerate(texts)] + [(5, texts[5], 2.0, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, n double, words string").repartition(3)
    monkeypatch.setattr(bpe, "LOT_BYTES", 50_000)
    monkeypatch.setattr(bpe, "BUCKET_WORDS", 100)
    out = bpe.encoded(df, PATH)
    assert out.columns == ["doc_id", "ids", "decoded"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in out.collect()), key=key) == sorted(((k, *expected(lib, t)) for k, t, *_ in rows), key=key)
    assert bpe.encoded(df.where("false"), PATH).collect() == []


def test_words_are_split_as_by_the_library(spark, lib):
    """Of all characters, those that Java may not know and every hundredth other one."""
    new = [c for r in (bpe.NEW_LETTERS + " " + bpe.NEW_NUMBERS).split() for c in range(int(r.split("-")[0], 16), int(r.split("-")[-1], 16) + 1)]
    known = {*range(0, 0x3100), *range(0x3100, 0x110000, 100), *new[::7], *[c + d for c in new[::7] for d in (-1, 1)]} - {*range(0xD800, 0xE000)}
    texts = [(f"x{chr(c)}x 1{chr(c)}1 !{chr(c)}! {chr(c)}",) for c in sorted(known)]
    got = spark.createDataFrame(texts, "t string").select("t", bpe.split_words(F.col("t"), []).alias("w")).collect()
    wrong = [r.t for r in got if list(r.w) != [r.t[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(r.t)]]
    assert not wrong


def test_each_word_is_encoded_once(monkeypatch):
    vocab, seen = bpe.Vocabulary(bpe.load(PATH)), []
    monkeypatch.setattr(vocab, "encode", lambda words, f=vocab.encode: (seen.extend(words.to_pylist()), f(words))[1])
    words = [pa.array(["the", " cat", "é"]), pa.array([" cat", "the"])]
    rows = pa.table({"bucket": [0, 0], "lot": ["a", "b"], "at": [bpe.squeezed(pa.array([4, 3, 2]).to_numpy()), bpe.squeezed(pa.array([0, 1]).to_numpy())], "words": [bpe.squeezed_words(w) for w in words]})
    out = bpe.encode_bucket(rows, vocab)
    assert sorted(seen) == sorted(["the", " cat", "é"])
    ids, n = bpe.lot_ids(out.filter(pa.array([False, True])))
    assert b"".join(vocab.decode(ids, n)) == b" catthe"
