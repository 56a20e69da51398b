"""op7: the field's marginals against enumeration over tags, offsets, and held-out labels."""

import random
import zlib
from itertools import product

import duckdb
import numpy as np
import pytest

from ledgerlake.llm import toxicity


@pytest.mark.parametrize("seed", range(6))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    trans, sizes = rng.normal(size=(2, 2)), np.array([1, 3, 6])
    u = rng.normal(size=(3, 6)) * 3
    p, pairs = toxicity.marginals(trans, u, sizes)
    want_pairs = np.zeros((2, 2))
    for row, n in enumerate(sizes):
        weight = {y: np.exp(sum(u[row, k] * y[k] for k in range(n)) + sum(trans[y[k - 1], y[k]] for k in range(1, n))) for y in product((0, 1), repeat=int(n))}
        z = sum(weight.values())
        for k in range(6):
            assert p[row, k] == pytest.approx(sum(w for y, w in weight.items() if y[k]) / z if k < n else 0.0)
        for k in range(1, n):
            for y, w in weight.items():
                want_pairs[y[k - 1], y[k]] += w / z
    assert pairs == pytest.approx(want_pairs)


R = random.Random(2)
VOCAB = ["".join(R.choice("bcdfglmnprstv") + R.choice("aeiou") for _ in range(R.choice([2, 3, 4]))) for _ in range(400)]
CLEAN = [" ".join(R.choice(VOCAB) for _ in range(20)) for _ in range(160)]
BAD = [" ".join([*(R.choice(VOCAB) for _ in range(9)), "grobble", *(R.choice(VOCAB) for _ in range(9))]) for _ in range(150)]


def test_offsets_name_the_words(spark):
    field = toxicity.fitted(CLEAN + BAD, [0] * len(CLEAN) + [1] * len(BAD))
    df = spark.createDataFrame([("é well\ngrobble here",), (CLEAN[0],), (None,), ("",)], "text string")
    got = toxicity.scored(df, field).collect()
    assert ["é well\ngrobble here"[s.start : s.stop] for s in got[0].toxicity.spans] == ["grobble"]
    assert got[0].toxicity.score >= 0.5 > max(r.toxicity.score for r in got[1:]) and got[1].toxicity.spans == []
    assert got[2].toxicity.score == got[3].toxicity.score


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(k, "text") for k in range(20)], "doc_id long, text string")
    for toxic, score in ((1, 1.0), (0, 0.0), (None, 0.0)):
        labels = spark.createDataFrame([(k, toxic) for k in range(20)], "doc_id long, toxic int")
        assert {round(r.toxicity.score, 6) for r in toxicity.scored(docs, toxicity.trained(docs, labels)).collect()} == {score}


def test_clean_drops_toxic_rows_alone(spark):
    rows = [(k, t, "x") for k, t in enumerate(CLEAN)] + [(1000 + k, t, "y") for k, t in enumerate(BAD)] + [(None, None, "z"), (None, BAD[0], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _, _ in rows if i is not None], "doc_id long, toxic int")
    got = toxicity.clean(docs, labels)
    assert got.columns == docs.columns and sorted(r.toxicity for r in got.collect()) == ["x"] * len(CLEAN) + ["z"]


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"  # sf0.01 holds out 6 toxic documents only
    toxic = dict(duckdb.connect().execute(f"SELECT doc_id, max(toxic) FROM '{sf}/labels.parquet' GROUP BY 1").fetchall())
    got = [(toxic[r.doc_id], r.predicted) for r in toxicity.op7_toxicity(spark, sf).collect() if r.held_out and toxic.get(r.doc_id) is not None]
    bad, clean = [p for t, p in got if t], [p for t, p in got if not t]
    print("toxic found", sum(bad), len(bad), "false alarms", sum(clean), len(clean))
    assert bad and sum(bad) >= 0.85 * len(bad) and sum(clean) <= 0.03 * len(clean)


def test_only_near_copies_are_left_out_of_the_fit():
    """Unlike texts that share their common words all stay, however many there are; copies and near copies go."""
    r = random.Random(9)
    common = VOCAB[:40]
    unlike = [set(common) | {r.choice(VOCAB) for _ in range(60)} for _ in range(600)]
    near = [unlike[0], unlike[1] | {"one"}, set(list(unlike[2])[1:])]

    def kept(docs):
        number = {w: k for k, w in enumerate(sorted(set().union(*docs)))}
        return toxicity.distinct_documents([np.array(sorted(number[w] for w in d), np.int32) for d in docs], np.array([zlib.crc32(w.encode()) for w in number], np.uint64))

    assert kept(unlike) == list(range(600)) and kept(unlike + near) == list(range(600)) and kept([set(), {"a"}, {"a"}]) == [1]


def test_held_out_and_predicted_follow_their_rules(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op7_toxicity(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got) and any(r.held_out for r in got)


def test_shares_are_the_marginals():
    rng = np.random.default_rng(3)
    trans, size = rng.normal(0, 2, (2, 2)), np.array([1, 1, 2, 5, 5, 9, 40])
    u = np.where(np.arange(40)[None, :] < size[:, None], rng.normal(0, 9, (7, 40)), 0.0)
    p, _ = toxicity.marginals(trans, u, size)
    assert np.allclose(toxicity.shares(trans, np.exp(np.clip(u, -30, 30)).T, size), p.T, rtol=1e-9, atol=1e-14)


def test_a_line_is_worked_out_once(monkeypatch):
    """Also of texts with tagged words, whose places come from the same marginals; features of words are those of marks()."""
    vocab = {m: k + 1 for k, m in enumerate(["bad", "^bad", "^badl", "fine", "\u03c3", "\u03c2", "i\u0307"])}
    f = toxicity.Field(vocab, np.array([0, 4.0, 3, 2, -1, 1, 2, 3]), -3.0, np.zeros((2, 2)), np.array([-1.0, 2, 1]))
    seen, ids = [], toxicity.Tokens.ids
    monkeypatch.setattr(toxicity.Tokens, "ids", lambda self, line: seen.append(line) or ids(self, line))
    texts = ["So BAD it is\nfine here", "so badly it is\nfine here", "", "\u03a3'\u03b1 \u0130 BADLYS caf\u00e9\nSo BAD it is"]
    x, spans = toxicity.scanned(f, texts, toxicity.Tokens(vocab))
    assert sorted(seen) == sorted({line for t in texts for line in t.split("\n")})
    for k, t in enumerate(texts):
        words = [(w.group().lower(), w.span()) for w in toxicity.WORD.finditer(t)]
        p = [1 / (1 + np.exp(3.0 - f.unary[[vocab.get(m, 0) for m in toxicity.marks(w)]].sum())) for w, _ in words]
        assert np.allclose(x[k], [1, max(p, default=0), np.log1p(sum(p))])
        assert [(s["start"], s["stop"]) for s in spans[k]] == [at for q, (_, at) in zip(p, words) if q >= 0.5]
