"""Each stage of the pipeline against a plain version on what the stage before it wrote."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import public_tokenizers

import corpus_pipeline
from ledgerlake.llm import mixing, quality, sentencepiece, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(11)
VOCAB = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.choice([2, 3, 4]))) for _ in range(900)]


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def planted():
    """Clean texts, near copies, toxic ones, junk, repeats and nulls; and what marks each."""
    rows, kind = [], {}

    def put(i, text, what, source="a"):
        rows.append((i, text, "en", source, None))
        kind[i] = what

    for k in range(150):
        put(k, prose(rng.randrange(60, 120)), "clean", "abc"[k % 3])
    for k in range(40):
        words = rows[k][1].split()
        put(1000 + k, " ".join(words[:-1] + ["changed"]), "copy", None)
    for k in range(120):
        put(2000 + k, prose(40) + f" grobble {rng.choice(VOCAB)} snarkwit " + prose(40), "toxic")
    for k in range(20):
        put(3000 + k, "buy now " * 60, "junk")
    put(4000, None, "junk")
    put(4001, "", "junk")
    put(4002, "too short", "junk")
    rows.append((5, rows[5][1], "en", "b", 1))  # an id with two equal texts
    rows.append((None, prose(80), None, None, None))
    return rows, kind


def plain_dedup(rows):
    word, sets = re.compile(r"[^\x20\x09-\x0D]+"), []
    for i, t in rows:
        w = word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w and i is not None else None)
    label = list(range(len(rows)))

    def top(k):
        return k if label[k] == k else top(label[k])

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if sets[k]:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(least.values()), [t for k, (i, t) in enumerate(rows) if not sets[k]]


def test_stages(spark, tmp_path, monkeypatch):
    rows, kind = planted()
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(k != "junk"), int(k == "toxic")) for i, k in kind.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, saved = {}, corpus_pipeline.saved
    monkeypatch.setattr(corpus_pipeline, "saved", lambda df, name: kept.setdefault(name.removeprefix("pipeline-"), saved(df, name)))
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = {k: [tuple(r) for r in df.collect()] for k, df in kept.items()}
    assert all(df.columns == [c.split()[0] for c in DOC.split(", ")] for df in kept.values())

    # toxicity: the scores of the same field over the rows themselves, and what was planted
    field = toxicity.trained(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    x = toxicity.features(field, [r[1] or "" for r in rows]) @ field.head
    assert Counter(docs["toxicity"]) == Counter(r for r, z in zip(rows, x) if z < 0)
    assert {kind[r[0]] for r in rows if r[0] is not None} - {kind[r[0]] for r in docs["toxicity"] if r[0] is not None} == {"toxic"}
    assert sum(kind.get(r[0]) != "toxic" for r in docs["toxicity"]) == sum(kind.get(r[0]) != "toxic" for r in rows)

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs["toxicity"])
    good = Counter(i for i, k in con.execute(f"SELECT doc_id, kept FROM ({quality.ORACLE})").fetchall() if k)
    assert Counter(r[0] for r in docs["quality_rules"]) == good and {kind[i] for i in good if i is not None} == {"clean", "copy"}

    ids, others = plain_dedup([r[:2] for r in docs["quality_rules"]])
    assert sorted((r[0] for r in docs["ngram_jaccard"] if r[0] is not None)) == ids and ids == list(range(150))
    assert [r[1] for r in docs["ngram_jaccard"] if r[0] is None] == others and set(docs["ngram_jaccard"]) <= set(docs["quality_rules"])

    con.execute("DELETE FROM documents")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs["ngram_jaccard"])
    times = Counter({i: taken // size for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall()})
    assert Counter(r[0] for r in docs["mixing"]) == +times and set(docs["mixing"]) <= set(docs["ngram_jaccard"])

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        lib = sentencepiece.Pieces(f.read()).library
    want = Counter()
    for r in docs["mixing"]:
        t = lib.encode(r[1])
        want[r[0], len(t), hashlib.sha256(",".join(map(str, t)).encode()).hexdigest(), hashlib.sha256(lib.decode(t).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in final) == want


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
