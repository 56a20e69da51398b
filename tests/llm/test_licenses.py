"""op10 against a plain version of its rules and of its contract."""

import re
import time

import duckdb

from ledgerlake.llm import licenses
from ledgerlake.llm.signatures import BASE, signatures

SF = "/root/testdata/sf0.01"
RULES = signatures()


def plain(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    norm = " ".join(words)
    base = [(k, label) for phrase, label in BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    hits = [(m.start(), m.end(), s.priority, s.label) for s in RULES if s.keyword in norm for m in re.finditer(s.pattern, norm)]
    kept = [h for h in hits if not any(k[0] <= h[0] and k[1] >= h[1] and k[2] > h[2] for k in hits)]
    places, labels = [k for k, _ in base], {x for _, x in base}
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {h[3] for h in kept})), max((h[2] for h in kept), default=0) / 100)


def query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string, labels string").write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: tuple(r)[1:] for r in licenses.op10_license_scan(spark, str(tmp_path)).collect()}


TEXTS = [None, "", "MIT License", "mit-license, Apache (License)! general public license", "Licensed under the Apache License, Version 2.0 (the \"License\")", "GNU Lesser General Public License v2.1 or the GNU General Public License", "emit license permit licenses", "mit license mit license", "SPDX-License-Identifier: LGPL-2.1-or-later", "x" * 50_000, "é MIT License é", "CC BY-NC-SA 4.0 and cc-by-sa 3.0; all rights reserved.", "under the same terms as Perl itself"]


def test_texts(spark, tmp_path):
    got = query(spark, [(k, t, "x") for k, t in enumerate(TEXTS)], tmp_path)
    assert got == {k: plain(t) for k, t in enumerate(TEXTS)}


def test_table(spark):
    text = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = {r.doc_id: tuple(r)[1:] for r in licenses.op10_license_scan(spark, SF).collect()}
    assert got == {i: plain(t) for i, t in text.items()} and sum(r[1] > 0 for r in got.values()) > 0


def test_every_signature_has_its_keyword_in_some_form():
    assert len(RULES) > 200 and len({r.label for r in RULES}) > 50
    assert all(r.keyword == " ".join(r.keyword.split()) for r in RULES)


def test_long_texts_of_hits_grow_in_proportion(spark, tmp_path):
    took = []
    for n in (1000, 4000):
        began = time.perf_counter()
        got = query(spark, [(1, "mit license or apache license and " * n, "x")], tmp_path / str(n))
        took.append(time.perf_counter() - began)
        assert got[1][1] == 2 * n and got[1][2:4] == (0, 6 * n - 3)
    print("seconds", took)
    assert took[1] < 5 * took[0]
