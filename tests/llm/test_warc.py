"""op9: archives as files, the map, revisits and single records."""

import base64
import hashlib
from collections import defaultdict
from pathlib import Path

from ledgerlake.llm import warc

KIND = "page_id long, url string, html string, digest string"
PAGES = [(1, "a", "<p>é"), (2, "u v", "<p>é"), (7, None, "<p>é"), (7, "again", "<p>é"), (3, None, None), (None, "z", ""), (9, "z", ""), (4, "z", "x" * 600_000), (5, "z", "lone"), (None, "n", "nobody"), (None, "n", "nobody"), (11, "r", "same"), (11, "r", "same")]


def expected(pages):
    most = {}
    for i, _, html in pages:
        if i is not None:
            most[html or ""] = max(i, most.get(html or "", i))
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        to = most.get(html or "")
        revisit = to is not None and to != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_query_equals_plain_version(spark, tmp_path):
    spark.createDataFrame([(*p, "x") for p in PAGES], KIND).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in warc.op9_warc(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == expected(PAGES)
    sf = "/root/testdata/sf0.01"
    pages = [(r.page_id, None, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect()]
    doubled = pages + [(10**6 + i, None, html) for i, _, html in pages[::2]]
    spark.createDataFrame([(*p, "x") for p in doubled], KIND).write.parquet(f"{tmp_path}/twice/pages.parquet")
    got = [tuple(r) for r in warc.op9_warc(spark, f"{tmp_path}/twice").collect()]
    assert sorted(got, key=repr) == expected(doubled) and sum(r[3] == "revisit" for r in got) >= len(pages[::2])


def test_files_frames_and_single_records(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], KIND)
    places = warc.written(pages, f"file://{tmp_path}/archive").collect()
    files = {p.name for p in Path(tmp_path, "archive").iterdir()}
    assert files == {r.bundle.rsplit("/", 1)[1] for r in places} and all(f.endswith(".warc.zst") for f in files)
    text = defaultdict(set)
    for i, _, html in PAGES:
        text[f"urn:page:{'none' if i is None else i}"].add((html or "").encode())
    for r in places:
        reader = warc.Reader(r.bundle)
        for e in r.entries:
            one = reader.record(r.frame, e.offset, e.length)
            assert one["record_id"] == e.record_id and (one["payload"] is None or one["payload"] in text[e.record_id])
    table = spark.createDataFrame(places, warc.MAP)
    assert [(r.page_id, bytes(r.payload)) for r in warc.fetched(table, ["urn:page:5"]).collect()] == [(5, b"lone")]


def test_whole_file_is_zstandard(spark, tmp_path):
    """Any reader that skips skippable frames reads a bundle from end to end."""
    import io

    import zstandard

    for r in warc.written(spark.createDataFrame([(*p, "x") for p in PAGES], KIND).coalesce(1), f"file://{tmp_path}/a").collect():
        data = Path(r.bundle.removeprefix("file://")).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") >= len(r.entries)


def test_empty_and_smallest_size(spark):
    none = warc.written(spark.createDataFrame([], KIND))
    assert none.collect() == [] and warc.read(none).collect() == []
    got = warc.read(warc.written(spark.createDataFrame([(*p, "x") for p in PAGES], KIND), min_bytes=5)).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {1, 2}  # "same" has four bytes
