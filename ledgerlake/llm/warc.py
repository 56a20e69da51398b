"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent frames, each of some records, ended by a seek table in a
skippable frame. Tasks write bundles to a folder that all executors share, each under a name
of its own attempt, at first with another ending; what is read is told by the map alone,
a table of (bundle, frame, records with their places in the frame) that Spark commits, so a
lost or repeated attempt leaves at most a file that the map doesn't name. A record is read by
seeking its frame. The folder is reached by pyarrow's file systems (file, hdfs, s3 and others).

A null html is an empty payload, a null url an empty one. Records with equal payloads:
all rows with the largest page_id among them are responses, the others revisit it; null
page_ids come last and, where no page_id is known, are responses. Repeated rows give
repeated records. An empty table gives an empty map and no file. Other columns take no part.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, shared_dir, table

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 256_000, 4_000_000
RESPONSE_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MAP = "bundle string, frame int, entries array<struct<record_id:string,offset:int,length:int>>"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """(record id, bytes) of one record; a revisit has the head of its response alone."""
    name = "none" if page_id is None else str(page_id)
    digest = sha1_base32(payload)
    record_id = f"urn:page:{name}"
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    block = RESPONSE_HEAD + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return record_id, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> Iterator[dict]:
    """The records in the bytes of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
        block = data[end + 4 : end + 4 + int(head["Content-Length"])]
        at = end + 8 + len(block)
        of = lambda uri: None if (x := uri.strip("<>").rsplit(":", 1)[1]) == "none" else int(x)
        revisit = head["WARC-Type"] == "revisit"
        payload = None if revisit else block[block.index(b"\r\n\r\n") + 4 :]
        if payload is not None and f"sha1:{sha1_base32(payload)}" != head["WARC-Payload-Digest"]:
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        yield {
            "page_id": of(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"], "payload": payload,
            "payload_bytes": int(head["X-Payload-Length"]) if revisit else len(payload),
            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": head["WARC-Type"],
            "refers_to": of(head["WARC-Refers-To"]) if revisit else None, "record_id": head["WARC-Record-ID"].strip("<>"),
        }


class Bundle:
    """A bundle in the making: frames go to the file as they fill."""

    def __init__(self, folder: str, name: str, level: int = 3):
        import zstandard
        from pyarrow import fs

        self.packer = zstandard.ZstdCompressor(level=level)
        self.path = f"{folder}/{name}"
        self.system, self.place = fs.FileSystem.from_uri(self.path)
        self.system.create_dir(self.place.rsplit("/", 1)[0], recursive=True)
        self.file = self.system.open_output_stream(self.place + ".open")
        self.sizes: list[tuple[int, int]] = []
        self.entries: list[list[dict]] = []
        self.open, self.raw = bytearray(), 0

    def add(self, record_id: str, data: bytes) -> None:
        if not self.open or len(self.open) + len(data) > FRAME_BYTES:
            self._close_frame()
            self.entries.append([])
        self.entries[-1].append({"record_id": record_id, "offset": len(self.open), "length": len(data)})
        self.open += data
        self.raw += len(data)

    def _close_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(bytes(self.open))
            self.file.write(frame)
            self.sizes.append((len(frame), len(self.open)))
            self.open = bytearray()

    def close(self) -> pd.DataFrame:
        """End the file; its rows of the map."""
        self._close_frame()
        seek = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(seek)) + seek)
        self.file.close()
        self.system.move(self.place + ".open", self.place)
        return pd.DataFrame({"bundle": self.path, "frame": range(len(self.entries)), "entries": self.entries})


def seek_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the end of a bundle."""
    n, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    out, at = [], 0
    for packed, size in struct.iter_unpack("<II", tail[-9 - 8 * n : -9]):
        out.append((at, packed, size))
        at += packed
    return out


class Reader:
    """Frames of a bundle by their numbers; only the footer and the frames asked for are read."""

    def __init__(self, path: str):
        import zstandard
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        n = struct.unpack("<I", self.file.read_at(9, size - 9)[:4])[0]
        self.frames = seek_table(self.file.read_at(9 + 8 * n, size - 9 - 8 * n))
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, size = self.frames[number]
        return self.unpacker.decompress(self.file.read_at(packed, at), max_output_size=max(1, size))

    def record(self, number: int, offset: int, length: int) -> dict:
        return next(parsed(self.frame(number)[offset : offset + length]))


def classified(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to (null for responses) of each row.

    Digests are counted before the join, and only those of two or more rows enter it; large
    groups of copies are on its left side, where adaptive execution splits them.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    most = rows.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("of"), F.col("size").alias("of_size")).agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(most, (F.col("digest") == F.col("of")) & (F.col("size") == F.col("of_size")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def written(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write the archive of pages as files in folder (one of its own in the shared folder); returns its map."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/ledgerlake/archive-{uuid.uuid4().hex}"

    def pack(lots: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, n, b = TaskContext.get(), 0, None
        for lot in lots:
            for page_id, url, html, refers in lot.itertuples(index=False):
                page, ref = (None if x is None else int(x) for x in (page_id, refers))
                if b is None:
                    b, n = Bundle(folder, f"{task.partitionId():06d}-{n:06d}-{task.taskAttemptId()}.warc.zst"), n + 1
                b.add(*record(page, url, html.encode(), ref))
                if b.raw >= BUNDLE_BYTES:
                    yield b.close()
                    b = None
        if b is not None:
            yield b.close()

    # Ids go as text, so that pandas keeps nulls and whole numbers apart.
    rows = classified(pages, min_bytes).select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))
    return saved(rows.mapInPandas(pack, MAP), "warc-map")


def read(places: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that rows of a map name, each cut from its frame at its place."""

    def unpack(lots: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        path, bundle = None, None
        for lot in lots:
            for at, number, entries in lot.itertuples(index=False):
                if at != path:
                    path, bundle = at, Reader(at)
                data = bundle.frame(number)
                rows = [next(parsed(data[e["offset"] : e["offset"] + e["length"]])) for e in entries]
                if [r["record_id"] for r in rows] != [e["record_id"] for e in entries]:
                    raise ValueError(f"frame {number} of {at} doesn't hold what the map says")
                out = pd.DataFrame([{**r, "payload": r["payload"] if payloads else None} for r in rows], columns=names, dtype=object)
                yield out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    return places.select("bundle", "frame", "entries").mapInPandas(unpack, RECORD)


def fetched(places: DataFrame, record_ids: list[str]) -> DataFrame:
    """The records of these ids; only the frames that hold them are read."""
    wanted = F.array(*[F.lit(x) for x in record_ids])
    return read(places.withColumn("entries", F.filter("entries", lambda e: F.array_contains(wanted, e["record_id"]))).where(F.size("entries") > 0))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read(written(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
