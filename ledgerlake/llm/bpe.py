"""Byte-level BPE encoding and decoding by a table of distinct words.

Spark splits texts into words. Documents are gathered in lots; a lot keeps its distinct words, numbered from the most frequent
one on, and every document as numbers. The words of all lots are dealt out by a hash, so that each distinct word
is encoded once, by merge rounds over flat arrays, and its ids go back to the lots that asked, by position.
There a document's ids stand in the order of its numbers; lots are written in buckets, so that they aren't shuffled for it. Decoding joins ids to pieces (a table of the vocabulary's
size, sent to tasks): a word's text is that of its ids, a document's that of its words.

Texts are taken whole, however long; a null text is an empty one and has no ids. Repeated rows are rows of their own,
null keys stay null, an empty table gives no rows, and other columns take no part. A special token's
text stands for that token wherever it occurs, as in the library's default. Words that occur everywhere
are asked for once by each lot. Lots and tables of words are bounded by LOT_BYTES (one longer text is a lot of its own) and
BUCKET_WORDS; what is written and shuffled is compressed numbers.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, bucketed, discard, saved, spread, table
from .sentencepiece import Merges, Pairs

LOT_BYTES, BUCKET_WORDS = 16 << 20, 200_000
#: The most buckets that Spark lets a table have by default; with more partitions than that, lots are shuffled to join them.
BUCKETS = 100_000
#: Bytes of words whose merges are worked out at a time.
MERGE_BYTES = 500_000

# White space, and the letters and numbers of Unicode 14 to 16, which an older Java doesn't know as such.
WHITE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
NEW_LETTERS = """870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3 A7D5-A7DC A7F2-A7F4
10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3 10780-10785 10787-107B0 107B2-107BA 10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81
11071-11072 11075 1123F-11240 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10 11F12-11F33 12F90-12FF0 1342F 13441-13446 13460-143FA
16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE
2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF"""
NEW_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79 1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA"


def ranges(codes: str) -> str:
    """Ranges of code points in hexadecimal as the inside of a Java character class."""
    return "".join("-".join(rf"\x{{{c}}}" for c in r.split("-")) for r in codes.split())


def word_pattern() -> str:
    """The pattern of byte-level BPE's words in Java's syntax. New characters are looked for only where they lie."""
    letter = rf"[\p{{L}}[\x{{870}}-\x{{323AF}}&&[{ranges(NEW_LETTERS)}]]]"
    number = rf"[\p{{N}}[\x{{10D40}}-\x{{1E5FA}}&&[{ranges(NEW_NUMBERS)}]]]"
    other = rf"[^\p{{L}}\p{{N}}{WHITE}{ranges(NEW_LETTERS)}{ranges(NEW_NUMBERS)}]"
    return rf"'(?:[stmd]|re|ve|ll)| ?{letter}+| ?{number}+| ?{other}+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def split_words(text: Column, special: list[str]) -> Column:
    """Words of a text in order; special tokens are words, and the text between them is split by itself."""
    plain = lambda t: F.regexp_extract_all(t, F.lit(word_pattern()), F.lit(0))
    text = F.coalesce(text, F.lit(""))
    whole = plain(text)
    for token in special:  # the text of one can't hold another's: load() makes sure
        parts = F.split(text, re.escape(token), -1)
        split = F.flatten(F.transform(parts, lambda t, i: F.when(i > 0, F.concat(F.array(F.lit(token)), plain(t))).otherwise(plain(t))))
        whole = F.when(F.contains(text, F.lit(token)), split).otherwise(whole)
    return whole


class Vocabulary(Merges):
    """Merges, pieces and special tokens of a byte-level BPE model."""

    def __init__(self, model: dict):
        kind, split = model["model"], model["pre_tokenizer"]
        if kind["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or model["normalizer"] or kind.get("ignore_merges") or kind.get("dropout"):
            raise ValueError("the model isn't plain byte-level BPE")
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        if len(self.special) > 1 or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in model["added_tokens"]):
            raise ValueError("one special token, taken as it stands, is expected")
        vocab = kind["vocab"]
        # a byte is written as itself where that can be seen, and else as one of the characters from 256 on
        seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        char = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*seen}))}
        byte = {c: b for b, c in char.items()}
        self.byte = np.array([vocab[char[b]] for b in range(256)], np.int32)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in kind["merges"])
        super().__init__(Pairs({(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}))
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for piece, i in vocab.items():
            pieces[i] = bytes(byte[c] for c in piece)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_bytes, self.piece_size = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces])
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        size = pc.binary_length(words).to_numpy().astype(np.int64)
        ids, count = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64)
        lot = np.cumsum(size) // MERGE_BYTES
        for k in np.unique(lot):
            a, b = np.searchsorted(lot, [k, k + 1])
            raw = np.frombuffer(b"".join(w.encode() for w in words[a:b].to_pylist()), np.uint8)
            sym, word = self.merged(self.byte[raw], np.repeat(np.arange(b - a, dtype=np.int32), size[a:b]))
            ids.append(sym)
            count[a:b] = np.bincount(word, minlength=b - a)
        ids = np.concatenate(ids)
        for token, i in self.special.items():
            at = pc.index(words, token).as_py()
            if at >= 0:
                start = count[:at].sum()
                ids = np.r_[ids[:start], [i], ids[start + count[at] :]].astype(np.int32)
                count[at] = 1
        return ids, count

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The bytes of each word: its ids joined to their pieces."""
        size = self.piece_size[ids]
        raw = self.piece_bytes[spread(self.piece_start[ids], size)].tobytes()
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(count)]].tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]


def load(path: str) -> dict:
    """The model, read on the driver and sent with the tasks (a few megabytes)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@functools.lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(json.loads(zlib.decompress(model)))


def squeezed(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte by byte of all of them, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    used = next((k for k in (4, 3, 2, 1) if planes[k - 1 :].any()), 1)
    raw = planes[:used].tobytes()
    return len(raw).to_bytes(8, "little") + bytes([used]) + pa.compress(raw, codec="zstd", asbytes=True)


def numbers(data: bytes) -> np.ndarray:
    size, used = int.from_bytes(data[:8], "little"), data[8]
    raw = np.frombuffer(pa.decompress(data[9:], size, codec="zstd", asbytes=True), np.uint8).reshape(used, -1) if size else np.zeros((used, 0), np.uint8)
    out = np.zeros((raw.shape[1], 4), np.uint8)
    out[:, :used] = raw.T
    return out.view("<u4")[:, 0].astype(np.int64)


def squeezed_words(words: pa.Array) -> bytes:
    """Words, none of which is empty, as their sizes and their text."""
    sizes, raw = squeezed(pc.binary_length(words).to_numpy()), "".join(words.to_pylist()).encode()
    return len(sizes).to_bytes(8, "little") + sizes + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed_words(data: bytes) -> pa.Array:
    at = 8 + int.from_bytes(data[:8], "little")
    ends = np.r_[0, np.cumsum(numbers(data[8:at]))].astype(np.int32)
    raw = pa.decompress(data[at + 8 :], int.from_bytes(data[at : at + 8], "little"), codec="zstd")
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), raw)


def lots(docs: DataFrame, key: str, text: str, special: list[str], n: int) -> DataFrame:
    """Lots of documents, written in n buckets: lot, keys, counts (words of each document), numbers (of their words), words."""
    kind = docs.schema[key].dataType.simpleString()
    rows = bound_batches(docs).select(F.col(key).alias("key"), split_words(F.col(text), special).alias("words"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, keys, lists, held = TaskContext.get().partitionId(), 0, [], [], 0

        def lot() -> pa.RecordBatch:
            nonlocal n, keys, lists, held
            words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
            counts = pa.concat_arrays([x.value_lengths() for x in lists])
            order = np.argsort(-np.bincount(words.indices, minlength=len(words.dictionary)), kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            out = [pa.array([f"{task}-{n}"]), one(pa.concat_arrays(keys)), one(counts), pa.array([squeezed(number[words.indices])], pa.binary()), one(words.dictionary.take(pa.array(order)))]
            n, keys, lists, held = n + 1, [], [], 0
            return pa.RecordBatch.from_arrays(out, ["lot", "keys", "counts", "numbers", "words"])

        for batch in batches:
            words = batch.column("words")
            ends = np.cumsum(words.value_lengths().to_numpy())
            size = np.r_[0, np.cumsum(pc.binary_length(words.flatten()).to_numpy().astype(np.int64))][ends]
            size = np.diff(np.r_[0, size])
            a = 0
            for b in range(1, batch.num_rows + 1):
                held += size[b - 1]
                if held >= LOT_BYTES or b == batch.num_rows:
                    keys.append(batch.column("key").slice(a, b - a))
                    lists.append(words.slice(a, b - a))
                    a = b
                if held >= LOT_BYTES:
                    yield lot()
        if keys:
            yield lot()

    return bucketed(rows.mapInArrow(gather, f"lot string, keys array<{kind}>, counts array<int>, numbers binary, words array<string>"), "bpe-lots", "lot", n)


def dealt(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The words of a lot by bucket, with their numbers in the lot."""
    for batch in batches:
        for j in range(batch.num_rows):
            words = batch.column("words")[j].values
            bucket = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words)) % n
            order = np.argsort(bucket, kind="stable")
            there, start = np.unique(bucket[order], return_index=True)
            parts = np.split(order, start[1:]) if len(order) else []
            out = [pa.array(there, pa.int32()), pa.array([batch.column("lot")[j].as_py()] * len(parts), pa.string()), pa.array([squeezed(np.diff(p, prepend=0)) for p in parts], pa.binary()), pa.array([squeezed_words(words.take(pa.array(p))) for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["bucket", "lot", "at", "words"])


def encode_bucket(rows: pa.Table, vocab: Vocabulary) -> pa.Table:
    """Each distinct word of a bucket is encoded once; every lot gets the ids of the words that it asked for."""
    asked = [unsqueezed_words(w) for w in rows.column("words").to_pylist()]
    words = pa.concat_arrays(asked).dictionary_encode()
    ids, count = vocab.encode(words.dictionary)
    start, of = np.cumsum(count) - count, np.split(words.indices.to_numpy(), np.cumsum([len(x) for x in asked])[:-1])
    found = [(squeezed(count[x]), squeezed(ids[spread(start[x], count[x])])) for x in of]
    return pa.table({"lot": rows.column("lot"), "at": rows.column("at"), "n": pa.array([a for a, _ in found], pa.binary()), "ids": pa.array([b for _, b in found], pa.binary())})


def lot_ids(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids of a lot's words in the order of their numbers, number of ids of each) from what the buckets sent."""
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([np.cumsum(numbers(x)) for x in rows.column("at").to_pylist()])
    n, ids = (np.concatenate([numbers(x) for x in rows.column(c).to_pylist()]) for c in ("n", "ids"))
    order = np.argsort(at)
    return ids[spread((np.cumsum(n) - n)[order], n[order])], n[order]


def coded(docs: DataFrame, path: str, key: str, text: str, finish: Callable, shape: str) -> DataFrame:
    """What finish(keys, words' counts, words' numbers, ids, counts of ids, vocabulary) makes of each lot of documents."""
    model = load(path)
    small = zlib.compress(json.dumps(model).encode())
    tasks = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), BUCKETS)
    written = lots(docs, key, text, list(Vocabulary(model).special), tasks)
    n_words = written.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(tasks, -(-n_words // BUCKET_WORDS))
    asked = written.select("lot", "words").mapInArrow(lambda b: dealt(b, n), "bucket int, lot string, at binary, words binary")
    sent = asked.groupBy("bucket").applyInArrow(lambda rows: encode_bucket(rows, vocabulary(small)), "lot string, at binary, n binary, ids binary")

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, n = lot_ids(right)
        parts = [finish(left.column("keys")[j].values, left.column("counts")[j].values.to_numpy(), numbers(left.column("numbers")[j].as_py()), ids, n, vocabulary(small)) for j in range(left.num_rows)]
        return pa.concat_tables(parts)

    # the lots stay where they are, in as many buckets as the ids are dealt to
    out = saved(written.select("lot", "keys", "counts", "numbers").groupBy("lot").cogroup(sent.groupBy("lot")).applyInArrow(close, shape), "bpe-documents")
    discard(written)
    return out


def by_document(counts: np.ndarray, words: np.ndarray) -> Iterator[list[int]]:
    ends = np.r_[0, np.cumsum(counts)].tolist()
    for a, b in zip(ends, ends[1:]):
        yield words[a:b].tolist()


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids and decoded text of every document."""

    def finish(keys, counts, words, ids, n, vocab) -> pa.Table:
        start, plain = np.cumsum(n) - n, vocab.decode(ids, n)
        total = np.r_[0, np.cumsum(n[words])][np.r_[0, np.cumsum(counts)]]
        flat = pa.array(ids[spread(start[words], n[words])], pa.int32())
        texts = [b"".join([plain[k] for k in doc]).decode("utf-8", "replace") for doc in by_document(counts, words)]
        return pa.table({key: keys, "ids": pa.ListArray.from_arrays(pa.array(total, pa.int32()), flat), "decoded": pa.array(texts, pa.string())})

    return coded(docs, path, key, text, finish, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, and the hashes of the ids and of the decoded text of every document."""

    def finish(keys, counts, words, ids, n, vocab) -> pa.Table:
        plain, name = vocab.decode(ids, n), list(map(str, range(len(vocab.piece_size))))
        ends = np.r_[0, np.cumsum(n)].tolist()
        flat = [name[i] for i in ids.tolist()]
        told = [",".join(flat[a:b]) for a, b in zip(ends, ends[1:])]
        total = np.diff(np.r_[0, np.cumsum(n[words])][np.r_[0, np.cumsum(counts)]])
        of_ids, of_text = [], []
        for doc in by_document(counts, words):
            of_ids.append(hashlib.sha256(",".join([told[k] for k in doc]).encode()).hexdigest())
            of_text.append(hashlib.sha256(b"".join([plain[k] for k in doc]).decode("utf-8", "replace").encode()).hexdigest())
        return pa.table({key: keys, "n_tokens": pa.array(total, pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_text, pa.string())})

    return coded(docs, path, key, text, finish, f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
