"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

A null text is an empty one and has no ids. Repeated rows and other columns stay as they
are; the work is per row, without a shuffle. Texts are encoded whole, in lots that bound a
worker's memory: the symbols of a lot and the remembered words are counted in characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, spread, table

MARK = "▁"
#: Rank of a pair that doesn't merge.
NONE = np.iinfo(np.int32).max
#: Characters of the words whose ids are remembered; all are forgotten when there are more.
MEMORY_CHARS = 1_000_000
#: Texts are taken in lots of about so many characters (one longer text is a lot of its own).
LOT_CHARS = 500_000


class Pairs:
    """Rank and result of each pair that merges: open addressing over the two numbers of a pair."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.left = np.full(1 << self.bits, -1, dtype=np.int32)
        self.right, self.rank, self.result = self.left.copy(), np.full(1 << self.bits, NONE, dtype=np.int32), self.left.copy()
        if not pairs:
            return
        a, b, rank, result = (np.array(x, dtype=np.int32) for x in zip(*[(*k, *v) for k, v in pairs.items()]))
        at, rest = self._slot(a, b), np.arange(len(a))
        while len(rest):
            # of those that ask for a free slot, the first gets it
            rest_at = at[rest]
            free = self.left[rest_at] < 0
            take = rest[free][np.unique(rest_at[free], return_index=True)[1]]
            self.left[at[take]], self.right[at[take]], self.rank[at[take]], self.result[at[take]] = a[take], b[take], rank[take], result[take]
            rest = np.setdiff1d(rest, take, assume_unique=True)
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, result) of each pair; NONE and -1 where it doesn't merge."""
        at = self._slot(a, b)
        seen = self.left[at]
        hit = (seen == a) & (self.right[at] == b)
        rank, result = np.where(hit, self.rank[at], NONE), np.where(hit, self.result[at], -1)
        rest = np.flatnonzero(~hit & (seen >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            spot = at[rest]
            seen = self.left[spot]
            hit = (seen == a[rest]) & (self.right[spot] == b[rest])
            rank[rest[hit]], result[rest[hit]] = self.rank[spot[hit]], self.result[spot[hit]]
            rest = rest[~hit & (seen >= 0)]
        return rank, result


class Merges:
    """Merging in rounds, given the pairs that merge."""

    def __init__(self, pairs: Pairs):
        self.pairs = pairs

    def merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word of each) once no pair is left to merge; words are numbered upwards.

        A round takes each word's pairs of least rank, left to right and without overlaps, up to
        the first whose result makes a pair of no greater rank, as that one would be next.
        """
        if not len(sym):
            return sym, word
        whole = []
        rank, new = np.full(len(sym), NONE, dtype=np.int32), np.full(len(sym), -1, dtype=np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], new[inner] = self.pairs.look_up(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(sym)])
            best = np.minimum.reduceat(rank, first)
            done = best == NONE
            if done.any():
                out = np.repeat(done, size)
                whole.append((sym[out], word[out]))
                sym, word, rank, new = sym[~out], word[~out], rank[~out], new[~out]
                if not len(sym):
                    break
                best, size = best[~done], size[~done]
            at = np.flatnonzero(rank == np.repeat(best, size))
            # every other place of a run of neighbours: a symbol merges once
            begins = np.r_[True, at[1:] != at[:-1] + 1]
            run = np.flatnonzero(begins)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
            got, own = new[at], word[at]
            next_to = np.r_[False, at[1:] == at[:-1] + 2] & np.r_[False, own[1:] == own[:-1]]
            # what stands left when its turn comes is merged already; what stands right isn't yet
            before = np.where(next_to, np.r_[0, got[:-1]], sym[np.maximum(at - 1, 0)])
            has_left, right = (at > 0) & (word[np.maximum(at - 1, 0)] == own), np.minimum(at + 2, len(sym) - 1)
            has_right = (at + 2 < len(sym)) & (word[right] == own)
            left_rank, left_new = self._joined(before, got, has_left)
            right_rank, right_new = self._joined(got, sym[right], has_right)
            turn = (left_rank <= rank[at]) | (right_rank <= rank[at])
            if turn.any():
                passed = np.cumsum(turn) - turn
                head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                stay = passed == np.repeat(passed[head], np.diff(np.r_[head, len(own)]))
                at, got, next_to, has_left = at[stay], got[stay], next_to[stay], has_left[stay]
                left_rank, left_new, right_rank, right_new = left_rank[stay], left_new[stay], right_rank[stay], right_new[stay]
            sym[at], rank[at], new[at] = got, right_rank, right_new
            by = (at - 1 - next_to)[has_left]
            rank[by], new[by] = left_rank[has_left], left_new[has_left]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            sym, word, rank, new = sym[keep], word[keep], rank[keep], new[keep]
        sym, word = (np.concatenate(x) for x in zip(*whole))
        by = np.argsort(word, kind="stable")
        return sym[by], word[by]

    def _joined(self, a: np.ndarray, b: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, new = np.full(len(a), NONE, dtype=np.int32), np.full(len(a), -1, dtype=np.int32)
        rank[there], new[there] = self.pairs.look_up(a[there], b[there])
        return rank, new


class Pieces(Merges):
    """Tables of a BPE model and the words it remembers."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        s = self.library
        n = s.get_piece_size()
        plain = {s.id_to_piece(i): i for i in range(n) if not (s.is_byte(i) or s.is_control(i) or s.is_unknown(i))}
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("the model has pieces over word starts")
        self.size = n
        char = {p: i for p, i in plain.items() if len(p) == 1}
        #: By code point; characters without a piece have numbers from n on and never merge.
        self.char = np.arange(n, n + 0x110000, dtype=np.int32)
        self.char[[ord(p) for p in char]] = list(char.values())
        self.byte = np.array([s.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        levels = {x: k for k, x in enumerate(sorted({s.get_score(i) for i in plain.values()}, reverse=True))}
        super().__init__(Pairs({(plain[p[:c]], plain[p[c:]]): (levels[s.get_score(i)], i) for p, i in plain.items() for c in range(1, len(p)) if p[:c] in plain and p[c:] in plain}))
        # Control characters without a piece never merge, so words end there too.
        odd = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in char)
        self.word = re.compile(f"{MARK}*[^{MARK}{odd}]+|{MARK}+" + (f"|[{odd}]+" if odd else ""))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.start, self.count, self.chars = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of these new words."""
        sym = self.char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        sym, word = self.merged(sym, np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words]))
        code = np.maximum(sym - self.size, 0)
        # characters without a piece are written as the bytes of their UTF-8
        n = np.where(sym < self.size, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        ids = np.repeat(sym, n)
        odd = np.flatnonzero(sym >= self.size)
        if len(odd):
            ids[spread((np.cumsum(n) - n)[odd], n[odd])] = self.byte[np.frombuffer("".join(map(chr, code[odd].tolist())).encode("utf-8"), dtype=np.uint8)]
        count = np.bincount(np.repeat(word, n), minlength=len(words))
        self.known |= zip(words, range(len(self.known), len(self.known) + len(words)))
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(count) - count]
        self.ids, self.count = np.r_[self.ids, ids], np.r_[self.count, count]

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        split = [self.word.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        for again in (False, True):
            new = list({w for ws in split for w in ws} - self.known.keys())
            chars = sum(map(len, new))
            if again or self.chars + chars <= MEMORY_CHARS:
                break
            self._forget()
        if new:
            self._learn(new)
            self.chars += chars
        known = self.known
        of = np.array([known[w] for ws in split for w in ws], dtype=np.int64)
        ends = np.r_[0, np.cumsum([len(ws) for ws in split])]
        n = self.count[of]
        total = np.r_[0, np.cumsum(n)]
        return self.ids[spread(self.start[of], n)].astype(np.int32), np.diff(total[ends])

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, n = self.flat(texts)
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Text of the ids, by the library's own decode."""
        return self.library.decode(ids) if ids else []


def model_bytes(path: str) -> bytes:
    """The model, read once on the driver (half a megabyte) and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def tokens(model: bytes, text: Column) -> Column:
    """struct(ids, decoded) of a text column. Results leave a worker lot by lot, not batch by batch."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(model)
        for batch in batches:
            lot = np.maximum(0, np.cumsum(pc.fill_null(pc.utf8_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64) - 1) // LOT_CHARS
            for k in np.unique(lot).tolist():
                a, b = np.searchsorted(lot, [k, k + 1]).tolist()
                # Repeats of a text in a lot are encoded once.
                one = batch.slice(a, b - a).dictionary_encode()
                of = one.indices.to_numpy()
                ids, n = pieces.flat(one.dictionary.to_pylist())
                start = np.cumsum(n) - n
                decoded = pa.array([pieces.library.decode(ids[i : i + k].tolist()) for i, k in zip(start.tolist(), n.tolist())], pa.string())
                yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n[of])], pa.int32()), pa.array(ids[spread(start[of], n[of])], pa.int32())), decoded.take(one.indices)], ["ids", "decoded"])

    return run(text)


def encoded(docs: DataFrame, path: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """docs with struct(ids, decoded) in the column out."""
    return bound_batches(docs).withColumn(out, tokens(model_bytes(path), F.coalesce(F.col(text), F.lit(""))))


def digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    df = encoded(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), out="_t")
    return df.select(
        "doc_id",
        F.size("_t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("_t.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("_t.decoded"), 256).alias("decoded_sha256"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
