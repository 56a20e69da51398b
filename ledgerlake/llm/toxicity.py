"""Toxicity by a linear-chain conditional random field over words.

Words of labelled documents are labelled first: in toxic documents, those that are far more
frequent there than in clean ones. The field learns to tag them from the word, its
beginnings and the tags around it; marginals of forward-backward give each document's score and offending offsets.

Null and empty texts have no words; their score comes from zero features alone, like that
of any text without toxic words. A chain is a line of the text; texts are scored whole.
With no labelled rows, or of one kind alone, every score is that kind's share (0 if none).
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, table
from .shingles import mixed

WORD = re.compile(r"\w+")
#: The fit takes at most so many labelled rows of each kind, by a hash of their id, and of them so many
#: characters, in that order.
FIT_ROWS, FIT_CHARS = 1500, 8_000_000
#: Features seen in fewer documents of the fit have no weight of their own.
MIN_DOCS = 3
#: Lengths of the beginnings that are features.
BEGINNINGS = (3, 4, 5)
#: A word is labelled in toxic documents from this log-likelihood ratio on.
MIN_RATIO = 20.0
#: Padded cells in a lot of chains.
CELLS = 100_000
#: Words whose features a task keeps from text to text.
REMEMBERED = 200_000


@dataclass
class Field:
    """Weights of the field and of the score over its marginals."""

    vocab: dict[str, int]  # words and, after ^, beginnings of words
    unary: np.ndarray  # weight of tag 1 for each
    bias: float
    trans: np.ndarray  # 2 x 2
    head: np.ndarray  # bias, greatest marginal, log of their sum


def marks(word: str) -> list[str]:
    """Features of a word: itself and its beginnings."""
    return [word, *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


class Tokens(dict):
    """Numbers of words as they are met, from 1 on, and the features of each."""

    def __init__(self, vocab: dict[str, int]):
        super().__init__()
        self.words, self.begun = vocab.get, {m[1:]: k for m, k in vocab.items() if m[0] == "^"}.get
        self.rows, self.known = array("i", [0] * (1 + len(BEGINNINGS))), np.zeros(0)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.rows) // (1 + len(BEGINNINGS))
        # as marks() has them
        self.rows.extend([self.words(word, 0), *[self.begun(word[:n], 0) if len(word) > n else 0 for n in BEGINNINGS]])
        return number

    def ids(self, line: str) -> list[int]:
        # Beyond ASCII, a word's lower case depends on what stands around it.
        return list(map(self.__getitem__, WORD.findall(line.lower()) if line.isascii() else map(str.lower, WORD.findall(line))))

    def table(self, first: int = 0) -> np.ndarray:
        """Features of the words from number `first` on."""
        return np.array(self.rows[first * (1 + len(BEGINNINGS)) :], dtype=np.int32).reshape(-1, 1 + len(BEGINNINGS))

    def odds(self, f: Field) -> np.ndarray:
        """Of tag 1 at each word alone, by a field that doesn't change any more; words met since are added to what is known."""
        new = self.table(len(self.known))
        self.known = np.r_[self.known, np.exp(np.clip(f.bias + f.unary[new].sum(1), -30, 30))]
        return self.known


def lots(chains: list[list[int]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Chains of like length together, the shortest first: their numbers, ids padded with 0, lengths."""
    order = sorted((k for k, c in enumerate(chains) if c), key=lambda k: len(chains[k]))
    while order:
        n = 1
        while n < len(order) and (n + 1) * len(chains[order[n]]) <= CELLS and len(chains[order[n]]) <= 2 * len(chains[order[0]]) + 8:
            n += 1
        part, order = order[:n], order[n:]
        size = np.array([len(chains[k]) for k in part])
        pad = np.zeros((n, size.max()), dtype=np.int32)
        for r, k in enumerate(part):
            pad[r, : size[r]] = chains[k]
        yield part, pad, size


def marginals(trans: np.ndarray, u: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of tag 1 at each place, and of each pair of tags, by forward-backward."""
    n, t = u.shape
    live = np.arange(t)[None, :] < size[:, None]
    # Work with p = P(tag 1 | what is seen so far); a step mixes it by the transitions.
    e = np.exp(np.clip(u, -30, 30))
    a = np.exp(trans)
    fore, back = np.empty((t, n, 2)), np.empty((t, n, 2))
    x = np.stack([np.ones(n), e[:, 0]], 1)
    fore[0] = x / x.sum(1, keepdims=True)
    for i in range(1, t):
        x = fore[i - 1] @ a
        x[:, 1] *= e[:, i]
        fore[i] = x / x.sum(1, keepdims=True)
    back[t - 1] = 1.0
    for i in range(t - 2, -1, -1):
        y = back[i + 1].copy()
        y[:, 1] *= e[:, i + 1]
        y = y @ a.T
        y /= y.sum(1, keepdims=True)
        back[i] = np.where(live[:, i + 1][:, None], y, 1.0)
    m = fore * back
    p = (m[:, :, 1] / m.sum(2)).T * live
    of_pairs = np.zeros((2, 2))
    if t > 1:
        nxt = back[1:].copy()
        nxt[:, :, 1] *= e[:, 1:].T
        joint = fore[:-1, :, :, None] * a[None, None] * nxt[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        of_pairs = (joint * live[:, 1:].T[:, :, None, None]).sum((0, 1))
    return p, of_pairs


def shares(trans: np.ndarray, e: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Marginal of tag 1 as by marginals(), of chains from the shortest to the longest: e[i] has the odds of words i alone.

    Forward and backward messages are kept as odds of tag 1 against tag 0, of the chains that reach so far.
    """
    (a00, a01), (a10, a11) = np.exp(trans).tolist()
    t, n = e.shape
    reach = np.searchsorted(size, np.arange(t), side="right").tolist()
    r, s = np.zeros((t, n)), np.ones(n)
    r[0] = e[0]
    for i in range(1, t):
        k = reach[i]
        x = r[i - 1, k:]
        r[i, k:] = e[i, k:] * (a01 + a11 * x) / (a00 + a10 * x)
    for i in range(t - 2, -1, -1):
        k = reach[i + 1]
        x = e[i + 1, k:] * s[k:]
        s[k:] = (a10 + a11 * x) / (a00 + a01 * x)
        r[i] *= s
    return r / (1 + r)


def counted(docs: list[np.ndarray], words: list[str], toxic: np.ndarray) -> tuple[Counter, Counter]:
    """In how many clean and in how many toxic documents (numbers of words) each feature occurs."""
    by_kind = Counter(), Counter()
    for d, t in zip(docs, toxic):
        by_kind[int(t)].update({m for w in d.tolist() for m in marks(words[w])})
    return by_kind


def telling(c0: Counter, c1: Counter, n0: int, n1: int) -> set[str]:
    """Features far more frequent in toxic documents than in clean ones (log-likelihood ratio)."""
    out = set()
    for w, k1 in c1.items():
        k0 = c0.get(w, 0)
        p, p1, p0 = (k1 + k0) / (n1 + n0), k1 / n1, k0 / n0
        ll = lambda k, n, q: (k * np.log(q) if k else 0) + ((n - k) * np.log(1 - q) if n - k else 0)
        if p1 > 10 * p0 and 2 * (ll(k1, n1, p1) + ll(k0, n0, p0) - ll(k1, n1, p) - ll(k0, n0, p)) >= MIN_RATIO:
            out.add(w)
    return out


def distinct_documents(docs: list[np.ndarray], hashes: np.ndarray, least: float = 0.9) -> list[int]:
    """Numbers of documents, without those whose words are those of an earlier one that stays, by a Jaccard similarity of `least`.

    A document is its distinct words' numbers, by which hashes are found. One copied many times would make all its words look
    telling. Bands of least hashes, each hash with a seed of its own, say which earlier ones to compare with; only a measured
    similarity lets a document go.
    """
    seeds = np.random.default_rng(24).integers(0, 2**64, (24, 1), dtype=np.uint64)
    seen: dict[tuple, list[int]] = {}
    out = []
    for k, d in enumerate(docs):
        if not len(d):
            continue
        first = mixed(hashes[d][None, :] ^ seeds).min(1).tolist()
        bands = [(b, *first[3 * b : 3 * b + 3]) for b in range(8)]
        earlier = {j for b in bands for j in seen.get(b, ())}
        both = {j: len(np.intersect1d(d, docs[j], assume_unique=True)) for j in earlier}
        if not any(n >= least * (len(d) + len(docs[j]) - n) for j, n in both.items()):
            out.append(k)
            for b in bands:
                seen.setdefault(b, []).append(k)
    return out


def scanned(f: Field, texts: list[str], tokens: Tokens) -> tuple[np.ndarray, list[list[dict]]]:
    """Per text: 1, greatest marginal, log of their sum; and the places of the words whose marginal is at least one half.

    A line that comes again is worked out once; `tokens` may know words of earlier texts.
    """
    lines, of, line_of, starts = {}, [], [], []
    for k, t in enumerate(texts):
        at = 0
        for line in t.split("\n"):
            line_of.append(lines.setdefault(line, len(lines)))
            of.append(k)
            starts.append(at)
            at += len(line) + 1
    chains = [tokens.ids(line) for line in lines]
    odds, hits = tokens.odds(f), {}
    most, summed = np.zeros((2, len(chains)))
    for part, pad, size in lots(chains):
        p = shares(f.trans, odds[pad.T], size)
        most[part], summed[part] = p.max(0), p.sum(0)
        for i, k in zip(*np.nonzero(p >= 0.5)):
            hits.setdefault(part[k], []).append(i)
    top, total = np.zeros(len(texts)), np.zeros(len(texts))
    np.maximum.at(top, of, most[line_of])
    np.add.at(total, of, summed[line_of])
    places = {c: [w.span() for w in WORD.finditer(line)] for c, line in enumerate(lines) if c in hits}
    spans = [[] for _ in texts]
    for k, c, at in zip(of, line_of, starts):
        if c in hits:
            spans[k] += [{"start": at + a, "stop": at + b} for a, b in (places[c][i] for i in hits[c])]
    return np.stack([np.ones(len(texts)), top, np.log1p(total)], 1), spans


def pieces(texts: list[str]) -> Iterator[list[str]]:
    """The texts in lots of about a million characters."""
    k = 0
    while k < len(texts):
        n, end = 0, k
        while end < len(texts) and (end == k or n + len(texts[end]) <= 1_000_000):
            n, end = n + len(texts[end]), end + 1
        yield texts[k:end]
        k = end


def features(f: Field, texts: list[str]) -> np.ndarray:
    """Per text: 1, greatest marginal, log of their sum."""
    return scanned(f, texts, Tokens(f.vocab))[0]


def offsets(f: Field, text: str) -> list[dict]:
    """Places of the words whose marginal is at least one half."""
    return scanned(f, [text], Tokens(f.vocab))[1][0]


def fitted(texts: list[str], labels: list[int], rounds: int = 30) -> Field:
    """The field and its score, fitted on these documents (Adagrad on the exact likelihood)."""
    y = np.array(labels, dtype=bool)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        return Field({}, np.zeros(1), -9.0, np.zeros((2, 2)), np.array([30.0 if share else -30.0, 0, 0]))
    # documents as numbers of their words: sets of texts' words would take ten times as much of the driver's memory
    number: dict[str, int] = {}
    docs = [np.unique(np.fromiter((number.setdefault(w, len(number)) for w in map(str.lower, WORD.findall(t))), np.int32)) for t in texts]
    words = list(number)
    hashes = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint64)
    del number
    # Near copies go within each kind.
    apart = [np.flatnonzero(y == kind) for kind in (True, False)]
    use = sorted(int(part[k]) for part in apart for k in distinct_documents([docs[j] for j in part], hashes))
    if len(set(y[use])) == 2:
        texts, docs, y = [texts[k] for k in use], [docs[k] for k in use], y[use]
    c0, c1 = counted(docs, words, y)
    hot_marks = telling(c0, c1, int((~y).sum()), int(y.sum()))
    vocab = {m: k + 1 for k, m in enumerate(sorted(m for m in c0.keys() | c1.keys() if c0[m] + c1[m] >= MIN_DOCS))}
    del docs, words, c0, c1
    f = Field(vocab, np.zeros(len(vocab) + 1), -3.0, np.zeros((2, 2)), np.zeros(3))
    tokens, chains, toxic = Tokens(vocab), [], []
    for t, is_toxic in zip(texts, y):
        for line in t.split("\n"):
            chains.append(tokens.ids(line))
            toxic.append(is_toxic)
    rows = tokens.table()
    is_hot = np.zeros(len(vocab) + 1, dtype=bool)
    is_hot[[vocab[m] for m in hot_marks if m in vocab]] = True
    hot = is_hot[rows].any(1)
    # Lines of clean documents and lines with a tagged word; others of toxic documents say little.
    used = [k for k, c in enumerate(chains) if c and (not toxic[k] or hot[c].any())]
    packs = [(pad, size, hot[pad] & np.array(toxic)[used][part][:, None]) for part, pad, size in lots([chains[k] for k in used])]
    g2u, g2b, g2t = np.full(f.unary.shape, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(rounds):
        weight = f.bias + f.unary[rows].sum(1)
        gw, gb, gt = np.zeros(len(rows)), 0.0, -1e-2 * f.trans
        for pad, size, tags in packs:
            p, pairs = marginals(f.trans, weight[pad], size)
            live = np.arange(p.shape[1])[None, :] < size[:, None]
            tag = tags & live
            d = tag - p
            gw += np.bincount(pad[live], weights=d[live], minlength=len(rows))
            gb += d.sum()
            both = live[:, 1:]
            seen = np.array([[(((tag[:, :-1] == i) & (tag[:, 1:] == j)) & both).sum() for j in (0, 1)] for i in (0, 1)])
            gt += seen - pairs
        gu = -1e-2 * f.unary
        for k in range(rows.shape[1]):
            gu += np.bincount(rows[:, k], weights=gw, minlength=len(gu))
        gu[0] = 0.0
        g2u, g2b, g2t = g2u + gu**2, g2b + gb**2, g2t + gt**2
        f.unary += 0.4 * gu / np.sqrt(g2u)
        f.bias += 0.4 * gb / np.sqrt(g2b)
        f.trans += 0.1 * gt / np.sqrt(g2t)
    # what the rounds have used is the driver's memory, and the words are known
    del chains, packs, rows, hot, weight, gw, gu, g2u
    x = np.concatenate([scanned(f, part, tokens)[0] for part in pieces(texts)])
    w = np.zeros(3)
    for _ in range(25):  # Newton, with a small ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - q) - 1e-2 * w
        w += np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(3), grad)
    f.head = w
    return f


def trained(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> Field:
    """A field for labelled docs whose crc32(doc_id) mod 5 is not 0; a sample of both kinds, bounded in rows and characters.

    Of the sample, the fit leaves out near copies of earlier texts of the same kind, lines of toxic
    texts without a telling word, and features of under MIN_DOCS texts; scoring leaves nothing out.
    """
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(~held_out(F.col("doc_id")))
    place = F.xxhash64("doc_id")
    texts, y = [], []
    for kind in (1, 0):
        # Ids first: the sort carries no texts.
        ids = one.where(F.col("toxic") == kind).join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(place, "doc_id").limit(fit_rows)
        part = rows.join(F.broadcast(ids.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
        # over at most fit_rows rows
        upto = F.sum(F.length("text")).over(Window.orderBy(place, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
        part = part.withColumn("upto", upto).where(F.col("upto") <= fit_chars).orderBy("doc_id").collect()
        texts += [r["text"] for r in part]
        y += [kind] * len(part)
    return fitted(texts, y)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tags(field: Field, text: Column) -> Column:
    """struct(score, spans) of a text column; spans are [start, stop) of tagged words."""

    @F.pandas_udf("struct<score:double,spans:array<struct<start:int,stop:int>>>")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(field.vocab)
        for s in series:
            texts = ["" if t is None else t for t in s.tolist()]
            score, spans = [], []
            for part in pieces(texts):
                tokens = tokens if len(tokens) < REMEMBERED else Tokens(field.vocab)
                x, found = scanned(field, part, tokens)
                score += (1 / (1 + np.exp(-np.clip(x @ field.head, -30, 30)))).tolist()
                spans += found
            yield pd.DataFrame({"score": score, "spans": spans})

    return run(text)


def scored(docs: DataFrame, field: Field, text: str = "text", out: str = "toxicity") -> DataFrame:
    return bound_batches(docs).withColumn(out, tags(field, F.coalesce(F.col(text), F.lit(""))))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score below one half, with the columns of docs."""
    df = scored(docs, trained(docs, labels), out="_llt_")
    return df.where(F.col("_llt_.score") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = scored(docs, trained(docs, table(spark, sf_dir, "labels")), out="_t")
    score = F.col("_t.score")
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted"), F.col("_t.spans").alias("spans"))
