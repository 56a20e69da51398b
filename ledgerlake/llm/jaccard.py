"""N-gram Jaccard join by a token-group matrix.

Texts become sets of word shingles; equal sets are one class. Classes are partitioned into
groups of similar ones: each tries one leader with a least hash in common, and stays with it
where they link. The matrix has a cell for each token and group: the union of the group's
tokens, of which the cells of rare tokens (the prefixes, one of which any two linked sets
share) are laid out first, with the sizes of the members that hold the token. Groups that
share no such cell, or whose cells' sizes rule a link out, aren't compared. Cells meet only
where a common token is early enough to be the first one of a link with a set that is no smaller,
so that texts just under the limit with one another don't meet at all that they share. Where groups
may link, a class of the smaller group asks the larger one: first one member; then, if the class's
overlap with the whole union of the group reaches what a link needs, the group is opened
and its members compared exactly. A group of one is its own union: its bound is the comparison.

Sets are hashed from the texts whenever they are needed, rather than stored: only the sets
of classes that take part in a comparison are ever shuffled.

Null, empty and wordless texts have no shingles and no links. Rows with a null id have a
null component and link nothing. Repeated rows are in the same class. An empty table gives
an empty result; other columns take no part. No cap is set on members, partners or candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles
from .common import bound_batches, discard, saved, spread, table

#: Times that classes try a leader; groups only save work, so more tries change costs, not results.
STAR_ROUNDS = 4
#: Members of a group that a class is compared with at a time, about.
BLOCK = 256
#: Groups of at most so many classes are held against one another by the tokens of their prefixes; others are asked anyway.
SMALL = 64
#: Bytes of matrix cells in a task, about; as two sides' sums and sorts they take about ten times as much.
CELL_BYTES = 8 << 20
#: One class in so many tells which tokens are frequent, and most tokens put last; both change costs, not results.
ORDER_EVERY, LATE_TOKENS = 16, 500_000
#: Most bits of the filter that says which sets a comparison needs (8 MB); beyond, more sets are shuffled than needed.
FILTER_BITS = 1 << 26
WORDY = r"[^\x20\x09-\x0D]"


def measured(text: Column, n: int) -> Column:
    """struct(c1, c2: the class; n: size of the set; ks, sk: keys and least tokens that tell similar sets)."""

    @F.arrow_udf("struct<c1:bigint,c2:bigint,n:int,ks:array<bigint>,sk:array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for _, _, data, ends in shingles.lots(texts):
            tokens, stops = shingles.sets(data, ends, n)
            c1, c2 = shingles.classes(tokens, stops)
            sk = shingles.lists(*shingles.first_of_each(tokens, stops, shingles.SKETCH))
            parts.append(pa.StructArray.from_arrays([pa.array(c1), pa.array(c2), pa.array(np.diff(np.r_[0, stops]), pa.int32()), shingles.keys(tokens, stops), sk], ["c1", "c2", "n", "ks", "sk"]))
        return pa.concat_arrays(parts)

    return run(text)


def prefixed(text: Column, n: int, percent: int, late: np.ndarray) -> Column:
    """struct(c1, c2, n, pre): pre has the first n - ceil(percent n) + 1 tokens of a set, `late` ones coming last.

    Two sets that link share a token of both prefixes.
    """
    by = np.argsort(late, kind="stable")
    sorted_late = late[by]

    @F.arrow_udf("struct<c1:bigint,c2:bigint,n:int,pre:array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for _, _, data, ends in shingles.lots(texts):
            tokens, stops = shingles.sets(data, ends, n)
            size = np.diff(np.r_[0, stops])
            c1, c2 = shingles.classes(tokens, stops)
            if len(late) and len(tokens):
                at = np.minimum(np.searchsorted(sorted_late, tokens), len(late) - 1)
                place = np.where(sorted_late[at] == tokens, by[at] + 1, 0)
                tokens = tokens[np.argsort(np.repeat(np.arange(len(size)), size) * (len(late) + 1) + place, kind="stable")]
            pre = shingles.lists(*shingles.first_of_each(tokens, stops, np.where(size > 0, size - -(-percent * size // 100) + 1, 0)))
            parts.append(pa.StructArray.from_arrays([pa.array(c1), pa.array(c2), pa.array(size, pa.int32()), pre], ["c1", "c2", "n", "pre"]))
        return pa.concat_arrays(parts)

    return run(text)


def cells(prefixes: DataFrame) -> DataFrame:
    """(t, g, lo, hi, most) of (g, n, pre): a group's tokens, with the least and greatest size of members that hold
    the token and the most tokens such a member has from there on. Cells of a batch's members fall together here."""

    def run(batches):
        for batch in (whole.slice(k, 1000) for whole in batches for k in range(0, whole.num_rows, 1000)):
            g, n, pre = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), batch.column(2)
            ends = pre.offsets.to_numpy().astype(np.int64)
            size = np.diff(ends)
            t = pre.values.to_numpy()[ends[0] : ends[-1]]
            g, n, rest = np.repeat(g, size), np.repeat(n, size), np.repeat(n, size) - spread(np.zeros(len(size), np.int64), size)
            by = np.lexsort((t, g))
            g, t, n, rest = g[by], t[by], n[by], rest[by]
            first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (t[1:] != t[:-1])]) if len(g) else np.zeros(0, int)
            if len(first):
                out = [t[first], g[first], np.minimum.reduceat(n, first), np.maximum.reduceat(n, first), np.maximum.reduceat(rest, first)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, [pa.int64()] * 2 + [pa.int32()] * 3)], ["t", "g", "lo", "hi", "most"])

    return prefixes.select("g", "n", "pre").mapInArrow(run, "t long, g long, lo int, hi int, most int")


def meeting(found: DataFrame, n_parts: int, percent: int) -> DataFrame:
    """(g1, g2), perhaps repeated, of the groups with a common cell that may hold the first common token of a link.

    Of two sets that link, the smaller has that token among its first n - ceil(2 percent n / (100 + percent)) + 1,
    as its overlap with a set of its size or more is no less; the larger has it in its prefix.
    """
    laid = found.repartition(n_parts, "t").groupBy("t", "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("most").alias("most"))
    early = lambda c: F.lit(100 + percent) * F.col(f"{c}most") >= F.lit(2 * percent) * F.col(f"{c}lo")
    x = laid.where(early("")).select("t", F.struct("g", "lo", "hi", "most").alias("x"))
    y = laid.select("t", F.struct("g", "lo", "hi", "most").alias("y"))
    fits = (F.lit(100) * F.col("x.hi") >= F.lit(percent) * F.col("y.lo")) & (F.lit(100) * F.col("y.hi") >= F.lit(percent) * F.col("x.lo"))
    # From their first common token on, two sets have at most the lesser rest in common.
    enough = F.lit(100 + percent) * F.least("x.most", "y.most") >= F.lit(percent) * (F.col("x.lo") + F.col("y.lo"))
    # Where both may be the smaller, they meet once.
    once = F.when(early("y."), F.col("x.g") < F.col("y.g")).otherwise((F.col("x.g") != F.col("y.g")) & (F.col("x.lo") <= F.col("y.hi")))
    return x.join(y, "t").where(fits & enough & once).select(F.least("x.g", "y.g").alias("g1"), F.greatest("x.g", "y.g").alias("g2"))


def opened_sets(docs: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """(hid, c1, c2, sh) of the representatives of the needed (hid, c1, c2), and perhaps of some others.

    A filter of bounded size goes with the tasks; the join that follows is exact.
    """
    bits = 1 << 15
    count = needed.count()
    while bits < min(FILTER_BITS, 64 * count):
        bits *= 2
    at = F.pmod("hid", F.lit(bits)) + 1
    maps = needed.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()
    wanted = np.zeros(bits // 8, dtype=np.uint8)
    for r in maps:
        wanted[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["m"], dtype=np.uint8)

    def run(batches):
        seen = set()  # copies of a class in this task
        for batch in batches:
            at = batch.column(0).to_numpy() % bits
            some = np.flatnonzero((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            hid, texts = batch.column(0).to_numpy()[some], batch.column(1).take(pa.array(some))
            for a, b, data, ends in shingles.lots(texts):
                tokens, stops = shingles.sets(data, ends, n)
                size = np.diff(np.r_[0, stops])
                c1, c2 = shingles.classes(tokens, stops)
                own = hid[a:b]
                use = [k for k in np.flatnonzero(size).tolist() if (x := (int(own[k]), int(c1[k]), int(c2[k]))) not in seen and not seen.add(x)]
                if use:
                    sh = shingles.lists(tokens[spread((stops - size)[use], size[use])], np.cumsum(size[use]))
                    yield pa.RecordBatch.from_arrays([pa.array(own[use]), pa.array(c1[use]), pa.array(c2[use]), sh], ["hid", "c1", "c2", "sh"])

    return docs.select("hid", "t").mapInArrow(run, "hid long, c1 long, c2 long, sh array<long>")


def linked(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.lit(100) * both >= F.lit(percent) * (F.size(a) + F.size(b) - both)


def near_size(a: Column, b: Column, percent: int) -> Column:
    return (F.lit(100) * F.least(a, b)) >= (F.lit(percent) * F.greatest(a, b))


class Join:
    """A join of docs with themselves; see classed()."""

    def __init__(self, docs: DataFrame, key: str, text: str, n: int, percent: int):
        self.n, self.percent = n, percent
        rows = bound_batches(docs).select(F.col(key).alias("id"), F.xxhash64(F.col(key)).alias("hid"), F.coalesce(F.col(text), F.lit("")).alias("t"))
        self.docs = rows.where(F.col("id").isNotNull() & F.col("t").rlike(WORDY))
        self.thin = saved(rows.select("id", measured(F.col("t"), n).alias("m")).select("id", "m.*"), "thin")
        per = self.thin.where("id IS NOT NULL AND n > 0").groupBy("c1", "c2").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "ks", "sk")])
        #: A row per class; hid names the text from which its set is hashed again.
        self.kinds = saved(per.withColumn("hid", F.xxhash64("id")).withColumn("cno", F.monotonically_increasing_id()), "classes")
        self.name = self.kinds.select("cno", "hid", "c1", "c2")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that link."""
        side = lambda x: self.name.select(F.col("cno").alias(x), F.col("hid").alias(f"{x}h"), F.col("c1").alias(f"{x}1"), F.col("c2").alias(f"{x}2"))
        full = saved(pairs.join(side("a"), "a").join(side("b"), "b"), "pairs")
        if full.isEmpty():
            return full.select("a", "b")
        keys = [full.select(F.col(f"{x}h").alias("hid"), F.col(f"{x}1").alias("c1"), F.col(f"{x}2").alias("c2")) for x in "ab"]
        sets = saved(opened_sets(self.docs, keys[0].unionByName(keys[1]).distinct(), self.n), "sets")
        of = lambda x: sets.toDF(f"{x}h", f"{x}1", f"{x}2", f"s{x}")
        df = full.join(of("a"), ["ah", "a1", "a2"]).select("a", "b", "bh", "b1", "b2", "sa").join(of("b"), ["bh", "b1", "b2"])
        out = saved(df.where(linked(F.col("sa"), F.col("sb"), self.percent)).select("a", "b").distinct(), "verified")
        discard(full, sets)
        return out

    def stars(self) -> tuple[DataFrame, DataFrame]:
        """(links a, b; groups cno, g of the linked classes): in each round a class tries one leader that has a key in common."""
        percent = self.percent
        k = self.kinds.select("cno", "n", F.posexplode("ks").alias("r", "k"))
        shared = saved(k.groupBy("r", "k").agg(F.count("*").alias("m")).where("m > 1").select("r", "k"), "shared-keys")
        k = saved(k.join(shared, ["r", "k"]), "keys")
        sk = lambda x: self.kinds.select(F.col("cno").alias(x), F.col("sk").alias(f"s{x}"))
        low = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, shingles.SKETCH)
        est = F.lit(100) * F.size(F.array_intersect(low, F.array_intersect("sa", "sb"))) / F.size(low)
        links, groups = None, None
        for turn in range(STAR_ROUNDS):
            now = k.withColumn("g", F.col("cno")) if groups is None else k.join(groups, "cno", "left").withColumn("g", F.coalesce("g", "cno"))
            lead = now.groupBy("r", "k").agg(F.min(F.struct(F.xxhash64("cno", F.lit(turn)).alias("h"), "cno", "n", "g")).alias("l"), F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi")
            lead = saved(lead.select("r", "k", F.col("l.cno").alias("b"), F.col("l.n").alias("nb"), F.col("l.g").alias("gb")), "leaders")
            p = now.join(lead, ["r", "k"]).where((F.col("g") != F.col("gb")) & near_size(F.col("n"), F.col("nb"), percent)).select(F.col("cno").alias("a"), "b").distinct()
            p = p.join(sk("a"), "a").join(sk("b"), "b").select("a", "b", est.alias("est"))
            # The try only saves work: links it misses are found by opening groups.
            best = p.where(F.col("est") >= percent - 25).groupBy("a").agg(F.min(F.struct(F.col("est") < percent, "b")).alias("pick"))
            found = self.verified(saved(best.select("a", "pick.b"), "star-pairs"))
            discard(lead)
            links = found if links is None else links.unionByName(found)
            groups = joined_groups(groups, found)
            if found.isEmpty():
                break
        discard(shared, k)
        return links, groups

    def late(self) -> np.ndarray:
        """Tokens found thrice or more in a sample of classes, the most frequent last; they end the order of tokens."""
        part = F.pmod(F.col("hid"), F.lit(ORDER_EVERY)) == 0
        own = opened_sets(self.docs.where(part), self.name.where(part).select("hid", "c1", "c2"), self.n)
        top = own.select(F.explode("sh").alias("t")).groupBy("t").count().where("count >= 3").orderBy(F.desc("count"), "t").limit(LATE_TOKENS)
        tokens = top.select("t").toArrow().column(0).to_numpy()[::-1].astype(np.int64)
        pa.default_memory_pool().release_unused()
        return tokens

    def asked(self, groups: DataFrame) -> DataFrame:
        """(g1, g2): groups whose cells don't rule out a link between them."""
        percent = self.percent
        sizes = groups.groupBy("g").agg(F.count("*").alias("k"))
        to = self.name.join(groups, "cno", "left").join(sizes, "g", "left").select("c1", "c2", F.coalesce("g", "cno").alias("g"), F.coalesce("k", F.lit(1)).alias("k"))
        to = saved(to, "named")
        per = self.docs.select(prefixed(F.col("t"), self.n, percent, self.late()).alias("m")).select("m.*")
        # Copies fall together before and after the shuffle.
        one = per.groupBy("c1", "c2").agg(F.first("n").alias("n"), F.first("pre").alias("pre")).join(to, ["c1", "c2"])
        one = saved(one.select("g", "k", "n", "pre"), "prefixes")
        total = self.kinds.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
        n_parts = max(int(self.kinds.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) * 48 // CELL_BYTES))
        met = saved(meeting(cells(one), n_parts, percent).distinct(), "met")
        # The prefix that ends first holds every common token up to its end, so both have it in common there:
        # more than these in common come only from what follows a prefix, ceil(percent n) - 1 tokens.
        ends = met.select(F.col("g1").alias("g")).unionByName(met.select(F.col("g2").alias("g"))).distinct()
        held = one.where(F.col("k") <= SMALL).join(ends, "g", "left_semi").groupBy("g")
        held = held.agg(F.array_distinct(F.flatten(F.collect_list("pre"))).alias("p"), F.min("n").alias("lo"), F.max("n").alias("hi"))
        of = lambda x: held.toDF(*[f"{c}{x}" for c in held.columns])
        both = F.size(F.array_intersect("p1", "p2"))
        rest = F.floor((F.lit(percent) * F.greatest("hi1", "hi2") + 99) / 100) - 1
        may = F.lit(100 + percent) * (both + rest) >= F.lit(percent) * (F.col("lo1") + F.col("lo2"))
        out = saved(met.join(of(1), "g1", "left").join(of(2), "g2", "left").where(F.coalesce(may, F.lit(True))).select("g1", "g2"), "asks")
        discard(to, one, met)
        return out

    def bounded(self, asks: DataFrame, groups: DataFrame) -> DataFrame:
        """The (a, g) of asks where class a's overlap with the union of all tokens of group g allows a link."""
        inside = groups.join(asks.select("g").distinct(), "g", "left_semi")
        of = lambda who: self.name.join(who, "cno")
        near, far = of(inside), of(asks.select(F.col("a").alias("cno"), "g"))
        need = [x.select("hid", "c1", "c2") for x in (near, far)]
        sets = saved(opened_sets(self.docs, need[0].unionByName(need[1]).distinct(), self.n), "sets")
        union = sets.join(near, ["hid", "c1", "c2"]).select("g", F.explode("sh").alias("t")).distinct()
        own = sets.join(far, ["hid", "c1", "c2"])
        tokens = own.select(F.col("cno").alias("a"), "g", F.size("sh").alias("n"), F.explode("sh").alias("t"))
        found = tokens.join(union, ["g", "t"]).groupBy("a", "g", "n").count()
        return found.where(F.lit(100) * F.col("count") >= F.lit(self.percent) * F.col("n")).select("a", "g")

    def opened(self, may: DataFrame, groups: DataFrame) -> DataFrame:
        """The links (a, b) of each class a with the members of its group g, for (a, g) in may: a class against BLOCK members at a time."""
        inside = groups.join(may.select("g").distinct(), "g", "left_semi")
        blocks = inside.groupBy("g").count().select("g", F.ceil(F.col("count") / BLOCK).cast("int").alias("n_blocks"))
        near = self.name.join(inside, "cno").join(blocks, "g").withColumn("block", F.pmod(F.xxhash64("cno"), F.col("n_blocks")).cast("int"))
        far = self.name.join(may.select(F.col("a").alias("cno"), "g"), "cno").join(blocks, "g")
        need = [x.select("hid", "c1", "c2") for x in (near, far)]
        sets = saved(opened_sets(self.docs, need[0].unionByName(need[1]).distinct(), self.n), "sets")
        packed = sets.join(near, ["hid", "c1", "c2"]).groupBy("g", "block").agg(F.collect_list(F.struct("cno", "sh")).alias("m"))
        ask = sets.join(far, ["hid", "c1", "c2"]).select(F.col("cno").alias("a"), "g", F.col("sh").alias("sa"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
        percent = self.percent

        @F.arrow_udf("array<bigint>")
        def linked_members(sa: pa.Array, m: pa.Array) -> pa.Array:
            out = []
            for own, members in zip(sa, m):
                own, ids, sh = own.values.to_numpy(), members.values.field("cno").to_numpy(), members.values.field("sh")
                tokens, ends = sh.flatten().to_numpy(), np.cumsum(sh.value_lengths().to_numpy())
                both = np.diff(np.r_[0, np.cumsum(np.isin(tokens, own))][np.r_[0, ends]])
                size = np.diff(np.r_[0, ends])
                out.append(ids[100 * both >= percent * (len(own) + size - both)].tolist())
            return pa.array(out, pa.list_(pa.int64()))

        met = ask.join(packed, ["g", "block"]).select("a", linked_members("sa", "m").alias("b"))
        return saved(met.select("a", F.explode("b").alias("b")), "opened-links")

    def grouped(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(links a, b; groups cno, g of the linked classes of stars; parts g, part of groups that later links join)."""
        first, groups = self.stars()
        asks = self.asked(groups)
        sizes = groups.groupBy("g").count()
        both = asks.join(sizes.toDF("g1", "k1"), "g1", "left").join(sizes.toDF("g2", "k2"), "g2", "left").fillna(1, ["k1", "k2"])
        less = F.col("k1") <= F.col("k2")
        both = saved(both.select(F.when(less, F.col("g1")).otherwise(F.col("g2")).alias("q"), F.when(less, F.col("g2")).otherwise(F.col("g1")).alias("g"), F.greatest("k1", "k2").alias("k")), "sized-asks")
        # A group's name is one of its members: that one is tried first.
        q = both.join(groups.select(F.col("cno").alias("m"), F.col("g").alias("q")), "q", "left").select(F.coalesce("m", "q").alias("a"), "g", "k")
        more = self.verified(saved(q.select("a", F.col("g").alias("b")), "tries"))
        rest = saved(q.where("k > 1").select("a", "g").join(more.toDF("a", "g"), ["a", "g"], "left_anti"), "rest")
        if not rest.isEmpty():
            may = saved(self.bounded(rest, groups), "opened")
            more = saved(more.unionByName(self.opened(may, groups)), "later-links")
        discard(asks, both)
        group = lambda x: groups.select(F.col("cno").alias(x), F.col("g").alias(f"g{x}"))
        between = more.join(group("a"), "a", "left").join(group("b"), "b", "left").select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")).where("a <> b").distinct()
        return first.unionByName(more), groups, components(saved(between, "between")).toDF("g", "part")


def joined_groups(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """(cno, g): the groups with those that links (a, b) of classes connect put together; a group has the name of its least member's group."""
    ends = links.select(F.col("a").alias("cno")).unionByName(links.select(F.col("b").alias("cno"))).distinct()
    if groups is None:
        return saved(components(links), "groups")
    group = lambda x: groups.select(F.col("cno").alias(x), F.col("g").alias(f"g{x}"))
    between = links.join(group("a"), "a", "left").join(group("b"), "b", "left").select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b")).where("a <> b").distinct()
    parts = components(saved(between, "between")).toDF("g", "part")
    now = groups.join(ends, "cno", "full").select("cno", F.coalesce("g", "cno").alias("g")).join(parts, "g", "left")
    return saved(now.select("cno", F.coalesce("part", "g").alias("g")), "groups")


def components(links: DataFrame) -> DataFrame:
    """(cno, g) of the linked classes: g is the least cno reachable. Least labels spread and jump until none changes."""
    both = saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both-ways")
    now = saved(both.select(F.col("a").alias("cno")).distinct().withColumn("g", F.col("cno")), "labels")
    while True:
        near = both.join(now.select(F.col("cno").alias("b"), F.col("g").alias("gb")), "b").groupBy(F.col("a").alias("cno")).agg(F.min("gb").alias("near"))
        step = now.join(near, "cno").select("cno", F.col("g").alias("old"), F.least("g", "near").alias("g"))
        jump = now.select(F.col("cno").alias("g"), F.col("g").alias("far"))
        new = saved(step.join(jump, "g", "left").select("cno", "old", F.least("g", F.coalesce("far", "g")).alias("g")), "labels")
        changed = not new.where("g <> old").isEmpty()
        discard(now)
        now = new
        if not changed:
            discard(both)
            return now.select("cno", "g")


def classed(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: id, c1, c2, n; classes: c1, c2, cno, id, g; links: a, b between classes) of docs; g names the component."""
    j = Join(docs, key, text, n, percent)
    links, groups, parts = j.grouped()
    kinds = j.kinds.select("c1", "c2", "cno", "id").join(groups, "cno", "left").withColumn("g", F.coalesce("g", "cno")).join(parts, "g", "left")
    return j.thin.select("id", "c1", "c2", "n"), saved(kinds.select("c1", "c2", "cno", "id", F.coalesce("part", "g").alias("g")), "parts"), links


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(membership: id, n, cno, component; links: a, b between classes) of docs."""
    thin, kinds, links = classed(docs, key, text, n, percent)
    least = kinds.groupBy("g").agg(F.min("id").alias("component"))
    named = kinds.join(least, "g").select("c1", "c2", "cno", "component")
    out = thin.join(named, ["c1", "c2"], "left").select("id", "n", "cno", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    return out, links


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component: that of the least (id, class, row hash); rows with a null id or no words stay."""
    thin, kinds, _ = classed(docs, key, text, n, percent)
    member = thin.where("id IS NOT NULL AND n > 0").join(kinds.select("c1", "c2", "g"), ["c1", "c2"])
    least = saved(member.groupBy("g").agg(F.min(F.struct("id", "c1", "c2")).alias("l")).select(F.col("l.id").alias("_llj_id"), F.col("l.c1").alias("_llj_1"), F.col("l.c2").alias("_llj_2")), "least")
    words = F.coalesce(F.col(text), F.lit("")).rlike(WORDY)
    part = F.col(key).isNotNull() & words
    rows = docs.where(part).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), measured(F.col(text), n).alias("m"))
    rows = rows.select(F.col(f"row.`{key}`").alias("_llj_id"), F.col("m.c1").alias("_llj_1"), F.col("m.c2").alias("_llj_2"), "row")
    on = ["_llj_id", "_llj_1", "_llj_2"]
    best = rows.groupBy(*on).agg(F.min_by("row", F.xxhash64("row")).alias("row")).join(least, on, "left_semi")
    return best.select("row.*").unionByName(docs.where(~part))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    member, _ = joined(table(spark, sf_dir, "documents"))
    return member.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
