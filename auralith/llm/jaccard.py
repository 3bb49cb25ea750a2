"""Exact Jaccard links between the shingle sets of texts.

A set is that of the 64-bit hashes of a text's word shingles, and its name a 128-bit digest of them. Two sets link if their Jaccard is SIMILAR or more,
counted on the whole sets. Which pairs are counted is exact too: in any one order of all hashes, two sets that link share one of their first
n - ceil(SIMILAR * n) + 1. Hashes that many texts of a sample hold come last in that order; this spares comparisons and changes no result.
A hash that up to LARGE sets have among their first makes pairs. One that more have makes no pairs but ties its sets into a cluster, whose whole sets are compared where
they meet, block by block; each comparison of blocks yields what connects their groups, so no number of rows grows with the square of a cluster's size.
As blocks that meet do grow so, hashes that turn out to be crowded, which a sample of a large table can't show, come last too, and the sets' first are taken anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import BROADCAST_ROWS, checkpointed, delete, heavy_keys, hot_values, join_skewed, map_texts, slices, stored, tidy
from auralith.operators.graph import connected

#: The similarity from which two sets link, as a fraction.
SIMILAR = (4, 5)
#: About so many texts are looked at for common hashes: those in COMMON of them or more, and at most MOST_COMMON hashes.
SAMPLE, COMMON, MOST_COMMON = 20_000, 4, 200_000
#: Runs of up to FEW rows are compared at once, of up to LARGE as pairs; larger ones are tied into clusters, of which about so many hashes are a block.
FEW, LARGE, BLOCK = 8, 32, 1 << 19
#: How often crowded hashes, those of more than FEW sets, are put last; those that are found after that make pairs or clusters.
ORDERS = 2
NAME = ["s0", "s1"]
#: Parts of the range of hashes that the hashes of a set are counted in, and the size of sets from which on the counts may not fit.
PARTS, COUNTED = 64, 65_536
#: What a round of comparisons moves, as a multiple of all sets; and the bits of a text's key that tell which texts it needs.
ROUND, BITS = 1, 25


def common_hashes(docs: DataFrame, hashes) -> np.ndarray:
    """Sorted hashes that many texts hold. hashes: text -> array of its hashes."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes(text.as_py() or "")).view(np.int64))], names=["h"])

    held = checkpointed(some.mapInArrow(run, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON))
    # the frequency from which on there are at most MOST_COMMON; a row a frequency comes to the driver, then the hashes
    least, room = SAMPLE * 2, MOST_COMMON
    for n, hashes_of in sorted((r["n"], r["count"]) for r in held.groupBy("n").count().collect())[::-1]:
        room -= hashes_of
        if room < 0:
            break
        least = n
    found = held.where(F.col("n") >= least).select("h").toArrow().column("h")
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


def text_key() -> Column:
    """A key by which a text is found again; others may have the same."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def named(hashes: np.ndarray) -> tuple[int, int, int, bytes]:
    """The set's name as two numbers, its size and its counts by part of the range."""
    own = np.unique(hashes)
    digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), ">i8").tolist()
    return *digest, len(own), np.minimum(np.bincount((own >> np.uint64(58)).astype(np.int64), minlength=PARTS), COUNTED - 1).astype("<u2").tobytes()


def _first(hashes: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The set's first hashes in the order of all."""
    own = np.unique(hashes)
    often = common[np.searchsorted(common, own).clip(max=len(common) - 1)] == own if len(common) else np.zeros(len(own), bool)
    first = len(own) - -(-SIMILAR[0] * len(own) // SIMILAR[1]) + 1 if len(own) else 0
    return np.r_[own[~often], own[often]][:first].view(np.int64)


def firsts(docs: DataFrame, hashes, common: np.ndarray) -> DataFrame:
    """s0, s1, first: each shingle set of the texts once, with its first hashes in the order of all. hashes: text -> array of its hashes; common: hashes that come last."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(texts: list[str]) -> list[pa.Array]:
        made = [hashes(t) for t in texts]
        names = [named(h)[:2] for h in made]
        return [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), pa.array([_first(h, shared.value) for h in made], pa.list_(pa.int64()))]

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(texts, "text", "s0 bigint, s1 bigint, first array<bigint>", work).drop("text").groupBy("s0", "s1").agg(F.min("first").alias("first"))


def crowded(sets: DataFrame, common: np.ndarray) -> np.ndarray:
    """Sorted hashes, other than the common ones, that more than FEW sets, not all of one group, have among their first; the MOST_COMMON most frequent at most. sets: s0, s1, group, first."""
    rows = sets.select("group", F.explode("first").alias("k"))
    many = rows.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > FEW).orderBy(F.desc("n"), "k").limit(MOST_COMMON)
    mixed = rows.join(F.broadcast(checkpointed(many.select("k"))), "k").groupBy("k").agg(F.min("group").alias("a"), F.max("group").alias("b")).where("a <> b")
    return np.setdiff1d(mixed.select("k").toArrow().column("k").to_numpy().astype(np.int64).view(np.uint64), common)


def ordered_firsts(docs: DataFrame, hashes, groups: DataFrame) -> DataFrame:
    """s0, s1, group, n, first: the sets with their first hashes in an order in which few sets crowd on one. groups: s0, s1, group, n, each set once. The first hashes are stored while
    crowded ones are looked for, not after."""
    common = common_hashes(docs, hashes)
    for _ in range(ORDERS):
        held, path = stored(firsts(docs, hashes, common).join(groups, NAME))
        more = crowded(held, common)
        delete(docs.sparkSession, path)
        tidy(docs.sparkSession)
        if not len(more):
            break
        common = np.union1d(common, more)
    return firsts(docs, hashes, common).join(groups, NAME)


def _may_link(r: np.ndarray, n: np.ndarray, at: np.ndarray, a, b) -> np.ndarray:
    """Whether rows a and b of one hash, in different groups r, may link by sizes n and positions at: if this is the first hash that they share,
    they share no more than it and what follows in either."""
    low, high = SIMILAR
    most = np.minimum(n[a] - at[a], n[b] - at[b])
    return (r[a] != r[b]) & (high * np.minimum(n[a], n[b]) >= low * np.maximum(n[a], n[b])) & ((low + high) * most >= low * (n[a] + n[b]))


def _candidates(k: np.ndarray, r: np.ndarray, n: np.ndarray, at: np.ndarray, large: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """Rows of whole runs of equal hashes k that may link; and of runs of more than `large` rows the first one with each other one, unless all are of one group."""
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    counts = np.diff(np.r_[starts, len(k)])
    few, out, tied = np.repeat(counts <= min(FEW, large), counts), [], []
    for step in range(1, min(int(counts.max(initial=1)), FEW)):
        a = np.flatnonzero((k[step:] == k[:-step]) & few[step:])
        a = a[_may_link(r, n, at, a, a + step)]
        out.append((a, a + step))
    for s, c in zip(starts[counts > min(FEW, large)], counts[counts > min(FEW, large)], strict=True):
        own = s + np.argsort(n[s : s + c], kind="stable")
        if (r[own] == r[own[0]]).all():
            continue
        if c > large:
            tied.append((np.full(c - 1, s), np.arange(s + 1, s + c)))
            continue
        ends = np.searchsorted(n[own], SIMILAR[1] * n[own] // SIMILAR[0], "right")
        for i in range(c - 1):
            b = own[i + 1 : ends[i]]
            a = np.full(len(b), own[i])
            ok = _may_link(r, n, at, a, b)
            out.append((a[ok], b[ok]))
    return out, tied


def candidates(sets: DataFrame) -> DataFrame:
    """a0, a1, b0, b1, tied: names of sets that may link, and, if tied, that belong to a cluster (see links_inside). Sets that link and are no such pair are in one cluster, or in one group.
    sets: s0, s1, group (known to be linked inside), n, first."""
    schema = "a0 bigint, a1 bigint, b0 bigint, b1 bigint, tied boolean"
    # position in the set's order, from 0
    filed = sets.select("s0", "s1", "group", "n", F.posexplode("first").alias("at", "k")).repartition("k").sortWithinPartitions("k")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            k = batch.column("k").to_numpy()
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))
            if cut or k[0] != last:
                # what is held ends with this batch's rows before its last run
                yield from done([*held, batch.slice(0, cut)])
                held, batch = [], batch.slice(cut)
            held.append(batch)
            last = k[-1]
        yield from done(held)

    def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p for p in parts if p.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        k, r, n, at, s0, s1 = (t.column(c).to_numpy() for c in ("k", "group", "n", "at", "s0", "s1"))
        for tied, found in enumerate(_candidates(k, r, n.astype(np.int64), at.astype(np.int64), LARGE)):
            a, b = (np.concatenate([p[i] for p in found]) if found else np.zeros(0, int) for i in (0, 1))
            if len(a):
                swap = (s0[a] > s0[b]) | ((s0[a] == s0[b]) & (s1[a] > s1[b]))
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                rows = np.unique(np.stack([s0[a], s1[a], s0[b], s1[b]], 1), axis=0)
                yield pa.RecordBatch.from_arrays([*[pa.array(rows[:, i]) for i in range(4)], pa.array(np.full(len(rows), bool(tied)))], names=["a0", "a1", "b0", "b1", "tied"])

    return filed.mapInArrow(scan, schema).distinct()


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a0, a1, b0, b1 that may link by their counts: two sets share no more hashes of a part of the range than either has there. sets: s0, s1, n, counts, each set once."""
    ends = pairs.select(F.struct(F.col("a0").alias("s0"), F.col("a1").alias("s1")).alias("a"), F.struct(F.col("b0").alias("s0"), F.col("b1").alias("s1")).alias("b"))
    hot = hot_values(ends, "a", "b")
    side = lambda end, n, c: sets.select(F.struct("s0", "s1").alias(end), F.col("n").alias(n), F.col("counts").alias(c)).hint("merge")
    both = join_skewed(join_skewed(ends, side("a", "n_x", "x"), ["a"], hot), side("b", "n_y", "y"), ["b"], hot)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, PARTS) for c in ("x", "y"))
            n_x, n_y = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_x", "n_y"))
            most = np.minimum(x, y).sum(1, dtype=np.int64)
            ok = (sum(SIMILAR) * most >= SIMILAR[0] * (n_x + n_y)) | (np.maximum(n_x, n_y) >= COUNTED)
            yield batch.select(["a0", "a1", "b0", "b1"]).filter(pa.array(ok))

    flat = both.select("a.s0", "a.s1", F.col("b.s0").alias("b0"), F.col("b.s1").alias("b1"), "n_x", "n_y", "x", "y").toDF("a0", "a1", "b0", "b1", "n_x", "n_y", "x", "y")
    return flat.mapInArrow(keep, "a0 bigint, a1 bigint, b0 bigint, b1 bigint")


def _bits(keys: DataFrame) -> dict[int, bytes]:
    """A bitmap of the keys' last BITS bits, by its parts; at most 2 ** BITS bits come to the driver."""
    low = keys.select(F.expr(f"pmod(text_key, {1 << BITS}) + 1").alias("low"))  # from 1 on parts are numbered without a gap
    parts = low.groupBy(F.expr("bitmap_bucket_number(low)").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(low))").alias("bits"))
    return {r["part"]: bytes(r["bits"]) for r in parts.collect()}


def _hashed(docs: DataFrame, hashes, keys: DataFrame) -> DataFrame:
    """s0, s1, hashes (the whole sorted set): of the texts whose key is among the keys, and of a few others. Only these are hashed. Rows may repeat."""
    size = 4096  # bytes of a part
    found = np.zeros((1 << BITS) // 8, np.uint8)
    for part, bits in _bits(keys).items():
        found[(part - 1) * size : part * size] = np.frombuffer(bits, np.uint8)[: len(found) - (part - 1) * size]
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = batch.column("text_key").to_numpy() & ((1 << BITS) - 1)
            hit = (shared.value[low >> 3] >> (low & 7).astype(np.uint8)) & 1
            for part in slices(iter([batch.select(["text"]).filter(pa.array(hit.astype(bool)))]), "text"):
                sets = [np.unique(hashes(t or "")) for t in part.column(0).to_pylist()]
                names = [named(s)[:2] for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=[*NAME, "hashes"])

    return docs.select("text", text_key()).mapInArrow(run, "s0 bigint, s1 bigint, hashes binary")


def _whole_sets(needed: DataFrame, docs: DataFrame, hashes) -> tuple[DataFrame, str]:
    """s0, s1, hashes of the needed sets, once each, and the path where they are stored. needed: s0, s1, text_key, each set once; checkpointed."""
    n, wanted = needed.count(), needed.select(*NAME)
    # few: they go to the sets; else the sets are shuffled once
    own = _hashed(docs, hashes, needed).join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, NAME, "left_semi")
    return stored(own.groupBy(*NAME).agg(F.min("hashes").alias("hashes")))


def linked(pairs: DataFrame, sets: DataFrame, docs: DataFrame, hashes) -> DataFrame:
    """The pairs a0, a1, b0, b1 whose sets link, by the whole sets; checkpointed. pairs: checkpointed; sets: s0, s1, n, text_key (of one text), each set once; docs: the texts; hashes: text -> array of its hashes.

    The pairs are dealt over as many rounds as keep what a round shuffles near the size of all sets, whatever the number of pairs.
    """
    spark = pairs.sparkSession
    # hashes that all rounds move: a set up to three times, and once for each pair that it is the first of
    ends = pairs.select(F.struct(F.col("a0").alias("s0"), F.col("a1").alias("s1")).alias("a"), F.struct(F.col("b0").alias("s0"), F.col("b1").alias("s1")).alias("b"))
    uses = ends.groupBy(F.col("a").alias("s")).agg(F.count("*").alias("as_a")).unionByName(ends.select(F.col("b").alias("s"), F.lit(0).cast("long").alias("as_a")).distinct()).groupBy("s").agg((F.sum("as_a") + 3).alias("times"))
    moved = uses.select("s.*", "times").join(sets.select(*NAME, "n"), NAME).agg(F.sum(F.col("times") * F.col("n"))).first()[0] or 0
    rounds = max(1, -(-moved // max(1, int(ROUND * (sets.agg(F.sum("n")).first()[0] or 0)))))
    out = []
    for i in range(rounds):
        some = pairs if rounds == 1 else checkpointed(pairs.where(F.pmod(F.xxhash64("a0", "a1", "b0", "b1"), F.lit(rounds)) == i))
        out.append(_linked_once(some, sets, docs, hashes))
        tidy(spark)
    return reduce(DataFrame.union, out)


def _linked_once(pairs: DataFrame, sets: DataFrame, docs: DataFrame, hashes) -> DataFrame:
    """linked, in one round."""
    spark = pairs.sparkSession
    ends = pairs.select(F.struct(F.col("a0").alias("s0"), F.col("a1").alias("s1")).alias("a"), F.struct(F.col("b0").alias("s0"), F.col("b1").alias("s1")).alias("b"))
    needed = checkpointed(ends.select(F.explode(F.array("a", "b")).alias("s")).distinct().select("s.s0", "s.s1").join(sets.select(*NAME, "text_key"), NAME))
    own, path = _whole_sets(needed, docs, hashes)
    tidy(spark)
    hot = hot_values(ends, "a", "b")
    side = lambda end, name: own.select(F.struct("s0", "s1").alias(end), F.col("hashes").alias(name)).hint("merge")
    both = join_skewed(join_skewed(ends, side("a", "x"), ["a"], hot), side("b", "y"), ["b"], hot)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(SIMILAR[1] * shared >= SIMILAR[0] * (len(x) + len(y) - shared))
            yield batch.select(["a0", "a1", "b0", "b1"]).filter(pa.array(ok, pa.bool_()))

    out = checkpointed(both.select("a.s0", "a.s1", F.col("b.s0").alias("b0"), F.col("b.s1").alias("b1"), "x", "y").toDF("a0", "a1", "b0", "b1", "x", "y").mapInArrow(keep, "a0 bigint, a1 bigint, b0 bigint, b1 bigint"))
    delete(spark, path)
    return out


def _connecting(sets: list[np.ndarray], group: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between sets on the left and on the right that connect the groups which their links connect, at most one for each group but one. Hashes held on the
    right are looked up for each set on the left, so that it meets only those that share one."""
    if not len(left) or not len(right):
        return np.zeros(0, int), np.zeros(0, int)
    of, sizes = np.unique(group, return_inverse=True)[1], np.array([len(s) for s in sets])
    held, rows = np.concatenate([sets[i] for i in right]), np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(held, kind="stable")
    held, rows = held[order], rows[order]
    a, b = [], []
    for i in left.tolist():
        low = np.searchsorted(held, sets[i])
        counts = np.searchsorted(held, sets[i], "right") - low
        shared = np.bincount(rows[np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())], minlength=len(right))
        near = right[SIMILAR[1] * shared >= SIMILAR[0] * (sizes[i] + sizes[right] - shared)]
        found, first = np.unique(of[near], return_index=True)
        for g, j in zip(found.tolist(), near[first].tolist(), strict=True):
            if g != of[i]:
                a.append(i)
                b.append(j)
                of[of == g] = of[i]
    return np.array(a, int), np.array(b, int)


def links_inside(ties: DataFrame, groups: DataFrame, docs: DataFrame, hashes) -> DataFrame | None:
    """a0, a1, b0, b1: links that connect what all links between the sets of a cluster connect, beyond the groups; checkpointed; none without clusters. Ties a0, a1, b0, b1 make the clusters;
    groups: s0, s1, root (s0 of which tells groups apart), n, text_key, each set once; docs, hashes: as in linked.

    A cluster's sets are dealt into blocks. A set goes to every pair of blocks that holds its own, but sets of the cluster's largest group, which are known to be
    connected, don't meet each other. The pairs of blocks are dealt over rounds as in linked.
    """
    if ties.isEmpty():
        return None
    spark = docs.sparkSession
    roots = connected(ties.select(F.struct(F.col("a0").alias("s0"), F.col("a1").alias("s1")).alias("a"), F.struct(F.col("b0").alias("s0"), F.col("b1").alias("s1")).alias("b")))
    members = checkpointed(roots.select("node.*", F.col("root").alias("cluster")).join(groups.select(*NAME, F.col("root.s0").alias("group"), F.col("n").cast("long").alias("n"), "text_key"), NAME))
    sizes = members.groupBy("cluster", "group").agg(F.sum("n").alias("n"), F.count("*").alias("sets"))
    # the largest group's blocks come after those of the others
    sizes = sizes.groupBy("cluster").agg(F.max(F.struct("n", "group")).alias("main"), F.sum("n").alias("n"), F.sum("sets").alias("sets"))
    sizes = checkpointed(sizes.select("cluster", F.col("main.group").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("others"), F.ceil(F.col("main.n") / BLOCK).cast("int").alias("mains"), "sets"))
    both = join_skewed(members, sizes.select("cluster", "main", "others", "mains"), ["cluster"], heavy_keys(sizes, ["cluster"], "sets"))
    inside, at = F.col("group") == F.col("main"), F.xxhash64(*NAME)
    own = F.when(inside, F.col("others") + F.pmod(at, F.col("mains"))).otherwise(F.pmod(at, F.col("others"))).cast("int")
    meets = F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("mains"))
    dealt = checkpointed(both.where("others > 0").select("cluster", *NAME, "group", "n", "text_key", own.alias("own"), meets.alias("meets")))
    moved, of_all = dealt.agg(F.sum(F.col("n") * F.col("meets"))).first()[0] or 0, groups.agg(F.sum("n")).first()[0] or 0
    rounds = max(1, -(-moved // max(1, int(ROUND * of_all))))
    sets, path = _whole_sets(checkpointed(dealt.select(*NAME, "text_key")), docs, hashes)
    tidy(spark)

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        own, s0, s1 = (table.column(c).to_numpy() for c in ("own", *NAME))
        hashes_of = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
        a, b = _connecting(hashes_of, table.column("group").to_numpy(), np.flatnonzero(own == i), np.flatnonzero(own == j))
        return pa.table([pa.array(x) for x in (s0[a], s1[a], s0[b], s1[b])], names=["a0", "a1", "b0", "b1"])

    meet = dealt.select("cluster", *NAME, "group", "own", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)).alias("other"))
    meet = meet.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *NAME, "group", "own")
    out = []
    for k in range(rounds):
        some = meet.where(F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(rounds)) == k).join(sets.hint("merge"), NAME)
        out.append(checkpointed(some.groupBy("cluster", "i", "j").applyInArrow(compare, "a0 bigint, a1 bigint, b0 bigint, b1 bigint")))
        tidy(spark)
    delete(spark, path)
    return reduce(DataFrame.union, out)
