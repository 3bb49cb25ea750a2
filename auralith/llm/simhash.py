"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint bit is 1 if it is set in over half the hashes of a text's word shingles, repeats included. Fingerprints are cut into
segments, fewer than the differing bits that still link, so that one segment differs by one bit at most if 2 * segments > radius.
Each fingerprint is filed once for every bit position: the segment of that position without that bit. Fingerprints with an equal
entry are compared in full. Equal fingerprints are filed once. A link counts in one entry only; if that entry holds many fingerprints, it
yields a spanning forest of all its links instead of pairs; one with more than BUCKET is dealt out as pairs of blocks, which loses no link.
Links between fingerprints become components, whose name is the smallest doc_id in them.

Cases: null text is empty; texts without words have fingerprint zero and link like others; a text with fewer words than a shingle is
one shingle; rows that repeat a doc_id are rows of their own with one result each; rows with null doc_id are linked, but never
name a component (null if all of it has none); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auralith.llm import jaccard
from auralith.llm.common import BROADCAST_ROWS, checkpointed, heavy_keys, hot_values, join_skewed, join_small, map_texts, tidied, tidy
from auralith.operators.graph import connected

SEED = 42
#: Shingle hashes that are counted at once.
CHUNK = 65_535
#: An entry of up to FEW fingerprints is compared at once; of up to BUCKET in one place; larger ones in blocks of about BLOCK.
FEW, BUCKET, BLOCK = 16, 4096, 2048


def _hash_chunks(text: str, words: int) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles, repeats included, at most CHUNK at once; none without words."""
    parts = text.encode().lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    ends = [e - 1 for e in accumulate(len(p) + 1 for p in parts)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    spans = list(zip(starts, ends[words - 1 :], strict=False)) or [(0, len(joined))]
    digest = xxhash.xxh64_digest
    for at in range(0, len(spans), CHUNK):
        yield np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in spans[at : at + CHUNK]]), ">u8")


def shingles(text: str, words: int) -> np.ndarray:
    """Hashes of all the text's shingles."""
    return np.concatenate([np.zeros(0, np.uint64), *_hash_chunks(text, words)]).astype(np.uint64)


def _print(chunks: Iterable[np.ndarray], lanes: int) -> list[int]:
    total, n = np.zeros(64 * lanes, np.int64), 0
    for hashes in chunks:
        mixed = np.stack([hashes, *[_mixed(hashes, lane) for lane in range(1, lanes)]], 1).astype(">u8")
        total += _bit_counts(np.unpackbits(mixed.view(np.uint8)).reshape(len(hashes), 64 * lanes))
        n += len(hashes)
    return np.packbits(2 * total > n).view(">i8").tolist()


def fingerprint(text: str, words: int, lanes: int) -> list[int]:
    """One 64-bit number for each lane, as signed integers; lane 0 hashes with XXH64, further lanes mix that hash again."""
    return _print(_hash_chunks(text, words), lanes)


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """A finaliser over the hash and the lane's number (fixed multipliers of a public 64-bit mixer)."""
    x = hashes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * lane % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bit_counts(bits: np.ndarray) -> np.ndarray:
    """Column sums; bytes are summed in groups of 255, which can't overflow."""
    whole = len(bits) // 255 * 255
    out = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        out += bits[:whole].reshape(-1, 255, bits.shape[1]).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, words: int = 4, bits: int = 64) -> DataFrame:
    """doc_id, f0 (and f1 ... for more than 64 bits), of whole texts."""
    lanes = bits // 64

    def work(texts: list[str]) -> list[pa.Array]:
        made = np.array([fingerprint(t, words, lanes) for t in texts], np.int64).reshape(-1, lanes)
        return [pa.array(made[:, i]) for i in range(lanes)]

    return map_texts(docs.select("doc_id", "text"), "text", ", ".join(f"f{i} bigint" for i in range(lanes)), work).drop("text")


def _cuts(lanes: int, segments: int) -> list[tuple[int, int, int]]:
    """Lane, first bit and end of each segment."""
    per = segments // lanes
    cuts = [round(64 * k / per) for k in range(per + 1)]
    return [(lane, low, high) for lane in range(lanes) for low, high in zip(cuts, cuts[1:], strict=False)]


def _variants(lanes: int, segments: int) -> Column:
    """The entries of a fingerprint: for each bit, its number, above the segment that holds it with that bit cleared."""
    out = []
    for lane, low, high in _cuts(lanes, segments):
        for bit in range(high - low):
            mask = (1 << (high - low)) - 1 - (1 << bit)
            out.append(F.shiftrightunsigned(f"f{lane}", low).bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(F.lit((64 * lane + low + bit) << 32).cast("long")))
    return F.array(*out)


def _own_entry(x: np.ndarray, segments: int) -> np.ndarray:
    """Of the entries that two fingerprints with differing bits x share, the number of the one that their link counts in: the first segment
    that differs by one bit at most, at that bit (the first bit if it doesn't differ). So no link is made in two entries."""
    out = np.full(len(x), -1)
    for lane, low, high in reversed(_cuts(x.shape[1], segments)):
        bits = (x[:, lane] >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        near = np.bitwise_count(bits) <= 1
        at = np.where(bits == 0, 0, np.bitwise_count(np.maximum(bits, np.uint64(1)) - np.uint64(1)))
        out = np.where(near, 64 * lane + low + at, out)
    return out


def _linked(x: np.ndarray, entry: np.ndarray, segments: int, radius: int) -> np.ndarray:
    """Whether differing bits x are a link that counts in the entry."""
    out = np.bitwise_count(x).sum(-1) <= radius
    at = np.flatnonzero(out)
    out[at] = _own_entry(x[at], segments) == entry[at]
    return out


def _forest(f: np.ndarray, entry: int, segments: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what all links connect: from the smallest fingerprint on, each reached one takes the unreached ones that it links to.

    The order is that of the fingerprints, alike in every entry, so entries that hold the same fingerprints make the same edges. For that,
    links that count in another entry are followed too, and neither entry nor segments matter.
    """
    order = np.lexsort(f.T[::-1])
    g, left = f[order], np.arange(len(f))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            at = heappop(front)
            hit = np.bitwise_count(g[left] ^ g[at]).sum(-1) <= radius
            found, left = left[hit], left[~hit]
            for i in found.tolist():
                heappush(front, i)
            if len(found):
                yield order[np.minimum(found, at)], order[np.maximum(found, at)]


def _compare(key: np.ndarray, f: np.ndarray, segments: int, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges inside runs of equal keys (sorted, each run whole and of at most BUCKET rows)."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    counts = np.diff(np.r_[starts, len(key)])
    few, entries = np.repeat(counts <= FEW, counts), key >> 32
    out = []
    for step in range(1, min(int(counts.max(initial=1)), FEW)):
        at = np.flatnonzero((key[step:] == key[:-step]) & few[step:])
        at = at[_linked(f[at] ^ f[at + step], entries[at], segments, radius)]
        out.append((at, at + step))
    for s, n in zip(starts[counts > FEW], counts[counts > FEW], strict=True):
        out += [(a + s, b + s) for a, b in _forest(f[s : s + n], int(entries[s]), segments, radius)]
    return out


def links(distinct: DataFrame, bits: int = 64, segments: int = 3, radius: int = 4) -> DataFrame:
    """a0.., b0..: links between different fingerprints f0.. that connect whatever links within radius connect. distinct: each fingerprint once."""
    lanes = bits // 64
    names = [f"f{i}" for i in range(lanes)]
    ends = [f"{side}{i}" for side in "ab" for i in range(lanes)]
    schema = ", ".join(["k bigint", *[f"{e} bigint" for e in ends]])
    entries = distinct.select(F.explode(_variants(lanes, segments)).alias("k"), *names)
    # entries that a sixteenth of the fingerprints shows to be far beyond BUCKET go to the blocks at once, not through one sorted task; others that are too large go there from it
    shown = entries.where(F.pmod(F.xxhash64(*names), F.lit(16)) == 0).groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= max(1, BUCKET // 8))
    large = F.broadcast(checkpointed(shown.orderBy(F.desc("n"), "k").limit(BROADCAST_ROWS).select("k")))
    filed = entries.join(large, "k", "left_anti").repartition("k").sortWithinPartitions("k")

    def batch(k: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k), *[pa.array(x[:, i].view(np.int64)) for x in (a, b) for i in range(lanes)]], names=["k", *ends])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each key's run with key -1; the fingerprints of a run beyond BUCKET with its key, each as both ends."""
        held_k, held_f, big = np.zeros(0, np.int64), np.zeros((0, lanes), np.uint64), None
        for part in _with_end(batches):
            if part is not None:
                k = np.r_[held_k, part.column(0).to_numpy()]
                f = np.concatenate([held_f, np.stack([part.column(1 + i).to_numpy() for i in range(lanes)], 1).view(np.uint64)])
                whole = int(np.searchsorted(k, k[-1])) if len(k) else 0  # the last run may go on
            else:
                k, f, whole = held_k, held_f, len(held_k)
            if big is not None and len(k):
                more = int(np.searchsorted(k, big, "right"))
                if more:
                    yield batch(k[:more], f[:more], f[:more])
                k, f, whole = k[more:], f[more:], max(0, whole - more)
                big = big if not len(k) else None
            if len(k) - whole > BUCKET:
                big = int(k[-1])
                yield batch(k[whole:], f[whole:], f[whole:])
                k, f = k[:whole], f[:whole]
            held_k, held_f = k[whole:], f[whole:]
            k, f = k[:whole], f[:whole]
            if len(k) > 1:
                _, where, counts = np.unique(k, return_index=True, return_counts=True)
                for s, n in zip(where[counts > BUCKET], counts[counts > BUCKET], strict=True):
                    yield batch(k[s : s + n], f[s : s + n], f[s : s + n])
                small = np.repeat(counts <= BUCKET, counts)
                k, f = k[small], f[small]
                pairs = _compare(k, f, segments, radius) if len(k) > 1 else []
                a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, int) for i in (0, 1))
                if len(a):
                    yield batch(np.full(len(a), -1, np.int64), f[a], f[b])

    found = checkpointed(filed.mapInArrow(scan, schema).distinct())
    tidy(found.sparkSession)
    hot = found.where("k >= 0").select("k", *[F.col(f"a{i}").alias(f"f{i}") for i in range(lanes)]).union(entries.join(large, "k", "left_semi"))
    sizes = checkpointed(hot.groupBy(F.col("k").alias("__k")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    # a fingerprint of block i goes to every pair of blocks that holds i
    own = join_small(hot, sizes, F.col("k") == F.col("__k"), sizes.count(), "inner").withColumn("own", F.pmod(F.xxhash64(*names), "blocks").cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *names)

    def block(table: pa.Table) -> pa.Table:
        f = np.stack([table.column(n).to_numpy() for n in names], 1).view(np.uint64)
        pairs = list(_forest(f, table.column("k")[0].as_py() >> 32, segments, radius))
        a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, int) for i in (0, 1))
        return pa.Table.from_batches([batch(np.full(len(a), -1, np.int64), f[a], f[b])])

    rest = own.groupBy("k", "i", "j").applyInArrow(block, schema)
    return found.where("k < 0").union(rest).select(*ends).distinct()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def components(docs: DataFrame, words: int = 4, bits: int = 64, segments: int = 3, radius: int = 4) -> DataFrame:
    """doc_id, f0.., component_id: one row a document.

    All links within 2 * segments - 1 differing bits are found; with a larger radius those beyond are found where one segment differs by one
    bit at most, and the others are not.
    """
    names = [f"f{i}" for i in range(bits // 64)]
    rows = checkpointed(fingerprints(docs, words, bits))
    nodes = checkpointed(rows.groupBy(*names).agg(F.min("doc_id").alias("node"), F.count("*").alias("n")))
    # fingerprints become nodes: only those with a doc_id can name a component, so the others stand for it by their fingerprint
    node = F.struct(F.col("node").isNull().alias("n"), "node", *names)
    roots = connected(_of_prints(links(nodes.select(*names), bits, segments, radius), nodes.select(*names, node.alias("as")), names))
    rooted = roots.select(*[f"node.{n}" for n in names], F.struct(F.col("root.node").alias("id")).alias("root"))
    # the root of nodes that link; the node itself else
    grouped = nodes.join(rooted, names, "left").select(*names, F.when(F.col("root").isNotNull(), F.col("root.id")).otherwise(F.col("node")).alias("component_id"))
    return join_skewed(rows, checkpointed(grouped), names, heavy_keys(nodes, names, "n")).select("doc_id", *names, "component_id")


def _of_prints(edges: DataFrame, known: DataFrame, names: list[str]) -> DataFrame:
    """a, b: what the fingerprints at both ends of the edges a0.., b0.. are known as. known: each fingerprint once, and as."""
    ends = checkpointed(edges.select(*[F.struct(*[F.col(f"{side}{i}").alias(n) for i, n in enumerate(names)]).alias(side) for side in "ab"]))
    hot = hot_values(ends, "a", "b")
    for side in "ab":
        to = known.select(F.struct(*names).alias(side), F.col("as").alias(f"as_{side}"))
        ends = checkpointed(join_skewed(ends, to, [side], hot).drop(side))
    return ends.select(F.col("as_a").alias("a"), F.col("as_b").alias("b"))


def _signatures(docs: DataFrame, words: int, lanes: int) -> DataFrame:
    """doc_id, text_key, s0, s1 (name of the shingle set), n, counts (see jaccard.named), f0.., of whole texts."""

    def work(texts: list[str]) -> list[pa.Array]:
        chunks = [list(_hash_chunks(t, words)) for t in texts]
        sets = [jaccard.named(np.concatenate([np.zeros(0, np.uint64), *c]).astype(np.uint64)) for c in chunks]
        made = np.array([_print(c, lanes) for c in chunks], np.int64).reshape(-1, lanes)
        names = [pa.array([s[i] for s in sets], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
        return [*names, *[pa.array(made[:, i]) for i in range(lanes)]]

    schema = "s0 bigint, s1 bigint, n int, counts binary, " + ", ".join(f"f{i} bigint" for i in range(lanes))
    return map_texts(docs.select("doc_id", "text", jaccard.text_key()), "text", schema, work).drop("text")


def similar_groups(docs: DataFrame, words: int = 5, bits: int = 128, segments: int = 8, radius: int = 20) -> DataFrame:
    """s0, s1, doc_id, root: one row a shingle set, with its smallest doc_id and the smallest set that links of exact similarity connect it to.

    Links between fingerprints are candidates only. Those that the sets confirm make groups; what is left to find are links between different groups,
    and jaccard.candidates finds all that may be, as pairs or as clusters, so no link depends on a fingerprint. The sets themselves, larger than the texts, are not kept: each phase hashes
    the texts that it needs again.
    """
    lanes = bits // 64
    prints = [f"f{i}" for i in range(lanes)]
    hashes = lambda text: shingles(text, words)
    rows = checkpointed(_signatures(docs, words, lanes))
    # equal sets share the hashes, but repeats may set other bits: any fingerprint will do, and any text
    one = F.min(F.struct(*prints, "n", "counts", "text_key")).alias("x")
    sets = checkpointed(rows.groupBy("s0", "s1").agg(F.min("doc_id").alias("doc_id"), one).select("s0", "s1", "doc_id", "x.*"))
    holders = checkpointed(sets.groupBy(*prints).agg(F.min(F.struct("s0", "s1")).alias("s"), F.count("*").alias("sets")))
    del rows
    tidy(docs.sparkSession)
    near = _of_prints(links(holders.select(*prints), bits, segments, radius), holders.select(*prints, F.col("s").alias("as")), prints)
    same = join_skewed(sets.select("s0", "s1", *prints), holders.select(*prints, "s"), prints, heavy_keys(holders, prints, "sets")).where("s0 <> s.s0 OR s1 <> s.s1").select(F.col("s").alias("a"), F.struct("s0", "s1").alias("b"))
    near = near.select("a", "b").union(same).select("a.s0", "a.s1", F.col("b.s0").alias("b0"), F.col("b.s1").alias("b1")).toDF("a0", "a1", "b0", "b1")
    near = checkpointed(near)
    tidy(docs.sparkSession)
    sure = jaccard.linked(near, sets, docs, hashes)

    def grouped(edges: DataFrame) -> DataFrame:
        roots = connected(edges.select(F.struct(F.col("a0").alias("s0"), F.col("a1").alias("s1")).alias("a"), F.struct(F.col("b0").alias("s0"), F.col("b1").alias("s1")).alias("b")))
        return checkpointed(sets.select("s0", "s1", "doc_id", "n", "text_key").join(roots.select("node.*", "root"), ["s0", "s1"], "left").withColumn("root", F.coalesce("root", F.struct("s0", "s1"))))

    groups = grouped(sure)
    tidy(docs.sparkSession)
    # the first half of a root's name tells groups apart
    firsts = jaccard.ordered_firsts(docs, hashes, groups.select("s0", "s1", F.col("root.s0").alias("group"), "n"))
    maybe = checkpointed(jaccard.candidates(firsts))
    del firsts
    tidy(docs.sparkSession)
    inside = jaccard.links_inside(maybe.where("tied").drop("tied"), groups, docs, hashes)
    tidy(docs.sparkSession)
    maybe = checkpointed(jaccard.plausible(maybe.where("NOT tied").drop("tied"), sets))
    tidy(docs.sparkSession)
    more = jaccard.linked(maybe, sets, docs, hashes)
    more = more if inside is None else more.union(inside)
    out = groups if more.isEmpty() else grouped(sure.union(more))
    return out.select("s0", "s1", "doc_id", "root")


def remove_duplicates(docs: DataFrame, columns: list[str], words: int = 5, bits: int = 128, segments: int = 8, radius: int = 20) -> DataFrame:
    """The given columns of one document of each group of near copies: the one with the smallest doc_id. Of rows that repeat it, that with the smallest text stays.

    Texts link if the exact Jaccard similarity of their word shingles is jaccard.SIMILAR or more (texts without words with each other).
    Rows without a doc_id stay.
    """
    with tidied(docs.sparkSession):
        groups = similar_groups(docs, words, bits, segments, radius)
    chosen = groups.groupBy("root").agg(F.min("doc_id").alias("__id")).where("__id IS NOT NULL").select("__id").distinct()
    kept = docs.select(*columns).join(chosen, F.col("doc_id") == F.col("__id"), "left_semi")
    first = Window.partitionBy("doc_id").orderBy("doc_id", "text")
    kept = kept.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    return kept.unionByName(docs.select(*columns).where(F.col("doc_id").isNull()))
