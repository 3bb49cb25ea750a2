"""Connected components over shared speakers and speaker-disjoint splits: hash-ordered groups, prefix fill."""

from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auralith.operators.quantiles import sums_before
from auralith.session import checkpointed, tidy
from auralith.skew import heavy_keys, hot_values, join_skewed


def connected(edges: DataFrame) -> DataFrame:
    """node, root (smallest node that it reaches) for the nodes of edges a, b.

    Rounds of hooking and contraction: a node points to its smallest neighbour (itself if none is smaller), pointers are doubled until they
    reach their roots, and the edges between different roots are the graph of the next round. Edges that lie inside a tree are not read
    again. Every result is checkpointed; aggregates combine before they shuffle, no group of neighbours is gathered, and a node
    with many edges, or a root with many nodes, is dealt over several tasks (join_skewed).
    An empty graph gives an empty result; loops and repeated edges are ignored.
    """
    edges = checkpointed(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct())
    rounds = [_rooted(edges)]
    while True:
        tree, hot = rounds[-1], hot_values(edges, "u", "v")
        ends = checkpointed(join_skewed(edges, tree.select(F.col("node").alias("u"), F.col("root").alias("ru")), ["u"], hot).select("ru", "v"))
        ends = join_skewed(ends, tree.select(F.col("node").alias("v"), F.col("root").alias("rv")), ["v"], hot)
        edges = checkpointed(ends.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).where("u <> v").distinct())
        if edges.isEmpty():
            break
        tidy(edges.sparkSession)
        rounds.append(_rooted(edges))
    out = rounds[0]
    for later in rounds[1:]:
        following = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = checkpointed(join_skewed(out, following, ["root"], hot_values(out, "root"), "left").select("node", F.coalesce("next", "root").alias("root")))
    return out


def _rooted(edges: DataFrame) -> DataFrame:
    """node, root: the end of each node's chain of smallest neighbours, for edges u < v."""
    hooks = edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")).union(edges.select("u", "u").distinct())
    tree = checkpointed(hooks.groupBy("node").agg(F.min("root").alias("root")))
    while True:
        following = tree.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = checkpointed(join_skewed(tree, following, ["root"], hot_values(tree, "root")).select("node", F.col("root").alias("was"), F.col("next").alias("root")))
        tree = step.select("node", "root")
        if step.where("root < was").isEmpty():
            return tree


#: Clips and speakers that a task holds at once in gathered.
NODES = 250_000


def gathered(pairs: DataFrame) -> DataFrame:
    """Rows clip, near and speaker, near: the smallest clip that shared speakers lead to among those that a task has seen in a row of up to NODES clips and speakers. pairs: clip, speaker.

    A row for each clip (speaker is null) and each speaker (clip is null) of such a run; what is linked by the pairs is linked by these rows, so the graph that is left
    has a node a run and component, not one a clip. Nothing is shuffled."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    clip, speaker = pairs.schema["clip"], pairs.schema["speaker"]
    out = StructType([StructField("clip", clip.dataType), StructField("speaker", speaker.dataType), StructField("near", clip.dataType)])
    arrow, most = to_arrow_schema(out), NODES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}  # clip -> a clip no larger that it is linked to, itself at the top
        heard: dict = {}  # speaker -> one of its clips

        def top(c):
            while (up := above[c]) != c:
                above[c] = c = above[up]
            return c

        def rows() -> Iterator[pa.RecordBatch]:
            for seen in (above, heard):
                for part in batched(list(seen), 10_000):
                    none = [None] * len(part)
                    values = [*((part, none) if seen is above else (none, part)), [top(seen[k]) for k in part]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)
            above.clear()
            heard.clear()

        nameless = False
        for batch in batches:
            for c, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if c is None:
                    nameless = True
                    continue
                if c not in above:
                    above[c] = c
                if s is None:
                    continue
                if s not in heard:
                    heard[s] = c
                    continue
                x, y = top(c), top(heard[s])
                if x < y:
                    above[y] = x
                elif y < x:
                    above[x] = y
            if len(above) + len(heard) > most:
                yield from rows()
        yield from rows()
        if nameless:
            yield pa.RecordBatch.from_arrays([pa.array([None], f.type) for f in arrow], schema=arrow)

    return pairs.select("clip", "speaker").mapInArrow(run, out)


def components(pairs: DataFrame) -> DataFrame:
    """Clip, root (smallest clip that shared speakers lead to). pairs: clip, speaker, repeated or not; a clip without a speaker is alone.

    Tasks link what they see themselves (gathered). Then each speaker, or clip, of several runs is an edge between its smallest near clip and each of the others,
    so that no speaker's clips are paired with each other.
    """
    runs = checkpointed(gathered(pairs))
    clips = checkpointed(runs.where("speaker IS NULL").groupBy("clip").agg(F.min("near").alias("a"), F.max("near").alias("z"), F.count("*").alias("n")))
    speakers = checkpointed(runs.where("speaker IS NOT NULL").groupBy("speaker").agg(F.min("near").alias("a"), F.max("near").alias("z"), F.count("*").alias("n")))
    ends = lambda key, firsts: join_skewed(runs.where(F.col(key).isNotNull()).select(key, "near"), firsts.where("a < z").select(key, "a"), [key], heavy_keys(firsts.where("a < z"), [key], "n"))
    roots = connected(ends("speaker", speakers).unionByName(ends("clip", clips), allowMissingColumns=True).select("a", F.col("near").alias("b"))).select(F.col("node").alias("a"), "root")
    hot = heavy_keys(clips.groupBy("a").agg(F.count("*").alias("n")), ["a"], "n")
    return join_skewed(clips.select("clip", "a"), roots, ["a"], hot, "left").select("clip", F.coalesce("root", "a").alias("root"))


def splits(rooted: DataFrame, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Clip, split. Groups in hash order fill train while it is below its share, then val, the rest is test."""
    if train <= 0 or val <= 0 or train + val >= 1:
        raise ValueError("fractions must be positive and leave a test share")
    groups = rooted.groupBy("root").agg(F.count("*").alias("n")).withColumn("key", F.md5(F.concat(F.lit(f"{seed}|"), F.col("root").cast("string"))))
    placed = checkpointed(sums_before(groups, "key", "n"))
    total = placed.agg(F.bround(F.sum("n") * train).alias("goal"), F.bround(F.sum("n") * val).alias("goal_val"))
    placed = placed.crossJoin(F.broadcast(total))  # one row
    filled = placed.agg(F.coalesce(F.min(F.when(F.col("before") + F.col("n") >= F.col("goal"), F.col("before") + F.col("n"))), F.lit(0)).alias("filled"))
    split = F.when(F.col("before") < F.col("goal"), "train").when(F.col("before") - F.col("filled") < F.col("goal_val"), "val").otherwise("test")
    named = checkpointed(placed.crossJoin(F.broadcast(filled)).select("root", "n", split.alias("split")))
    return join_skewed(rooted.select("clip", "root"), named.select("root", "split"), ["root"], heavy_keys(named, ["root"], "n")).select("clip", "split")
