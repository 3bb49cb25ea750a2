"""Exact order statistics that no task holds all rows for."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auralith.session import checkpointed
from auralith.skew import join_small

#: Bins of a pass, and the rows from which on a group is cut into bins again rather than sorted in one place.
BINS, FEW = 1024, 10_000


def medians(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, median: the exact median of the non-null values by group, the mean of the two middle ones where they are even.

    Each pass counts equal-width bins between the smallest and the largest value that are left, and keeps the bin with the middle rank; counts combine
    before the shuffle, so a pass moves BINS numbers a group and task. Groups without values have no row.
    """
    values = rows.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("v"))
    state = values.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    middle = F.array(F.struct(F.lit(0).alias("side"), F.expr("(n + 1) DIV 2").alias("rank")), F.struct(F.lit(1).alias("side"), F.expr("n DIV 2 + 1").alias("rank")))
    state = checkpointed(state.select(*keys, F.explode(middle).alias("m"), "n", "lo", "hi").select(*keys, "m.side", "m.rank", "n", "lo", "hi"))
    size = state.count()
    inside = lambda s: join_small(values, s, keys, size, "inner").where("v BETWEEN lo AND hi")
    while not state.where((F.col("n") > FEW) & (F.col("lo") < F.col("hi"))).isEmpty():
        at = F.least(F.lit(BINS - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS)).cast("int")
        spread = inside(state.where("lo < hi")).groupBy(*keys, "side", "rank", at.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy(*keys, "side").orderBy("bin"))  # BINS rows a group
        found = spread.withColumn("upto", upto).where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        found = found.select(*keys, "side", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "n", "lo", "hi")
        state = checkpointed(found.unionByName(state.where("lo = hi")))
    left = inside(state.where("lo < hi")).groupBy(*keys, "side", "rank").agg(F.sort_array(F.collect_list("v")).alias("vs"))  # FEW values at most
    both = left.select(*keys, F.get("vs", (F.col("rank") - 1).cast("int")).alias("v")).unionByName(state.where("lo = hi").select(*keys, F.col("lo").alias("v")))
    return both.groupBy(*keys).agg(F.avg("v").alias("median"))


def sums_before(rows: DataFrame, key: str, size: str) -> DataFrame:
    """Adds before: the sum of size over the rows with a smaller key. The rows are cut into ranges of the key, range sums give offsets, and a window runs inside a range."""
    ranged = checkpointed(rows.repartitionByRange(F.col(key)).withColumn("__r", F.spark_partition_id()))
    sums = ranged.groupBy("__r").agg(F.sum(size).alias("__n"))
    # a row a range
    offsets = sums.select("__r", F.coalesce(F.sum("__n").over(Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__r").orderBy(key).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.sum(size).over(Window.partitionBy("__r", key))
    return ranged.withColumn("__u", F.sum(size).over(inside) - own).join(F.broadcast(offsets), "__r").withColumn("before", F.col("__o") + F.col("__u")).drop("__r", "__u", "__o")
