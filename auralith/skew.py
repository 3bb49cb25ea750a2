"""Joins of a checked size, and joins that deal hot keys over several tasks."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith.session import checkpointed

#: The most rows of a table that is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS = 20_000
#: A key with more rows is dealt over several tasks where it is among the BROADCAST_ROWS most frequent.
HEAVY = 500
#: Tables of so many rows aren't looked through for hot keys.
SMALL = 20_000


def join_small(left: DataFrame, small: DataFrame, on: Column | list[str], rows: int, how: str = "left") -> DataFrame:
    """Joins a table of a counted size: broadcast up to BROADCAST_ROWS rows, else as Spark plans it."""
    return left.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, on, how)


def compact(df: DataFrame) -> DataFrame:
    """Checkpointed; a table of up to SMALL rows in one partition, so that what follows on it alone is one task without an exchange, however many partitions the session
    deals shuffles over. Larger tables stay as they are dealt."""
    out = checkpointed(df)
    return checkpointed(out.coalesce(1)) if out.count() <= SMALL else out


def heavy_keys(counts: DataFrame, keys: list[str], n: str) -> DataFrame | None:
    """The keys with more than HEAVY rows, at most BROADCAST_ROWS of them, the most frequent, and the salts that join_skewed deals each over; none without such keys. counts: a row a key, n its rows."""
    most = checkpointed(counts.where(F.col(n) > HEAVY).select(*keys, F.col(n).alias("__n")))
    if most.isEmpty():
        return None
    if most.count() > BROADCAST_ROWS:
        most = checkpointed(most.orderBy(F.desc("__n"), *keys).limit(BROADCAST_ROWS))
    return most.select(*keys, F.ceil(F.col("__n") / HEAVY).cast("int").alias("salts"))


def hot_values(rows: DataFrame, *columns: str) -> DataFrame | None:
    """hot, salts: the values that the columns hold in more than HEAVY places (see heavy_keys); none in a table of up to SMALL rows, where no task can have much to do. rows: checkpointed."""
    if rows.count() <= SMALL:
        return None
    return heavy_keys(rows.select(F.explode(F.array(*columns)).alias("hot")).groupBy("hot").agg(F.count("*").alias("n")), ["hot"], "n")


def join_skewed(left: DataFrame, right: DataFrame, keys: list[str], heavy: DataFrame | None, how: str = "inner") -> DataFrame:
    """left joined (inner or left) to right, which has one row for each value of the keys. The rows of a heavy key are dealt over its salts and right's row is
    repeated for each of them, so that no task gets a key's rows all, and both sides are shuffled. heavy: the keys and their salts in this order, from heavy_keys. Null keys meet nothing."""
    if heavy is None:
        return left.join(right, keys, how)
    known = F.broadcast(heavy.toDF(*[f"__h{i}" for i in range(len(keys))], "__salts"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__h{i}") for i, k in enumerate(keys)])
    salts = F.coalesce("__salts", F.lit(1))
    dealt = left.join(known, on, "left").select(*left.columns, F.pmod(F.xxhash64(*left.columns), salts).cast("int").alias("__salt"))
    repeated = right.join(known, on, "left").select(*right.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("__salt"))
    return dealt.join(repeated.hint("merge"), [*keys, "__salt"], how).drop("__salt")
