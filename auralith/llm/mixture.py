"""Mixing sources to target weights.

Native: DataFrame functions only. Sizes are word counts. Sources in code point order (null last) weigh 5, 2, 1, repeating; targets
share the whole size and stop at MAX_EPOCHS times their source's size, the excess going to the others by weight. Within a source,
documents stand in the order of a hash of doc_id; the order is cut into ranges of the hash, range sums give each range its offset, and
a window inside a range gives the exact prefix sum. Each document is taken as often as the target covers the whole source; in the last
round the documents before the cut are taken once more and the document at the cut up to the exact word.

Cases: null text has size 0, null source is a source of its own, null doc_id sorts by the hash of an empty text; rows that repeat
a doc_id follow each other in the order of their sizes, and equal rows get interchangeable results; an empty table gives an empty
result; a source without words has target 0; columns other than the three that are read are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auralith.llm.common import WORD, checkpointed, join_small

WEIGHTS = [5, 2, 1]
MAX_EPOCHS = 3
#: Hexadecimal digits of the hash that name a range: 3 make 4,096 ranges a source.
RANGE_DIGITS = 3


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key: the narrow rows that the mix works on."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: one row a source.

    A source stops at its limit if, with all sources that reach theirs earlier (by limit per weight) at their limits, its share
    of the rest is above it. The window over sources has a row for each source, not for each document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("w", F.get(weights, (F.row_number().over(order) - 1) % len(WEIGHTS)).cast("long")).withColumn("most", MAX_EPOCHS * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy((F.col("most") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(everything)).withColumn("weight", F.sum("w").over(everything))
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))
    others = F.col("weight") - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("stops", F.col("most") * others < F.col("w") * left)
    stopped = lambda c: F.sum(F.when(F.col("stops"), F.col(c)).otherwise(0)).over(everything)
    share = (F.col("total") - stopped("most")).cast("double") * F.col("w") / (F.col("weight") - stopped("w"))
    return per.select("source", "source_size", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken, epochs: one row a document; reruns agree.

    taken is epochs (whole rounds) times size plus what the last round takes.
    """
    rows = checkpointed(sized(docs))
    range_of = F.substring("key", 1, RANGE_DIGITS)
    plan = checkpointed(targets(rows))
    n = plan.count()
    ranges = rows.groupBy("source", range_of.alias("range")).agg(F.sum("size").alias("range_size"))
    sums = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("__s"), F.col("range").alias("__r"), F.coalesce(F.sum("range_size").over(sums), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefixed = rows.withColumn("range", range_of).withColumn("upto", F.sum("size").over(inside))
    prefixed = prefixed.join(ranges, F.col("source").eqNullSafe(F.col("__s")) & (F.col("range") == F.col("__r"))).drop("__s", "__r")
    plan = plan.withColumnRenamed("source", "__s")
    out = join_small(prefixed, plan, F.col("source").eqNullSafe(F.col("__s")), n)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) DIV source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    last = F.least(F.greatest(rest - (F.col("offset") + F.col("upto") - F.col("size")), F.lit(0)), F.col("size"))
    return out.select("doc_id", "source", "key", "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"), epochs.cast("long").alias("epochs"))


def apply_mix(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of the documents as the mix takes them: a row for each round; the document at its source's cut keeps the words before it.

    Only the cut of each source, a row a source, goes to the documents; the texts are not shuffled. Documents without words stay once.
    """
    mixed = mix(docs)
    extra = F.col("taken") - F.col("epochs") * F.col("size")
    cuts = mixed.where(F.col("size") > 0).groupBy(F.col("source").alias("__s")).agg(
        F.max("epochs").alias("__rounds"), F.max(F.when(extra > 0, F.struct("key", F.col("doc_id").alias("id"), "size", extra.alias("extra")))).alias("__cut"))
    cuts = checkpointed(cuts)
    own = docs.select(F.struct(*columns).alias("__row"), "doc_id", "source", F.coalesce("text", F.lit("")).alias("__text"))
    own = own.withColumn("__size", F.regexp_count("__text", F.lit(WORD)).cast("long")).withColumn("__key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    out = join_small(own, cuts, F.col("source").eqNullSafe(F.col("__s")), cuts.count())
    here, cut = F.struct(F.col("__key").alias("key"), F.col("doc_id").alias("id"), F.col("__size").alias("size")), F.struct("__cut.key", "__cut.id", "__cut.size")
    part = F.when(here < cut, F.col("__size")).when(here == cut, F.col("__cut.extra")).otherwise(0)
    part = F.when(F.col("__cut").isNull() | (F.col("__size") == 0), 0).otherwise(part)
    rounds = F.when(F.col("__size") == 0, 1).otherwise(F.coalesce(F.col("__rounds"), F.lit(0))).cast("int")
    whole = rounds + F.when((part > 0) & (part == F.col("__size")), 1).otherwise(0)
    # words in each of the document's rows: null for the whole text
    shares = F.concat(F.array_repeat(F.lit(None).cast("long"), whole.cast("int")), F.when((part > 0) & (part < F.col("__size")), F.array(part.cast("long"))).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("__words", F.explode(shares))
    first = F.expr(r"array_join(slice(regexp_extract_all(__text, r'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+', 0), 1, cast(__words as int)), '')")
    text = F.when(F.col("__words").isNull(), F.col("__row.text")).otherwise(first)
    return out.select(*[text.alias("text") if c == "text" else F.when(F.col("__words").isNull(), F.col(f"__row.{c}")).otherwise(F.length(text)).alias(c) if c == "n_chars" else F.col(f"__row.{c}").alias(c) for c in columns])


#: The rows of op9_source_mixture in SQL.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, 3 * source_size AS most, CAST([5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS w FROM per
), summed AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weight,
    coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(w) OVER o, 0) AS w_before
  FROM weighed WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopping AS (
  SELECT *, most * (weight - w_before) < w * (total - most_before) AS stops FROM summed
), planned AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(most AS DOUBLE)
    ELSE CAST(total - sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS DOUBLE) * w / (weight - sum(CASE WHEN stops THEN w ELSE 0 END) OVER ()) END AS target
  FROM stopping
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target,
    CASE WHEN p.source_size > 0 THEN CAST(floor(p.target) AS BIGINT) // p.source_size ELSE 0 END AS epochs,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS before
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + least(greatest(CAST(floor(target) AS BIGINT) - epochs * source_size - before, 0), size) AS BIGINT) AS taken
FROM placed
"""
