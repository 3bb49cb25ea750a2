"""Inter-annotator agreement."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Category -> kappa aimed at, least kappa.
THRESHOLDS = [("PHYS", 0.65, 0.55), ("VERB", 0.60, 0.50), ("DIST", 0.60, 0.50), ("ACOU", 0.70, 0.60), ("EMOT", 0.55, 0.45), ("INTENS", 0.60, 0.50)]
CATEGORIES = [c for c, *_ in THRESHOLDS[:-1]]
LEAST_COVERAGE = 0.20


def cohen_kappa(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Kappa and n of pairs a, b, by group; 0 where chance agreement is complete. Works on the confusion counts."""
    by = by or []
    cells = pairs.groupBy(*by, "a", "b").agg(F.count("*").alias("n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    total = F.sum("n").over(group)
    cells = cells.withColumns({"total": total, "row": F.sum("n").over(Window.partitionBy(*by, "a")), "a_share": F.col("n")})
    columns = cells.groupBy(*by, F.col("b").alias("k")).agg(F.sum("n").alias("in_b"))
    rows = cells.groupBy(*by, F.col("a").alias("k")).agg(F.sum("n").alias("in_a"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"), F.max("total").alias("total"))
    both = rows.join(columns, [*by, "k"], "left")
    agg = both.groupBy(*by).agg(F.sum("same").alias("same"), F.sum(F.coalesce("in_b", F.lit(0)) * F.col("in_a")).alias("chance"), F.max("total").alias("n"))
    return agg.select(*by, F.round(_kappa(F.col("same") / F.col("n"), F.col("chance").cast("double") / F.col("n") / F.col("n"), 0.0), 6).alias("kappa"), "n")


def _kappa(observed: Column, expected: Column, degenerate: float) -> Column:
    return F.when(expected >= 1, F.lit(degenerate)).otherwise(F.try_divide(observed - expected, 1 - expected))


def weighted_kappa(pairs: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Agreement weight 1 up to a difference of one, then falling linearly to 0 at the largest; 0 without pairs, 1 on a scale of one point and where chance agreement is complete.

    A label outside the scale is an error."""
    if low == high:
        return pairs.agg(F.when(F.count("*") == 0, 0.0).otherwise(1.0).alias("kappa"), F.count("*").alias("n"))
    outside = F.raise_error(F.lit(f"a label is outside {low} to {high}")).cast("int")
    pairs = pairs.select(*[F.when(F.col(c).between(low, high), F.col(c)).otherwise(outside).alias(c) for c in "ab"])
    weight = lambda a, b: F.when(F.abs(a - b) <= 1, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - (F.abs(a - b) - 1) / F.lit(float(max(1, high - low - 1)))))
    cells = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    rows, columns = (cells.groupBy(F.col(c).alias(c)).agg(F.sum("n").alias(f"n_{c}")) for c in "ab")
    seen = cells.agg(F.sum("n").alias("n"), F.sum(F.col("n") * weight(F.col("a"), F.col("b"))).alias("seen"))
    # the marginals have a row a scale point
    chance = rows.crossJoin(columns).agg(F.sum(F.col("n_a") * F.col("n_b") * weight(F.col("a"), F.col("b"))).alias("chance"))
    out = seen.crossJoin(chance)
    kappa = _kappa(F.col("seen") / F.nullif("n", F.lit(0)), F.col("chance") / F.nullif("n", F.lit(0)) / F.nullif("n", F.lit(0)), 1.0)
    n = F.coalesce("n", F.lit(0))
    return out.select(F.when(n == 0, 0.0).otherwise(F.round(kappa, 6)).alias("kappa"), n.alias("n"))


def presence(events: DataFrame, clips: DataFrame, column: str) -> DataFrame:
    """(clip, category, present), 0 for clips without events; clips: the ids."""
    has = clips.join(events.select("clip", "tier1"), "clip", "left").groupBy("clip").agg(*[F.coalesce(F.bool_or(F.col("tier1").startswith(c)), F.lit(False)).cast("int").alias(c) for c in CATEGORIES])
    return has.unpivot(["clip"], CATEGORIES, "category", column)


def iaa_report(a: DataFrame, b: DataFrame, order: str, clips: DataFrame | None = None) -> DataFrame:
    """Category, kappa, n, target, least, meets_target, meets_min: a row a category over the clips, and INTENS over events paired by position.

    a, b: events of both annotators, positions in the order of the column `order`; clips: the ids of all annotated clips, those without any event too (by default those with events).
    """
    clips = (a.select("clip").union(b.select("clip")) if clips is None else clips.select("clip")).distinct()
    pairs = presence(a, clips, "a").join(presence(b, clips, "b"), ["clip", "category"])
    found = cohen_kappa(pairs, ["category"]).unionByName(weighted_kappa(positional_pairs(a, b, order)).withColumn("category", F.lit("INTENS")))
    limits = a.sparkSession.createDataFrame(THRESHOLDS, "category string, target double, least double")
    kappa, n = F.coalesce("kappa", F.lit(0.0)), F.coalesce("n", F.lit(0))
    return F.broadcast(limits).join(found, "category", "left").select("category", kappa.alias("kappa"), n.alias("n"), "target", "least", (kappa >= F.col("target")).alias("meets_target"), (kappa >= F.col("least")).alias("meets_min"))


def iaa_verdict(report: DataFrame, reviewed: DataFrame, total: int | DataFrame) -> DataFrame:
    """clips_reviewed, coverage, meets_coverage, all_meet_min, passes. reviewed: ids of the annotated clips; total: the clips there are, or a table of them."""
    n = reviewed.select("clip").distinct().agg(F.count("*").alias("clips_reviewed"))
    whole = total.agg(F.count("*").alias("total")) if isinstance(total, DataFrame) else n.select(F.lit(total).alias("total"))
    row = n.crossJoin(whole).crossJoin(report.agg(F.coalesce(F.bool_and("meets_min"), F.lit(True)).alias("all_meet_min")))  # one row each
    coverage = F.coalesce(F.try_divide(F.col("clips_reviewed").cast("double"), F.nullif("total", F.lit(0))), F.lit(0.0))
    enough = coverage >= LEAST_COVERAGE
    return row.select("clips_reviewed", F.round(coverage, 6).alias("coverage"), enough.alias("meets_coverage"), "all_meet_min", (enough & F.col("all_meet_min")).alias("passes"))


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """A22."""
    clips = a.select("clip").union(b.select("clip")).distinct()
    return presence(a, clips, "a").join(presence(b, clips, "b"), ["clip", "category"]).where("a <> b").select("clip").distinct()


def positional_pairs(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """Intensities of both annotators by position; the shorter list ends the pairs."""
    place = lambda df, c: df.select("clip", (F.row_number().over(Window.partitionBy("clip").orderBy(order)) - 1).alias("pos"), F.col("intensity").alias(c))
    return place(a, "a").join(place(b, "b"), ["clip", "pos"])
