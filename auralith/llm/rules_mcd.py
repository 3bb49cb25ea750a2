"""Quality rules: exact base counts, then robust multivariate outliers by minimum-covariance-determinant estimates.

Native: DataFrame functions only. Per document: counts over the whole text (null: empty text). The statistic vector is
transformed to five near-Gaussian values. Estimates are searched for each language and source, each language, and all documents, always from all
of their rows. A search has three starts around the medians (uncorrelated quartile scales, the correlation of the values squashed by tanh, and that of
their directions). A concentration step takes the three quarters of the rows that are closest and their mean and covariance, which never enlarges
the determinant. After FIRST steps the start with the smallest determinant goes on until no determinant falls by more than ENOUGH. A
reweighted estimate over the rows inside the 97.5 % ellipsoid ends the search, and the Mahalanobis distance to it decides.

A source's estimate is that of its rows and PRIOR rows of its language's, which is that of its rows and PRIOR rows of the whole table's: small groups lean
on what they are part of, smoothly and at every size. FLOORS are added to the variances, because most clean documents share the same zero in several statistics.

Cases: null text, lang or source are values like others (null text: no words, base_failed); ties and repeated rows are judged
alike, each row by itself; an empty table gives an empty result; columns other than the four that are read are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import SPACE, WORD, checkpointed, join_small

WINDOW = 8
MIN_WORDS, REPEAT_PERCENT = 20, 30
COVERED, FIRST, ENOUGH, PRIOR = 0.75, 2, 0.01, 200
#: Squared distance beyond which a document is rejected: chi-square with five degrees of freedom, tail 1e-8, so that the long tails of clean text stay.
CUTOFF = 45.0
#: chi-square with five degrees of freedom: its median, and its 97.5 % quantile for the reweighted step.
MEDIAN_5, TAIL_5 = 4.351, 12.833
DIMS = ["v_length", "v_symbols", "v_lines", "v_repeats", "v_distinct"]
#: Standard deviations added to each dimension's variance.
FLOORS = [0.05, 0.15, 0.15, 0.15, 0.10]
K = range(len(DIMS))
TRIANGLE = [(i, j) for i in K for j in range(i + 1)]
MOMENTS = [f"m{i}" for i in K] + [f"c{i}{j}" for i, j in TRIANGLE]


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, base_failed: one row a document.

    n_repeat_words counts the words covered by a window of 8 words that the text holds twice or more. Windows are compared by
    64-bit hashes first; only documents with an equal pair look at the windows themselves.
    """
    long = lambda c: c.cast("long")
    first = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("__text")).withColumn("__words", F.expr(f"filter(split(__text, r'{SPACE}'), w -> w <> '')"))
    counted = first.select(
        *keep,
        "__words",
        F.expr(f"filter(split(__text, '\\n'), l -> l rlike r'{WORD}')").alias("__lines"),
        long(F.size(F.split("__text", r"[#*$%&|<>]", -1)) - 1).alias("n_symbols"),
        long(F.length(F.array_join("__words", ""))).alias("word_chars"),
        F.expr(f"CASE WHEN size(__words) > {WINDOW} THEN transform(sequence(0, size(__words) - {WINDOW}), i -> xxhash64(slice(__words, i + 1, {WINDOW}))) END").alias("__windows"),
    )
    # null where no window can repeat
    windows = F.expr(
        f"CASE WHEN size(array_distinct(__windows)) < size(__windows) THEN sort_array(transform(sequence(0, size(__words) - {WINDOW}), "
        f"i -> struct(slice(__words, i + 1, {WINDOW}) AS w, i AS i))) END"
    )
    repeated = F.expr("sort_array(transform(filter(__sorted, (x, j) -> get(__sorted, j - 1).w = x.w OR get(__sorted, j + 1).w = x.w), x -> x.i))")
    covered = F.expr(f"aggregate(__starts, struct(0 AS n, -{WINDOW} AS last), (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)")
    counted = (
        counted.select("*", windows.alias("__sorted"))
        .withColumn("__starts", repeated)
        .select(
            *keep,
            long(F.size("__words")).alias("n_words"),
            "word_chars",
            "n_symbols",
            long(F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
            long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
            long(F.size("__lines")).alias("n_lines"),
            long(F.size(F.array_distinct("__words"))).alias("n_distinct"),
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics; null where the base rules failed."""
    words, chars = F.col("n_words"), F.col("word_chars")
    values = [F.log(chars / words), F.log(1 + 100 * F.col("n_symbols") / chars), F.col("n_dup_lines") / F.col("n_lines"), F.col("n_repeat_words") / words, F.log(F.col("n_distinct") / words)]
    return stats.withColumns({d: F.when(~F.col("base_failed"), v) for d, v in zip(DIMS, values, strict=True)})


@dataclass
class Model:
    """estimates: lang, source -> means and Cholesky factor of the source's estimate; checkpointed, with its number of rows."""

    estimates: DataFrame
    n: int


def _distance(d: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution with the Cholesky factor."""
    for i, c in enumerate(DIMS):
        rest = reduce(lambda a, j: a - F.col(f"l{i}{j}") * F.col(f"z{j}"), range(i), F.col(c) - F.col(f"m{i}"))
        d = d.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return d.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in K])).drop(*[f"z{i}" for i in K])


def _factored(moments: DataFrame, keep: list[str]) -> DataFrame:
    """keep, m*, l** (Cholesky factor of the covariance c** with FLOORS added), logdet (of that covariance)."""
    out = moments
    for i, j in TRIANGLE:
        value = F.coalesce(F.col(f"c{i}{j}"), F.lit(0.0)) + (FLOORS[i] ** 2 if i == j else 0.0)
        value = reduce(lambda a, h: a - F.col(f"l{i}{h}") * F.col(f"l{j}{h}"), range(j), value)
        # the floor keeps every pivot at least that large, whatever rounding does
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}"))
    logdet = 2 * reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in K])
    return out.select(*keep, *[f"m{i}" for i in K], *[f"l{i}{j}" for i, j in TRIANGLE], logdet.alias("logdet"))


def _moments(rows: DataFrame, by: list[str], values: list[Column] | None = None) -> DataFrame:
    """by, n, m*, c**; combined before the shuffle."""
    v = values or [F.col(d) for d in DIMS]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(v[i]).alias(f"m{i}") for i in K], *[F.covar_pop(v[i], v[j]).alias(f"c{i}{j}") for i, j in TRIANGLE])


def _starts(rows: DataFrame) -> DataFrame:
    """group, start, m*, c**: three starts around the medians, scaled by quartile ranges (FLOORS where those are smaller)."""
    at = rows.groupBy("group").agg(*[F.percentile_approx(d, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, d in enumerate(DIMS)])
    scale = lambda i: F.greatest((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349, F.lit(FLOORS[i]))
    at = checkpointed(at.select(F.col("group").alias("__g"), *[F.get(f"q{i}", F.lit(1)).alias(f"q{i}") for i in K], *[scale(i).alias(f"s{i}") for i in K]))
    n = at.count()
    z = join_small(rows, at, F.col("group").eqNullSafe(F.col("__g")), n).select("group", *[((F.col(d) - F.col(f"q{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, d in enumerate(DIMS)])
    size = F.greatest(F.sqrt(reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in K])), F.lit(1e-9))
    squashed, turned = [F.tanh(f"z{i}") for i in K], [F.col(f"z{i}") / size for i in K]
    corr = lambda v, name: [F.sum(v[i] * v[j]).alias(f"{name}{i}{j}") for i, j in TRIANGLE]
    sums = z.groupBy("group").agg(*corr(squashed, "t"), *corr(turned, "d"))
    both = join_small(sums, at, F.col("group").eqNullSafe(F.col("__g")), n)

    def covariance(name: str, i: int, j: int) -> Column:
        if i == j:
            return F.col(f"s{i}") * F.col(f"s{i}")
        norm = F.sqrt(F.col(f"{name}{i}{i}") * F.col(f"{name}{j}{j}"))
        return F.coalesce(F.try_divide(F.col(f"{name}{i}{j}"), norm), F.lit(0.0)) * F.col(f"s{i}") * F.col(f"s{j}")

    plain = [(F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in TRIANGLE]
    all_starts = [F.struct(F.lit(k).alias("start"), *c) for k, c in enumerate([plain, *[[covariance(n, i, j).alias(f"c{i}{j}") for i, j in TRIANGLE] for n in "td"]])]
    return both.select("group", *[F.col(f"q{i}").alias(f"m{i}") for i in K], F.explode(F.array(*all_starts)).alias("x")).select("group", *[f"m{i}" for i in K], "x.*")


def _closest(rows: DataFrame, estimates: DataFrame, n: int, share: float) -> tuple[DataFrame, DataFrame]:
    """rows with d2 for each estimate of their group, and the share's quantile of it by group and start."""
    far = _distance(join_small(rows, estimates.withColumnRenamed("group", "__g").drop("logdet"), F.col("group").eqNullSafe(F.col("__g")), n, "inner"))
    far = far.select("group", "start", *DIMS, "d2")
    limits = checkpointed(far.groupBy(F.col("group").alias("__h"), F.col("start").alias("__t")).agg(F.percentile_approx("d2", F.lit(share)).alias("limit")))
    return join_small(far, limits, F.col("group").eqNullSafe(F.col("__h")) & (F.col("start") == F.col("__t")), n, "inner"), limits


def _step(rows: DataFrame, estimates: DataFrame, n: int) -> DataFrame:
    """A concentration step: group, start, m*, l**, logdet of the closest COVERED rows."""
    near, _ = _closest(rows, estimates, n, COVERED)
    return checkpointed(_factored(_moments(near.where("d2 <= limit"), ["group", "start"]), ["group", "start"]))


def search(rows: DataFrame) -> DataFrame:
    """group, n, m*, c**: the reweighted minimum-covariance-determinant estimate of each group. rows: group (a struct), DIMS; read several times."""
    estimates = checkpointed(_factored(_starts(rows), ["group", "start"]))
    n = estimates.count()
    for _ in range(FIRST):
        estimates = _step(rows, estimates, n)
    best = estimates.groupBy("group").agg(F.min_by(F.struct(*[c for c in estimates.columns if c != "group"]), F.struct("logdet", "start")).alias("x"))
    estimates = checkpointed(best.select("group", "x.*"))
    names = [c for c in estimates.columns if c != "group"]
    while True:
        both = estimates.withColumn("k", F.lit(0)).unionByName(_step(rows, estimates, n).withColumn("k", F.lit(1)))
        # rounding of the quantile may make a step worse: each group keeps its better estimate, so the loop ends
        better = both.groupBy("group").agg(F.min_by(F.struct(*names), F.struct("logdet", "k")).alias("x"), (F.max(F.when(F.col("k") == 0, F.col("logdet"))) - F.min("logdet")).alias("fell"))
        better = checkpointed(better)
        estimates = better.select("group", "x.*")
        if (better.agg(F.max("fell")).first()[0] or 0.0) <= ENOUGH:
            break
    # all that lie within the 97.5 % ellipsoid of the subset, scaled so that half of the rows lie within its median
    near, _ = _closest(rows, estimates, n, 0.5)
    near = near.where(F.col("d2") <= F.greatest(F.lit(1.0), F.col("limit") / MEDIAN_5) * TAIL_5)
    return checkpointed(_moments(near, ["group"]))


def _leaned(own: DataFrame, above: DataFrame, on: Column, keep: list[str]) -> DataFrame:
    """The moments of a group's n rows together with PRIOR rows that have the moments above (p_m*, p_c**)."""
    a, b = F.col("n") / (F.col("n") + PRIOR), PRIOR / (F.col("n") + PRIOR)
    joined = own.join(above, on)
    mean = [(a * F.col(f"m{i}") + b * F.col(f"p_m{i}")).alias(f"m{i}") for i in K]
    gap = lambda i: F.col(f"m{i}") - F.col(f"p_m{i}")
    both = [(a * F.col(f"c{i}{j}") + b * F.col(f"p_c{i}{j}") + a * b * gap(i) * gap(j)).alias(f"c{i}{j}") for i, j in TRIANGLE]
    return joined.select(*keep, "n", *mean, *both)


def fit(stats: DataFrame) -> Model:
    """Estimates from all rows that pass the base rules. stats: lang, source and what base_counts adds; read several times."""
    rows = _vectors(stats).where(~F.col("base_failed"))
    none = F.lit(None).cast("string")
    level = lambda k, lang, source: F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source"))
    levels = F.array(level(0, none, none), level(1, F.col("lang"), none), level(2, F.col("lang"), F.col("source")))
    found = search(checkpointed(rows.select(F.explode(levels).alias("group"), *DIMS)))
    of = lambda k: found.where(F.col("group.level") == k).select(F.col("group.lang").alias("lang"), F.col("group.source").alias("source"), "n", *MOMENTS)
    above = lambda df, *keys: df.select(*[F.col(c).alias(f"p_{c}") for c in (*keys, *MOMENTS)])
    langs = _leaned(of(1), F.broadcast(above(of(0))), F.lit(True), ["lang"])  # one row above
    sources = _leaned(of(2), above(langs, "lang"), F.col("lang").eqNullSafe(F.col("p_lang")), ["lang", "source"])
    estimates = checkpointed(_factored(sources, ["lang", "source"]))
    return Model(estimates, estimates.count())


def judge(stats: DataFrame, model: Model) -> DataFrame:
    """Adds distance (squared; null where the base rules failed) and kept to all columns but those of the same names."""
    own = [c for c in stats.columns if c not in ("distance", "kept")]
    estimates = model.estimates.withColumnsRenamed({"lang": "__l", "source": "__s"})
    out = _distance(join_small(_vectors(stats), estimates, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), model.n))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))
    return out.select(*own, F.col("d2").alias("distance"), kept.alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance: one row a document.

    The texts are read once; the estimates and verdicts work on a checkpointed table of counts.
    """
    stats = checkpointed(base_counts(docs, ["doc_id", "lang", "source"]))
    return judge(stats, fit(stats)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of the documents that the rules keep.

    The counts are made once and checkpointed with their rows; the estimates work on a narrow table made from it in one pass.
    """
    counted = checkpointed(base_counts(docs.select(F.struct(*columns).alias("__row"), "text", "lang", "source"), ["__row", "lang", "source"]))
    return judge(counted, fit(counted)).where("kept").select("__row.*")
