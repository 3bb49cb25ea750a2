"""Evaluation of recognisers and judges: error rates, degradations, gates, similarity of speakers, emotions, release checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auralith.functions import text as T
from auralith.functions.arrow import map_rows
from auralith.operators.labels import spearman
from auralith.operators.quantiles import medians

# Least scored clips, least separation, largest deviation, least rank correlation.
GATES = {"scored": 5, "separation": 0.5, "deviation": 0.5, "rho": 0.3}
# What a judge scores, in the order of its answers.
DIMENSIONS = "pronunciation_clarity prosody_naturalness emotional_expression speaker_differentiation dialogue_flow escalation_arc scene_coherence overall_quality".split()


def transcript_errors(rows: DataFrame) -> DataFrame:
    """Adds word_edits, ref_words, hyp_words, wer and cer of normalised texts. rows: reference, hypothesis."""
    plain = rows.withColumn("__ref", T.normalised(F.col("reference"))).withColumn("__hyp", T.normalised(F.col("hypothesis")))
    out = map_rows(plain, ["__ref", "__hyp"], "word_edits int, ref_words int, hyp_words int", T.word_edits)
    return out.withColumn("wer", F.col("word_edits") / F.greatest("ref_words", F.lit(1))).withColumn("cer", T.char_error_rate(F.col("__ref"), F.col("__hyp"))).drop("__ref", "__hyp")


def silence_collapses(rows: DataFrame, least: float = 0.85) -> DataFrame:
    """Clips whose hypothesis has less than `least` of the words, the worst first when ordered by ratio. rows: clip, ref_words, hyp_words."""
    ratio = F.col("hyp_words") / F.greatest("ref_words", F.lit(1))
    return rows.select("clip", ratio.alias("length_ratio")).where(F.col("length_ratio") < least)


def off_length(ratio: Column) -> Column:
    """F8: whether a length ratio is off in either direction."""
    return (ratio < 0.95) | (ratio > 1.04)


def run_scores(rows: DataFrame) -> DataFrame:
    """Run, median_wer, mean_wer, median_cer, mean_cer. rows: run, wer, cer."""
    means = rows.groupBy("run").agg(F.round(F.avg("wer"), 6).alias("mean_wer"), F.round(F.avg("cer"), 6).alias("mean_cer"))
    for c in ("wer", "cer"):
        means = means.join(medians(rows, ["run"], c).select("run", F.round("median", 6).alias(f"median_{c}")), "run", "left")
    return means


def best_run(scores: DataFrame) -> DataFrame:
    """The run with the lowest median word error rate, of equal ones the first by name; runs without one don't count."""
    return scores.where("median_wer IS NOT NULL").agg(F.min_by("run", F.struct("median_wer", "run")).alias("run"))


def separations(clean: DataFrame, degraded: DataFrame, gate: float = 0.5) -> DataFrame:
    """Kind, mean_score, separation, passed: each degradation against the same clips without it. clean: clip, score; degraded: clip, kind, score."""
    both = degraded.join(clean.select("clip", F.col("score").alias("clean")), "clip")
    gap = F.avg("clean") - F.avg("score")
    return both.groupBy("kind").agg(F.round(F.avg("score"), 6).alias("mean_score"), F.round(gap, 6).alias("separation"), (gap >= gate).alias("passed"))


def any_pass(found: DataFrame) -> DataFrame:
    """Whether any degradation separates."""
    return found.agg(F.coalesce(F.bool_or("passed"), F.lit(False)).alias("any_pass"))


def gates(clips: DataFrame, results: DataFrame, limits: dict = GATES) -> DataFrame:
    """A row a model: scored, refusals, corpus_mean, noise_gap, rate_gap, max_deviation and the gates' outcomes; those of deviation are informational.

    clips: label, kind (corpus or degraded), degradation; results: model, clip, variant, reason (ok, content_refusal, json_parse_error, api_error), scores (a map, null if none).
    Only results with all metadata count; a clip's score is its mean over reruns; either separation is enough.
    """
    runs = results.where("variant = 'with_metadata'").join(clips.withColumnRenamed("label", "clip"), "clip")
    scored = F.col("scores").isNotNull()
    heads = runs.groupBy("model").agg(F.countDistinct(F.when(scored & (F.col("reason") != "content_refusal"), F.col("clip"))).alias("scored"), F.count_if(F.col("reason") == "content_refusal").alias("refusals"))
    per = runs.where(scored).groupBy("model", "clip", "kind", "degradation").agg(F.avg(F.try_element_at("scores", F.lit("overall_quality"))).alias("quality"))
    of = lambda c: F.avg(F.when(c, F.col("quality")))
    gaps = per.groupBy("model").agg(of(F.col("kind") == "corpus").alias("corpus_mean"), (of(F.col("kind") == "corpus") - of(F.col("degradation") == "wn_snr_-10db")).alias("noise_gap"),
                                    (of(F.col("kind") == "corpus") - of(F.col("degradation").startswith("synth_rate_slow_"))).alias("rate_gap"))
    spread = runs.where(scored).select("model", "clip", F.explode("scores").alias("dim", "score")).groupBy("model", "clip", "dim").agg(F.count("*").alias("n"), F.stddev_pop("score").alias("sd"))
    spread = spread.groupBy("model").agg(F.coalesce(F.max(F.when(F.col("n") >= 2, F.col("sd"))), F.lit(0.0)).alias("max_deviation"))
    out = heads.join(gaps, "model", "left").join(spread, "model", "left")
    enough, apart = F.col("scored") >= limits["scored"], F.coalesce(F.col("noise_gap") >= limits["separation"], F.lit(False)) | F.coalesce(F.col("rate_gap") >= limits["separation"], F.lit(False))
    return out.select("model", "scored", "refusals", *[F.round(c, 6).alias(c) for c in ("corpus_mean", "noise_gap", "rate_gap", "max_deviation")], enough.alias("refusal_pass"), apart.alias("discrimination_pass"),
                      (F.coalesce("max_deviation", F.lit(0.0)) <= limits["deviation"]).alias("variance_pass"), (enough & apart).alias("overall_pass"))


def rank_agreement(ranks: DataFrame) -> DataFrame:
    """Rho and n of expected ranks and scores."""
    return spearman(ranks.select("expected", "score"), "expected", "score")


def metadata_bias(results: DataFrame, dims: list[str] = ("emotional_expression", "escalation_arc")) -> DataFrame:
    """Model, clip, dim, with_metadata, no_arc, delta: mean scores with and without the arc in the prompt, where there are both."""
    rows = results.where("scores IS NOT NULL").select("model", "clip", "variant", F.explode("scores").alias("dim", "score")).where(F.col("dim").isin(list(dims)))
    of = lambda v: F.avg(F.when(F.col("variant") == v, F.col("score")))
    both = rows.groupBy("model", "clip", "dim").agg(of("with_metadata").alias("a"), of("no_arc").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    return both.select("model", "clip", "dim", F.round("a", 2).alias("with_metadata"), F.round("b", 2).alias("no_arc"), F.round(F.col("a") - F.col("b"), 2).alias("delta"))


# specified, not part of any command


def speaker_similarity(rows: DataFrame) -> DataFrame:
    """Cosines inside and between speakers, from sums of unit vectors: no pairs are made. rows: speaker, vector. speaker, n, inside (mean over its pairs), between (mean with all others)."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    parts = rows.select("speaker", F.posexplode(F.transform("vector", lambda v: v / norm)).alias("i", "x")).groupBy("speaker", "i").agg(F.sum("x").alias("x"))
    n = rows.groupBy("speaker").agg(F.count("*").alias("n"))
    whole = parts.groupBy("i").agg(F.sum("x").alias("all"))  # a row a dimension
    dots = parts.join(F.broadcast(whole), "i").groupBy("speaker").agg(F.sum(F.col("x") * F.col("x")).alias("own"), F.sum(F.col("x") * F.col("all")).alias("all"))
    every = rows.agg(F.count("*").alias("total"))
    out = dots.join(n, "speaker").crossJoin(F.broadcast(every))  # one row
    inside, between = F.try_divide(F.col("own") - F.col("n"), F.col("n") * (F.col("n") - 1)), F.try_divide(F.col("all") - F.col("own"), F.col("n") * (F.col("total") - F.col("n")))
    return out.select("speaker", "n", F.round(inside, 6).alias("inside"), F.round(between, 6).alias("between"))


def confusion(rows: DataFrame) -> DataFrame:
    """expected, heard, n: counts of emotions."""
    return rows.groupBy("expected", "heard").agg(F.count("*").alias("n"))


def recalls(rows: DataFrame) -> DataFrame:
    """expected, n, recall."""
    return rows.groupBy("expected").agg(F.count("*").alias("n"), F.round(F.count_if(F.col("expected") == F.col("heard")) / F.count("*"), 6).alias("recall"))


def regressions(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """metric, value, regressed: metrics that fell by more than one deviation of the baseline. now: metric, value; baseline: metric, mean, sd."""
    return now.join(baseline, "metric").select("metric", F.round("value", 6).alias("value"), (F.col("value") < F.col("mean") - F.col("sd")).alias("regressed"))


def class_balance(clips: DataFrame, bounds: DataFrame) -> DataFrame:
    """project, typology, share, inside: each project's shares of typologies within their bounds. bounds: project, typology, low, high."""
    n = clips.groupBy("project", "typology").agg(F.count("*").alias("n"))
    share = n.join(n.groupBy("project").agg(F.sum("n").alias("total")), "project").withColumn("share", F.col("n") / F.col("total"))
    rows = F.broadcast(bounds).join(share.select("project", "typology", "share"), ["project", "typology"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return rows.select("project", "typology", F.round("share", 6).alias("share"), F.col("share").between(F.col("low"), F.col("high")).alias("inside"))


def confusor_coverage(clips: DataFrame, share: float = 0.20, least: int = 50) -> DataFrame:
    """covered, thin: whether tier C is large enough, and how many of its types have too few training clips. clips: tier, kind, split."""
    types = clips.where("tier = 'C' AND split = 'train'").groupBy("kind").agg(F.count("*").alias("n"))
    whole = clips.agg((F.count_if(F.col("tier") == "C") >= share * F.count("*")).alias("covered"))
    return whole.crossJoin(types.agg(F.count_if(F.col("n") < least).alias("thin")))  # one row each


def trainable(clips: DataFrame) -> DataFrame:
    """Training clips without disagreement and with enough confidence. clips: quality_flags, annotator_confidence, split."""
    return clips.where((F.col("split") == "train") & ~F.coalesce(F.array_contains("quality_flags", "iaa_disagreement"), F.lit(False)) & (F.coalesce("annotator_confidence", F.lit(1.0)) >= 0.6))


def stratified_splits(clips: DataFrame, strata: list[str], train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """clip, split: each stratum's clips in hash order, cut at its shares; no task holds a stratum (the order is counted in ranges of the hash)."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("clip").cast("string")))
    rows = clips.select("clip", *strata, key.alias("key")).withColumn("range", F.substring("key", 1, 3))
    counts = rows.groupBy(*strata, "range").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(*strata).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy(*strata)))
    place = rows.withColumn("place", F.row_number().over(Window.partitionBy(*strata, "range").orderBy("key", "clip")) - 1).join(offsets.drop("n"), [*strata, "range"])
    at = F.col("before") + F.col("place")
    split = F.when(at < F.bround(F.col("total") * train), "train").when(at < F.bround(F.col("total") * train) + F.bround(F.col("total") * val), "val").otherwise("test")
    return place.select("clip", split.alias("split"))


def scene_disjoint(pairs: DataFrame, scenes: DataFrame) -> DataFrame:
    """clip, speaker rows for components that share neither speakers nor scenes. pairs: clip, speaker; scenes: clip, scene."""
    return pairs.select("clip", F.concat(F.lit("speaker:"), F.col("speaker").cast("string")).alias("speaker")).unionByName(scenes.select("clip", F.concat(F.lit("scene:"), F.col("scene").cast("string")).alias("speaker")))


def judge_prompt(clips: DataFrame, variant: str = "with_metadata") -> DataFrame:
    """P25: clip and prompt; without the arc and the typology's description in the variant no_arc. clips: clip, typology, typology_long, arc, seconds, speakers, backend, degradation (null: none)."""
    note = F.when(F.col("degradation").isNull(), "").otherwise(F.concat(F.lit("\ndegradation (for evaluation only): "), "degradation"))
    arc = F.concat(F.lit(" ("), "typology_long", F.lit(")\nintensity arc: "), "arc") if variant == "with_metadata" else F.lit("")
    head = F.concat(F.lit("clip: "), F.col("clip").cast("string"), F.lit("\ntypology: "), "typology", arc, F.format_string("\nduration: %.1f s\nspeakers: ", "seconds"), "speakers", F.lit("\nbackend: "), "backend", note)
    return clips.select("clip", F.concat(head, F.lit("\nScore 1 to 5 as JSON: " + ", ".join(DIMENSIONS))).alias("prompt"))


def first_sample(clips: DataFrame, n: int, order: str) -> DataFrame:
    """The first n clips by a column."""
    return clips.orderBy(order).limit(n)


def with_defaults(speakers: DataFrame) -> DataFrame:
    """A missing voice family is the voice; a missing or empty spoken text is the text, where there are such columns."""
    out = speakers
    if "voice_family" in out.columns:
        out = out.withColumn("voice_family", F.coalesce("voice_family", "tts_voice_id"))
    if "text_spoken" in out.columns:
        out = out.withColumn("text_spoken", F.coalesce(F.nullif("text_spoken", F.lit("")), "text"))
    return out


def recogniser_report(rows: DataFrame, clean: DataFrame, degraded: DataFrame, wer_gate: float = 0.40, gap: float = 0.5) -> dict[str, DataFrame]:
    """Tables of an evaluation: scores of runs with their gate, the best run, separations, whether any degradation separates. rows: run, reference, hypothesis."""
    scores = run_scores(transcript_errors(rows))
    found = separations(clean, degraded, gap)
    return {"runs": scores.withColumn("passed", F.coalesce(F.col("median_wer") < wer_gate, F.lit(False))), "best": best_run(scores), "separations": found, "any_pass": any_pass(found)}
