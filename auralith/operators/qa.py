"""Dataset quality: overlaps, outliers, warnings, histograms, totals, prosody statistics."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auralith.operators.quantiles import medians


def role_intensity_stats(metrics: DataFrame) -> DataFrame:
    """Turns, exact median F0, mean F0 deviation, mean level and mean loudness by role and intensity; values that no turn has are null."""
    means = metrics.groupBy("role", "intensity").agg(F.count("*").alias("n_turns"), *[F.round(F.avg(c), 6).alias(n) for c, n in (("f0_std", "f0_std_mean"), ("rms", "rms_mean"), ("lufs", "lufs_mean"))])
    middle = medians(metrics, ["role", "intensity"], "f0").withColumnRenamed("median", "f0_median")
    return means.join(middle.withColumn("f0_median", F.round("f0_median", 6)), ["role", "intensity"], "left")


def threshold_checks(stats: DataFrame, roles: list[str] | None = None) -> DataFrame:
    """Name, value, passed for the roles asked for (all by default), from A12's rows; a check without data fails."""
    of = lambda role, i, c: F.max(F.when((F.col("role") == role) & (F.col("intensity") == i), F.col(c)))
    one = stats.agg(*[of("VIC", i, "f0_median").alias(f"v{i}") for i in (1, 4, 5)], (of("AGG", 5, "rms_mean") - of("AGG", 1, "rms_mean")).alias("gain"))
    checks = F.expr("stack(4, 'VIC', 'vic_i1_f0', v1, v1 <= 200, 'VIC', 'vic_i4_f0', v4, v4 < 250, 'VIC', 'vic_i5_f0', v5, v5 < 250, 'AGG', 'agg_gain', gain, gain >= 8) AS (role, name, value, ok)")
    rows = one.select(checks).select("role", "name", F.round("value", 6).alias("value"), F.coalesce("ok", F.lit(False)).alias("passed"))
    return (rows.where(F.col("role").isin(roles)) if roles is not None else rows).drop("role")


def clip_overlap(events: DataFrame) -> DataFrame:
    """An event starts before the latest end so far; touching is no overlap. Sort and scan, not a self-join."""
    before = Window.partitionBy("clip").orderBy("onset_us", "offset_us").rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("latest", F.max("offset_us").over(before)).groupBy("clip").agg(F.coalesce(F.bool_or(F.col("onset_us") < F.col("latest")), F.lit(False)).alias("has_overlap"))


def outlier_clips(metrics: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Turns beyond two population deviations of their role and intensity, in pitch or level."""
    # a few groups hold all rows: their statistics are aggregated and joined back rather than windowed over
    stats = metrics.groupBy("role", "intensity").agg(*[f(c).alias(f"{c}_{n}") for c in ("f0", "rms") for n, f in (("n", F.count), ("mean", F.avg), ("sd", F.stddev_pop))])
    far = lambda c: (F.col(f"{c}_n") >= 2) & (F.col(f"{c}_sd") > 0) & (F.abs(F.col(c) - F.col(f"{c}_mean")) > deviations * F.col(f"{c}_sd"))
    return metrics.join(stats, ["role", "intensity"]).where(F.coalesce(far("f0"), F.lit(False)) | F.coalesce(far("rms"), F.lit(False))).select("clip").distinct()


def acoustic_warnings(metrics: DataFrame) -> DataFrame:
    """(clip, flag) rows."""
    agg = lambda i: F.avg(F.when((F.col("role") == "AGG") & (F.col("intensity") == i), F.col("rms")))
    high = (F.col("role") == "VIC") & (F.col("intensity") >= 4) & (F.col("f0") > 250)
    per = metrics.groupBy("clip").agg((agg(5) - agg(1)).alias("gain"), F.bool_or(high).alias("high"))
    flags = F.array_compact(F.array(F.when(F.round("gain", 9) < 6, "agg_no_escalation"), F.when(F.col("high"), "vic_f0_high")))
    return per.select("clip", F.explode(flags).alias("flag"))


def emotion_downgrade(events: DataFrame) -> DataFrame:
    """More neutral events than low-intensity ones, among those with a role."""
    return events.where("role IS NOT NULL").groupBy("clip").agg((F.count_if(F.col("emotion") == "neutral") > F.count_if(F.col("intensity") <= 2)).alias("flagged"))


def structural_flags(events: DataFrame) -> DataFrame:
    """clip, loud (a turn of intensity 4 or more), has_overlap (only asked of loud clips), flagged (A15): a row a clip with role-bearing events."""
    heard = events.where("role IS NOT NULL")
    per = heard.groupBy("clip").agg(F.bool_or(F.col("intensity") >= 4).alias("loud"), (F.count_if(F.col("emotion") == "neutral") > F.count_if(F.col("intensity") <= 2)).alias("flagged"))
    return per.join(clip_overlap(heard), "clip").withColumn("has_overlap", F.col("loud") & F.col("has_overlap"))


def structural_warnings(events: DataFrame) -> DataFrame:
    """(clip, flag) rows."""
    flags = F.array_compact(F.array(F.when(F.col("loud") & ~F.col("has_overlap"), "warn_no_overlap"), F.when(F.col("flagged"), "warn_emotion_downgrade")))
    return structural_flags(events).select("clip", F.explode(flags).alias("flag"))


def overlap_and_downgrade_ratio(events: DataFrame, clips: DataFrame) -> DataFrame:
    """Overlaps among clips with a turn of intensity 4 or more; downgrades among all valid clips, those without role-bearing events too. clips: the ids of the valid clips."""
    both = clips.select("clip").join(structural_flags(events), "clip", "left")
    n = F.count_if("loud")
    ratio = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    return both.agg(n.alias("clips_i4"), ratio(F.count_if("has_overlap"), n).alias("overlap_ratio"), ratio(F.count_if("flagged"), F.count("*")).alias("downgrade_ratio"))


def dataset_totals(clips: DataFrame) -> DataFrame:
    """A1 and A34."""
    return clips.agg(F.count("*").alias("clips"), F.round(F.sum("duration"), 6).alias("seconds"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


def failure_rate(results: DataFrame, most: float = 0.02) -> DataFrame:
    """A10: the share of clips that did not validate, 0 without clips; it passes up to and including `most`. results: is_valid, a row a clip."""
    rate = F.coalesce(F.try_divide(F.count_if(~F.col("is_valid")), F.count("*")), F.lit(0.0))
    return results.agg(F.round(rate, 6).alias("failure_rate"), (rate <= most).alias("passed"))


def histograms(clips: DataFrame) -> DataFrame:
    """A2: all histograms in one pass by grouping sets."""
    dims = ["typology", "tier", "split", "max_intensity"]
    by = clips.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(F.count("*").alias("clips"), F.grouping_id().alias("g"))
    name = F.when(F.col("g") == 7, "typology").when(F.col("g") == 11, "tier").when(F.col("g") == 13, "split").otherwise("max_intensity")
    return by.select(name.alias("dim"), F.coalesce("typology", "tier", "split", F.col("max_intensity").cast("string")).alias("key"), "clips")


def clip_backends(clips: DataFrame) -> DataFrame:
    """(clip, distinct backend) rows; a missing or empty map counts as unknown. clips: clip, tts_backend (a map)."""
    names = F.array_distinct(F.map_values("tts_backend"))
    return clips.select("clip", F.explode(F.when(F.coalesce(F.size(names), F.lit(0)) > 0, names).otherwise(F.array(F.lit("unknown")))).alias("backend"))


def backend_histogram(clips: DataFrame) -> DataFrame:
    """A7."""
    return clip_backends(clips).groupBy("backend").agg(F.count("*").alias("clips"))


def flagged_clips(clips: DataFrame) -> DataFrame:
    """Clip and its flags, of the clips that have any. clips: clip, quality_flags."""
    return clips.where(F.size("quality_flags") > 0).select("clip", F.array_join("quality_flags", ",").alias("flags"))


def cap_activations(clips: DataFrame) -> DataFrame:
    """Clips with prosody caps, and the caps of all. clips: n_caps."""
    return clips.agg(F.count_if(F.col("n_caps") > 0).alias("clips"), F.coalesce(F.sum(F.col("n_caps").cast("long")), F.lit(0)).alias("caps"))


def missing_labels(clips: DataFrame) -> DataFrame:
    """Clips without strong labels. clips: has_strong_labels."""
    return clips.agg(F.count_if(~F.col("has_strong_labels")).alias("clips"))


def card_shares(clips: DataFrame) -> DataFrame:
    """Each histogram's share of all clips in percent, one decimal, a dash where there is no clip."""
    total = clips.agg(F.count("*").alias("total"))
    share = F.when(F.col("total") == 0, "—").otherwise(F.format_string("%.1f%%", F.bround(100.0 * F.col("clips") / F.col("total"), 1)))
    return histograms(clips).crossJoin(F.broadcast(total)).select("dim", "key", "clips", share.alias("share"))  # one row


def warning_histogram(metrics: DataFrame) -> DataFrame:
    """A9."""
    return acoustic_warnings(metrics).groupBy("flag").agg(F.count("*").alias("clips"))


def distinct_speakers(pairs: DataFrame) -> DataFrame:
    """A3."""
    return pairs.agg(F.countDistinct("speaker").alias("speakers"), F.countDistinct("clip").alias("clips"))


def voices_by_gender(pairs: DataFrame) -> DataFrame:
    """A8."""
    return pairs.groupBy(F.when(F.col("speaker") % 2 == 0, "female").otherwise("male").alias("gender")).agg(F.countDistinct("speaker").alias("voices"))


def run_warnings(voices: DataFrame, backends: DataFrame, ratios: DataFrame, warned: DataFrame, clips: DataFrame) -> DataFrame:
    """Warnings of a run, a row each.

    voices: gender, voices (A8); backends: clip, backend (X2); ratios: A11's row; warned: (clip, flag) acoustic warnings; clips: the valid clips' ids.
    All but the warnings about overlap and downgrade need a clip; a gender that no voice has counts as none.
    """
    of = lambda g: F.coalesce(F.max(F.when(F.col("gender") == g, F.col("voices"))), F.lit(0)).alias(g)
    row = ratios.crossJoin(voices.agg(of("male"), of("female"))).crossJoin(backends.agg(F.countDistinct("backend").alias("backends")))
    row = row.crossJoin(warned.agg(F.countDistinct("clip").alias("warned"))).crossJoin(clips.agg(F.count("*").alias("total")))  # one row each
    some = F.col("total") > 0
    flags = F.array_compact(F.array(
        F.when(some & (F.col("male") < 3), "low_voice_diversity_male"), F.when(some & (F.col("female") < 3), "low_voice_diversity_female"),
        F.when(some & (F.col("backends") <= 1), "single_backend"), F.when((F.col("clips_i4") > 0) & (F.col("overlap_ratio") == 0), "zero_overlap"),
        F.when(F.col("downgrade_ratio") > 0.05, "high_emotion_downgrade"), F.when(some & (F.col("warned") > 0.10 * F.col("total")), "high_warning_rate")))
    return row.select(F.explode(flags).alias("warning"))


def counts_by(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows by each column, as in the summaries of a selection or a batch."""
    each = F.array(*[F.struct(F.lit(c).alias("dim"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("key")) for c in columns])
    return rows.select(F.explode(each).alias("x")).groupBy("x.dim", "x.key").agg(F.count("*").alias("n"))


def dominant_mode(turns: DataFrame) -> DataFrame:
    """Each scene's most frequent mix mode, of equal ones the one seen first; turns: scene, idx, mode."""
    per = turns.groupBy("scene", "mode").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    return per.groupBy("scene").agg(F.max_by("mode", F.struct("n", -F.col("first"))).alias("mode"))


def archive_totals(files: DataFrame, excluded: DataFrame) -> DataFrame:
    """Files, bytes and excluded stems that were there, of the files an archive takes. files: stem, size; excluded: stem."""
    rows = files.where(~F.col("stem").contains("_dirty")).join(excluded.select("stem", F.lit(True).alias("out")), "stem", "left")
    out = F.coalesce("out", F.lit(False))
    return rows.agg(F.count_if(~out).alias("files"), F.coalesce(F.sum(F.when(~out, F.col("size"))), F.lit(0)).alias("bytes"), F.countDistinct(F.when(out, F.col("stem"))).alias("excluded"))


def target_totals(targets: DataFrame) -> DataFrame:
    """Typology and count, of repeated typologies the last; targets: pos, typology, n."""
    return targets.groupBy("typology").agg(F.max_by("n", "pos").alias("n"))


def last_states(turns: DataFrame) -> DataFrame:
    """Each speaker's state of its last turn that has one, four digits. turns: scene, speaker, idx, rate, pitch, volume (null: none)."""
    last = turns.where("rate IS NOT NULL").groupBy("scene", "speaker").agg(F.max_by(F.struct("rate", "pitch", "volume"), "idx").alias("s"))
    return last.select("scene", "speaker", *[F.bround(f"s.{c}", 4).alias(c) for c in ("rate", "pitch", "volume")])
