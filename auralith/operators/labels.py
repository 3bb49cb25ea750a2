"""Label derivation, manifest and planning operators."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auralith.dims import EMOTION_ALIASES, EMOTIONS, EVENT_BANDS, frame
from auralith.operators.quantiles import sums_before


def event_type(clips: DataFrame) -> DataFrame:
    """The first band that reaches the intensity; NONE_AMBIENT above all bands or for unknown typologies."""
    bands = frame(clips.sparkSession, EVENT_BANDS, "band_of string, top int, tier1 string, tier2 string")
    fits = clips.join(bands, (F.col("typology") == F.col("band_of")) & (F.col("max_intensity") <= F.col("top")), "left")
    best = fits.groupBy("clip").agg(F.min_by(F.struct("tier1", "tier2"), "top").alias("e"))
    return best.select("clip", F.coalesce("e.tier1", F.lit("NONE")).alias("tier1"), F.coalesce("e.tier2", F.lit("NONE_AMBIENT")).alias("tier2"))


def normal_emotion(words: DataFrame, column: str) -> DataFrame:
    """P10: canonical emotion and whether an alias was used; unknown words come back as null for quarantine."""
    key = F.lower(F.trim(column))
    known = F.create_map(*[F.lit(x) for pair in EMOTION_ALIASES for x in pair])
    return words.withColumn("canonical", F.when(key.isin(EMOTIONS), key).otherwise(F.try_element_at(known, key))).withColumn("alias_used", ~key.isin(EMOTIONS) & F.col("canonical").isNotNull())


def size_bin(n: Column) -> Column:
    """P15."""
    edges = [(1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"), (100_000_000, "10M<n<100M"), (1_000_000_000, "100M<n<1B")]
    out = F.when(n < edges[0][0], edges[0][1])
    for top, name in edges[1:]:
        out = out.when(n < top, name)
    return out.otherwise("n>1B")


def nearest_style(rows: DataFrame, styles: DataFrame) -> DataFrame:
    """The style with the nearest key, the lower one if two are as near. rows: id, i; styles: k, style (a few rows)."""
    return rows.crossJoin(F.broadcast(styles)).groupBy("id", "i").agg(F.min_by("style", F.struct(F.abs(F.col("k") - F.col("i")), "k")).alias("style"))


def ssml_percent(rate: Column, semitones: Column, db: Column) -> tuple[Column, Column, Column]:
    """Signed whole percents of rate, pitch and volume, rounded half to even and within the format's bounds."""
    percent = lambda c, low, high: F.format_string("%+d%%", F.greatest(F.lit(low), F.least(F.lit(high), F.bround(c, 0))).cast("int"))
    return percent((rate - 1) * 100, -50, 200), percent(semitones * 5.946, -50, 50), percent(db, -50, 50)


def prosody_cap(rate: Column, pitch: Column) -> tuple[Column, Column, Column]:
    """Clamped rate and pitch, and how many were clamped."""
    r, p = F.greatest(F.lit(0.95), F.least(F.lit(1.20), rate)), F.greatest(F.lit(-3.0), F.least(F.lit(2.0), pitch))
    return r, p, (r != rate).cast("int") + (p != pitch).cast("int")


def weak_labels(events: DataFrame) -> DataFrame:
    """Sorted categories but NONE, largest intensity, any violence."""
    violent = F.col("tier1") != "NONE"
    out = events.groupBy("clip").agg(F.array_sort(F.collect_set(F.when(violent, F.col("tier1")))).alias("c"), F.coalesce(F.max("intensity"), F.lit(1)).alias("max_intensity"), F.bool_or(violent).alias("has_violence"))
    return out.select("clip", "has_violence", F.array_join("c", ",").alias("categories"), "max_intensity")


def event_ids(events: DataFrame) -> DataFrame:
    """W4, P8."""
    at = F.row_number().over(Window.partitionBy("clip").orderBy("onset_us", "event_id")) - 1
    return events.select("event_id", F.format_string("%s_EVT_%03d", F.col("clip").cast("string"), at).alias("label_id"))


def stratified_cap(clips: DataFrame, most: int = 50, seed: int = 42) -> DataFrame:
    """L3: up to most clips of each typology, in hash order. Each partition keeps its own first ones before the shuffle."""
    order = Window.partitionBy("typology").orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("clip").cast("string"))))
    return clips.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).select("typology", "clip")


def max_clips(clips: DataFrame, most: int = 100, seed: int = 42) -> DataFrame:
    """L4."""
    return clips.select("clip").orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("clip").cast("string")))).limit(most)


def round_robin(scenes: DataFrame, slots: int = 7) -> DataFrame:
    """The slot of a pool that each scene of a key takes in turn."""
    return scenes.select("typology", "clip", ((F.row_number().over(Window.partitionBy("typology", "custkey").orderBy("clip")) - 1) % slots).alias("slot"))


def addressee(turns: DataFrame) -> DataFrame:
    """For each speaker of a scene the other role it addresses: VIC before AGG before BYS, never its own."""
    roles = turns.select("scene", "role").distinct()
    rank = F.when(F.col("other") == "VIC", 0).when(F.col("other") == "AGG", 1).otherwise(2)
    pairs = roles.join(roles.withColumnRenamed("role", "other"), "scene").where("role <> other")  # three roles a scene at most
    return pairs.groupBy("scene", "role").agg(F.min_by("other", rank).alias("addressee"))


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks; null for fewer than two rows or constant values. Ranks come from value counts, not from a window over all rows."""
    ranks = lambda c: _average_ranks(rows.groupBy(F.col(c).alias("v")).agg(F.count("*").alias("n")), c)
    both = rows.join(ranks(x), x).join(ranks(y), y)
    sd = F.stddev_pop("rank_" + x) * F.stddev_pop("rank_" + y)
    return both.agg(F.round(F.try_divide(F.covar_pop("rank_" + x, "rank_" + y), F.nullif(sd, F.lit(0.0))), 6).alias("rho"), F.count("*").alias("n"))


def _average_ranks(counts: DataFrame, column: str) -> DataFrame:
    return sums_before(counts, "v", "n").select(F.col("v").alias(column), (F.col("before") + (F.col("n") + 1) / 2).alias("rank_" + column))


def size_name(n: int) -> str:
    """P15 of one number."""
    edges = [(1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"), (100_000_000, "10M<n<100M"), (1_000_000_000, "100M<n<1B")]
    return next((name for top, name in edges if n < top), "n>1B")


def sound_labels(sounds: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Labels of placed sounds that the taxonomy knows as acoustic events; already in clip time, 0.1 s long at least. sounds: clip, type, onset, offset; taxonomy: tier2."""
    known = sounds.where(F.col("type").startswith("ACOU_")).join(F.broadcast(taxonomy), F.col("type") == F.col("tier2"), "left_semi")  # a fixed table
    return known.select("clip", F.lit("ACOU").alias("tier1"), F.col("type").alias("tier2"), F.col("onset"), F.greatest("offset", F.col("onset") + 0.1).alias("offset"), F.lit(3).alias("intensity"), F.lit("sfx_augmentation").alias("notes"))


def with_roles(turns: DataFrame, speakers: DataFrame, strict: bool = False) -> DataFrame:
    """Each turn's speaker role; unknown speakers are UNK, or an error. speakers: speaker, role."""
    out = turns.join(speakers.select("speaker", F.col("role").alias("__r")), "speaker", "left")
    missing = F.raise_error(F.concat(F.lit("unknown speaker "), "speaker")).cast("string") if strict else F.lit("UNK")
    return out.withColumn("role", F.coalesce("__r", missing)).drop("__r")


def effective_prosody(style: dict[str, Column], base: dict[str, Column], state: dict[str, Column], jitter: dict[str, Column] | None = None) -> dict[str, Column]:
    """Rate by multiplication, pitch and volume by addition, pitch within twelve semitones, then jitter (rate factor, pitch and volume offsets)."""
    rate = style["rate"] * base["rate"] * state["rate"]
    pitch = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), style["pitch"] + state["pitch"]))
    volume = style["volume"] + base["volume"] + state["volume"]
    if jitter:
        rate, pitch, volume = rate * jitter["rate"], pitch + jitter["pitch"], volume + jitter["volume"]
    return {"rate": rate, "pitch": pitch, "volume": volume}


def snr_target(own: Column, profile: Column, default: float = 20.0) -> Column:
    """The profile's where the scene's is the default."""
    return F.when(own == default, profile).otherwise(own)


def rms_target(style: Column, role_default: Column) -> Column:
    """P22."""
    return F.coalesce(style, role_default)


def scene_projection(events: Column) -> Column:
    """P20: placed sounds with rounded times and levels."""
    return F.transform(events, lambda e: F.struct(e["type"].alias("type"), F.bround(e["onset"], 3).alias("onset"), F.bround(e["offset"], 3).alias("offset"), F.bround(e["level_db"], 1).alias("level_db")))


def preprocessing_record(peak: Column, denoised: Column) -> Column:
    """What was done to a clip."""
    true = F.lit(True)
    return F.struct(true.alias("resampled_to_16k"), true.alias("downmixed_to_mono"), true.alias("spectral_filtered"), denoised.alias("denoised"), peak.alias("normalized_dbfs"), true.alias("silence_padded"))


def int_keys(styles: Column) -> Column:
    """A map with its keys as whole numbers."""
    return F.transform_keys(styles, lambda k, v: k.cast("int"))
