"""Validators: arrays of error texts as column expressions, empty where all is well."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith import dims
from auralith.functions import signal

Named = Callable[[str], Column]


def fields(doc: str | None) -> Named:
    """Column of a field: of the struct `doc`, or of the row."""
    return lambda name: F.col(f"{doc}.{name}" if doc else name)


def messages(*checks: tuple[Column, str | Column]) -> Column:
    """The texts of the checks that find something wrong; a check on a null finds nothing."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(text) if isinstance(text, str) else text) for bad, text in checks]))


def missing(field: Named, *names: str) -> list[tuple[Column, str]]:
    return [(field(n).isNull(), f"{n} is missing") for n in names]


def outside(column: Column, valid: list) -> Column:
    return column.isNotNull() & ~column.isin(valid)


def unknown(column: Column, valid: list[str]) -> Column:
    """Whether an array holds anything but the valid values."""
    return F.size(F.array_except(column, F.array(*[F.lit(v) for v in valid]))) > 0


def _above(column: Column) -> Column:
    """Whether a character is above U+00A1."""
    return column.rlike(r"[^\x{0000}-\x{00A1}]")


def event_errors(doc: str | None = None) -> Column:
    """What is wrong with a strong label."""
    f = fields(doc)
    parent = F.create_map(*[F.lit(x) for pair in dims.PARENTS for x in pair])
    return messages(
        *missing(f, "event_id", "clip_id", "onset", "offset", "tier1_category", "tier2_subtype", "intensity"),
        (f("onset") < 0, "onset is negative"),
        (f("offset") <= f("onset"), "offset is not after onset"),
        (outside(f("tier1_category"), dims.TIER1), "unknown tier1_category"),
        (outside(f("tier2_subtype"), [c for c, _ in dims.PARENTS]), "unknown tier2_subtype"),
        (F.try_element_at(parent, f("tier2_subtype")) != f("tier1_category"), "tier2_subtype belongs to another tier1_category"),
        (~f("intensity").between(1, 5), "intensity is not 1 to 5"),
        (outside(f("speaker_role"), dims.ROLES), "unknown speaker_role"),
        (outside(f("emotional_state"), dims.EMOTIONS), "unknown emotional_state"),
        (~f("confidence").between(0, 1), "confidence is not 0 to 1"),
        (outside(f("label_source"), dims.LABEL_SOURCES), "unknown label_source"),
    )


def weak_label_errors(doc: str) -> Column:
    """What is wrong with a weak label."""
    f = fields(doc)
    return messages(
        *missing(f, "has_violence", "max_intensity", "violence_typology"),
        (unknown(f("violence_categories"), dims.TIER1), "unknown violence_categories"),
        (~f("max_intensity").between(1, 5), "max_intensity is not 1 to 5"),
        (outside(f("violence_typology"), dims.TYPOLOGIES), "unknown violence_typology of the weak label"),
    )


def clip_errors(doc: str | None = None) -> Column:
    """What is wrong with a clip document."""
    f = fields(doc)
    prefix = f"{doc}." if doc else ""
    own = messages(
        *missing(f, "clip_id", "project", "language", "violence_typology", "tier", "duration_seconds", "generation_date", "generator_version", "weak_label"),
        (outside(f("tier"), dims.TIERS), "unknown tier"),
        (outside(f("violence_typology"), dims.TYPOLOGIES), "unknown violence_typology"),
        (f("duration_seconds") <= 0, "duration_seconds is not positive"),
        (~f("is_synthetic"), "is_synthetic is not true"),
        (unknown(f("quality_flags"), dims.QUALITY_FLAGS), "unknown quality_flags"),
        (~f("annotator_confidence").between(0, 1), "annotator_confidence is not 0 to 1"),
        (F.exists(f("speakers"), lambda s: s["role"].isNull() | ~s["role"].isin(dims.ROLES)), "unknown role of a speaker"),
        (F.exists(f("speakers"), lambda s: s["gender"].isNull() | ~s["gender"].isin("male", "female")), "unknown gender of a speaker"),
        (F.exists(f("speakers"), lambda s: s["speaker_id"].isNull() | s["age_range"].isNull() | s["tts_voice_id"].isNull()), "a speaker lacks a field"),
        *[(_above(f(n)), f"{n} holds a character above U+00A1") for n in ("clip_id", "project", "violence_typology", "generator_version")],
    )
    return F.concat(own, F.when(f("weak_label").isNotNull(), weak_label_errors(f"{prefix}weak_label")).otherwise(F.array().cast("array<string>")))


# Rooms and devices of acoustic scenes.
ROOMS = ["small_bedroom", "apartment_kitchen", "living_room", "clinic_office", "welfare_office", "open_office_corridor"]
DEVICES = ["phone_in_hand", "phone_in_pocket", "phone_on_table", "pi_budget_mic"]
SPEAKER_ID = r"^[A-Z]{2,4}_[MF]_\d{1,3}-\d{1,3}_\d{3}$"


def scene_errors(doc: str | None = None) -> Column:
    """What is wrong with a scene configuration."""
    f = fields(doc)
    return messages(
        *missing(f, "scene_id", "project", "violence_typology", "tier", "script_template", "target_duration_minutes"),
        (outside(f("project"), dims.PROJECTS), "unknown project"),
        (outside(f("violence_typology"), dims.TYPOLOGIES), "unknown violence_typology"),
        (outside(f("tier"), dims.TIERS), "unknown tier"),
        (F.coalesce(F.size("speakers" if not doc else f"{doc}.speakers"), F.lit(0)) < 1, "no speakers"),
        (F.exists(f("speakers"), lambda s: s["role"].isNull() | ~s["role"].isin(dims.ROLES)), "unknown role of a speaker"),
        (F.coalesce(F.size(f("intensity_arc")), F.lit(0)) < 1, "no intensity_arc"),
        (F.exists(f("intensity_arc"), lambda i: ~i.between(1, 5)), "intensity_arc is not 1 to 5"),
        (f("target_duration_minutes") <= 0, "target_duration_minutes is not positive"),
        (f("tier").isin("B", "C") & f("acoustic_scene").isNull(), "tiers B and C need an acoustic_scene"),
    )


def speaker_errors(doc: str | None = None) -> Column:
    """What is wrong with a speaker configuration."""
    f = fields(doc)
    keys = F.map_keys(f("style_map"))
    entries = F.map_values(f("style_map"))
    return messages(
        *missing(f, "speaker_id", "role", "gender", "age_range", "context", "tts_voice_id"),
        (~f("speaker_id").rlike(SPEAKER_ID), "speaker_id is not of the form ROLE_G_AGE-AGE_NNN"),
        (outside(f("role"), dims.ROLES), "unknown role"),
        (outside(f("gender"), ["male", "female"]), "unknown gender"),
        (outside(f("context"), [*dims.PROJECTS, "both"]), "unknown context"),
        (outside(f("tts_provider"), ["azure", "google"]), "unknown tts_provider"),
        (outside(f("split"), ["train", "val", "test_synth"]), "unknown split"),
        (F.exists(keys, lambda k: F.coalesce(~k.try_cast("int").between(1, 5), F.lit(True))), "a style_map key is not 1 to 5"),
        (F.exists(entries, lambda e: (e["rate_multiplier"] <= 0) | (e["rate_multiplier"] > 3)), "rate_multiplier is not above 0 and up to 3"),
        (F.exists(entries, lambda e: ~e["pitch_delta_st"].between(-12, 12)), "pitch_delta_st is not -12 to 12"),
        (F.exists(entries, lambda e: ~e["volume_delta_db"].between(-20, 20)), "volume_delta_db is not -20 to 20"),
        (F.exists(entries, lambda e: ~e["rms_target_dbfs"].between(-60, 0)), "rms_target_dbfs is not -60 to 0"),
        ((f("prosody_baseline.rate") <= 0) | (f("prosody_baseline.rate") > 3), "rate of the baseline is not above 0 and up to 3"),
        (f("prosody_baseline.pitch_hz") <= 0, "pitch_hz of the baseline is not positive"),
        (~f("prosody_baseline.volume_db").between(-20, 20), "volume_db of the baseline is not -20 to 20"),
    )


def speaker_warnings(doc: str | None = None) -> Column:
    """Styles that the speaker's provider can't render."""
    f = fields(doc)
    styled = F.exists(F.map_values(f("style_map")), lambda e: ~F.lower(e["style"]).isin("general", ""))
    return messages((f("tts_provider").eqNullSafe("google") & styled, "styles have no effect with this provider"))


def run_errors(doc: str | None = None) -> Column:
    """What is wrong with a run configuration."""
    f = fields(doc)
    parts = [F.coalesce(f(f"splits.{n}"), F.lit(d)) for n, d in (("train", 0.70), ("val", 0.15), ("test", 0.15))]
    return messages(
        *missing(f, "run_id", "project"),
        (outside(f("project"), dims.PROJECTS), "unknown project"),
        (outside(f("tier"), dims.TIERS), "unknown tier"),
        (F.coalesce(F.size(f("targets")), F.lit(0)) < 1, "no targets"),
        (F.exists(f("targets"), lambda t: ~t["violence_typology"].isin(dims.TYPOLOGIES)), "unknown violence_typology of a target"),
        (F.exists(f("targets"), lambda t: t["count"] <= 0), "a target's count is not positive"),
        (F.exists(F.array(*parts), lambda p: (p <= 0) | (p >= 1)), "a split fraction is not between 0 and 1"),
        (F.abs(parts[0] + parts[1] + parts[2] - 1) > 1e-6, "split fractions don't sum to 1"),
        (f("max_retries") < 1, "max_retries is below 1"),
    )


def acoustic_errors(doc: str | None = None) -> Column:
    """What is wrong with an acoustic scene: room_type, device, distances, rt60_range, background_events."""
    f = fields(doc)
    return messages(
        *missing(f, "room_type", "device", "speaker_distance_meters", "victim_distance_meters"),
        (outside(f("room_type"), ROOMS), "unknown room_type"),
        (outside(f("device"), DEVICES), "unknown device"),
        (f("speaker_distance_meters") <= 0, "speaker_distance_meters is not positive"),
        (f("victim_distance_meters") <= 0, "victim_distance_meters is not positive"),
        (F.get(f("rt60_range"), F.lit(0)) > F.get(f("rt60_range"), F.lit(1)), "rt60_range is not ordered"),
        (F.exists(f("background_events"), lambda e: e["onset_seconds"].isNull() & e["onset_at_phase"].isNull()), "a background event has no onset"),
    )


def valid_peak(target: Column) -> Column:
    """Whether a peak target is within its bounds."""
    return target.between(-12.0, -1.5)


def valid_version(version: Column) -> Column:
    """V7."""
    return version.rlike(r"^v\d+\.\d+(\.\d+)?$")


def drifted(pitch_offset: Column, most: float = 1.5) -> Column:
    """Whether a speaker's pitch has drifted by more than `most` semitones."""
    return F.abs(pitch_offset) > most


def unknown_codes(used: DataFrame, known: DataFrame, code: str) -> DataFrame:
    """V6: the codes of constant tables that the taxonomy doesn't have; must be empty."""
    return used.select(code).distinct().join(F.broadcast(known.select(code).distinct()), code, "left_anti")  # a fixed table


def audio_errors(samples: Column, rate: Column, channels: Column) -> Column:
    """V2: what is wrong with decoded audio (the first channel's samples)."""
    pad = F.floor(rate * 0.5).cast("int")
    n = F.size(samples)
    finite = ~F.exists(samples, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    loud = lambda x, limit: signal.peak_dbfs(x) > limit
    padded = n > 2 * pad
    return messages(
        (rate != 16_000, "sample_rate is not 16000"),
        (channels != 1, "channels is not 1"),
        (~finite, "audio holds NaN or infinite samples"),
        (n / rate < 3.0, "duration is below 3 s"),
        (finite & loud(samples, -0.5), "peak exceeds -1 dBFS"),
        (padded & loud(F.slice(samples, 1, pad), -40.0), "head is not silent"),
        (padded & loud(F.slice(samples, F.greatest(n - pad + 1, F.lit(1)), pad), -40.0), "tail is not silent"),
    )


def clip_results(files: DataFrame, docs: DataFrame, audio: DataFrame) -> DataFrame:
    """V1: dir, stem, is_valid, errors, warnings: a row a WAV file.

    files: dir, stem, has_wav, has_txt, has_json, has_jsonl (S18); docs: dir, stem, clip_id of the valid documents (S3); audio: dir, stem, sample_rate, channels, samples, error (S12).
    A bad name or a missing file ends the checks of a clip; another id in the document and missing strong labels are warnings.
    """
    rows = files.where("has_wav").join(docs.select("dir", "stem", "clip_id"), ["dir", "stem"], "left").join(audio, ["dir", "stem"], "left")
    first = messages((~F.col("stem").rlike(r"^[a-z0-9_\-]+$"), "disallowed characters in the name"), (~F.col("has_txt"), "missing transcript"), (~F.col("has_json"), "missing metadata"))
    heard = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(audio_errors(F.col("samples"), F.col("sample_rate"), F.col("channels")))
    later = F.concat(heard, messages((F.col("clip_id").isNull(), "invalid metadata")))
    errors = F.when(F.size(first) > 0, first).otherwise(later)
    warnings = F.when(F.size(first) > 0, F.array().cast("array<string>")).otherwise(messages((F.col("clip_id") != F.col("stem"), "clip_id is not the name"), (~F.col("has_jsonl"), "missing strong labels")))
    out = rows.select("dir", "stem", errors.alias("errors"), warnings.alias("warnings"))
    return out.select("dir", "stem", (F.size("errors") == 0).alias("is_valid"), "errors", "warnings")


def script_errors(turn: Named, speakers: Column) -> Column:
    """What is wrong with a turn (text, speaker_id, intensity, pause); an empty text ends its checks. speakers: array of the known ids."""
    text = turn("text")
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    count = lambda a, w: F.when(a["w"] == w, a["n"] + 1).otherwise(1)
    run = F.aggregate(words, F.struct(F.lit("").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("most")), lambda a, w: F.struct(w.alias("w"), count(a, w).alias("n"), F.greatest(a["most"], count(a, w)).alias("most")), lambda a: a["most"])
    pause = turn("pause")
    checks = messages(
        (~F.array_contains(speakers, turn("speaker_id")), "unknown speaker"),
        (~turn("intensity").between(1, 5), "intensity"),
        (F.isnan(pause) | ~pause.between(0.0, 1.5), "pause"),
        (run >= 4, "repeated"),
        (~text.rlike(r"[\x{0591}-\x{05F4}\x{FB1D}-\x{FB4F}]"), "no_hebrew"),
    )
    return F.when(F.coalesce(F.regexp_replace(text, r"(?U)\s+", ""), F.lit("")) == "", F.array(F.lit("empty"))).otherwise(checks)
