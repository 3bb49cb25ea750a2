"""The manifest: a flat row a clip."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = "clip_id project violence_typology tier duration_seconds speaker_ids voice_families has_violence max_intensity quality_flags split wav_path strong_labels_path".split()


def relative(path: Column, root: str | None) -> Column:
    """P5: the path below the root, or itself where it isn't below or there is no root; schemes don't count."""
    plain = F.regexp_replace(path, "^[a-z0-9+.-]+:/*(?=/)", "")
    if root is None:
        return plain
    base = root.rstrip("/") + "/"
    return F.when(plain.startswith(base), F.substring(plain, len(base) + 1, 1_000_000)).otherwise(plain)


def data_root(out: str, override: str | None = None) -> str:
    """Two folders above the output folder, unless told otherwise."""
    return override if override else out.rstrip("/").rsplit("/", 2)[0] or "/"


def clip_id(scene: Column) -> Column:
    """A scene's clip id."""
    return F.concat(F.lower(F.translate(scene, "-", "_")), F.lit("_00"))


def manifest(docs: DataFrame, splits: DataFrame | None = None, clip_ids: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """The 13 columns of each clip whose WAV file is there.

    docs: the fields of clip documents, path (of the document), has_wav, has_jsonl; splits: clip_id, split; clip_ids: an allow-list.
    Lists keep their order; an empty or missing voice family falls back to the voice; missing splits and labels are empty texts.
    """
    rows = docs.where("has_wav")
    if clip_ids is not None:
        rows = rows.join(clip_ids.select("clip_id").distinct(), "clip_id", "left_semi")
    split = F.lit("")
    if splits is not None:
        rows, split = rows.drop("split").join(splits.select("clip_id", "split"), "clip_id", "left"), F.coalesce("split", F.lit(""))
    voice = F.transform("speakers", lambda s: F.coalesce(F.nullif(s["voice_family"], F.lit("")), s["tts_voice_id"]))
    stem = F.regexp_replace("path", r"\.json$", "")
    return rows.select(
        "clip_id", "project", "violence_typology", "tier", "duration_seconds",
        F.array_join(F.transform("speakers", lambda s: s["speaker_id"]), "|").alias("speaker_ids"), F.array_join(voice, "|").alias("voice_families"),
        F.col("weak_label.has_violence").alias("has_violence"), F.col("weak_label.max_intensity").alias("max_intensity"), F.coalesce(F.array_join("quality_flags", ","), F.lit("")).alias("quality_flags"), split.alias("split"),
        relative(F.concat(stem, F.lit(".wav")), root).alias("wav_path"), F.when(F.col("has_jsonl"), relative(F.concat(stem, F.lit(".jsonl")), root)).otherwise("").alias("strong_labels_path"))
