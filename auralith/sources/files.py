"""Readers of clip folders: file listings, clip documents, strong labels, paired annotations, transcripts, configurations, audio.

Listings and documents are read by Spark's own sources, a row a file or line; nothing is listed or parsed on the driver but templates and taxonomies.
"""

from __future__ import annotations

import io
import json
import re
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auralith import dims
from auralith.operators import validate

CLIP = """clip_id STRING, project STRING, language STRING, violence_typology STRING, tier STRING, duration_seconds DOUBLE, sample_rate INT, channels INT, generation_date STRING,
generator_version STRING, is_synthetic BOOLEAN, acoustic_scene STRUCT<room_type: STRING, device: STRING, ir_source: STRING, speaker_distance_meters: DOUBLE, snr_db_actual: DOUBLE>,
speakers ARRAY<STRUCT<speaker_id: STRING, role: STRING, gender: STRING, age_range: STRING, tts_voice_id: STRING, voice_family: STRING>>,
weak_label STRUCT<has_violence: BOOLEAN, violence_categories: ARRAY<STRING>, max_intensity: INT, violence_typology: STRING>, quality_flags ARRAY<STRING>, annotator_confidence DOUBLE,
iaa_reviewed BOOLEAN, generation_metadata STRUCT<pipeline_version: STRING, tts_backend: MAP<STRING, STRING>,
effective_prosody_caps: ARRAY<STRUCT<turn_index: INT, intensity: INT, dim: STRING, pre_cap: DOUBLE, post_cap: DOUBLE>>>"""
EVENT = """event_id STRING, clip_id STRING, onset DOUBLE, offset DOUBLE, tier1_category STRING, tier2_subtype STRING, intensity INT, speaker_id STRING, speaker_role STRING,
emotional_state STRING, confidence DOUBLE, label_source STRING, iaa_reviewed BOOLEAN, truncated BOOLEAN, notes STRING"""
BAD = "_corrupt_record STRING"


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path, dir, stem, ext, size: every file below the folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("length").alias("size"))
    return files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"), F.regexp_extract("path", r"\.([^./]*)$", 1).alias("ext"), "size")


def clean(files: DataFrame) -> DataFrame:
    """files that are no retained originals."""
    return files.where(~F.col("stem").contains("_dirty"))


def wavs(files: DataFrame, dirty: bool = False) -> DataFrame:
    """S1 (and S2, with the retained originals): the WAV files, in path order when written."""
    found = files.where("ext = 'wav'")
    return found if dirty else clean(found)


def sidecars(files: DataFrame) -> DataFrame:
    """Dir, stem, has_wav, has_txt, has_json, has_jsonl: which files of a clip there are."""
    return files.groupBy("dir", "stem").agg(*[F.bool_or(F.col("ext") == e).alias(f"has_{e}") for e in ("wav", "txt", "json", "jsonl")])


def _texts(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, dir, stem, value: whole texts of the files that fit."""
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"), "value")


def parsed(rows: DataFrame, column: str, schema: str, wrong: str) -> DataFrame:
    """Adds doc, the JSON of the column, null where it doesn't parse or `wrong` (a function of the struct's name) finds errors; a field of the wrong type fails the whole record.

    The text is parsed once: the array around it is unfolded, which the optimizer doesn't move filters and fields through, where it would copy the parser into each of them."""
    once = F.explode_outer(F.array(F.from_json(column, f"{schema}, {BAD}", {"columnNameOfCorruptRecord": "_corrupt_record"})))
    out = rows.select(*[c for c in rows.columns if c != "doc"], once.alias("doc"))
    return out.withColumn("doc", F.when(F.col("doc").isNotNull() & F.col("doc._corrupt_record").isNull() & (F.size(wrong("doc")) == 0), F.col("doc").dropFields("_corrupt_record")))


def clip_documents(spark: SparkSession, folder: str) -> DataFrame:
    """S3: path, dir, stem and the fields of each clip document; others are left out."""
    return parsed(clean(_texts(spark, folder, "*.json")), "value", CLIP, validate.clip_errors).where("doc IS NOT NULL").select("path", "dir", "stem", "doc.*")


def _lines(texts: DataFrame) -> DataFrame:
    """The lines of each text with a character in them, and their positions."""
    rows = texts.select("path", "dir", "stem", F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line", "text"))
    return rows.where(F.trim("text") != "")


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Path, dir, stem, line and the fields of each strong label; malformed lines are left out."""
    return parsed(_lines(_texts(spark, folder, "*.jsonl")), "text", EVENT, validate.event_errors).where("doc IS NOT NULL").select("path", "dir", "stem", "line", _event_defaults())


def _event_defaults():
    """The struct's fields, missing ones with their defaults."""
    return F.struct(*[{"confidence": F.coalesce("doc.confidence", F.lit(1.0)), "label_source": F.coalesce("doc.label_source", F.lit("auto")), "iaa_reviewed": F.coalesce("doc.iaa_reviewed", F.lit(False)), "truncated": F.coalesce("doc.truncated", F.lit(False))}.get(n, F.col(f"doc.{n}")).alias(n) for n in [c.split()[0] for c in EVENT.replace("\n", " ").split(", ")]]).alias("event")


def strict_events(spark: SparkSession, folder: str) -> DataFrame:
    """As event_lines, but a bad line fails the query."""
    rows = parsed(_lines(_texts(spark, folder, "*.jsonl")), "text", EVENT, validate.event_errors)
    checked = F.when(F.col("doc").isNull(), F.raise_error(F.concat(F.lit("bad label line in "), "path")).cast("string")).otherwise(F.col("path"))
    return rows.select(checked.alias("path"), "dir", "stem", "line", _event_defaults())


def annotation_pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clips (clip), and the events of annotators A and B (clip, line, and the event's fields).

    A clip is a folder with exactly two label files, A's the first by name; a bad line in either drops the clip, an empty file is an annotation without events.
    """
    # Spark's scans leave empty files out, so the names come from the index that the driver makes of the folder anyway
    index = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").load(folder)
    paths = index.inputFiles()
    files = spark.createDataFrame([(p,) for p in paths if p], "path string").withColumn("clip", F.regexp_extract("path", "([^/]*)/[^/]*$", 1))
    ranked = files.withColumn("side", F.row_number().over(Window.partitionBy("clip").orderBy("path"))).withColumn("n", F.count("*").over(Window.partitionBy("clip")))
    sides = ranked.where("n = 2").select("path", "clip", "side")
    rows = parsed(_lines(_texts(spark, folder, "*.jsonl")), "text", EVENT, validate.event_errors).withColumn("clip", F.regexp_extract("dir", "([^/]*)$", 1))
    clips = sides.select("clip").distinct().join(rows.where("doc IS NULL").select("clip").distinct(), "clip", "left_anti")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    placed = rows.where("doc IS NOT NULL").withColumn("name", name).join(sides.select("clip", "side", name.alias("name")), ["clip", "name"]).join(clips, "clip", "left_semi")
    side = lambda k: placed.where(F.col("side") == k).select("clip", "line", F.col("doc.tier1_category").alias("tier1"), "doc.intensity")
    return clips, side(1), side(2)


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Path, stem, text: transcripts without blank lines and lines in brackets."""
    lines = F.filter(F.split("value", r"\r\n|\n|\r"), lambda x: (x != "") & ~x.startswith("["))
    return _texts(spark, folder, "*.txt").select("path", "dir", "stem", F.trim(F.array_join(lines, "\n")).alias("text"))


SCENE = """scene_id STRING, project STRING, language STRING, violence_typology STRING, tier STRING, random_seed INT, script_template STRING, intensity_arc ARRAY<INT>,
target_duration_minutes DOUBLE, speakers ARRAY<STRUCT<speaker_id: STRING, role: STRING>>, acoustic_scene MAP<STRING, STRING>"""
SPEAKER = """speaker_id STRING, role STRING, gender STRING, age_range STRING, context STRING, tts_voice_id STRING, tts_provider STRING, voice_family STRING,
prosody_baseline STRUCT<rate: DOUBLE, pitch_hz: DOUBLE, volume_db: DOUBLE>, style_map MAP<STRING, STRUCT<style: STRING, rate_multiplier: DOUBLE, pitch_delta_st: DOUBLE, volume_delta_db: DOUBLE, rms_target_dbfs: DOUBLE>>, split STRING"""
RUN = """run_id STRING, project STRING, tier STRING, random_seed INT, targets ARRAY<STRUCT<violence_typology: STRING, count: INT>>, splits STRUCT<train: DOUBLE, val: DOUBLE, test: DOUBLE>, max_retries INT, fail_fast BOOLEAN"""


def configs(spark: SparkSession, folder: str, schema: str, wrong, glob: str = "*.yaml") -> DataFrame:
    """Path and fields of each YAML file below the folder; files that don't parse or have errors (`wrong`: a function of the struct's name) are left out. Parsed on executors."""
    import yaml

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                try:
                    found.append(json.dumps(yaml.safe_load(text), default=str))
                except yaml.YAMLError:
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "value"])

    rows = _texts(spark, folder, glob).select("path", "value").mapInArrow(run, "path string, value string")
    return parsed(rows, "value", schema, wrong).where("doc IS NOT NULL").select("path", "doc.*")


def scenes(spark: SparkSession, folder: str, project: str | None = None, tier: str | None = None) -> DataFrame:
    """Scene configurations of a project and tier (of all by default)."""
    found = configs(spark, folder, SCENE, validate.scene_errors)
    for column, value in (("project", project), ("tier", tier)):
        found = found.where(F.col(column) == value) if value is not None else found
    return found


def first_wins(tables: list[DataFrame], key: str, order: str) -> DataFrame:
    """The union of the tables; of rows with one key that of the first table stays, inside a table the first by order."""
    ranked = [t.withColumn("__t", F.lit(i)) for i, t in enumerate(tables)]
    whole = ranked[0]
    for t in ranked[1:]:
        whole = whole.unionByName(t)
    columns = [c for c in whole.columns if c != "__t"]
    return whole.groupBy(F.col(key).alias("__k")).agg(F.min_by(F.struct(*columns), F.struct("__t", order)).alias("x")).select("x.*")


def speakers(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Speaker configurations; of repeated ids the first folder's stays."""
    return first_wins([configs(spark, f, SPEAKER, validate.speaker_errors, "speaker_*.yaml") for f in folders], "speaker_id", "path")


def from_dict(spark: SparkSession, value: dict, schema: str) -> DataFrame:
    """One row from a configuration in memory."""
    return spark.createDataFrame([(json.dumps(value),)], "value string").select(F.from_json("value", schema).alias("doc")).select("doc.*")


def taxonomy(spark: SparkSession) -> DataFrame:
    """tier2, tier1."""
    return dims.frame(spark, dims.PARENTS, "tier2 string, tier1 string")


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Channels x samples in -1 to 1, and the sample rate, of PCM data of 8 to 32 bits or 32-bit floats."""
    if data[:4] == b"RIFF" and (at := data.find(b"fmt ")) > 0 and int.from_bytes(data[at + 8 : at + 10], "little") == 3:
        channels, rate = int.from_bytes(data[at + 10 : at + 12], "little"), int.from_bytes(data[at + 12 : at + 16], "little")
        body = data.index(b"data") + 8
        n = (len(data) - body) // 4 * 4
        return np.frombuffer(data[body : body + n], "<f4").astype(float).reshape(-1, channels).T, rate
    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000
        x = x / 2.0**23
    else:
        x = np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)
    return x.reshape(-1, channels).T, rate


def audio(spark: SparkSession, folder: str, first_channel: bool = False) -> DataFrame:
    """Path, dir, stem, sample_rate, channels, samples (the mean of the channels, or the first), error (null where the file could be read); a row a WAV file, in slices of one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rate = channels = samples = error = None
                try:
                    x, rate = decode(batch.column(1)[i].as_py())
                    channels, samples = len(x), (x[0] if first_channel else x.mean(0))
                except (wave.Error, ValueError, EOFError, IndexError) as e:
                    error = f"Cannot load audio: {e}"
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([rate], pa.int32()), pa.array([channels], pa.int32()), pa.array([samples], pa.list_(pa.float64())), pa.array([error], pa.string())],
                    names=["path", "sample_rate", "channels", "samples", "error"],
                )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(folder).select("path", "content")
    rows = files.mapInArrow(run, "path string, sample_rate int, channels int, samples array<double>, error string")
    return rows.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"), "sample_rate", "channels", "samples", "error")


def resolved_assets(events: DataFrame, assets: DataFrame) -> DataFrame:
    """Events with asset: their own path, else the first asset of their type, else null (to be synthesised). events: type, asset_path; assets: type, path."""
    first = assets.groupBy("type").agg(F.min("path").alias("found"))
    return events.join(F.broadcast(first), "type", "left").withColumn("asset", F.coalesce("asset_path", "found")).drop("found")  # a row an asset type


def pending(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The planned rows that aren't done yet."""
    return plan.join(done.select(*keys).distinct(), keys, "left_anti")


def cached(rows: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Rows with value from the cache and hit; of repeated keys the smallest value. cache: key, value."""
    held = cache.groupBy(key).agg(F.min("value").alias("value"))
    return rows.join(held, key, "left").withColumn("hit", F.col("value").isNotNull())


def rendered(template: str, slots: dict[str, str]) -> str:
    """The template with each {{ name }} replaced; a name without a slot is an error."""

    def value(m: re.Match) -> str:
        if m[1] not in slots:
            raise KeyError(f"no slot for {m[1]}")
        return str(slots[m[1]])

    return re.sub(r"\{\{\s*(\w+)\s*\}\}", value, template)


def corpus_clips(spark: SparkSession, folder: str) -> DataFrame:
    """Stem, samples, sha256, reference, ref_words of each WAV with its transcript; a missing transcript or another rate than 16 kHz is an error."""
    hashes = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(folder).select("path", F.sha2("content", 256).alias("sha256"))
    rows = audio(spark, folder).join(hashes, "path").join(transcripts(spark, folder).select("dir", "stem", F.col("text").alias("reference")), ["dir", "stem"], "left")
    bad = F.when(F.col("reference").isNull(), F.concat(F.lit("no transcript for "), "path")).when(F.col("sample_rate") != 16_000, F.concat(F.lit("not 16 kHz: "), "path"))
    checked = F.when(bad.isNotNull(), F.raise_error(bad).cast("string")).otherwise(F.col("stem"))
    words = F.size(F.filter(F.split("reference", r"\s+"), lambda w: w != "")).cast("long")
    return rows.select(checked.alias("stem"), "samples", "sha256", "reference", words.alias("ref_words"))


def degradation(label: str = "label"):
    """Kind and amount of variant names such as wn_snr_-10db, wn_snr_p10db, lp_3400hz, slow_0p85."""
    c = F.col(label)
    number = F.regexp_replace(F.regexp_replace(F.regexp_extract(c, r"_(-?p?[\d.p]+?)(?:db|hz)?$", 1), "^p", ""), "p", ".")
    kind = F.when(c.startswith("wn_snr_"), "white_noise").when(c.startswith("lp_"), "lowpass").when(c.startswith("slow_"), "slow_rate").when(c == "clean", "clean")
    return F.struct(kind.alias("kind"), F.when(c != "clean", F.try_to_number(number, F.lit("S9999.99"))).cast("double").alias("amount"))


def voices(catalogue: DataFrame, part: str = "Chirp") -> DataFrame:
    """Voice names and whether their name holds `part`."""
    return catalogue.select("name", F.col("name").contains(part).alias("has_part"))


#: The profile that is there without a file.
GENERIC = {"name": "generic", "snr_target_db": 20.0, "agg_pause_prob": 0.30}


def profile(name: str, folder: str) -> dict:
    """A project's profile, from its YAML file in the folder, or the built-in one; any other name is an error."""
    from pathlib import Path

    import yaml

    path = Path(folder) / f"{name}.yaml"
    if path.exists():
        return GENERIC | {"name": name} | (yaml.safe_load(path.read_text("utf-8")) or {})
    if name != "generic":
        raise FileNotFoundError(f"no profile {name}")
    return dict(GENERIC)
