"""End-to-end commands on clip folders: quality report, recogniser check, prosody measures, manifest, agreement, release, generation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auralith import dims
from auralith.functions import dsp, providers, ssml
from auralith.functions import text as T
from auralith.functions.arrow import map_rows
from auralith.operators import evaluation, iaa, labels, manifest, qa, timeline, validate
from auralith.session import checkpointed
from auralith.sinks import files as sinks
from auralith.skew import BROADCAST_ROWS, heavy_keys, join_skewed
from auralith.sources import files


def measured_turns(events: DataFrame, audio: DataFrame) -> DataFrame:
    """Clip, clip_id, speaker_role, intensity, f0_median_hz, f0_std_hz, rms_db, lufs_db: a row a role-bearing event. events: dir, stem, event; audio: dir, stem, samples, sample_rate."""
    heard = events.where("event.speaker_role IS NOT NULL").groupBy("dir", "stem").agg(F.collect_list("event").alias("events"))  # the events of one clip meet its samples once
    out = map_rows(heard.join(audio.where("error IS NULL").select("dir", "stem", "samples", "sample_rate"), ["dir", "stem"]), ["events", "samples", "sample_rate"],
                   "turns array<struct<clip_id:string,speaker_role:string,intensity:int,f0_median_hz:double,f0_std_hz:double,rms_db:double,lufs_db:double>>", _measure)
    return out.select("dir", F.col("stem").alias("clip"), F.explode("turns").alias("t")).select("dir", "clip", "t.*")


def _measure(events: list[dict], samples: list[float], rate: int) -> tuple[list[dict]]:
    names = ("f0_median_hz", "f0_std_hz", "rms_db", "lufs_db")
    return ([{k: e[k] for k in ("clip_id", "speaker_role", "intensity")} | dict(zip(names, dsp.measured(samples, rate, e["onset"], e["offset"]), strict=True)) for e in events],)


def _metrics(turns: DataFrame) -> DataFrame:
    return turns.select("clip", F.col("speaker_role").alias("role"), "intensity", F.col("f0_median_hz").alias("f0"), F.col("f0_std_hz").alias("f0_std"), F.col("rms_db").alias("rms"), F.col("lufs_db").alias("lufs"))


def run_qa(spark: SparkSession, folder: str, splits: DataFrame | None = None, most: float = 0.02, summary: bool = False) -> dict[str, DataFrame | dict]:
    """Tables of the quality report of a folder. splits: clip_id, split.

    totals (one row: passed, failure_rate and the counts), histograms, failed, quality_flagged, prosody_cap_activations, acoustic_warnings, structural_warnings (clip, value), and
    with summary run_summary: stats, voices, backends, ratios, outliers, warnings. A folder without clips passes.
    """
    listed = checkpointed(files.clean(files.listing(spark, folder)))
    docs, audio = files.clip_documents(spark, folder), files.audio(spark, folder).where(~F.col("stem").contains("_dirty"))
    results = checkpointed(validate.clip_results(files.sidecars(listed), docs, audio))
    valid = results.where("is_valid")
    clips = docs.join(valid.select("dir", "stem", F.array_contains("warnings", "missing strong labels").alias("unlabelled")), ["dir", "stem"])
    split = F.lit("unassigned")
    if splits is not None:
        clips, split = clips.join(splits.select("clip_id", F.col("split").alias("__split")), "clip_id", "left"), F.coalesce("__split", F.lit("unassigned"))
    caps = F.coalesce(F.size("generation_metadata.effective_prosody_caps"), F.lit(0))
    clips = checkpointed(clips.select("dir", "stem", F.col("clip_id").alias("clip"), F.col("violence_typology").alias("typology"), "tier", split.alias("split"), F.col("weak_label.max_intensity").alias("max_intensity"), F.col("duration_seconds").alias("duration"),
                                      F.coalesce("quality_flags", F.array()).alias("quality_flags"), F.greatest(caps, F.lit(0)).alias("n_caps"), "unlabelled", "speakers", F.col("generation_metadata.tts_backend").alias("tts_backend")))
    events = files.event_lines(spark, folder).join(valid.select("dir", "stem"), ["dir", "stem"], "left_semi")
    turns = checkpointed(measured_turns(events, audio))
    named = clips.select("dir", "stem", "clip")
    parts = events.join(named, ["dir", "stem"]).select("clip", F.col("event.speaker_role").alias("role"), "event.intensity", F.col("event.onset").alias("onset_us"), F.col("event.offset").alias("offset_us"), F.col("event.emotional_state").alias("emotion"))
    parts = checkpointed(parts)
    listed_of = lambda df: df.groupBy("clip").agg(F.array_sort(F.collect_set("flag")).alias("value"))
    own = turns.withColumnRenamed("clip", "stem").join(named, ["dir", "stem"]).drop("dir", "stem")
    acoustic, structural = qa.acoustic_warnings(_metrics(own)), qa.structural_warnings(parts)
    one = qa.failure_rate(results, most).crossJoin(clips.agg(F.count("*").alias("total_clips"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration_seconds"), F.count_if(F.size("quality_flags") > 0).alias("quality_flagged_clips"),
                                                             F.count_if("unlabelled").alias("clips_missing_strong_labels"), F.count_if(F.col("n_caps") > 0).alias("clips_with_prosody_cap_activations"), F.coalesce(F.sum("n_caps"), F.lit(0)).alias("prosody_cap_activations_total")))
    one = one.crossJoin(results.agg(F.count_if(~F.col("is_valid")).alias("failed_clips"))).crossJoin(clips.select(F.explode("speakers.speaker_id").alias("s")).agg(F.countDistinct("s").alias("speaker_count")))  # one row each
    report = {
        "totals": one, "histograms": qa.histograms(clips), "failed": results.where("NOT is_valid").select("dir", "stem", "errors"), "quality_flagged": clips.where(F.size("quality_flags") > 0).select("clip", F.col("quality_flags").alias("value")),
        "prosody_cap_activations": clips.where("n_caps > 0").select("clip", F.col("n_caps").alias("value")), "acoustic_warnings": listed_of(acoustic), "structural_warnings": listed_of(structural)}
    if summary:
        ids = clips.select("clip")
        people = clips.select(F.explode("speakers").alias("s")).select("s.gender", "s.tts_voice_id")
        voices = people.groupBy("gender").agg(F.countDistinct("tts_voice_id").alias("voices"))
        backends, ratios = qa.clip_backends(clips.select("clip", "tts_backend")), qa.overlap_and_downgrade_ratio(parts, ids)
        report["run_summary"] = {"stats": qa.role_intensity_stats(_metrics(own)), "voices": voices, "backends": backends.groupBy("backend").agg(F.count("*").alias("clips")), "ratios": ratios,
                                 "outliers": qa.outlier_clips(_metrics(own)), "warnings": qa.run_warnings(voices, backends, ratios, acoustic, ids)}
    return report


def run_asr_check(spark: SparkSession, folder: str, least: float = 0.85, recogniser: str = "stub") -> DataFrame:
    """Clip, length_ratio, wer, cer of clips with collapsed hypotheses, by an asr provider."""
    heard = providers.called(files.audio(spark, folder).where(~F.col("stem").contains("_dirty") & F.col("error").isNull()).drop("error"), "samples", "hypothesis", "asr", recogniser, "string")
    rows = heard.select("dir", "stem", "hypothesis").join(files.transcripts(spark, folder).select("dir", "stem", F.col("text").alias("reference")), ["dir", "stem"])
    scored = evaluation.transcript_errors(rows)
    ratio = F.col("hyp_words") / F.greatest("ref_words", F.lit(1))
    return scored.select(F.col("stem").alias("clip"), ratio.alias("length_ratio"), "wer", "cer").where(F.col("length_ratio") < least)


def measure_prosody(spark: SparkSession, folder: str, roles: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The turns' measures, their statistics and the threshold checks, of roles (upper case) or all; retained originals count too."""
    turns = checkpointed(measured_turns(files.event_lines(spark, folder), files.audio(spark, folder, first_channel=True)))
    wanted = [r.strip().upper() for r in roles] if roles is not None else None
    turns = turns.where(F.col("speaker_role").isin(wanted)) if wanted is not None else turns
    stats = qa.role_intensity_stats(_metrics(turns))
    return turns, stats, qa.threshold_checks(stats, wanted)


def generate_manifest(spark: SparkSession, folder: str, splits: DataFrame | None = None, clip_ids: DataFrame | None = None, root: str | None = None, out: str | None = None) -> DataFrame:
    """The manifest of a folder, written to `out` if given."""
    has = files.sidecars(files.listing(spark, folder)).select("dir", "stem", "has_wav", "has_jsonl")
    rows = manifest.manifest(files.clip_documents(spark, folder).join(has, ["dir", "stem"]), splits, clip_ids, root)
    if out is not None:
        sinks.manifest_csv(rows, out)
    return rows


def run_iaa(spark: SparkSession, folder: str, total: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C4: report, verdict and disagreements of a folder of paired annotations."""
    clips, a, b = files.annotation_pairs(spark, folder)
    report = iaa.iaa_report(a, b, "line", clips)
    return report, iaa.iaa_verdict(report, clips, total), iaa.disagreements(a, b)


def package(spark: SparkSession, folder: str, out: str, version: str, projects: list[str], excluded: DataFrame | None = None, most: float = 0.02) -> dict:
    """An archive with a dataset card, if the version is well formed and the quality report passes."""
    if not spark.range(1).select(validate.valid_version(F.lit(version)).alias("ok")).first()["ok"]:
        raise ValueError(f"{version} is no version")
    report = run_qa(spark, folder, most=most)
    totals = report["totals"].first()
    if not totals["passed"]:
        raise RuntimeError(f"the quality report failed: {totals['failure_rate']:.1%} of the clips")
    shares = report["histograms"].select("dim", "key", "clips", sinks.percent_or_dash(F.col("clips"), F.lit(totals["total_clips"])).alias("share"))
    card = sinks.dataset_card({"clips": totals["total_clips"], "seconds": totals["total_duration_seconds"], "speakers": totals["speaker_count"], "failed": totals["failed_clips"], "flagged": totals["quality_flagged_clips"]}, shares, version, projects)
    return sinks.archive(spark, folder, out, card, excluded)


def scripts(scenes: DataFrame, speakers: list[str], cache: DataFrame | None = None, model: str = "stub") -> DataFrame:
    """Scene, key, hit, idx and each turn's fields, from the cache or an llm provider; a turn with errors fails the query. scenes: scene, prompt."""
    rows = scenes.withColumn("key", T.script_key(["scene", "prompt"]))
    rows = files.cached(rows, cache, "key") if cache is not None else rows.withColumn("value", F.lit(None).cast("string")).withColumn("hit", F.lit(False))
    answered = rows.where("hit").withColumn("answer", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("string")).unionByName(providers.called(rows.where("NOT hit"), "prompt", "answer", "llm", model, "string"))
    raw = F.coalesce("value", "answer")
    turns = answered.select("scene", "key", "hit", raw.alias("raw"), F.posexplode(T.response_turns(raw)).alias("idx", "t")).select("scene", "key", "hit", "raw", "idx", "t.*", F.col("t.pause_before_s").alias("pause"))
    errors = validate.script_errors(F.col, F.array(*[F.lit(s) for s in speakers]))
    checked = F.when(F.size(errors) > 0, F.raise_error(F.concat_ws(", ", F.lit("bad turn"), errors)).cast("string")).otherwise(F.col("text"))
    return turns.withColumn("text", checked).drop("pause")


def marked(turns: DataFrame, voice: str = "stub") -> DataFrame:
    """Adds ssml of each turn, and key, its hash. turns: spoken, voice, style, rate, pitch, volume, phrases."""
    styles = providers.provider("tts", voice).styles

    def mark(text, name, style, rate, pitch, volume, found) -> tuple[str]:
        return (ssml.document([{"text": text, "voice": name, "style": style, "rate": rate, "pitch": pitch, "volume": volume, "phrases": found}], styles),)

    return map_rows(turns, ["spoken", "voice", "style", "rate", "pitch", "volume", "phrases"], "ssml string", mark).withColumn("key", F.sha2("ssml", 256))


def speech(keys: DataFrame, cache: DataFrame | None = None, voice: str = "stub") -> DataFrame:
    """Adds hit, wav and error to rows of different keys, from the cache or a tts provider. keys: key, ssml.

    The calls are dealt over many tasks even where the table is small: they take far longer than its bytes let Spark expect."""
    rows = files.cached(keys, cache, "key") if cache is not None else keys.withColumn("value", F.lit(None).cast("binary")).withColumn("hit", F.lit(False))
    spark = keys.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = providers.called(rows.where("NOT hit").repartition(tasks, "key"), "ssml", "wav", "tts", voice, "binary")
    return rows.where("hit").withColumn("wav", F.col("value")).withColumn("error", F.lit(None).cast("string")).unionByName(made).drop("value")


def utterances(turns: DataFrame, cache: DataFrame | None = None, voice: str = "stub") -> DataFrame:
    """Adds ssml, key, hit and wav of each turn, from the cache or a tts provider; equal markup is spoken once. turns: spoken, voice, style, rate, pitch, volume, phrases."""
    rows = checkpointed(marked(turns, voice))
    keys = checkpointed(rows.groupBy("key").agg(F.min("ssml").alias("ssml"), F.count("*").alias("n")))
    return join_skewed(rows, speech(keys.select("key", "ssml"), cache, voice).drop("ssml"), ["key"], heavy_keys(keys, ["key"], "n"))


def render_scenes(turns: DataFrame, seed: int = 42, voice: str = "stub", audio: bool = True) -> DataFrame:
    """Each turn with its drift, capped prosody, gap, speech and place in the scene. turns: scene, idx, speaker, role, intensity, text, spoken, voice, style, phrases.

    Equal markup is spoken once, and measured once for each way its voice is raised. Without `audio` the speech itself (wav) isn't kept."""
    drift = timeline.speaker_drift(turns)
    gaps = timeline.turn_gaps(turns.select("scene", "idx", "role", "intensity"), seed)
    rows = turns.join(drift.select("scene", "speaker", "idx", F.col("rate").alias("r"), F.col("pitch").alias("p"), F.col("volume").alias("v")), ["scene", "speaker", "idx"]).join(gaps, ["scene", "idx"])
    rate, pitch, clamped = labels.prosody_cap(F.col("r"), F.col("p"))
    rows = checkpointed(marked(rows.withColumns({"rate": rate, "pitch": pitch, "volume": F.col("v"), "caps": clamped}).drop("r", "p", "v"), voice))
    raised = F.when(F.col("intensity").isin(*dsp.RAISED), F.col("intensity")).otherwise(0).cast("int")
    keys = checkpointed(rows.groupBy("key").agg(F.min("ssml").alias("ssml"), F.collect_set(raised).alias("levels"), F.count("*").alias("n")))  # three levels at most
    hot, size = heavy_keys(keys, ["key"], "n"), keys.count()
    heard = map_rows(speech(keys.select("key", "ssml", "levels"), voice=voice).where("error IS NULL"), ["wav", "levels"], "heard array<struct<level:int,samples:bigint,speech_end:bigint,gate:string>>", _placed)
    heard = checkpointed(heard.select("key", "hit", "error", "heard", *(["wav"] if audio else [])))
    found = heard.select("key", "hit", "error", "heard")
    rows = rows.join(F.broadcast(found), "key") if size <= BROADCAST_ROWS else join_skewed(rows, found, ["key"], hot)
    own = F.filter("heard", lambda h: h["level"] == raised)[0]
    rows = checkpointed(rows.withColumns({n: own[n] for n in ("samples", "speech_end", "gate")}).drop("heard"))
    placed = rows.join(timeline.rendered_timeline(rows), ["scene", "idx"])
    return join_skewed(placed, heard.select("key", "wav"), ["key"], hot) if audio else placed


def _placed(wav: bytes, levels: list[int]) -> tuple[list[dict]]:
    channels, rate = files.decode(bytes(wav))
    x, out = dsp.resampled(channels.mean(0), rate, dsp.RATE), []
    for level in levels:
        y = dsp.lombard(x, level)
        out.append({"level": level, "samples": len(y), "speech_end": dsp.speech_end(y), "gate": dsp.gate(y, dsp.RATE, "female")[1]})
    return (out,)


def mixed(rows: DataFrame) -> DataFrame:
    """Scene, samples: the sum of the turns' samples at their places. rows: scene, first (a whole sample), samples (an array); a scene's turns meet in one row."""

    def add(parts: list[dict]) -> tuple[list[float]]:
        import numpy as np

        out = np.zeros(max((p["first"] + len(p["samples"]) for p in parts), default=0))
        for p in parts:
            out[p["first"] : p["first"] + len(p["samples"])] += p["samples"]
        return (out.tolist(),)

    held = rows.groupBy("scene").agg(F.collect_list(F.struct("first", "samples")).alias("parts"))
    return map_rows(held, ["parts"], "samples array<double>", add).select("scene", "samples")


def event_labels(rendered: DataFrame, typologies: DataFrame) -> DataFrame:
    """Strong labels of a rendered scene's turns. rendered: scene, idx, speaker, role, intensity, emotion, seconds, onset, offset; typologies: scene, typology."""
    times = timeline.label_times(rendered)
    rows = rendered.drop("onset", "offset").join(times, ["scene", "idx"]).join(typologies, "scene")
    kinds = labels.event_type(rows.select(F.struct("scene", "idx").alias("clip"), "typology", F.col("intensity").alias("max_intensity"))).select("clip.*", "tier1", "tier2")
    named = labels.normal_emotion(rows.join(kinds, ["scene", "idx"]), "emotion")
    clip = manifest.clip_id(F.col("scene").cast("string"))
    return named.select(F.format_string("%s_EVT_%03d", clip, F.col("idx")).alias("event_id"), clip.alias("clip_id"), "onset", "offset", F.col("tier1").alias("tier1_category"), F.col("tier2").alias("tier2_subtype"), "intensity",
                        F.col("speaker").alias("speaker_id"), F.col("role").alias("speaker_role"), F.col("canonical").alias("emotional_state"), F.lit(1.0).alias("confidence"), F.lit("auto").alias("label_source"), F.lit(False).alias("iaa_reviewed"), "truncated")


def _phrases(text: str, spoken: str, hints: list[dict] | None) -> tuple[list[dict]]:
    return (ssml.phrases(hints or [], text, spoken),)


def _segment(wav: bytes, intensity: int) -> tuple[list[float]]:
    """A turn's samples as they are mixed: mono at 16 kHz, raised voice, faded ends."""
    channels, rate = files.decode(bytes(wav))
    x = dsp.lombard(dsp.resampled(channels.mean(0), rate, dsp.RATE), intensity)
    k = min(160, len(x) // 2)
    if k:
        x = x.copy()
        x[:k] *= np.linspace(0, 1, k)
        x[-k:] *= np.linspace(1, 0, k)
    return (x.tolist(),)


def _finished(samples: list[float], tier: str, seed: int) -> tuple[list[float], float, list[dict]]:
    """The clip's samples, their peak, and the sounds placed in them (tiers B and C)."""
    x, _ = dsp.preprocessed(np.array(samples)[None], dsp.RATE)
    log: list[dict] = []
    if tier in ("B", "C"):
        scene = {"room_type": "living_room", "device": "phone_on_table", "speaker_distance_meters": 1.5, "background_events": [{"type": "hvac_hum", "loop": True}, {"type": "ACOU_SLAM", "onset_at_phase": "peak", "level_db": -12.0}]}
        y, log, _ = dsp.augmented(x, dsp.RATE, scene, seed, dict(dims.PHASES))
        x = dsp.peak_limited(dsp.to_peak(dsp.restored(y, len(x), dsp.RATE // 2), -2.0))
    x = np.r_[x, np.zeros(max(0, 3 * dsp.RATE - len(x)))]
    return x.tolist(), float(20 * np.log10(np.abs(x).max())) if np.abs(x).any() else float("-inf"), [{"type": e["type"], "onset": e["onset"], "offset": e["offset"]} for e in log]


def generate(spark: SparkSession, scenes: DataFrame, speakers: DataFrame, folder: str, seed: int = 42) -> DataFrame:
    """Clips of scenes, from script to files: transcript, speech, mix, processing, augmentation, strong labels and metadata. scene, clip_id, path of each.

    scenes: scene (number), project, typology, tier, prompt; speakers: a row a speaker, with the fields of clip documents, known to all scenes.
    Scripts and speech come from the stand-in providers; the executors write to `folder`, which they must share.
    """
    people = speakers.select(F.col("speaker_id").alias("speaker"), "role", "gender", "tts_voice_id")
    ids = [r["speaker"] for r in people.collect()]  # the cast of a project
    lines = scripts(scenes.select("scene", "prompt"), ids).select("scene", "idx", F.col("speaker_id").alias("speaker"), "text", "intensity", F.col("emotional_state").alias("emotion"), "phrase_hints")
    turns = lines.join(F.broadcast(people), "speaker")  # the same
    heard = turns.join(labels.addressee(turns), ["scene", "role"], "left")
    spoken, _ = T.disambiguated(F.col("text"), F.when(F.col("addressee") == "AGG", "male").when(F.col("addressee") == "VIC", "female"))
    turns = map_rows(heard.withColumn("spoken", spoken), ["text", "spoken", "phrase_hints"], f"phrases {ssml.PHRASES}", _phrases).drop("phrase_hints")
    rows = checkpointed(render_scenes(turns.withColumns({"voice": F.col("tts_voice_id"), "style": F.lit("general")}), seed))
    parts = map_rows(rows.select("scene", "wav", "intensity", F.bround(F.col("onset") * dsp.RATE).cast("int").alias("first")), ["wav", "intensity"], "samples array<double>", _segment)
    clips = mixed(parts.select("scene", "first", "samples")).join(scenes.select("scene", "project", "typology", "tier"), "scene")
    name = manifest.clip_id(F.concat(F.lit("scene-"), F.col("scene").cast("string")))
    path = F.concat(F.lit(folder.rstrip("/") + "/"), F.lower(F.lit(ids[0])), F.lit("/"), name)
    clips = checkpointed(map_rows(clips.withColumn("seed", F.lit(seed) + F.col("scene")), ["samples", "tier", "seed"], "samples array<double>, peak double, sounds array<struct<type:string,onset:double,offset:double>>", _finished).withColumns({"clip_id": name, "path": path}))
    named = rows.withColumn("seconds", F.col("samples") / dsp.RATE)
    strong = event_labels(named.withColumn("scene", F.concat(F.lit("scene-"), F.col("scene").cast("string"))), scenes.select(F.concat(F.lit("scene-"), F.col("scene").cast("string")).alias("scene"), "typology")).drop("scene")
    sounds = labels.sound_labels(clips.select(F.col("clip_id").alias("clip"), F.explode("sounds").alias("s")).select("clip", "s.*"), files.taxonomy(spark))
    placed = sounds.select(F.concat("clip", F.lit("_EVT_S"), F.xxhash64("tier2", "onset").cast("string")).alias("event_id"), F.col("clip").alias("clip_id"), "onset", "offset", F.col("tier1").alias("tier1_category"), F.col("tier2").alias("tier2_subtype"), "intensity", "notes")
    events = checkpointed(strong.unionByName(placed, allowMissingColumns=True))
    weak = labels.weak_labels(events.select(F.col("clip_id").alias("clip"), F.col("tier1_category").alias("tier1"), "intensity"))
    weak = weak.select(F.col("clip").alias("clip_id"), F.struct("has_violence", F.filter(F.split("categories", ","), lambda c: c != "").alias("violence_categories"), "max_intensity").alias("weak"))
    cast = speakers.select(F.struct(*[c for c in ("speaker_id", "role", "gender", "age_range", "tts_voice_id", "voice_family")]).alias("s")).agg(F.collect_list("s").alias("speakers"))
    whole = clips.join(weak, "clip_id").crossJoin(F.broadcast(cast))  # one row
    document = F.struct("clip_id", "project", F.lit("he").alias("language"), F.col("typology").alias("violence_typology"), "tier", (F.size("samples") / dsp.RATE).alias("duration_seconds"), F.lit(dsp.RATE).alias("sample_rate"), F.lit(1).alias("channels"),
                        F.date_format(F.current_date(), "yyyy-MM-dd").alias("generation_date"), F.lit("1").alias("generator_version"), F.lit(True).alias("is_synthetic"), "speakers", F.col("weak").withField("violence_typology", F.col("typology")).alias("weak_label"),
                        labels.preprocessing_record(F.col("peak"), F.lit(False)).alias("preprocessing_applied"), F.array().cast("array<string>").alias("quality_flags"))
    texts = sinks.transcript_texts(rows.select(manifest.clip_id(F.concat(F.lit("scene-"), F.col("scene").cast("string"))).alias("clip_id"), "idx", F.col("speaker").alias("speaker_id"), "role", "onset", "offset", "text", F.lit("-").alias("action"), "intensity"))
    jsonl = events.groupBy("clip_id").agg(F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct(*events.columns)))), "\n").alias("value"))  # the events of one clip
    file = lambda df, ext, content: df.select(F.concat("path", F.lit(ext)).alias("path"), content.alias("content"))
    sinks.write_files(map_rows(clips.select(F.concat("path", F.lit(".wav")).alias("path"), "samples"), ["samples"], "content binary", lambda x: (sinks.wav_bytes(x),)))
    for df, ext in ((texts, ".txt"), (jsonl, ".jsonl")):
        sinks.write_files(file(df.join(clips.select("clip_id", "path"), "clip_id"), ext, F.col("value").cast("binary")))
    sinks.write_files(file(whole, ".json", F.to_json(document).cast("binary")))
    return clips.select("scene", "clip_id", "path")


def judged(results: DataFrame) -> DataFrame:
    """Reason and scores of a judge's raw answers: ok, content_refusal, json_parse_error, api_error. results: raw, error."""
    scores = F.from_json(F.col("raw"), "map<string,int>")
    reason = F.when(F.col("error").isNotNull(), "api_error").when(F.coalesce(F.trim("raw"), F.lit("")) == "", "content_refusal").when(scores.isNull(), "json_parse_error").otherwise("ok")
    return results.withColumn("reason", reason).withColumn("scores", F.when(reason == "ok", scores))
