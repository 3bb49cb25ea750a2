"""More registered queries: validation, labels, planning, texts, signals, evaluation; with SQL where SQL can express them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auralith import dims
from auralith.functions import dsp, signal, text
from auralith.functions.arrow import map_rows
from auralith.operators import evaluation, labels, manifest, planning, qa, qa_run, validate
from auralith.plans.catalogue import QUERIES, SQL, query, simple  # noqa: F401
from auralith.sinks import files as sinks
from auralith.sources import files
from auralith.sources import views as V


def rows_only(name: str):
    """A query that SQL has no form of; the tests compare with a plain version."""

    def register(f):
        QUERIES[name] = f
        return f

    return register


# validation

CODES = "[" + ", ".join(f"'{c}'" for c, _ in dims.PARENTS) + "]"
TIERS1 = "[" + ", ".join(f"'{c}'" for c in dims.TIER1) + "]"
EMOTIONS = "[" + ", ".join(f"'{c}'" for c in dims.EMOTIONS) + "]"
ERRORS = f"""(CASE WHEN offset_s <= onset THEN 1 ELSE 0 END + CASE WHEN onset < 0 THEN 1 ELSE 0 END + CASE WHEN NOT list_contains({TIERS1}, tier1) THEN 1 ELSE 0 END + CASE WHEN NOT list_contains({CODES}, tier2) THEN 1 ELSE 0 END
 + CASE WHEN parent <> tier1 THEN 1 ELSE 0 END + CASE WHEN intensity NOT BETWEEN 1 AND 5 THEN 1 ELSE 0 END + CASE WHEN role NOT IN ('AGG', 'VIC', 'BYS', 'UNK') THEN 1 ELSE 0 END
 + CASE WHEN NOT list_contains({EMOTIONS}, emotion) THEN 1 ELSE 0 END + CASE WHEN confidence NOT BETWEEN 0 AND 1 THEN 1 ELSE 0 END)"""
CHECKED = f"lb AS (SELECT l.*, parent, {ERRORS} AS n_errors FROM v_label l LEFT JOIN {dims.values(dims.PARENTS, 'code, parent')} p ON tier2 = code)"
AS_EVENT = ["CAST(event_id AS STRING) AS event_id", "CAST(clip AS STRING) AS clip_id", "onset", "offset_s AS offset", "tier1 AS tier1_category", "tier2 AS tier2_subtype", "intensity", "CAST(NULL AS STRING) AS speaker_id", "role AS speaker_role", "emotion AS emotional_state",
            "confidence", "'auto' AS label_source", "false AS iaa_reviewed", "false AS truncated", "CAST(NULL AS STRING) AS notes"]


@query("V3_event_errors", f"WITH {CHECKED} SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(n_errors AS INT) AS n_errors FROM lb")
def event_errors(spark: SparkSession, d: str) -> DataFrame:
    return V.labels(spark, d).selectExpr(*AS_EVENT).select("event_id", F.size(validate.event_errors()).alias("n_errors"))


@query("S5_event_lines", f"WITH {CHECKED} SELECT CAST(event_id AS VARCHAR) AS event_id, round(onset, 6) AS onset, CAST(intensity AS INT) AS intensity FROM lb WHERE n_errors = 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0 AND event_id % 47 <> 0")
def event_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = V.labels(spark, d).selectExpr(*AS_EVENT)
    line = F.to_json(F.struct(*rows.columns))
    n = F.col("event_id").cast("long")
    broken = F.when(n % 41 == 0, F.substring(line, 1, 30)).when(n % 43 == 0, F.lit("")).when(n % 47 == 0, F.regexp_replace(line, '"onset":', '"onset":"late","was":')).otherwise(line)
    return files.parsed(rows.select(broken.alias("text")), "text", files.EVENT, validate.event_errors).where("doc IS NOT NULL").select("doc.event_id", F.round("doc.onset", 6).alias("onset"), "doc.intensity")


simple("J8_parent_check", V.labels, lambda r: r.selectExpr(*AS_EVENT).where(F.array_contains(validate.event_errors(), "tier2_subtype belongs to another tier1_category")).select("event_id"), f"WITH {CHECKED} SELECT CAST(event_id AS VARCHAR) AS event_id FROM lb WHERE parent <> tier1")
simple("U2_unknown_codes", V.labels, lambda r: validate.unknown_codes(r, dims.frame(r.sparkSession, dims.PARENTS, "tier2 string, tier1 string"), "tier2"), f"SELECT DISTINCT tier2 FROM v_label WHERE NOT list_contains({CODES}, tier2)")
simple("V6_code_tables", V.labels, lambda r: validate.unknown_codes(dims.frame(r.sparkSession, dims.EVENT_BANDS, "band string, top int, tier1 string, tier2 string"), dims.frame(r.sparkSession, dims.PARENTS, "tier2 string, tier1 string"), "tier2"),
       f"SELECT tier2 FROM {dims.values(dims.EVENT_BANDS, 'band, top, tier1, tier2')} b WHERE NOT list_contains({CODES}, tier2)")


@query("V3_weak_label_errors", f"WITH w AS (SELECT clip, CASE WHEN clip % 11 = 0 THEN 9 ELSE max(intensity) END AS i, CASE WHEN clip % 7 = 0 THEN 'ODD' ELSE 'IT' END AS t, list_distinct(list(tier1)) AS c FROM v_event GROUP BY clip) SELECT clip, CAST((i NOT BETWEEN 1 AND 5)::INT + (t = 'ODD')::INT + (len(list_filter(c, lambda x: NOT list_contains({TIERS1}, x))) > 0)::INT AS INT) AS n_errors FROM w")
def weak_errors(spark: SparkSession, d: str) -> DataFrame:
    per = V.events(spark, d).groupBy("clip").agg(F.max("intensity").alias("i"), F.collect_set("tier1").alias("c"))
    w = F.struct(F.lit(True).alias("has_violence"), F.col("c").alias("violence_categories"), F.when(F.col("clip") % 11 == 0, 9).otherwise(F.col("i")).alias("max_intensity"), F.when(F.col("clip") % 7 == 0, "ODD").otherwise("IT").alias("violence_typology"))
    return per.select("clip", w.alias("w")).select("clip", F.size(validate.weak_label_errors("w")).alias("n_errors"))


HEARD = "h AS (SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN 16 WHEN 1 THEN 20 ELSE 25 END AS rate, 1 + vec_id % 5 // 4 AS channels, list_transform(embedding, lambda v, i: CASE WHEN vec_id % 2 = 0 AND (i <= 8 OR i > 56) THEN 0 ELSE CAST(v AS DOUBLE) * (1 + vec_id % 7) END) AS x FROM embeddings), hp AS (SELECT *, rate // 2 AS pad, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM h)"


@query("V2_audio_errors", f"WITH {HEARD} SELECT vec_id, array_to_string(list_filter(['sample_rate is not 16000', CASE WHEN channels <> 1 THEN 'channels is not 1' END, CASE WHEN 64 / rate < 3 THEN 'duration is below 3 s' END, CASE WHEN 20 * log10(peak) > -0.5 THEN 'peak exceeds -1 dBFS' END, CASE WHEN list_max(list_transform(x[1:pad], lambda v: abs(v))) > 0.01 THEN 'head is not silent' END, CASE WHEN list_max(list_transform(x[64 - pad + 1:64], lambda v: abs(v))) > 0.01 THEN 'tail is not silent' END], lambda e: e IS NOT NULL), ', ') AS errors FROM hp")
def audio_errors(spark: SparkSession, d: str) -> DataFrame:
    x = F.expr("transform(embedding, (v, i) -> CASE WHEN vec_id % 2 = 0 AND (i < 8 OR i >= 56) THEN 0D ELSE CAST(v AS DOUBLE) * (1 + vec_id % 7) END)")
    rows = V.read(spark, d, "embeddings").select("vec_id", x.alias("x"), F.when(F.col("vec_id") % 3 == 0, 16).when(F.col("vec_id") % 3 == 1, 20).otherwise(25).alias("rate"), F.expr("CAST(1 + vec_id % 5 DIV 4 AS INT) AS channels"))
    return rows.select("vec_id", F.array_join(validate.audio_errors(F.col("x"), F.col("rate"), F.col("channels")), ", ").alias("errors"))


@query("V10_scene_errors", "SELECT o_orderkey AS clip, CAST((o_orderkey % 5 = 0)::INT + (o_orderkey % 7 = 0)::INT + (o_orderkey % 11 = 0)::INT + (o_totalprice < 50000)::INT + (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1)::INT AS INT) AS n_errors FROM orders")
def scene_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = V.read(spark, d, "orders").select(
        k.alias("clip"), F.lit("s").alias("scene_id"), F.when(k % 5 == 0, "other").otherwise("she_proves").alias("project"), F.when(k % 7 == 0, "ODD").otherwise("SV").alias("violence_typology"), F.when(k % 2 == 1, "B").otherwise("A").alias("tier"),
        F.lit("t").alias("script_template"), F.when(k % 11 == 0, F.array(F.lit(1), F.lit(6))).otherwise(F.array(F.lit(1), F.lit(5))).alias("intensity_arc"), (F.col("o_totalprice") - 50000).alias("p"),
        F.array(F.struct(F.lit("a").alias("speaker_id"), F.lit("AGG").alias("role"))).alias("speakers"), F.when(k % 3 != 0, F.create_map(F.lit("room"), F.lit("x"))).alias("acoustic_scene"))
    rows = rows.withColumn("target_duration_minutes", F.when(F.col("p") < 0, -1.0).otherwise(3.0))
    return rows.select("clip", F.size(validate.scene_errors()).alias("n_errors"))


KNOWN = ["AGG_1", "VIC_1", "BYS_1"]


@query("V4_validate_script", """WITH w AS (SELECT scene, idx, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS k FROM v_turn ),
r AS (SELECT scene, idx, w = lag(w) OVER o AND w = lag(w, 2) OVER o AND w = lag(w, 3) OVER o AS four FROM w WINDOW o AS (PARTITION BY scene, idx ORDER BY k)), b AS (SELECT scene, idx, coalesce(bool_or(four), false) AS repeated FROM r GROUP BY ALL)
SELECT scene, idx, CASE WHEN trim(text) = '' THEN 'empty' ELSE array_to_string(list_filter([CASE WHEN speaker NOT IN ('AGG_1', 'VIC_1', 'BYS_1') THEN 'unknown speaker' END, CASE WHEN amount * 2 NOT BETWEEN 0 AND 1.5 THEN 'pause' END, CASE WHEN repeated THEN 'repeated' END, 'no_hebrew'], lambda e: e IS NOT NULL), ',') END AS errors FROM v_turn JOIN b USING (scene, idx)""")
def script(spark: SparkSession, d: str) -> DataFrame:
    turns = V.turns(spark, d).withColumn("speaker_id", F.col("speaker")).withColumn("pause", F.col("amount") * 2)
    return turns.select("scene", "idx", F.array_join(validate.script_errors(F.col, F.array(*[F.lit(k) for k in KNOWN])), ",").alias("errors"))


@query("S18_sidecars", "SELECT clip AS stem, true AS has_wav, clip % 17 <> 0 AS has_txt, clip % 19 <> 0 AS has_json, has_strong_labels AS has_jsonl FROM v_clip ")
def sidecars(spark: SparkSession, d: str) -> DataFrame:
    return files.sidecars(_files(spark, d)).select(F.col("stem").cast("long").alias("stem"), "has_wav", "has_txt", "has_json", "has_jsonl")


def _files(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array_compact(F.array(F.lit("wav"), F.when(F.col("clip") % 17 != 0, "txt"), F.when(F.col("clip") % 19 != 0, "json"), F.when(F.col("has_strong_labels"), "jsonl")))
    return V.clips(spark, d).select(F.lit("/data").alias("dir"), F.col("clip").cast("string").alias("stem"), F.explode(kinds).alias("ext"), (F.col("clip") * 10).alias("size"))


@query("A27_archive_totals", "WITH f AS (SELECT clip, 1 + (clip % 17 <> 0)::INT + (clip % 19 <> 0)::INT + has_strong_labels::INT AS n FROM v_clip ) SELECT CAST(sum(n) FILTER (clip % 23 <> 0) AS BIGINT) AS files, CAST(sum(n * clip * 10) FILTER (clip % 23 <> 0) AS BIGINT) AS bytes, count(*) FILTER (clip % 23 = 0) AS excluded FROM f")
def totals(spark: SparkSession, d: str) -> DataFrame:
    return qa.archive_totals(_files(spark, d), V.clips(spark, d).where("clip % 23 = 0").select(F.col("clip").cast("string").alias("stem")))


# labels and manifest


def _docs(spark: SparkSession, d: str) -> DataFrame:
    speakers = V.clip_speakers(spark, d).groupBy("clip").agg(F.array_sort(F.collect_list("speaker")).alias("ids"))
    people = F.transform("ids", lambda s: F.struct(s.cast("string").alias("speaker_id"), F.concat(F.lit("voice"), (s % 5).cast("string")).alias("tts_voice_id"), F.when(s % 3 == 0, "").when(s % 3 == 1, "family").alias("voice_family")))
    weak = F.struct((F.col("max_intensity") > 2).alias("has_violence"), "max_intensity")
    rows = V.clips(spark, d).join(speakers, "clip").join(V.clip_flags(spark, d), "clip")
    return rows.select(F.concat(F.lit("clip_"), F.col("clip").cast("string")).alias("clip_id"), "project", F.col("typology").alias("violence_typology"), "tier", F.round("duration", 6).alias("duration_seconds"), people.alias("speakers"), weak.alias("weak_label"), "quality_flags",
                       F.concat(F.lit("file:/data/he/"), F.col("clip").cast("string"), F.lit(".json")).alias("path"), (F.col("clip") % 19 != 0).alias("has_wav"), F.col("has_strong_labels").alias("has_jsonl"), "split")


MANIFEST = """l AS (SELECT clip, string_agg(CAST(speaker AS VARCHAR), '|' ORDER BY speaker) AS ids, string_agg(CASE WHEN speaker % 3 = 1 THEN 'family' ELSE 'voice' || (speaker % 5) END, '|' ORDER BY speaker) AS voices FROM v_clip_speaker GROUP BY clip),
mf AS (SELECT 'clip_' || clip AS clip_id, project, typology AS violence_typology, tier, round(duration, 6) AS duration_seconds, ids AS speaker_ids, voices AS voice_families, max_intensity > 2 AS has_violence, max_intensity, array_to_string(quality_flags, ',') AS quality_flags,
CASE WHEN split = 'unassigned' THEN '' ELSE split END AS split, 'he/' || clip || '.wav' AS wav_path, CASE WHEN has_strong_labels THEN 'he/' || clip || '.jsonl' ELSE '' END AS strong_labels_path FROM v_clip JOIN l USING (clip) JOIN v_clip_flags USING (clip) WHERE clip % 19 <> 0)"""


@query("C3_manifest", f"WITH {MANIFEST} SELECT * FROM mf")
def whole_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return manifest.manifest(docs.drop("split"), docs.where("split <> 'unassigned'").select("clip_id", "split"), root="/data")


@query("K3_manifest_text", f"WITH {MANIFEST} SELECT clip_id, CASE WHEN has_violence THEN 'True' ELSE 'False' END AS has_violence, CAST(max_intensity AS VARCHAR) AS max_intensity, quality_flags, wav_path FROM mf WHERE violence_typology = 'IT'")
def manifest_text(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    wanted = docs.where("violence_typology = 'IT'").select("clip_id")
    return sinks.manifest_text(manifest.manifest(docs.drop("split"), None, wanted, "/data")).select("clip_id", "has_violence", "max_intensity", "quality_flags", "wav_path")


@query("K5_prosody_text", "SELECT clip AS clip_id, role AS speaker_role, intensity, coalesce(printf('%.2f', f0), '') AS f0_median_hz, coalesce(printf('%.2f', f0_std), '') AS f0_std_hz, printf('%.2f', rms) AS rms_db FROM v_turn_metrics ")
def prosody_text(spark: SparkSession, d: str) -> DataFrame:
    m = V.turn_metrics(spark, d)
    return sinks.prosody_text(m.select(F.col("clip").alias("clip_id"), F.col("role").alias("speaker_role"), "intensity", F.col("f0").alias("f0_median_hz"), F.col("f0_std").alias("f0_std_hz"), F.col("rms").alias("rms_db")))


@query("P7_clip_id", "SELECT o_orderkey AS clip, lower(replace('Scene-' || o_orderstatus || '-' || o_orderkey, '-', '_')) || '_00' AS clip_id FROM orders")
def clip_ids(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "orders").select(F.col("o_orderkey").alias("clip"), manifest.clip_id(F.concat_ws("-", F.lit("Scene"), "o_orderstatus", F.col("o_orderkey").cast("string"))).alias("clip_id"))


@query("P14_sound_labels", "SELECT clip, 'ACOU' AS tier1, sound AS tier2, round(onset, 6) AS onset, round(greatest(offset_s, onset + 0.1), 6) AS offset_s, 3 AS intensity FROM (SELECT *, ['ACOU_SLAM', 'ACOU_WIND', 'rain', 'ACOU_FALL'][CAST(event_id % 4 AS INT) + 1] AS sound FROM v_label ) WHERE event_id % 4 IN (0, 3)")
def sounds(spark: SparkSession, d: str) -> DataFrame:
    rows = V.labels(spark, d).withColumn("type", F.get(F.array(*[F.lit(t) for t in ("ACOU_SLAM", "ACOU_WIND", "rain", "ACOU_FALL")]), (F.col("event_id") % 4).cast("int")))
    out = labels.sound_labels(rows.select("clip", "type", "onset", F.col("offset_s").alias("offset")), files.taxonomy(spark))
    return out.select("clip", "tier1", "tier2", F.round("onset", 6).alias("onset"), F.round("offset", 6).alias("offset_s"), "intensity")


@query("P18_effective_prosody", "SELECT scene, idx, round(0.9 * 1.1 * (1 + seconds / 100), 6) AS rate, round(greatest(-12, least(12, intensity * 3 - 2 + seconds)), 6) AS pitch, round(amount + 1 + intensity, 6) AS volume FROM v_turn ")
def effective(spark: SparkSession, d: str) -> DataFrame:
    i, s = F.col("intensity"), F.col("seconds")
    made = labels.effective_prosody({"rate": F.lit(0.9), "pitch": i * 3 - 2.0, "volume": F.col("amount")}, {"rate": F.lit(1.1), "volume": F.lit(1.0)}, {"rate": 1 + s / 100, "pitch": s, "volume": i})
    return V.turns(spark, d).select("scene", "idx", *[F.round(c, 6).alias(n) for n, c in made.items()])


@query("P24_ssml_percent", "WITH r AS (SELECT scene, idx, CAST(round_even(greatest(-50, least(200, round_even((0.9 + intensity - 1) * 100, 0))), 0) AS INT) AS rate, CAST(greatest(-50, least(50, round_even((intensity * 4 - 12) * 5.946::DOUBLE, 0))) AS INT) AS pitch, CAST(greatest(-50, least(50, round_even(intensity * 30 - 90.0, 0))) AS INT) AS volume FROM v_turn ) SELECT scene, idx, CASE WHEN rate >= 0 THEN '+' ELSE '' END || rate || '%' AS rate, CASE WHEN pitch >= 0 THEN '+' ELSE '' END || pitch || '%' AS pitch, CASE WHEN volume >= 0 THEN '+' ELSE '' END || volume || '%' AS volume FROM r")
def percents(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("intensity")
    made = labels.ssml_percent(F.lit(0.9) + i, i * 4 - 12, i * 30 - 90.0)
    return V.turns(spark, d).select("scene", "idx", *[c.alias(n) for c, n in zip(made, ("rate", "pitch", "volume"), strict=True)])


@query("P13_safe_end", "SELECT event_id, round(CASE WHEN onset + 1 > onset THEN least(greatest(offset_s - 2, onset + 1.0 / 16000), onset + 1) END, 7) AS ends FROM v_label ")
def safe_ends(spark: SparkSession, d: str) -> DataFrame:
    from auralith.operators.timeline import safe_end

    return V.labels(spark, d).select("event_id", F.round(safe_end(F.col("onset"), F.col("offset_s") - 2, F.col("onset") + 1), 7).alias("ends"))


@query("P21_P22_fallbacks", "SELECT clip, CASE WHEN slot = 0 THEN 18.0 ELSE CAST(10 + slot AS DOUBLE) END AS snr, CASE WHEN slot % 2 = 1 THEN CAST(-slot AS DOUBLE) WHEN slot % 3 = 0 THEN -20.0 END AS rms FROM v_clip ")
def fallbacks(spark: SparkSession, d: str) -> DataFrame:
    slot = F.col("slot")
    own = F.when(slot == 0, 20.0).otherwise((slot + 10).cast("double"))
    return V.clips(spark, d).select("clip", labels.snr_target(own, F.lit(18.0)).alias("snr"), labels.rms_target(F.when(slot % 2 == 1, -slot.cast("double")), F.when(slot % 3 == 0, -20.0)).alias("rms"))


@query("J7_roles", "SELECT scene, idx, CASE WHEN speaker LIKE '%_1' THEN substr(speaker, 1, 3) ELSE 'UNK' END AS role FROM v_turn ")
def roles(spark: SparkSession, d: str) -> DataFrame:
    turns = V.turns(spark, d)
    known = turns.where("speaker LIKE '%_1'").select("speaker", F.substring("speaker", 1, 3).alias("role")).distinct()
    return labels.with_roles(turns.drop("role"), known).select("scene", "idx", "role")


# planning

SPEAKERS = "sp AS (SELECT s_suppkey AS speaker, ['AGG', 'VIC', 'BYS'][CAST(s_suppkey % 3 AS INT) + 1] AS role, ['she_proves', 'elephant_in_the_room', 'both'][CAST(s_suppkey % 4 // 2 + s_suppkey % 2 AS INT) + 1] AS context, CASE WHEN s_suppkey % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM supplier)"
POOLS = "po AS (SELECT context, role, split, speaker AS candidate FROM sp WHERE context <> 'both' UNION ALL SELECT unnest(['she_proves', 'elephant_in_the_room']), role, split, speaker FROM sp WHERE context = 'both'), pl AS (SELECT *, row_number() OVER (PARTITION BY context, role, split ORDER BY md5('42|' || candidate), candidate) - 1 AS slot, count(*) OVER (PARTITION BY context, role, split) AS size FROM po)"


def _speakers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    pick = lambda names, at: F.get(F.array(*[F.lit(n) for n in names]), at.cast("int"))
    return V.read(spark, d, "supplier").select(k.alias("speaker"), pick(["AGG", "VIC", "BYS"], k % 3).alias("role"), pick([*dims.PROJECTS, "both"], F.floor((k % 4) / 2) + k % 2).alias("context"), F.when(k % 5 == 0, "val").otherwise("train").alias("split"))


simple("J14_pools", _speakers, lambda s: planning.pools(s, 42).select("context", "role", "split", "candidate", F.col("slot").cast("long").alias("slot"), "size"), f"WITH {SPEAKERS}, {POOLS} SELECT context, role, split, candidate, slot, size FROM pl")


@query("C7_distribute_speakers", f"""WITH {SPEAKERS}, {POOLS}, sc AS (SELECT o_orderkey AS scene, CASE WHEN o_orderkey % 2 = 0 THEN 'she_proves' ELSE 'elephant_in_the_room' END AS project, unnest([0, 1]) AS pos, o_custkey FROM orders),
st AS (SELECT scene, pos, s.speaker, s.role, s.split, CASE WHEN s.context = 'both' THEN project ELSE s.context END AS context FROM sc JOIN sp s ON s.speaker = (o_custkey + pos * 7) % 120), tn AS (SELECT *, row_number() OVER (PARTITION BY context, role, split ORDER BY scene, pos) - 1 AS n FROM st)
SELECT scene, tn.speaker, candidate AS replacement FROM tn JOIN pl USING (context, role, split) WHERE pl.slot = tn.n % pl.size AND candidate <> tn.speaker""")
def rotation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    scenes = V.read(spark, d, "orders").select(k.alias("scene"), F.when(k % 2 == 0, dims.PROJECTS[0]).otherwise(dims.PROJECTS[1]).alias("project"), F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), "o_custkey")
    return planning.distribute_speakers(scenes.select("scene", "project", "pos", ((F.col("o_custkey") + F.col("pos") * 7) % 120).alias("speaker")), _speakers(spark, d))


UNIFORM = "(('0x' || substr(md5('42|' || scene || '|' || variant || '|{}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
ROOMS, DEVICES = (str(sorted(x)) for x in (validate.ROOMS, validate.DEVICES))


@query("L8_L9_variants", f"""WITH v AS (SELECT clip AS scene, unnest([0, 1, 2]) AS variant FROM v_clip ), u AS (SELECT *, {UNIFORM.format('band')} AS b, {UNIFORM.format('place')} AS p FROM v)
SELECT scene, variant, {ROOMS}[CAST(floor({UNIFORM.format('room')} * 6) AS INT) + 1] AS room_type, {DEVICES}[CAST(floor({UNIFORM.format('device')} * 4) AS INT) + 1] AS device, [0.5, 1.5, 3.5][CAST(floor({UNIFORM.format('distance')} * 3) AS INT) + 1]::DOUBLE AS distance,
round(CASE WHEN b <= 0.5 THEN 18 + 12 * p WHEN b <= 0.8 THEN 10 + 8 * p WHEN b <= 0.9 THEN 5 + 5 * p ELSE 30 + 10 * p END, 1) AS snr FROM u""")
def variants(spark: SparkSession, d: str) -> DataFrame:
    return planning.variants(V.clips(spark, d).select(F.col("clip").alias("scene")), 3)


TARGETS = [("IT", 40), ("NEG", 5)]
simple("L3b_selected", V.clips, lambda c: planning.selected(c.select(F.col("clip").alias("scene"), "typology"), dims.frame(c.sparkSession, TARGETS, "typology string, n int")),
       f"SELECT clip AS scene, typology FROM (SELECT clip, typology, n, row_number() OVER (PARTITION BY typology ORDER BY md5('42|' || clip), clip) AS place FROM v_clip JOIN {dims.values(TARGETS, 'typology, n')} t USING (typology)) WHERE place <= n")


@rows_only("C6_batch_plan")
def batch(spark: SparkSession, d: str) -> DataFrame:
    clips = V.clips(spark, d)
    return planning.batch_plan(clips.select(F.col("clip").alias("scene"), "typology"), dims.frame(spark, [("IT", 300), ("NEG", 200), ("SV", 100)], "typology string, n int"), V.clip_speakers(spark, d).select(F.col("clip").alias("scene"), "speaker"), 500)


simple("A28_target_totals", V.turns, lambda t: qa.target_totals(t.select(F.col("idx").alias("pos"), F.col("mode").alias("typology"), (F.col("scene") * 100 + F.col("idx")).alias("n")).where("pos < 5").groupBy("typology", "pos").agg(F.max("n").alias("n"))),
       "WITH m AS (SELECT mode, idx, max(scene * 100 + idx) AS n FROM v_turn WHERE idx < 5 GROUP BY ALL) SELECT mode AS typology, arg_max(n, idx) AS n FROM m GROUP BY mode")


@query("J21_judge_plan", "SELECT item_id AS clip, unnest(['a', 'b']) AS model, run FROM benchmark, (SELECT unnest([0, 1, 2]) AS run) r")
def judge_plan(spark: SparkSession, d: str) -> DataFrame:
    return planning.judge_plan(dims.frame(spark, [("a",), ("b",)], "model string"), V.read(spark, d, "benchmark").select(F.col("item_id").alias("clip")), 3)


@query("J6_pending", "SELECT item_id AS clip, model, run FROM (SELECT item_id, unnest(['a', 'b']) AS model, run FROM benchmark, (SELECT unnest([0, 1, 2]) AS run) r) WHERE NOT (item_id % 2 = 0 AND model = 'a' AND run < 2)")
def pending(spark: SparkSession, d: str) -> DataFrame:
    plan = judge_plan(spark, d)
    return files.pending(plan, plan.where("clip % 2 = 0 AND model = 'a' AND run < 2"), ["clip", "model", "run"]).select("clip", "model", "run")


@query("S16_assets", "SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN 'own' END, CASE event_type WHEN 'click' THEN 'a1' WHEN 'error' THEN 'b1' END) AS asset FROM events")
def assets(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame([("click", "a2"), ("click", "a1"), ("error", "b1")], "type string, path string")
    rows = V.read(spark, d, "events").select("event_id", F.col("event_type").alias("type"), F.when(F.col("event_id") % 3 == 0, "own").alias("asset_path"))
    return files.resolved_assets(rows, known).select("event_id", "asset")


@query("U1_first_wins", "WITH u AS (SELECT 0 AS t, c_nationkey AS nation, c_name AS name FROM customer UNION ALL SELECT 1, s_nationkey, s_name FROM supplier) SELECT nation, name FROM u QUALIFY row_number() OVER (PARTITION BY nation ORDER BY t, name) = 1")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    c, s = (V.read(spark, d, t).select(F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_name").alias("name")) for t, p in (("customer", "c"), ("supplier", "s")))
    return files.first_wins([c, s], "nation", "name")


simple("A33_cost", V.clips, lambda c: planning.cost(c.sparkSession, c.select(F.col("duration").alias("seconds")), 3), "SELECT model, round(sum(duration) / 60 * 3 * minute + 0.5 * count(*) * 3 * tokens, 4) AS usd FROM v_clip , (VALUES ('gemini', 0.0125::DOUBLE, 0.0050::DOUBLE), ('openai', 0.10::DOUBLE, 0.020::DOUBLE)) t(model, minute, tokens) GROUP BY model, minute, tokens")


# texts


@query("T5_signals", r"""WITH b AS (SELECT item_id, trim(regexp_replace(regexp_replace(text, '[.,!?;:"''()\[\]\-–—…״׳]', ' ', 'g'), '\s+', ' ', 'g')) AS r, text FROM benchmark), h AS (SELECT *, r || ' ' || r AS hyp FROM b),
g AS (SELECT item_id, string_split(r, ' ') AS w, string_split(hyp, ' ') AS v FROM h), x AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS t FROM g WHERE len(w) >= 3), y AS (SELECT item_id, unnest(list_transform(range(1, len(v) - 1), lambda i: array_to_string(v[i:i + 2], ' '))) AS t FROM g WHERE len(v) >= 3),
mx AS (SELECT item_id, max(n) AS n FROM (SELECT item_id, t, count(*) AS n FROM x GROUP BY ALL) GROUP BY item_id), my AS (SELECT item_id, max(n) AS n FROM (SELECT item_id, t, count(*) AS n FROM y GROUP BY ALL) GROUP BY item_id)
SELECT g.item_id, round(len(v) / greatest(len(w), 1), 6) AS length_ratio, CAST(coalesce(my.n, 0) AS INT) AS hyp_repeat, CAST(coalesce(mx.n, 0) AS INT) AS ref_repeat, round(coalesce(my.n, 0) / greatest(coalesce(mx.n, 0), 1), 6) AS repeat_ratio, 1 AS rtl_marks FROM g LEFT JOIN mx USING (item_id) LEFT JOIN my USING (item_id)""")
def signals(spark: SparkSession, d: str) -> DataFrame:
    rows = V.read(spark, d, "benchmark").select("item_id", "text", F.concat_ws(" ", "text", F.lit("‏"), "text").alias("hyp"))
    length, hyp, ref, repeat, marks = text.hallucination_signals(F.col("text"), F.col("hyp"))
    return rows.select("item_id", F.round(length, 6).alias("length_ratio"), hyp, ref, F.round(repeat, 6).alias("repeat_ratio"), marks)


@query("F8_off_length", "SELECT event_id, value / 100 < 0.95 OR value / 100 > 1.04 AS off FROM events")
def off_length(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "events").select("event_id", evaluation.off_length(F.col("value") / 100).alias("off"))


@query("T15_parse_response", "SELECT conv_id, turn, text, CAST(CASE WHEN turn % 3 = 0 THEN 1 ELSE turn % 5 + 1 END AS INT) AS intensity, CASE WHEN turn % 2 = 0 THEN 0.3 ELSE 0.7 END::DOUBLE AS pause, 'neutral' AS emotion FROM conversations WHERE conv_id % 7 <> 0")
def responses(spark: SparkSession, d: str) -> DataFrame:
    turn = F.struct(F.lit("a").alias("speaker_id"), "text", F.when(F.col("turn") % 3 != 0, F.col("turn") % 5 + 1).alias("intensity"), F.when(F.col("turn") % 2 != 0, 0.7).alias("pause_before_s"))
    rows = V.read(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct(F.array(turn).alias("turns"))).alias("json"))
    raw = F.when(F.col("conv_id") % 7 == 0, F.lit("no json")).when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), "json", F.lit("\n```\n"))).otherwise(F.col("json"))
    return rows.select("conv_id", "turn", F.explode(text.response_turns(raw)).alias("t")).select("conv_id", "turn", "t.text", "t.intensity", F.col("t.pause_before_s").alias("pause"), F.col("t.emotional_state").alias("emotion"))


@query("K9_transcript", "SELECT 'c' || scene AS clip_id, '[CLIP_ID: c' || scene || E']\\n' || string_agg('[SPEAKER: ' || speaker || ' | ROLE: ' || role || ' | ONSET: ' || printf('%.2f', idx / 4.0) || ' | OFFSET: ' || printf('%.2f', idx / 4.0 + 1) || E']\\n' || text || E'\\n[ACTION: X | INTENSITY: ' || intensity || ']', E'\\n' ORDER BY idx) || E'\\n' AS value FROM v_turn GROUP BY scene")
def transcripts(spark: SparkSession, d: str) -> DataFrame:
    t = V.turns(spark, d)
    rows = t.select(F.concat(F.lit("c"), F.col("scene").cast("string")).alias("clip_id"), "idx", F.col("speaker").alias("speaker_id"), "role", (F.col("idx") / 4.0).alias("onset"), (F.col("idx") / 4.0 + 1).alias("offset"), "text", F.lit("X").alias("action"), "intensity")
    return sinks.transcript_texts(rows)


@rows_only("T4_word_errors")
def word_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = V.read(spark, d, "benchmark").select("item_id", F.col("text").alias("reference"), F.regexp_replace("text", r" (\w+) (\w+)$", " $2 $1").alias("hypothesis"))
    return evaluation.transcript_errors(rows).select("item_id", "ref_words", "hyp_words", F.round("wer", 6).alias("wer"), F.round("cer", 6).alias("cer"))


@rows_only("T6_disfluency")
def disfluency(spark: SparkSession, d: str) -> DataFrame:
    draw = lambda k: dims.uniform(F.lit("42"), F.col("doc_id").cast("string"), k.cast("string"))
    return V.read(spark, d, "documents").select("doc_id", text.disfluent(F.col("text"), 0.1, draw).alias("text"))


@rows_only("T7_T9_disambiguation")
def disambiguation(spark: SparkSession, d: str) -> DataFrame:
    said = F.get(F.array(*[F.lit(s) for s in ("זה שלך", "אני הולך אליך עכשיו", "שלום")]), (F.col("idx") % 3).cast("int"))
    turns = V.turns(spark, d).withColumn("text", said)
    heard = labels.addressee(turns).join(turns, ["scene", "role"])
    spoken, rules = text.disambiguated(F.col("text"), F.when(F.col("addressee") == "AGG", "male").when(F.col("addressee") == "VIC", "female"))
    return heard.select("scene", "idx", spoken.alias("spoken"), rules.alias("rules")).withColumn("left", F.size(text.ambiguities(F.col("spoken")))).withColumn("rules", F.array_join("rules", ","))


@query("H3_file_hash", "SELECT page_id, sha256(html) AS sha256 FROM pages")
def hashes(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("sha256"))


@query("T10_sanitized", r"SELECT page_id, length(regexp_replace(html || chr(7) || chr(31), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS n FROM pages")
def sanitized(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace(F.concat("html", F.lit("\x07\x1f")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return V.read(spark, d, "pages").select("page_id", F.length(bare).cast("long").alias("n"))


# signals


def _x(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "embeddings").select("vec_id", F.expr("transform(embedding, v -> CAST(v AS DOUBLE) * (1 + vec_id % 7))").alias("x"))


X = "xs AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE) * (1 + vec_id % 7)) AS x FROM embeddings)"


def weighed(x: Column) -> Column:
    """A sum that tells positions apart."""
    return F.round(F.aggregate(F.zip_with(x, F.sequence(F.lit(1), F.size(x)), lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v), 6)


WEIGHED = "round(list_sum(list_transform({}, lambda v, i: v * i)), 6)"


@query("D12_fades", f"WITH {X} SELECT vec_id, {WEIGHED.format('list_transform(x, lambda v, i: v * CASE WHEN i <= 10 THEN (i - 1) / 9 WHEN i > 54 THEN (64 - i) / 9 ELSE 1 END)')} AS total FROM xs")
def fades(spark: SparkSession, d: str) -> DataFrame:
    return _x(spark, d).select("vec_id", weighed(signal.faded(F.col("x"), 10)).alias("total"))


@query("D16_tile", f"WITH {X} SELECT vec_id, {WEIGHED.format('list_concat(x, list_concat(x, x[1:22]))')} AS total FROM xs")
def tile(spark: SparkSession, d: str) -> DataFrame:
    return _x(spark, d).select("vec_id", weighed(signal.tiled(F.col("x"), 150)).alias("total"))


@query("D8_pad", f"WITH {X} SELECT vec_id, CAST(len(x) + 16 AS INT) AS n, round(list_sum(list_transform(x, lambda v, i: v * (i + 8))), 6) AS total FROM xs")
def padded(spark: SparkSession, d: str) -> DataFrame:
    return _x(spark, d).select("vec_id", F.size(signal.padded(F.col("x"), 8)).alias("n"), weighed(signal.padded(F.col("x"), 8)).alias("total"))


@query("D18_onset", "SELECT event_id, round(greatest(0, least(CASE event_id % 4 WHEN 0 THEN value / 10 WHEN 1 THEN 0.65 * value WHEN 2 THEN 0.5 * value ELSE 0 END + CASE WHEN event_id % 3 = 0 THEN -1 ELSE 0 END, value - 0.1)), 6) AS onset FROM events")
def onsets(spark: SparkSession, d: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    phase = F.when(k % 4 == 1, "peak").when(k % 4 == 2, "odd")
    return V.read(spark, d, "events").select("event_id", F.round(planning.onset(v, F.when(k % 4 == 0, v / 10), phase, F.when(k % 3 == 0, -1.0)), 6).alias("onset"))


@query("D26_restored", f"WITH {X} SELECT vec_id, round(list_sum(list_transform(x[5:56], lambda v, i: v * (i + 4))), 6) AS total FROM xs")
def restored(spark: SparkSession, d: str) -> DataFrame:
    out = map_rows(_x(spark, d), ["x"], "y array<double>", lambda x: (dsp.restored(x, 60, 4).tolist(),))
    return out.select("vec_id", weighed(F.col("y")).alias("total"))


@query("D10_D15_gain", f"WITH {X}, r AS (SELECT *, sqrt(list_sum(list_transform(x, lambda v: v * v)) / 64) AS level FROM xs) SELECT vec_id, {WEIGHED.format('list_transform(x, lambda v: v * (0.1 / level))')} AS total, round(20 * log10(level / 0.05), 6) AS snr FROM r")
def gain(spark: SparkSession, d: str) -> DataFrame:
    import numpy as np

    out = map_rows(_x(spark, d), ["x"], "y array<double>, snr double", lambda x: (dsp.rms_gain(np.array(x), -20.0).tolist(), dsp.snr_db(np.array(x), np.full(9, 0.05))))
    return out.select("vec_id", weighed(F.col("y")).alias("total"), F.round("snr", 6).alias("snr"))


@query("W10_steps", f"WITH {X}, p AS (SELECT vec_id, list_concat(list_concat(list_transform(range(4), lambda i: 0.0::DOUBLE), x), list_transform(range(4), lambda i: 0.0::DOUBLE)) AS z FROM xs) SELECT vec_id, round(list_max(list_transform(range(1, 65), lambda i: abs(list_sum(z[i + 5:i + 8]) - list_sum(z[i:i + 3])) / 4)), 6) AS most FROM p")
def steps(spark: SparkSession, d: str) -> DataFrame:
    return map_rows(_x(spark, d), ["x"], "most double", lambda x: (float(dsp.steps(x, 100).max()),)).select("vec_id", F.round("most", 6).alias("most"))


def _signal(name: str, work) -> None:
    """A query that gives the level of each embedding's signal, a second of it, after an operation without a form in SQL."""
    import numpy as np

    rows_only(name)(lambda spark, d: map_rows(_x(spark, d), ["x", "vec_id"], "level double", lambda x, k: (round(dsp.rms(np.asarray(work(dsp.fitted(np.array(x), 16_000) * 0.1, k))), 6),)).select("vec_id", "level"))


_signal("D5_resample", lambda x, k: dsp.resampled(x, 16_000, 24_000))
_signal("D6_highpass", lambda x, k: dsp.filtered(x, dsp.butterworth("high", 2, 80.0, 16_000)))
_signal("D7_wiener", lambda x, k: dsp.wiener(x))
_signal("D9_preprocess", lambda x, k: dsp.preprocessed(x[None], 24_000)[0])
_signal("D11_lombard", lambda x, k: dsp.lombard(x, 1 + k % 5))
_signal("D20_room", lambda x, k: dsp.in_room(x, 16_000, sorted(dsp.ROOMS)[k % 6], 1.5, k))
_signal("D21_device", lambda x, k: dsp.through_device(x, 16_000, sorted(dsp.DEVICE_COLOURS)[k % 4]))
_signal("D17_D19_D22_augment", lambda x, k: dsp.augmented(x, 16_000, {"room_type": "living_room", "device": "phone_on_table", "speaker_distance_meters": 1.5, "snr_target_db": 15.0, "background_events": [{"type": "hvac_hum", "loop": True}, {"type": "ACOU_SLAM", "onset_at_phase": "peak", "level_db": -6.0}]}, k, dict(dims.PHASES))[0])
_signal("D23_breathiness", lambda x, k: dsp.breathy(x, 16_000, 0.5, k))
_signal("D30_D31_D33_degraded", lambda x, k: dsp.degraded(x, 16_000, *[("white_noise", -10.0), ("lowpass", 3400.0), ("slow_rate", 0.85)][k % 3], seed=k))
_signal("D32_matched", lambda x, k: dsp.matched(x * 3, x)[0])


@rows_only("D24_D28_measures")
def measures(spark: SparkSession, d: str) -> DataFrame:
    import numpy as np

    def work(x: list[float]) -> tuple:
        y = dsp.fitted(np.array(x), 16_000) * 0.1
        return *dsp.measured(y, 16_000, 0.1, 0.9), dsp.longest_voiced(y, 16_000), dsp.speech_end(y), dsp.gate(y, 16_000, "male")[1]

    return map_rows(_x(spark, d), ["x"], "f0 double, f0_std double, rms_db double, lufs_db double, voiced double, speech_end int, failed string", work).drop("x")


# evaluation

simple("A30_run_scores", lambda s, d: V.read(s, d, "events").select(F.col("event_type").alias("run"), (F.col("value") / 490).alias("wer"), (F.col("value") / 980 + F.col("event_id") % 7).alias("cer")), evaluation.run_scores,
       "SELECT event_type AS run, round(avg(value / 490), 6) AS mean_wer, round(avg(value / 980 + event_id % 7), 6) AS mean_cer, round(median(value / 490), 6) AS median_wer, round(median(value / 980 + event_id % 7), 6) AS median_cer FROM events GROUP BY 1")
simple("L7_best_run", lambda s, d: QUERIES["A30_run_scores"](s, d), evaluation.best_run, "SELECT arg_min(run, m) AS run FROM (SELECT event_type AS run, median(value / 490) AS m FROM events GROUP BY 1)")


@query("A31_separations", "SELECT l_returnflag AS kind, round(avg(l_discount * 40), 6) AS mean_score, round(avg(o_totalprice / 100000) - avg(l_discount * 40), 6) AS separation, avg(o_totalprice / 100000) - avg(l_discount * 40) >= 0.5 AS passed FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def separations(spark: SparkSession, d: str) -> DataFrame:
    clean = V.read(spark, d, "orders").select(F.col("o_orderkey").alias("clip"), (F.col("o_totalprice") / 100000).alias("score"))
    return evaluation.separations(clean, V.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip"), F.col("l_returnflag").alias("kind"), (F.col("l_discount") * 40).alias("score")))


REASON = "CASE WHEN event_id % 11 = 0 THEN 'content_refusal' WHEN event_id % 13 = 0 THEN 'api_error' ELSE 'ok' END"


def _judged(spark: SparkSession, d: str) -> DataFrame:
    scores = "CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN map('overall_quality', CAST(1 + user_id % 5 AS INT), 'escalation_arc', CAST(1 + event_id % 4 AS INT)) END"
    return V.read(spark, d, "events").selectExpr("event_type AS model", "user_id % 10 AS clip", "CASE WHEN event_id % 4 = 0 THEN 'no_arc' ELSE 'with_metadata' END AS variant", f"{REASON} AS reason", f"{scores} AS scores")


JUDGED = f"j AS (SELECT event_type AS model, user_id % 10 AS clip, CASE WHEN event_id % 4 = 0 THEN 'no_arc' ELSE 'with_metadata' END AS variant, {REASON} AS reason, event_id % 11 <> 0 AND event_id % 13 <> 0 AS scored, CAST(1 + user_id % 5 AS INT) AS q, CAST(1 + event_id % 4 AS INT) AS e, CASE WHEN user_id % 10 < 6 THEN 'corpus' ELSE 'degraded' END AS kind, CASE user_id % 10 WHEN 8 THEN 'wn_snr_-10db' WHEN 9 THEN 'synth_rate_slow_0.85x' END AS degradation FROM events)"


@query("A32_gates", f"""WITH {JUDGED}, w AS (SELECT * FROM j WHERE variant = 'with_metadata'), h AS (SELECT model, count(DISTINCT clip) FILTER (scored) AS scored, count(*) FILTER (reason = 'content_refusal') AS refusals FROM w GROUP BY 1),
p AS (SELECT model, clip, kind, degradation, avg(q) AS q, stddev_pop(q) AS sq, stddev_pop(e) AS se, count(*) AS n FROM w WHERE scored GROUP BY ALL),
g AS (SELECT model, avg(q) FILTER (kind = 'corpus') AS corpus_mean, avg(q) FILTER (kind = 'corpus') - avg(q) FILTER (degradation = 'wn_snr_-10db') AS noise_gap, avg(q) FILTER (kind = 'corpus') - avg(q) FILTER (degradation LIKE 'synth_rate_slow_%') AS rate_gap, coalesce(max(greatest(sq, se)) FILTER (n >= 2), 0) AS sd FROM p GROUP BY 1)
SELECT model, scored, refusals, round(corpus_mean, 6) AS corpus_mean, round(noise_gap, 6) AS noise_gap, round(rate_gap, 6) AS rate_gap, round(sd, 6) AS max_deviation, scored >= 5 AS refusal_pass, coalesce(noise_gap >= 0.5, false) OR coalesce(rate_gap >= 0.5, false) AS discrimination_pass, sd <= 0.5 AS variance_pass,
scored >= 5 AND (coalesce(noise_gap >= 0.5, false) OR coalesce(rate_gap >= 0.5, false)) AS overall_pass FROM h LEFT JOIN g USING (model)""")
def gates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("id")
    clips = spark.range(10).select(k.alias("label"), F.when(k < 6, "corpus").otherwise("degraded").alias("kind"), F.when(k == 8, "wn_snr_-10db").when(k == 9, "synth_rate_slow_0.85x").alias("degradation"))
    return evaluation.gates(clips, _judged(spark, d))


@query("J20_metadata_bias", f"WITH {JUDGED}, b AS (SELECT model, clip, avg(e) FILTER (variant = 'with_metadata') AS a, avg(e) FILTER (variant = 'no_arc') AS b FROM j WHERE scored GROUP BY ALL) SELECT model, clip, 'escalation_arc' AS dim, round(a, 2) AS with_metadata, round(b, 2) AS no_arc, round(a - b, 2) AS delta FROM b WHERE a IS NOT NULL AND b IS NOT NULL")
def bias(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.metadata_bias(_judged(spark, d))


@query("E4_speaker_similarity", """WITH e AS (SELECT label AS speaker, embedding AS v, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm FROM embeddings), p AS (SELECT speaker, generate_subscripts(v, 1) AS i, unnest(v) / norm AS x FROM e),
s AS (SELECT speaker, i, sum(x) AS x FROM p GROUP BY ALL), a AS (SELECT i, sum(x) AS y FROM s GROUP BY i), d AS (SELECT speaker, sum(x * x) AS own, sum(x * y) AS every FROM s JOIN a USING (i) GROUP BY 1), n AS (SELECT speaker, count(*) AS n FROM e GROUP BY 1)
SELECT speaker, n, round((own - n) / (n * (n - 1)), 6) AS inside, round((every - own) / (n * ((SELECT count(*) FROM e) - n)), 6) AS between FROM d JOIN n USING (speaker)""")
def similarity(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.speaker_similarity(V.read(spark, d, "embeddings").select(F.col("label").alias("speaker"), F.expr("transform(embedding, v -> CAST(v AS DOUBLE))").alias("vector")))


HEARD_AS = "SELECT emotion AS expected, CASE WHEN event_id % 5 = 0 THEN 'calm' ELSE emotion END AS heard FROM v_event "
_heard = lambda s, d: V.events(s, d).selectExpr("emotion AS expected", "CASE WHEN event_id % 5 = 0 THEN 'calm' ELSE emotion END AS heard")
simple("E3_confusion", _heard, evaluation.confusion, f"SELECT expected, heard, count(*) AS n FROM ({HEARD_AS}) GROUP BY ALL")
simple("E3_recalls", _heard, evaluation.recalls, f"SELECT expected, count(*) AS n, round(count(*) FILTER (expected = heard) / count(*), 6) AS recall FROM ({HEARD_AS}) GROUP BY 1")
BOUNDS = [("she_proves", "IT", 0.1, 0.3), ("she_proves", "NEU", 0.0, 0.2), ("elephant_in_the_room", "SV", 0.3, 0.4)]
simple("E_class_balance", V.clips, lambda c: evaluation.class_balance(c, c.sparkSession.createDataFrame(BOUNDS, "project string, typology string, low double, high double")),
       f"WITH s AS (SELECT project, typology, count(*) / sum(count(*)) OVER (PARTITION BY project) AS share FROM v_clip GROUP BY project, typology) SELECT project, typology, round(coalesce(share, 0), 6) AS share, coalesce(share, 0) BETWEEN low AND high AS inside FROM {dims.values(BOUNDS, 'project, typology, low, high')} b LEFT JOIN s USING (project, typology)")
simple("E_stratified_splits", V.clips, lambda c: evaluation.stratified_splits(c, ["project", "typology", "tier"]),
       "WITH r AS (SELECT clip, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY project, typology, tier) AS n FROM v_clip WINDOW w AS (PARTITION BY project, typology, tier ORDER BY md5('42|' || clip), clip)) SELECT clip, CASE WHEN place < round_even(n * 0.7, 0) THEN 'train' WHEN place < round_even(n * 0.7, 0) + round_even(n * 0.15, 0) THEN 'val' ELSE 'test' END AS split FROM r")
simple("E_confusor_coverage", V.clips, lambda c: evaluation.confusor_coverage(c.withColumn("kind", F.col("typology"))), "SELECT count(*) FILTER (tier = 'C') >= 0.2 * count(*) AS covered, (SELECT count(*) FROM (SELECT typology, count(*) AS n FROM v_clip WHERE tier = 'C' AND split = 'train' GROUP BY 1) WHERE n < 50) AS thin FROM v_clip ")


@rows_only("C8_render_scenes")
def rendered(spark: SparkSession, d: str) -> DataFrame:
    turns = V.turns(spark, d).select("scene", "idx", "speaker", "role", "intensity", F.lit("שלום לך").alias("spoken"), F.lit("voice").alias("voice"), F.lit("angry").alias("style"), F.lit(None).cast(f"{qa_run.ssml.PHRASES}").alias("phrases"))
    return qa_run.render_scenes(turns, audio=False).select("scene", "idx", "mode", "samples", "onset", "offset", "hit")

