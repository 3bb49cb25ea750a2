"""Registered queries: operator on a view, and the same rows in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auralith import dims
from auralith.functions import signal, text
from auralith.operators import graph, iaa, labels, qa, timeline
from auralith.sources import views as V
from auralith.streaming import windows

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name], SQL[name] = f, V.with_views(sql)
        return f

    return register


def simple(name: str, view, operator, sql: str) -> None:
    query(name, sql)(lambda spark, d: operator(view(spark, d)))


STATS = "SELECT role, intensity, count(*) AS n_turns, round(median(f0), 6) AS f0_median, round(avg(f0_std), 6) AS f0_std_mean, round(avg(rms), 6) AS rms_mean, round(avg(lufs), 6) AS lufs_mean FROM {} GROUP BY role, intensity"
simple("A12_role_intensity_stats", V.turn_metrics, qa.role_intensity_stats, STATS.format("v_turn_metrics "))
simple("A12b_role_intensity_stats_big", V.turn_metrics_big, qa.role_intensity_stats, STATS.format("v_turn_metrics_big "))
simple("A23_threshold_checks", V.turn_metrics, lambda m: qa.threshold_checks(qa.role_intensity_stats(m)), """
WITH o AS (SELECT median(f0) FILTER (role = 'VIC' AND intensity = 1) AS v1, median(f0) FILTER (role = 'VIC' AND intensity = 4) AS v4, median(f0) FILTER (role = 'VIC' AND intensity = 5) AS v5,
  avg(rms) FILTER (role = 'AGG' AND intensity = 5) - avg(rms) FILTER (role = 'AGG' AND intensity = 1) AS g FROM v_turn_metrics )
SELECT 'vic_i1_f0' AS name, round(v1, 6) AS value, coalesce(v1 <= 200, false) AS passed FROM o UNION ALL SELECT 'vic_i4_f0', round(v4, 6), coalesce(v4 < 250, false) FROM o
UNION ALL SELECT 'vic_i5_f0', round(v5, 6), coalesce(v5 < 250, false) FROM o UNION ALL SELECT 'agg_gain', round(g, 6), coalesce(g >= 8, false) FROM o""")
OVERLAP = "SELECT clip, coalesce(bool_or(onset_us < latest), false) AS has_overlap FROM (SELECT clip, onset_us, max(offset_us) OVER (PARTITION BY clip ORDER BY onset_us, offset_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM v_event {}) GROUP BY clip"
simple("W1_clip_overlap", V.events, qa.clip_overlap, OVERLAP.format(""))
simple("W2_outlier_clips", V.turn_metrics, qa.outlier_clips, """
WITH s AS (SELECT *, avg(f0) OVER w AS fm, stddev_pop(f0) OVER w AS fs, count(f0) OVER w AS fn, avg(rms) OVER w AS rm, stddev_pop(rms) OVER w AS rs, count(rms) OVER w AS rn FROM v_turn_metrics WINDOW w AS (PARTITION BY role, intensity))
SELECT DISTINCT clip FROM s WHERE (fn >= 2 AND fs > 0 AND abs(f0 - fm) > 2 * fs) OR (rn >= 2 AND rs > 0 AND abs(rms - rm) > 2 * rs)""")
WARN = """w AS (SELECT clip, avg(rms) FILTER (role = 'AGG' AND intensity = 5) - avg(rms) FILTER (role = 'AGG' AND intensity = 1) AS g, bool_or(role = 'VIC' AND intensity >= 4 AND coalesce(f0 > 250, false)) AS h FROM v_turn_metrics GROUP BY clip),
f AS (SELECT clip, 'agg_no_escalation' AS flag FROM w WHERE round(g, 9) < 6 UNION ALL SELECT clip, 'vic_f0_high' FROM w WHERE h)"""
simple("A13_A14_acoustic_warnings", V.turn_metrics, qa.acoustic_warnings, f"WITH {WARN} SELECT clip, flag FROM f")
simple("A9_warning_histogram", V.turn_metrics, qa.warning_histogram, f"WITH {WARN} SELECT flag, count(*) AS clips FROM f GROUP BY flag")
DOWN = "SELECT clip, count(*) FILTER (emotion = 'neutral') > count(*) FILTER (intensity <= 2) AS flagged, bool_or(intensity >= 4) AS loud FROM v_event WHERE role IS NOT NULL GROUP BY clip"
simple("A15_emotion_downgrade", V.events, qa.emotion_downgrade, f"SELECT clip, flagged FROM ({DOWN})")
STRUCTURE = f"d AS ({DOWN}), o AS ({OVERLAP.format('WHERE role IS NOT NULL')}), st AS (SELECT clip, loud, flagged, loud AND has_overlap AS has_overlap FROM d JOIN o USING (clip))"
RATIO = f"{STRUCTURE}, valid AS (SELECT DISTINCT clip FROM v_event ), r AS (SELECT count(*) FILTER (loud) AS clips_i4, round(coalesce(count(*) FILTER (has_overlap) / nullif(count(*) FILTER (loud), 0), 0), 6) AS overlap_ratio, round(coalesce(count(*) FILTER (flagged) / nullif(count(*), 0), 0), 6) AS downgrade_ratio FROM valid LEFT JOIN st USING (clip))"
simple("A11_overlap_and_downgrade_ratio", V.events, lambda e: qa.overlap_and_downgrade_ratio(e, e.select("clip").distinct()), f"WITH {RATIO} SELECT * FROM r")
simple("A9_structural_histogram", V.events, lambda e: qa.structural_warnings(e).groupBy("flag").agg(F.count("*").alias("clips")), f"WITH {STRUCTURE} SELECT 'warn_no_overlap' AS flag, count(*) AS clips FROM st WHERE loud AND NOT has_overlap HAVING count(*) > 0 UNION ALL SELECT 'warn_emotion_downgrade', count(*) FROM st WHERE flagged HAVING count(*) > 0")
simple("A1_dataset_totals", V.clips, qa.dataset_totals, "SELECT count(*) AS clips, round(sum(duration), 6) AS seconds, round(sum(duration) / 3600, 6) AS hours FROM v_clip ")
simple("A10_failure_rate", V.clips, lambda c: qa.failure_rate(c.select((F.col("duration") >= 3).alias("is_valid"))), "SELECT round(count(*) FILTER (duration < 3) / count(*), 6) AS failure_rate, count(*) FILTER (duration < 3) / count(*) <= 0.02 AS passed FROM v_clip ")
simple("A2_histograms", V.clips, qa.histograms, "SELECT 'typology' AS dim, typology AS key, count(*) AS clips FROM v_clip GROUP BY 2 UNION ALL SELECT 'tier', tier, count(*) FROM v_clip GROUP BY 2 UNION ALL SELECT 'split', split, count(*) FROM v_clip GROUP BY 2 UNION ALL SELECT 'max_intensity', CAST(max_intensity AS VARCHAR), count(*) FROM v_clip GROUP BY 2")
BACKENDS = "be AS (SELECT DISTINCT clip, unnest(CASE WHEN tts_backend IS NULL OR cardinality(tts_backend) = 0 THEN ['unknown'] ELSE map_values(tts_backend) END) AS backend FROM v_clip_backend )"
simple("A7_backend_histogram", V.clip_backends, qa.backend_histogram, f"WITH {BACKENDS} SELECT backend, count(*) AS clips FROM be GROUP BY backend")
simple("A4_flagged_clips", V.clip_flags, qa.flagged_clips, "SELECT clip, array_to_string(quality_flags, ',') AS flags FROM v_clip_flags WHERE len(quality_flags) > 0")
simple("A5_cap_activations", V.clips, qa.cap_activations, "SELECT count(*) FILTER (n_caps > 0) AS clips, CAST(sum(n_caps) AS BIGINT) AS caps FROM v_clip ")
simple("A6_missing_labels", V.clips, qa.missing_labels, "SELECT count(*) FILTER (NOT has_strong_labels) AS clips FROM v_clip ")
HISTOGRAMS = "SELECT 'typology' AS dim, typology AS key, count(*) AS clips FROM v_clip GROUP BY 2 UNION ALL SELECT 'tier', tier, count(*) FROM v_clip GROUP BY 2 UNION ALL SELECT 'split', split, count(*) FROM v_clip GROUP BY 2 UNION ALL SELECT 'max_intensity', CAST(max_intensity AS VARCHAR), count(*) FROM v_clip GROUP BY 2"
simple("A34_card_shares", V.clips, qa.card_shares, f"WITH h AS ({HISTOGRAMS}) SELECT dim, key, clips, printf('%.1f%%', round_even(100.0 * clips / (SELECT count(*) FROM v_clip ), 1)) AS share FROM h")
simple("A25_summary", V.clips, lambda c: qa.counts_by(c, "typology", "split"), "SELECT 'typology' AS dim, typology AS key, count(*) AS n FROM v_clip GROUP BY 2 UNION ALL SELECT 'split', split, count(*) FROM v_clip GROUP BY 2")
simple("A3_distinct_speakers", V.clip_speakers, qa.distinct_speakers, "SELECT count(DISTINCT speaker) AS speakers, count(DISTINCT clip) AS clips FROM v_clip_speaker ")
VOICES = "SELECT CASE WHEN speaker % 2 = 0 THEN 'female' ELSE 'male' END AS gender, count(DISTINCT speaker) AS voices FROM v_clip_speaker GROUP BY 1"
simple("A8_voices_by_gender", V.clip_speakers, qa.voices_by_gender, VOICES)


@query("A24_run_warnings", f"""WITH {WARN}, {RATIO}, v AS ({VOICES}), {BACKENDS}, one AS (SELECT clips_i4, overlap_ratio, downgrade_ratio, coalesce((SELECT voices FROM v WHERE gender = 'male'), 0) AS male, coalesce((SELECT voices FROM v WHERE gender = 'female'), 0) AS female,
  (SELECT count(DISTINCT backend) FROM be) AS backends, (SELECT count(DISTINCT clip) FROM f) AS warned, (SELECT count(*) FROM valid) AS total FROM r)
SELECT unnest(list_filter([CASE WHEN total > 0 AND male < 3 THEN 'low_voice_diversity_male' END, CASE WHEN total > 0 AND female < 3 THEN 'low_voice_diversity_female' END, CASE WHEN total > 0 AND backends <= 1 THEN 'single_backend' END,
  CASE WHEN clips_i4 > 0 AND overlap_ratio = 0 THEN 'zero_overlap' END, CASE WHEN downgrade_ratio > 0.05 THEN 'high_emotion_downgrade' END, CASE WHEN total > 0 AND warned / total > 0.10 THEN 'high_warning_rate' END], lambda x: x IS NOT NULL)) AS warning FROM one""")
def run_warnings(spark: SparkSession, d: str) -> DataFrame:
    events = V.events(spark, d)
    clips = events.select("clip").distinct()
    return qa.run_warnings(qa.voices_by_gender(V.clip_speakers(spark, d)), qa.clip_backends(V.clip_backends(spark, d)), qa.overlap_and_downgrade_ratio(events, clips), qa.acoustic_warnings(V.turn_metrics(spark, d)), clips)


KAPPA = "c AS (SELECT {g} a, b, count(*) AS n FROM p GROUP BY ALL), t AS (SELECT {g} sum(n) AS n, sum(n) FILTER (a = b) AS s FROM c GROUP BY ALL), ra AS (SELECT {g} a AS k, sum(n) AS x FROM c GROUP BY ALL), rb AS (SELECT {g} b AS k, sum(n) AS y FROM c GROUP BY ALL), e AS (SELECT {g} sum(x * y) AS e FROM ra JOIN rb USING ({g} k) GROUP BY ALL)"
FINAL = "CASE WHEN e / n / n >= 1 THEN 0 ELSE round((coalesce(s, 0) / n - coalesce(e, 0) / n / n) / (1 - coalesce(e, 0) / n / n), 6) END"


@query("A17_cohen_kappa", "WITH p AS (SELECT quality AS a, toxic AS b FROM labels), " + KAPPA.format(g="") + f" SELECT {FINAL} AS kappa, CAST(n AS BIGINT) AS n FROM t, e")
def cohen(spark: SparkSession, d: str) -> DataFrame:
    return iaa.cohen_kappa(V.read(spark, d, "labels").select(F.col("quality").alias("a"), F.col("toxic").alias("b")))


SHIFTED = "SELECT intensity AS a, greatest(1, least(5, intensity + CAST(event_id % 3 AS INT) - 1)) AS b FROM v_event "


@query("A18_weighted_kappa", f"WITH p AS ({SHIFTED}), c AS (SELECT a, b, count(*) AS n FROM p GROUP BY ALL), ra AS (SELECT a, sum(n) AS x FROM c GROUP BY a), rb AS (SELECT b, sum(n) AS y FROM c GROUP BY b), s AS (SELECT sum(n) AS n, sum(n * CASE WHEN abs(a - b) <= 1 THEN 1.0 ELSE greatest(0.0, 1 - (abs(a - b) - 1) / 3.0) END::DOUBLE) AS seen FROM c), e AS (SELECT sum(x * y * CASE WHEN abs(a - b) <= 1 THEN 1.0 ELSE greatest(0.0, 1 - (abs(a - b) - 1) / 3.0) END::DOUBLE) AS e FROM ra, rb) SELECT round((seen / n - e / n / n) / (1 - e / n / n), 6) AS kappa, CAST(n AS BIGINT) AS n FROM s, e")
def weighted(spark: SparkSession, d: str) -> DataFrame:
    return iaa.weighted_kappa(V.events(spark, d).selectExpr("intensity AS a", "greatest(1, least(5, intensity + CAST(event_id % 3 AS INT) - 1)) AS b"))


def _annotators(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = V.events(spark, d)
    return e, e.where("event_id % 7 <> 0")


PRESENT = "k AS (SELECT unnest(['PHYS', 'VERB', 'DIST', 'ACOU', 'EMOT']) AS category), p AS (SELECT clip, category, CAST(bool_or(tier1 = category) AS INT) AS a, CAST(coalesce(bool_or(tier1 = category) FILTER (event_id % 7 <> 0), false) AS INT) AS b FROM v_event , k GROUP BY ALL)"


POSITIONAL = "pa AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY event_id) - 1 AS pos, intensity AS a FROM v_event ), pb AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY event_id) - 1 AS pos, intensity AS b FROM v_event WHERE event_id % 7 <> 0), pp AS (SELECT a, b FROM pa JOIN pb USING (clip, pos))"
WEIGHT = "CASE WHEN abs(a - b) <= 1 THEN 1.0 ELSE greatest(0.0, 1 - (abs(a - b) - 1) / 3.0) END::DOUBLE"
REPORT = f"""{PRESENT}, {KAPPA.format(g="category,")}, q AS (SELECT category, {FINAL} AS kappa, CAST(n AS BIGINT) AS n FROM t LEFT JOIN e USING (category)), {POSITIONAL},
iw AS (SELECT count(*) AS n, sum({WEIGHT}) AS seen FROM pp), ia AS (SELECT a, count(*) AS x FROM pp GROUP BY a), ib AS (SELECT b, count(*) AS y FROM pp GROUP BY b), ie AS (SELECT sum(x * y * {WEIGHT}) AS e FROM ia, ib),
kk AS (SELECT * FROM q UNION ALL SELECT 'INTENS', round((seen / n - e / n / n) / (1 - e / n / n), 6), n FROM iw, ie), rep AS (SELECT category, kappa, n, target, least, kappa >= target AS meets_target, kappa >= least AS meets_min FROM kk JOIN {dims.values(iaa.THRESHOLDS, "category, target, least")} th USING (category))"""


@query("A20_iaa_report", f"WITH {REPORT} SELECT * FROM rep")
def report(spark: SparkSession, d: str) -> DataFrame:
    return iaa.iaa_report(*_annotators(spark, d), "event_id")


@query("A21_iaa_verdict", f"WITH {REPORT}, rv AS (SELECT count(DISTINCT clip) AS reviewed FROM v_event ), m AS (SELECT bool_and(meets_min) AS ok FROM rep) SELECT reviewed AS clips_reviewed, round(reviewed / (SELECT count(*) FROM v_clip ), 6) AS coverage, reviewed / (SELECT count(*) FROM v_clip ) >= 0.2 AS meets_coverage, ok AS all_meet_min, ok AND reviewed / (SELECT count(*) FROM v_clip ) >= 0.2 AS passes FROM rv, m")
def verdict(spark: SparkSession, d: str) -> DataFrame:
    a, b = _annotators(spark, d)
    return iaa.iaa_verdict(iaa.iaa_report(a, b, "event_id"), a.select("clip"), V.clips(spark, d))


@query("A22_disagreement", f"WITH {PRESENT} SELECT DISTINCT clip FROM p WHERE a <> b")
def disagreement(spark: SparkSession, d: str) -> DataFrame:
    return iaa.disagreements(*_annotators(spark, d))


@query("J10_positional_pairs", "WITH a AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY event_id) - 1 AS pos, intensity AS a FROM v_event ), b AS (SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY event_id) - 1 AS pos, intensity AS b FROM v_event WHERE event_id % 7 <> 0) SELECT clip, CAST(pos AS INT) AS pos, a, b FROM a JOIN b USING (clip, pos)")
def positional(spark: SparkSession, d: str) -> DataFrame:
    return iaa.positional_pairs(*_annotators(spark, d), "event_id")


BANDS = dims.values(dims.EVENT_BANDS, "band_of, top, tier1, tier2")
simple("P9_event_type", V.clips, labels.event_type, f"SELECT c.clip, coalesce(arg_min(tier1, top), 'NONE') AS tier1, coalesce(arg_min(tier2, top), 'NONE_AMBIENT') AS tier2 FROM v_clip c LEFT JOIN {BANDS} b ON typology = band_of AND max_intensity <= top GROUP BY c.clip")
SPOKEN = [*dims.EMOTIONS, *[a for a, _ in dims.EMOTION_ALIASES], "bored"]
WORD = "[" + ", ".join(f"'{w}'" for w in SPOKEN) + "]"
LIST = ", ".join(f"'{w}'" for w in dims.EMOTIONS)


@query("P10_emotion", f"WITH w AS (SELECT event_id, {WORD}[CAST(event_id % {len(SPOKEN)} AS INT) + 1] AS word FROM events) SELECT event_id, coalesce(CASE WHEN word IN ({LIST}) THEN word END, to_word) AS canonical, to_word IS NOT NULL AS alias_used FROM w LEFT JOIN {dims.values(dims.EMOTION_ALIASES, 'from_word, to_word')} a ON word = from_word")
def emotion(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(*[F.lit(f" {w.upper()}") for w in SPOKEN])
    rows = V.read(spark, d, "events").select("event_id", F.get(words, (F.col("event_id") % len(SPOKEN)).cast("int")).alias("word"))
    return labels.normal_emotion(rows, "word").select("event_id", "canonical", "alias_used")


@query("P15_size_bin", "WITH e AS (SELECT clip, clip * clip AS n FROM v_clip ) SELECT clip, CASE WHEN n < 1000 THEN 'n<1K' WHEN n < 10000 THEN '1K<n<10K' WHEN n < 100000 THEN '10K<n<100K' WHEN n < 1000000 THEN '100K<n<1M' WHEN n < 10000000 THEN '1M<n<10M' WHEN n < 100000000 THEN '10M<n<100M' WHEN n < 1000000000 THEN '100M<n<1B' ELSE 'n>1B' END AS bin FROM e")
def size_bins(spark: SparkSession, d: str) -> DataFrame:
    return V.clips(spark, d).select("clip", labels.size_bin(F.col("clip") * F.col("clip")).alias("bin"))


STYLES = [(1, "calm"), (3, "firm"), (5, "shout")]


@query("P17_nearest_style", f"SELECT event_id AS id, intensity AS i, arg_min(style, abs(k - intensity) * 100 + k) AS style FROM v_event , {dims.values(STYLES, 'k, style')} s GROUP BY ALL")
def style(spark: SparkSession, d: str) -> DataFrame:
    return labels.nearest_style(V.events(spark, d).select(F.col("event_id").alias("id"), F.col("intensity").alias("i")), dims.frame(spark, STYLES, "k int, style string"))


@query("P19_prosody_cap", "WITH r AS (SELECT scene, idx, 0.9 + intensity / 10 + seconds / 100 AS rate, intensity - 4 + seconds / 10 AS pitch FROM v_turn ) SELECT scene, idx, round(greatest(0.95, least(1.2, rate)), 6) AS rate, round(greatest(-3, least(2, pitch)), 6) AS pitch, CAST(greatest(0.95, least(1.2, rate)) <> rate AS INT) + CAST(greatest(-3, least(2, pitch)) <> pitch AS INT) AS n_events FROM r")
def cap(spark: SparkSession, d: str) -> DataFrame:
    i, s = F.col("intensity"), F.col("seconds")
    rate, pitch, n = labels.prosody_cap(F.lit(0.9) + i / 10 + s / 100, i - 4 + s / 10)
    return V.turns(spark, d).select("scene", "idx", F.round(rate, 6).alias("rate"), F.round(pitch, 6).alias("pitch"), n.alias("n_events"))


simple("A16_weak_labels", V.events, labels.weak_labels, "SELECT clip, bool_or(tier1 <> 'NONE') AS has_violence, coalesce(string_agg(DISTINCT tier1, ',' ORDER BY tier1) FILTER (tier1 <> 'NONE'), '') AS categories, max(intensity) AS max_intensity FROM v_event GROUP BY clip")
simple("W4_event_ids", V.events, labels.event_ids, "SELECT event_id, clip || '_EVT_' || lpad(CAST(row_number() OVER (PARTITION BY clip ORDER BY onset_us, event_id) - 1 AS VARCHAR), 3, '0') AS label_id FROM v_event ")
simple("L3_stratified_cap", V.clips, labels.stratified_cap, "SELECT typology, clip FROM v_clip QUALIFY row_number() OVER (PARTITION BY typology ORDER BY md5('42|' || clip)) <= 50")
simple("L4_max_clips", V.clips, labels.max_clips, "SELECT clip FROM v_clip ORDER BY md5('42|' || clip) LIMIT 100")
simple("L5_top20", V.clips, lambda c: c.select("clip", F.round("duration", 6).alias("duration")).orderBy(F.desc("duration"), "clip").limit(20), "SELECT clip, round(duration, 6) AS duration FROM v_clip ORDER BY 2 DESC, 1 LIMIT 20")
simple("W13_round_robin", V.clips, labels.round_robin, "SELECT typology, clip, CAST((row_number() OVER (PARTITION BY typology, custkey ORDER BY clip) - 1) % 7 AS INT) AS slot FROM v_clip ")
simple("J17_addressee", V.turns, labels.addressee, "WITH r AS (SELECT DISTINCT scene, role FROM v_turn ) SELECT a.scene, a.role, arg_min(b.role, CASE b.role WHEN 'VIC' THEN 0 WHEN 'AGG' THEN 1 ELSE 2 END) AS addressee FROM r a JOIN r b ON a.scene = b.scene AND a.role <> b.role GROUP BY ALL")
COMPONENTS = "WITH RECURSIVE e AS (SELECT DISTINCT a.clip AS x, b.clip AS y FROM v_clip_speaker a JOIN v_clip_speaker b USING (speaker)), reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x), g AS (SELECT x AS clip, min(y) AS root FROM reach GROUP BY x)"
simple("G1_components", V.clip_speakers, graph.components, f"{COMPONENTS} SELECT clip, root FROM g")
simple("G1_splits", V.clip_speakers, lambda p: graph.splits(graph.components(p)), f"""{COMPONENTS}, s AS (SELECT root, count(*) AS n, md5('42|' || root) AS key FROM g GROUP BY root),
w AS (SELECT *, sum(n) OVER (ORDER BY key ROWS UNBOUNDED PRECEDING) - n AS before FROM s), t AS (SELECT round_even(sum(n) * 0.7, 0) AS goal, round_even(sum(n) * 0.15, 0) AS goal_val FROM s),
f AS (SELECT coalesce(min(before + n) FILTER (before + n >= goal), 0) AS filled FROM w, t)
SELECT clip, CASE WHEN before < goal THEN 'train' WHEN before - filled < goal_val THEN 'val' ELSE 'test' END AS split FROM g JOIN w USING (root), t, f""")


@query("J5_anti", "SELECT clip FROM v_clip WHERE clip NOT IN (SELECT clip FROM v_clip_speaker )")
def without_speakers(spark: SparkSession, d: str) -> DataFrame:
    return V.clips(spark, d).join(V.clip_speakers(spark, d), "clip", "left_anti").select("clip")


@query("J4_semi", "SELECT clip FROM v_clip WHERE clip IN (SELECT clip FROM v_clip_speaker )")
def with_speakers(spark: SparkSession, d: str) -> DataFrame:
    return V.clips(spark, d).join(V.clip_speakers(spark, d), "clip", "left_semi").select("clip")


simple("W7_prev_turn", V.turns, timeline.previous_turn, "SELECT scene, idx, lag(role) OVER w AS prev_role, lag(intensity) OVER w AS prev_intensity FROM v_turn WINDOW w AS (PARTITION BY scene ORDER BY idx)")
simple("W5a_script_timeline", V.turns, timeline.script_timeline, "SELECT scene, idx, round(e - seconds, 6) AS onset, round(e, 6) AS offset FROM (SELECT *, sum(CASE WHEN mode = 'sequential' THEN greatest(amount, 0) ELSE 0 END + seconds) OVER (PARTITION BY scene ORDER BY idx ROWS UNBOUNDED PRECEDING) AS e FROM v_turn )")
TIMELINE = """n AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY idx) AS k FROM v_turn ),
s AS (SELECT scene, idx, k, samples, speech_end, CAST(floor(greatest(amount, 0) * 16000) AS BIGINT) AS first, greatest(amount, 0)::DOUBLE AS script_onset, greatest(amount, 0)::DOUBLE + samples / 16000 AS script_offset, CAST(0 AS BIGINT) AS earlier, CAST(NULL AS BIGINT) AS prev_end
  FROM n WHERE k = 1
UNION ALL SELECT scene, idx, k, samples, speech_end, first, script_onset, script_onset + samples / 16000,
    greatest(earlier, CASE WHEN mode = 'barge_in' AND first - p_first <= 0 THEN p_first WHEN mode = 'barge_in' AND p_speech > first - p_first THEN p_first + p_speech ELSE p_first + p_samples END),
    CASE WHEN mode = 'barge_in' AND first - p_first <= 0 THEN p_first WHEN mode = 'barge_in' AND p_speech > first - p_first THEN p_first + p_speech ELSE p_first + p_samples END
  FROM (SELECT t.scene, t.idx, t.k, t.samples, t.speech_end, t.mode, s.earlier, s.first AS p_first, s.samples AS p_samples, least(s.speech_end, s.samples) AS p_speech,
    CASE WHEN t.mode = 'sequential' THEN s.script_offset + greatest(t.amount, 0) ELSE s.script_offset END AS script_onset,
    CAST(floor(16000 * CASE WHEN t.mode = 'sequential' THEN greatest(s.earlier, s.first + s.samples) / 16000 + greatest(t.amount, 0)
      ELSE greatest(s.first / 16000, s.first / 16000 + s.speech_end / 16000 - least(greatest(t.amount, 0), s.speech_end / 16000)) END) AS BIGINT) AS first
    FROM s JOIN n t ON t.scene = s.scene AND t.k = s.k + 1)),
tl AS (SELECT s.scene, s.idx, s.script_onset, s.script_offset, s.first / 16000 AS onset, coalesce(x.prev_end, s.first + s.samples) / 16000 AS ends FROM s LEFT JOIN s x ON x.scene = s.scene AND x.k = s.k + 1)"""
simple("W5b_rendered_timeline", V.turns, timeline.rendered_timeline, f"WITH RECURSIVE {TIMELINE} SELECT scene, idx, round(script_onset, 7) AS script_onset, round(script_offset, 7) AS script_offset, round(onset, 7) AS onset, round(ends, 7) AS \"offset\" FROM tl")


@query("W3_truncated", f"WITH RECURSIVE {TIMELINE} SELECT t.scene, t.idx, coalesce(lead(mode) OVER (PARTITION BY t.scene ORDER BY t.idx) = 'barge_in', false) OR round(ends, 7) - round(onset, 7) < seconds - 2 / 16000 OR seconds = 0 AS truncated FROM v_turn t JOIN tl USING (scene, idx)")
def truncated(spark: SparkSession, d: str) -> DataFrame:
    turns = V.turns(spark, d)
    return timeline.truncated_by_next(timeline.audible(turns, timeline.rendered_timeline(turns)).withColumn("truncated", F.col("seconds") == 0))


@query("P11_label_times", f"WITH RECURSIVE {TIMELINE}, a AS (SELECT t.scene, t.idx, seconds, round(onset, 7) AS onset, round(ends, 7) AS ends FROM v_turn t JOIN tl USING (scene, idx)) SELECT scene, idx, round(onset + 0.5, 7) AS onset, round(greatest(ends + 0.5, onset + 0.5 + CASE WHEN ends - onset < seconds - 2 / 16000 THEN 1 / 16000 ELSE 0.1 END), 7) AS \"offset\", ends - onset < seconds - 2 / 16000 AS truncated FROM a")
def label_times(spark: SparkSession, d: str) -> DataFrame:
    turns = V.turns(spark, d)
    return timeline.label_times(turns.select("scene", "idx", "seconds").join(timeline.rendered_timeline(turns), ["scene", "idx"]))


simple("A26_dominant_mode", V.turns, qa.dominant_mode, "WITH m AS (SELECT scene, mode, count(*) AS n, min(idx) AS first FROM v_turn GROUP BY ALL) SELECT scene, arg_max(mode, n * 1000000 - first) AS mode FROM m GROUP BY scene")
simple("W16_monotonic", V.turns, lambda t: timeline.monotonic(t, ["scene"], "idx", "seconds"), "SELECT scene, bool_and(ok) AS monotonic FROM (SELECT scene, coalesce(lag(seconds) OVER (PARTITION BY scene ORDER BY idx) <= seconds + 0.01, true) AS ok FROM v_turn ) GROUP BY scene")
TARGETS = dims.values(dims.DRIFT_TARGETS, "t_role, t_i, t_rate, t_pitch, t_volume")
STEP = "CASE WHEN t.intensity >= s.i THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END"
DRIFT = f"""n AS (SELECT scene, speaker, idx, intensity, coalesce(t_rate, 1) AS r, coalesce(t_pitch, 0) AS p, coalesce(t_volume, 0) AS v, CASE WHEN role = 'VIC' THEN {dims.BREATHINESS}[intensity]::DOUBLE ELSE 0 END AS b, row_number() OVER (PARTITION BY scene, speaker ORDER BY idx) AS k FROM v_turn LEFT JOIN {TARGETS} x ON role = t_role AND intensity = t_i),
s AS (SELECT scene, speaker, idx, k, intensity AS i, 1::DOUBLE AS rate, 0::DOUBLE AS pitch, 0::DOUBLE AS volume, 0::DOUBLE AS breathiness, 0.6::DOUBLE * (r - 1) + 1 AS nr, 0.6::DOUBLE * p AS np, 0.6::DOUBLE * v AS nv, 0.6::DOUBLE * b AS nb FROM n WHERE k = 1
UNION ALL SELECT t.scene, t.speaker, t.idx, t.k, t.intensity, s.nr, s.np, s.nv, s.nb, s.nr + {STEP} * (t.r - s.nr), s.np + {STEP} * (t.p - s.np), s.nv + {STEP} * (t.v - s.nv), s.nb + {STEP} * (t.b - s.nb) FROM s JOIN n t ON t.scene = s.scene AND t.speaker = s.speaker AND t.k = s.k + 1)"""
simple("W6_speaker_state", V.turns, timeline.speaker_drift, f"WITH RECURSIVE {DRIFT} SELECT scene, speaker, idx, round(rate, 6) AS rate, round(pitch, 6) AS pitch, round(volume, 6) AS volume, round(breathiness, 6) AS breathiness FROM s")
simple("A29_last_states", V.turns, lambda t: qa.last_states(timeline.speaker_drift(t)), f"WITH RECURSIVE {DRIFT} SELECT scene, speaker, round_even(round(arg_max(rate, idx), 6), 4) AS rate, round_even(round(arg_max(pitch, idx), 6), 4) AS pitch, round_even(round(arg_max(volume, idx), 6), 4) AS volume FROM s GROUP BY ALL")
DRAW = "(('0x' || substr(md5('42|' || scene || '|' || idx || '|{}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
GAP_SQL = f"""WITH l AS (SELECT *, lag(role) OVER w AS pr, lag(intensity) OVER w AS pi FROM v_turn WINDOW w AS (PARTITION BY scene ORDER BY idx)),
m AS (SELECT l.*, CASE WHEN pr IS NOT NULL AND {DRAW.format('roll')} < barge THEN 'barge_in' WHEN pr IS NOT NULL AND {DRAW.format('roll')} < barge + overlap THEN 'overlap' ELSE 'sequential' END AS gm,
CASE WHEN pr IS NULL THEN 'agg_low' WHEN role = 'VIC' THEN CASE WHEN pi <= 2 THEN 'vic_low' WHEN pi = 3 THEN 'vic_i3' WHEN pi = 4 THEN 'vic_i4' ELSE 'vic_i5' END WHEN role = 'AGG' AND intensity >= 4 THEN CASE WHEN {DRAW.format('pause')} < 0.3 THEN 'agg_pause' ELSE 'agg_high' END WHEN role = 'AGG' AND intensity = 3 THEN 'agg_high' ELSE 'agg_low' END AS context
FROM l LEFT JOIN {dims.values(dims.OVERLAP_CHANCES, 'c_prev, c_role, c_i, barge, overlap')} c ON pr = c_prev AND role = c_role AND intensity = c_i)
SELECT scene, idx, gm AS mode, round(CASE gm WHEN 'barge_in' THEN 0.2 + (0.5 - 0.2) * {DRAW.format('amount')} WHEN 'overlap' THEN 0.1 + (0.35 - 0.1) * {DRAW.format('amount')} ELSE low + (high - low) * {DRAW.format('amount')} END, 6) AS amount FROM m JOIN GAP_TABLE g USING (context)"""
simple("N1_gap_controller", V.turns, timeline.turn_gaps, GAP_SQL.replace("GAP_TABLE", dims.values(dims.GAPS, "context, low, high")))
simple("N1b_gap_controller_2", V.turns, lambda t: timeline.turn_gaps(t, table=dims.GAPS_2), GAP_SQL.replace("GAP_TABLE", dims.values(dims.GAPS_2, "context, low, high")))
simple("W15_spearman", V.turn_metrics, lambda m: labels.spearman(m.where("f0 IS NOT NULL").select("f0", "rms"), "f0", "rms"), "WITH r AS (SELECT rank() OVER (ORDER BY f0) + (count(*) OVER (PARTITION BY f0) - 1) / 2 AS x, rank() OVER (ORDER BY rms) + (count(*) OVER (PARTITION BY rms) - 1) / 2 AS y FROM v_turn_metrics WHERE f0 IS NOT NULL) SELECT round(corr(x, y), 6) AS rho, count(*) AS n FROM r")


@query("T3_length_ratio", "WITH t AS (SELECT doc_id, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS n, len(list_filter(string_split(substr(text, 1, CAST(length(text) * 3 // 4 AS INT)), ' '), lambda x: x <> '')) AS m FROM documents) SELECT doc_id, round(m / greatest(n, 1), 6) AS ratio, m / greatest(n, 1) < 0.75 AS collapsed FROM t")
def ratio(spark: SparkSession, d: str) -> DataFrame:
    cut = F.expr("substring(text, 1, CAST(length(text) * 3 DIV 4 AS INT))")
    r = text.length_ratio(cut, F.col("text"))
    return V.read(spark, d, "documents").select("doc_id", F.round(r, 6).alias("ratio"), (r < 0.75).alias("collapsed"))


@query("T1_normalize", r"SELECT scene, idx, trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS normal FROM v_turn ")
def normalize(spark: SparkSession, d: str) -> DataFrame:
    return V.turns(spark, d).select("scene", "idx", text.normalised(F.col("text")).alias("normal"))


@query("W17_trigram_repeat", "WITH w AS (SELECT scene, idx, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM v_turn ), g AS (SELECT scene, idx, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM w WHERE len(w) >= 3), c AS (SELECT scene, idx, g, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT scene, idx, max(n) AS n FROM c GROUP BY ALL) SELECT scene, idx, CAST(coalesce(n, 0) AS INT) AS repeats FROM w LEFT JOIN m USING (scene, idx)")
def trigrams(spark: SparkSession, d: str) -> DataFrame:
    return V.turns(spark, d).select("scene", "idx", text.most_repeated_trigram(F.col("text")).alias("repeats"))


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "embeddings").select("vec_id", F.expr("transform(embedding, x -> CAST(x AS DOUBLE) * (1 + vec_id % 7))").alias("x"))


SAMPLES = "s AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE) * (1 + vec_id % 7)) AS x FROM embeddings), m AS (SELECT *, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM s)"


@query("D1_D2_levels", f"WITH {SAMPLES} SELECT vec_id, round(sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)), 6) AS rms, round(20 * log10(peak), 6) AS peak_dbfs FROM m")
def levels(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("x")
    return _samples(spark, d).select("vec_id", F.round(signal.rms(x), 6).alias("rms"), F.round(signal.peak_dbfs(x), 6).alias("peak_dbfs"))


@query("D3_D4_gain", f"WITH {SAMPLES} SELECT vec_id, round(peak * least(1, 0.9 / peak), 6) AS limited_peak, round(list_sum(list_transform(x, lambda v: abs(v) * (0.7943282347242815 / peak))), 6) AS normal_sum FROM m")
def gains(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate(signal.to_peak(F.col("x"), -2.0), F.lit(0.0), lambda a, v: a + F.abs(v))
    return _samples(spark, d).select("vec_id", F.round(signal.peak(signal.limited(F.col("x"), 0.9)), 6).alias("limited_peak"), F.round(total, 6).alias("normal_sum"))


@query("R1_sliding_windows", "WITH e AS (SELECT epoch_us(ts) // 1000000 // 3600 * 3600 AS hour FROM events), w AS (SELECT hour - 3600 * unnest([0, 1, 2]) AS window_start FROM e) SELECT CAST(window_start AS BIGINT) AS window_start, count(*) AS n FROM w GROUP BY 1")
def sliding(spark: SparkSession, d: str) -> DataFrame:
    return windows.sliding_counts(V.read(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts")))


@query("H2_text_key", "SELECT doc_id, sha256(text) AS key FROM documents")
def text_keys(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))


@query("X1_props_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def props(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


#: Suppliers connect nearly all clips, where the recursive SQL would not end; the tests compare with union and find.
QUERIES["G1_components_suppliers"] = lambda spark, d: graph.components(V.clip_suppliers(spark, d))
QUERIES["G1_splits_suppliers"] = lambda spark, d: graph.splits(graph.components(V.clip_suppliers(spark, d)))
