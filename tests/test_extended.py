"""Known values of operators that SQL has no form of, and hand-computed cases of those that it has."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from auralith import dims, hebrew
from auralith.functions import dsp, providers, signal, ssml, text
from auralith.operators import evaluation, iaa, labels, manifest, planning, qa, qa_run, quantiles, timeline
from auralith.plans.extended import QUERIES, SQL
from auralith.sources import files

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


# statistics


def test_medians_cut_into_bins(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 5)
    monkeypatch.setattr(quantiles, "BINS", 4)
    rng = np.random.default_rng(0)
    rows = [("a", float(v)) for v in rng.normal(size=101)] + [("b", float(v)) for v in rng.exponential(size=100)] + [("c", 7.0)] * 50 + [("d", None), ("e", 1.0), ("f", -1e300), ("f", 1e300), ("g", 1.0), ("g", 2.0)]
    got = {r["k"]: r["median"] for r in quantiles.medians(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    want = {k: float(np.median([v for g, v in rows if g == k and v is not None])) for k in "abcefg"}
    assert got == pytest.approx(want)


def test_sums_before(spark):
    rows = [(float(k % 7), k) for k in range(60)]
    got = {r["v"]: r["before"] for r in quantiles.sums_before(spark.createDataFrame(rows, "v double, n int"), "v", "n").collect()}
    assert got == {v: sum(n for w, n in rows if w < v) for v, _ in rows}


def test_weighted_kappa_known_values(spark):
    pairs = [(1, 1), (1, 5), (5, 5), (3, 3), (2, 4), (5, 1)]
    weight = lambda a, b: 1.0 if abs(a - b) <= 1 else max(0.0, 1 - (abs(a - b) - 1) / 3)
    seen = sum(weight(a, b) for a, b in pairs) / 6
    chance = sum(weight(a, b) for a, _ in pairs for _, b in pairs) / 36
    df = spark.createDataFrame(pairs, "a int, b int")
    assert iaa.weighted_kappa(df).first()["kappa"] == pytest.approx((seen - chance) / (1 - chance), abs=1e-6)
    assert iaa.weighted_kappa(df.limit(0)).first()["kappa"] == 0 and iaa.weighted_kappa(spark.createDataFrame([(1, 1)], "a int, b int"), 1, 1).first()["kappa"] == 1
    with pytest.raises(Exception, match="outside"):
        iaa.weighted_kappa(spark.createDataFrame([(1, 6)], "a int, b int")).collect()


def test_run_warnings_at_their_limits(spark):
    frame = spark.createDataFrame
    clips = frame([(i,) for i in range(20)], "clip int")
    warned = lambda n: frame([(i, "x") for i in range(n)], "clip int, flag string")
    ratios = lambda i4, overlap, down: frame([(i4, overlap, down)], "clips_i4 int, overlap_ratio double, downgrade_ratio double")
    run = lambda *a: {r["warning"] for r in qa.run_warnings(*a).collect()}
    voices, backends = frame([("male", 3), ("female", 2)], "gender string, voices int"), frame([(1, "a"), (2, "b")], "clip int, backend string")
    assert run(voices, backends, ratios(3, 0.5, 0.05), warned(2), clips) == {"low_voice_diversity_female"}
    assert run(voices.where("gender = 'male'"), backends.limit(1), ratios(3, 0.0, 0.06), warned(3), clips) == {"low_voice_diversity_female", "single_backend", "zero_overlap", "high_emotion_downgrade", "high_warning_rate"}
    assert run(voices, backends, ratios(0, 0.0, 0.0), warned(0), clips.limit(0)) == set()


def test_failure_rate_limit(spark):
    rate = lambda bad, n: tuple(qa.failure_rate(spark.createDataFrame([(i >= bad,) for i in range(n)], "is_valid boolean")).first())
    assert rate(1, 50) == (0.02, True) and rate(2, 50)[1] is False and rate(0, 0) == (0.0, True)


# timelines


def test_barge_in_by_hand(spark):
    rows = [("s", 0, "sequential", 0.5, 16_000, 14_400), ("s", 1, "barge_in", 0.2, 8_000, 8_000), ("s", 2, "overlap", 9.0, 1_600, 1_600), ("s", 3, "barge_in", 9.0, 1_600, 1_600), ("s", 4, "sequential", -1.0, 1_600, 0), ("t", 0, "overlap", 1.0, 1_600, 1_600)]
    got = {(r["scene"], r["idx"]): (r["onset"], r["offset"], r["script_onset"]) for r in timeline.rendered_timeline(spark.createDataFrame(rows, "scene string, idx int, mode string, amount double, samples long, speech_end long")).collect()}
    # the first ends with its speech, 0.2 s after the second begins; the third reaches back over the whole second; the fourth begins with the third, which then isn't heard
    assert got["s", 0] == (0.5, 1.4, 0.5) and got["s", 1] == (1.2, 1.7, 1.5) and got["s", 2] == (1.2, 1.2, 2.0) and got["s", 3] == (1.2, 1.3, 2.1)
    assert got["s", 4] == (1.7, 1.8, 2.2) and got["t", 0] == (0.0, 0.1, 0.0)


def test_drift_by_hand(spark):
    rows = [("s", "a", k, "VIC", i) for k, i in enumerate([5, 3, 9])] + [("s", "b", 0, "BYS", 5), ("s", "c", 1, "VIC", 1)]
    got = {(r["speaker"], r["idx"]): (r["rate"], r["breathiness"]) for r in timeline.speaker_drift(spark.createDataFrame(rows, "scene string, speaker string, idx int, role string, intensity int")).collect()}
    first = 1 + 0.6 * (0.87 - 1)
    assert got["a", 0] == (1, 0) and got["a", 1] == (round(first, 6), 0.6) and got["a", 2] == (round(first + 0.3 * (0.94 - first), 6), round(0.6 + 0.3 * (0.33 - 0.6), 6)) and got["c", 1] == (1, 0)


def test_folds_cross_batches(spark):
    """A scene longer than a batch and more scenes than partitions."""
    rows = spark.range(25_000).select((F.col("id") % 3).alias("scene"), (F.col("id") / 3).cast("long").alias("idx"), F.lit("sequential").alias("mode"), F.lit(0.0).alias("amount"), F.lit(16_000).alias("samples"), F.lit(16_000).alias("speech_end"))
    out = timeline.rendered_timeline(rows)
    assert out.where("onset <> idx OR offset <> idx + 1").isEmpty() and out.count() == 25_000


# texts


def test_disambiguation(spark):
    rows = [("זה שלך", "female"), ("זה שלך", "male"), ("זה שלך", "none"), ("שלכם אליך, שלך", "female"), ("", "male")]
    spoken, rules = text.disambiguated(F.col("t"), F.col("g"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "t string, g string").select(spoken.alias("s"), rules, F.size(text.ambiguities(F.col("s")))).collect()] if False else [
        (r["s"], r["rules"]) for r in spark.createDataFrame(rows, "t string, g string").select(spoken.alias("s"), rules.alias("rules")).collect()]
    forms = {rule: (f, m) for rule, _, f, m in hebrew.AMBIGUOUS}
    assert got[0] == ("זה " + forms["POSS_SHEL"][0], ["F2_POSS_SHEL"]) and got[1] == ("זה " + forms["POSS_SHEL"][1], ["M2_POSS_SHEL"]) and got[2] == ("זה שלך", []) and got[4] == ("", [])
    assert got[3][0].startswith("שלכם ") and got[3][1] == ["F2_POSS_SHEL", "F2_PREP_ELAIKH"]
    assert spark.range(1).select(F.size(text.ambiguities(F.lit("זה שלך, שלכם לך")))).first()[0] == 2


def test_word_and_character_errors(spark):
    assert text.word_edits("a b c d", "a x c") == (2, 4, 3) and text.word_edits(None, "a") == (1, 0, 1) and text.word_edits("", "") == (0, 0, 0)
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (" ".join(rng.choice(list("xyz"), rng.integers(0, 7))) for _ in range(2))
        x, y = a.split(), b.split()
        d = np.zeros((len(x) + 1, len(y) + 1), int)
        d[:, 0], d[0] = range(len(x) + 1), range(len(y) + 1)
        for i in range(len(x)):
            for j in range(len(y)):
                d[i + 1, j + 1] = min(d[i, j + 1] + 1, d[i + 1, j] + 1, d[i, j] + (x[i] != y[j]))
        assert text.word_edits(a, b)[0] == d[-1, -1]
    row = evaluation.transcript_errors(spark.createDataFrame([("one, two! three", "one two"), ("", "x")], "reference string, hypothesis string")).collect()
    assert [(r["wer"], r["ref_words"]) for r in row] == [(pytest.approx(1 / 3), 3), (1.0, 0)] and row[0]["cer"] == pytest.approx(6 / 13)


def test_plain_hebrew(spark):
    assert spark.range(1).select(text.plain_hebrew(F.lit("‏שָׁלוֹם, (אמן)!  ארץ"))).first()[0] == "שלומ אמנ ארצ"


def test_disfluency_keeps_the_text(spark):
    one = lambda chance: spark.range(1).select(text.disfluent(F.lit("A. B! C? D"), chance, lambda k: F.lit(0.5))).first()[0]
    assert one(0.1) == "A. B! C? D" and one(0.9) == "A. אה B! אה C? אה D"


def test_speech_markup():
    assert ssml.offset_map("abcd", "abXcd") == [0, 1, 3, 4, 5] and ssml.offset_map("abcd", "ad") == [0, 1, 1, 1, 2] and ssml.offset_map("", "x") == [1]
    hints = [{"phrase_id": "p", "hint": "slow", "char_start_original": 0, "char_end_original": 2}, {"phrase_id": "q", "hint": "odd", "char_start_original": 0, "char_end_original": 1}]
    assert [(p["char_start"], p["char_end"], p["rate"]) for p in ssml.hinted(hints, "ab c", "abX c")] == [(0, 3, "-20%")]
    found = ssml.commands("לך עכשיו! טוב. שב")
    assert [(p["char_start"], p["char_end"], p["phrase_id"]) for p in found] == [(3, 9, "heuristic_p0"), (15, 17, "heuristic_p1")]
    phrase = lambda a, b, before=0, after=0, rate=None: dict(zip(ssml.FIELDS, ("p", a, b, rate, None, None, before, after), strict=True))
    made = ssml.document([{"text": "a & b\x07cd", "voice": "v", "style": "angry", "rate": 1.105, "pitch": 0.05, "volume": -60.0, "phrases": [phrase(0, 1, after=100, rate="-15%"), phrase(1, 1), phrase(1, 2, before=50), phrase(0, 4)]}])
    assert '<voice name="v"><mstts:express-as style="angry"><prosody rate="+10%" volume="-50%"><prosody rate="-15%">a</prosody><break time="150ms" /> &amp; bcd</prosody></mstts:express-as></voice>' in made
    assert "mstts" not in ssml.document([{"text": "x", "voice": "v", "style": "angry"}], styles=False)


def test_parsed_answers(spark):
    raw = '{"turns": [{"speaker_id": "a", "text": "t", "phrase_hints": [{"phrase_id": "p", "hint": "slow", "char_start_original": 0, "char_end_original": 1}, {"phrase_id": "q"}]}]}'
    got = spark.range(1).select(text.response_turns(F.lit(f"Sure:\n```json\n{raw}\n```")).alias("t"), text.response_turns(F.lit("nothing")).alias("none")).first()
    t = got["t"][0]
    assert (t["intensity"], t["pause_before_s"], t["emotional_state"], len(t["phrase_hints"])) == (1, 0.3, "neutral", 1) and got["none"] is None
    judged = qa_run.judged(spark.createDataFrame([('{"overall_quality": 4}', None), ("{", None), ("", None), (None, "down")], "raw string, error string")).collect()
    assert [r["reason"] for r in judged] == ["ok", "json_parse_error", "content_refusal", "api_error"] and judged[0]["scores"] == {"overall_quality": 4}


# signals


def direct(x, sections):
    for b0, b1, b2, a1, a2 in sections:
        y, x1, x2, y1, y2 = np.zeros(len(x)), 0.0, 0.0, 0.0, 0.0
        for i, v in enumerate(x):
            y[i] = b0 * v + b1 * x1 + b2 * x2 - a1 * y1 - a2 * y2
            x2, x1, y2, y1 = x1, v, y1, y[i]
        x = y
    return x


def gain_db(sections, f, rate=16_000):
    z = np.exp(-2j * np.pi * f / rate)
    return 20 * np.log10(abs(np.prod([(b0 + b1 * z + b2 * z * z) / (1 + a1 * z + a2 * z * z) for b0, b1, b2, a1, a2 in sections])))


def test_filters():
    x = np.random.default_rng(0).standard_normal(4000)
    for sections in (dsp.butterworth("high", 2, 80.0, 16_000), dsp.butterworth("low", 8, 3400.0, 16_000), dsp.butterworth("low", 3, 1000.0, 16_000), dsp.high_shelf(3.5, 2500.0, 16_000), dsp.peaking(3000.0, 3.0, 1.5, 16_000)):
        assert np.abs(direct(x, sections) - dsp.filtered(x, sections)).max() < 1e-9
    assert gain_db(dsp.butterworth("high", 2, 80.0, 16_000), 80) == pytest.approx(-3.01, abs=0.01) and gain_db(dsp.butterworth("low", 8, 3400.0, 16_000), 3400) == pytest.approx(-3.01, abs=0.01)
    assert gain_db(dsp.high_shelf(3.5, 2500.0, 16_000), 7999) == pytest.approx(3.5, abs=0.01) and gain_db(dsp.high_shelf(3.5, 2500.0, 16_000), 2500) == pytest.approx(1.75, abs=0.01)
    assert gain_db(dsp.peaking(3000.0, 3.0, 1.5, 16_000), 3000) == pytest.approx(3.0, abs=0.01)
    assert np.allclose(dsp.butterworth("high", 2, 80.0, 16_000)[0], [0.97803048, -1.95606096, 0.97803048, -1.95557824, 0.95654368], atol=1e-8)
    assert (dsp.lombard(x, 3) == x).all() and not np.allclose(dsp.lombard(x, 5), x)


def test_resampling_and_levels():
    t = np.arange(24_000) / 24_000
    y = dsp.resampled(np.sin(2 * np.pi * 440 * t), 24_000, 16_000)
    assert len(y) == 16_000 and np.abs(y[500:-500] - np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000)[500:-500]).max() < 2e-3
    assert dsp.rms(dsp.rms_gain(y, -20.0)) == pytest.approx(0.1) and (dsp.rms_gain(y * 1e-6, -20.0) == y * 1e-6).all()
    assert np.abs(dsp.peak_limited(y * 3)).max() == pytest.approx(10 ** (-1 / 20)) and dsp.snr_db(np.zeros(999), y) == float("-inf") and dsp.snr_db(y, np.zeros(9)) == float("inf")
    # a sine of 997 Hz at -23 dBFS of RMS is at about -23 LUFS
    tone = np.sin(2 * np.pi * 997 * np.arange(48_000 * 3) / 48_000)
    assert dsp.loudness(tone * 10 ** (-23 / 20) * np.sqrt(2), 48_000) == pytest.approx(-23.0, abs=0.2) and dsp.loudness(tone[:100], 48_000) is None and dsp.loudness(tone * 0, 48_000) is None
    x, steps = dsp.preprocessed(np.stack([y, y]), 16_000)
    assert steps == ["downmix_to_mono", "highpass_80Hz_order2", "peak_normalize", "peak_limit", "silence_pad"] and not x[:8000].any() and np.abs(x).max() == pytest.approx(10 ** (-2 / 20))


def test_turn_measures():
    t = np.arange(16_000 * 3) / 16_000
    tone = 0.3 * np.sin(2 * np.pi * 200 * t)
    f0, sd, level, loud = dsp.measured(tone, 16_000, 0.5, 2.5)
    assert f0 == pytest.approx(200, rel=0.02) and sd < 5 and level == pytest.approx(20 * np.log10(0.3 / np.sqrt(2)), abs=0.05) and loud is not None
    assert dsp.measured(tone, 16_000, 1.0, 1.04) == (None, None, -96.0, None) and dsp.measured(tone, 16_000, 9, 10)[2] == -96.0
    assert dsp.longest_voiced(np.r_[tone[:16_000], np.zeros(8000), tone[:8000]], 16_000) == pytest.approx(1.0, abs=0.02)
    assert dsp.gate(np.tile(tone, 1), 16_000, "female") == (False, "sustained_vowel") and dsp.gate(tone[:16_000], 16_000, "female") == (True, None) and dsp.gate(tone[:16_000], 16_000, "male") == (False, "f0_guardrails")
    steps = np.zeros(48_000)
    steps[8_000:16_000], steps[24_000:32_000] = 0.02, -0.3
    assert np.abs(dsp.suppressed(dsp.steps(steps, 16_000), 0.08, 640) - [23_999, 31_999]).max() <= 1
    assert dsp.speech_end(np.r_[tone[:3200], np.zeros(1600)]) == 3200 and dsp.speech_end(np.zeros(500)) == 0 and dsp.speech_end(np.ones(50)) == 50 and dsp.speech_end(np.zeros(0)) == 0


def test_scenes_with_noise_and_rooms():
    tone = 0.3 * np.sin(2 * np.pi * 200 * np.arange(32_000) / 16_000)
    events = [{"type": "hvac_hum", "loop": True}, {"type": "ACOU_SLAM", "onset_at_phase": "peak", "level_db": -12.0}, {"type": "ACOU_FOOT", "onset_seconds": 50.0}]
    out, log, snr = dsp.mixed_noise(tone, 16_000, events[:1], 15.0, 1, None, dict(dims.PHASES))
    assert snr == pytest.approx(15.0, abs=0.1) and log == [{"type": "hvac_hum", "onset": 0.0, "offset": 2.0, "level_db": log[0]["level_db"]}]
    out, log, _ = dsp.mixed_noise(tone, 16_000, events, 15.0, 1, {"peak": 0.5}, dict(dims.PHASES))
    assert [e["onset"] for e in log] == [0.0, 0.5, 1.9] and log[1]["level_db"] == -12.0 and all(e["offset"] <= 2.0 for e in log) and len(out) == 32_000
    again = dsp.mixed_noise(tone, 16_000, events, 15.0, 1, {"peak": 0.5}, dict(dims.PHASES))[0]
    assert (again == out).all()
    assert len(dsp.in_room(tone, 16_000, "clinic_office", 1.0, 3)) == 32_000 and len(dsp.through_device(tone, 16_000, "pi_budget_mic")) == 32_000
    with pytest.raises(KeyError):
        dsp.through_device(tone, 16_000, "radio")
    breath = dsp.breathy(tone, 16_000, 1.0, 2) - tone
    assert dsp.rms(breath) == pytest.approx(0.25 * dsp.rms(tone)) and (dsp.breathy(tone, 16_000, 0.0) == tone).all()
    clipped, was = dsp.matched(np.r_[10.0, np.zeros(99)], np.full(100, 0.5))
    assert was and np.abs(clipped).max() == pytest.approx(0.99) and len(dsp.degraded(tone, 16_000, "slow_rate", 0.85)) == 32_000
    noisy = dsp.degraded(tone, 16_000, "white_noise", -10.0) - tone
    assert 10 * np.log10(np.mean(tone**2) / np.mean(noisy**2)) == pytest.approx(-10, abs=0.2)


def test_wiener_against_plain():
    x = np.random.default_rng(4).standard_normal(200)
    padded = np.r_[np.zeros(14), x, np.zeros(14)]
    mean = np.array([padded[i : i + 29].mean() for i in range(200)])
    var = np.array([np.square(padded[i : i + 29]).mean() for i in range(200)]) - mean**2
    noise = var.mean()
    assert np.allclose(dsp.wiener(x), np.where(var < noise, mean, mean + (x - mean) * (1 - noise / var)))


def test_fades_of_short_signals(spark):
    one = lambda n, k: spark.range(1).select(signal.faded(F.array(*[F.lit(1.0)] * n), k)).first()[0]
    want = lambda n, k: np.ones(n) * np.r_[np.linspace(0, 1, min(k, n // 2)), np.ones(n - min(k, n // 2))] * np.r_[np.ones(n - min(k, n // 2)), np.linspace(1, 0, min(k, n // 2))]
    for n, k in ((20, 5), (9, 5), (4, 160), (2, 160), (1, 160), (6, 1)):
        assert one(n, k) == pytest.approx(want(n, k).tolist()), (n, k)


# planning, labels, connectors


def test_paths():
    assert manifest.data_root("/a/b/data/he") == "/a/b" and manifest.data_root("/a/b", "/c") == "/c"


def test_rotation_by_hand(spark):
    speakers = spark.createDataFrame([("a", "AGG", "both", "train"), ("b", "AGG", "she_proves", "train"), ("c", "AGG", "she_proves", "val"), ("d", "VIC", "elephant_in_the_room", "train")], "speaker string, role string, context string, split string")
    pool = {(r["context"], r["split"], r["role"]): r["size"] for r in planning.pools(speakers, 1).collect()}
    assert pool == {("she_proves", "train", "AGG"): 2, ("elephant_in_the_room", "train", "AGG"): 1, ("she_proves", "val", "AGG"): 1, ("elephant_in_the_room", "train", "VIC"): 1}
    scenes = spark.createDataFrame([(k, "she_proves", 0, "a") for k in range(6)] + [(9, "she_proves", 1, "x"), (9, "she_proves", 0, "c")], "scene int, project string, pos int, speaker string")
    out = planning.distribute_speakers(scenes, speakers).collect()
    assert len(out) == 3 and {(r["speaker"], r["replacement"]) for r in out} == {("a", "b")}


def test_variants_check_their_lists(spark):
    scenes = spark.createDataFrame([(1,), (2,)], "scene int")
    rows = planning.variants(scenes, 50, devices=["phone_in_hand"]).collect()
    assert len(rows) == 100 and {r["device"] for r in rows} == {"phone_in_hand"} and all(5 <= r["snr"] <= 40 for r in rows) and {r["distance"] for r in rows} == {0.5, 1.5, 3.5}
    for bad in ({"devices": []}, {"rooms": ["attic"]}):
        with pytest.raises(ValueError):
            planning.variants(scenes, 1, **bad)


def test_strict_roles(spark):
    turns, known = spark.createDataFrame([("a",), ("b",)], "speaker string"), spark.createDataFrame([("a", "AGG")], "speaker string, role string")
    assert sorted(r["role"] for r in labels.with_roles(turns, known).collect()) == ["AGG", "UNK"]
    with pytest.raises(Exception, match="unknown speaker"):
        labels.with_roles(turns, known, strict=True).collect()


def test_connectors(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    with pytest.raises(KeyError, match="no tts provider"):
        providers.called(rows, "x", "y", "tts", "nobody", "string")

    def load():
        calls = []

        def f(x):
            calls.append(x)
            if x == "b" or len(calls) < 2:
                raise OSError("down")
            return x * 2

        return f

    providers.register("llm", "flaky", providers.Provider(load, "llm"))
    got = {r["id"]: (r["y"], r["error"]) for r in providers.called(rows.coalesce(1), "x", "y", "llm", "flaky", "string").collect()}
    assert got == {1: ("aa", None), 2: (None, "OSError: down")}


def test_scripts_and_speech_with_caches(spark):
    scenes = spark.createDataFrame([("s1", "write"), ("s2", "other")], "scene string, prompt string")
    known = ["AGG_M_30-45_001", "VIC_F_25-40_002"]
    turns = qa_run.scripts(scenes, known)
    made = turns.select("key", F.col("raw").alias("value")).distinct()
    again = qa_run.scripts(scenes, known, made.limit(1))
    assert again.select("scene", "idx", "text").exceptAll(turns.select("scene", "idx", "text")).isEmpty() and again.where("hit").select("scene").distinct().count() == 1
    with pytest.raises(Exception, match="unknown speaker"):
        qa_run.scripts(scenes, known[:1]).collect()
    speech = qa_run.utterances(spark.createDataFrame([("שלום", "v", "calm", 1.0, 0.0, 0.0, None)], f"spoken string, voice string, style string, rate double, pitch double, volume double, phrases {ssml.PHRASES}"))
    one = speech.first()
    assert one["wav"][:4] == b"RIFF" and not one["hit"] and one["error"] is None
    hit = qa_run.utterances(speech.select("spoken", "voice", "style", "rate", "pitch", "volume", "phrases"), speech.select("key", F.col("wav").alias("value"))).first()
    assert hit["hit"] and hit["wav"] == one["wav"]


def test_mixdown(spark):
    rows = spark.createDataFrame([("s", 0, [1.0, 1.0]), ("s", 1, [0.5, 0.5, 0.5])], "scene string, first int, samples array<double>")
    assert qa_run.mixed(rows).first()["samples"] == [1.0, 1.5, 0.5, 0.5]


def test_labels_of_rendered_scenes(spark):
    rows = spark.createDataFrame([("A-1", 0, "a", "AGG", 5, "Furious", 1.0, 0.0, 1.0), ("A-1", 1, "v", "VIC", 2, "calm", 1.0, 1.0, 1.5)], "scene string, idx int, speaker string, role string, intensity int, emotion string, seconds double, onset double, offset double")
    got = qa_run.event_labels(rows, spark.createDataFrame([("A-1", "SV")], "scene string, typology string")).orderBy("event_id").collect()
    assert [(r["event_id"], r["onset"], r["offset"], r["tier2_subtype"], r["emotional_state"], r["truncated"]) for r in got] == [("a_1_00_EVT_000", 0.5, 1.5, "PHYS_HARD", "anger", False), ("a_1_00_EVT_001", 1.5, 2.0, "VERB_SHOUT", "calm", True)]


def test_specified_operators(spark):
    now, base = spark.createDataFrame([("a", 1.0), ("b", 5.0)], "metric string, value double"), spark.createDataFrame([("a", 2.0, 0.5), ("b", 5.1, 0.5)], "metric string, mean double, sd double")
    assert {r["metric"]: r["regressed"] for r in evaluation.regressions(now, base).collect()} == {"a": True, "b": False}
    clips = spark.createDataFrame([(["iaa_disagreement"], 1.0, "train"), ([], 0.5, "train"), ([], None, "train"), ([], 1.0, "val")], "quality_flags array<string>, annotator_confidence double, split string")
    assert evaluation.trainable(clips).count() == 1
    pairs, scenes = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "clip int, speaker string"), spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "clip int, scene int")
    from auralith.operators import graph

    assert {r["clip"]: r["root"] for r in graph.components(evaluation.scene_disjoint(pairs, scenes)).collect()} == {1: 1, 2: 1, 3: 3}


def test_evaluation_reports(spark):
    rows = spark.createDataFrame([("a", "one two", "one two"), ("a", "one two", "one"), ("b", "one two", "x y")], "run string, reference string, hypothesis string")
    scored = lambda kind: spark.createDataFrame([(i, kind, 2.0 - i / 10) for i in range(3)], "clip int, kind string, score double")
    clean = spark.createDataFrame([(i, 3.0) for i in range(9)], "clip int, score double")
    out = evaluation.recogniser_report(rows, clean, scored("noise"))
    assert {r["run"]: (r["median_wer"], r["passed"]) for r in out["runs"].collect()} == {"a": (0.25, True), "b": (1.0, False)} and out["best"].first()["run"] == "a" and out["any_pass"].first()["any_pass"]
    assert out["separations"].first()["separation"] == pytest.approx(1.1)
    clips = spark.createDataFrame([(1, "SV", "situational", "1-3-5", 4.0, "two", "azure", None)], "clip int, typology string, typology_long string, arc string, seconds double, speakers string, backend string, degradation string")
    both = [evaluation.judge_prompt(clips, v).first()["prompt"] for v in ("with_metadata", "no_arc")]
    assert "1-3-5" in both[0] and "1-3-5" not in both[1] and "situational" not in both[1] and "overall_quality" in both[1]
    people = spark.createDataFrame([("v", None, "t", ""), ("v", "", "t", "s")], "tts_voice_id string, voice_family string, text string, text_spoken string")
    assert [(r["voice_family"], r["text_spoken"]) for r in evaluation.with_defaults(people).collect()] == [("v", "t"), ("", "s")]


@pytest.mark.parametrize("audio", [True, False])
def test_equal_markup_is_spoken_once(spark, tmp_path, monkeypatch, audio):
    """Each turn has the speech of its own markup and the measures of its own intensity, but the provider is asked once for each markup."""
    asked = str(tmp_path / "asked")

    def load():
        def speak(text: str) -> bytes:
            with open(asked, "a") as f:
                f.write(f"{hash(text)}\n")
            return providers._tone(text)

        return speak

    monkeypatch.setitem(providers.REGISTRY, ("tts", "counted"), providers.Provider(load, "tts", styles=True))
    turns = [(s, i, r, r, 1 + (s + i) % 5, "שלום לך", "voice", "angry", None) for s in range(12) for i in range(6) for r in [("AGG", "VIC", "BYS")[i % 3]]]
    turns = spark.createDataFrame(turns, f"scene long, idx long, speaker string, role string, intensity int, spoken string, voice string, style string, phrases {ssml.PHRASES}")
    rows = qa_run.render_scenes(turns, voice="counted", **({} if audio else {"audio": False})).collect()
    assert len(open(asked).read().split()) == len({r["key"] for r in rows}) < len(rows) == 72
    for r in rows:
        wav = providers._tone(r["ssml"])
        x = dsp.lombard(dsp.resampled(files.decode(wav)[0].mean(0), 24_000, dsp.RATE), r["intensity"])
        assert (r["samples"], r["speech_end"], r["gate"], r["hit"], r["error"]) == (len(x), dsp.speech_end(x), dsp.gate(x, dsp.RATE, "female")[1], False, None)
        assert ("wav" in r) == audio and (not audio or bytes(r["wav"]) == wav)
