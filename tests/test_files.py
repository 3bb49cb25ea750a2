"""Readers, validators, reports and writers on a folder of clips written here."""

import csv
import hashlib
import io
import json
import tarfile
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from auralith.operators import iaa, qa_run, validate
from auralith.plans.extended import QUERIES
from auralith.sinks import files as sinks
from auralith.sources import files

SPEAKERS = [{"speaker_id": f"{r}_{g[0].upper()}_30-45_00{k}", "role": r, "gender": g, "age_range": "30-45", "tts_voice_id": f"v{k}", "voice_family": ""} for k, (r, g) in enumerate([("AGG", "male"), ("VIC", "female")])]


def wav(seconds=4.0, rate=16_000, peak=0.5, pad=0.5, channels=1):
    x = peak * np.sin(2 * np.pi * 220 * np.arange(int(seconds * rate)) / rate)
    n = int(pad * rate)
    if n:
        x[:n] = x[-n:] = 0
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.repeat((x * 32767).astype("<i2"), channels).tobytes())
    return out.getvalue()


def clip(name, **more):
    return {"clip_id": name, "project": "she_proves", "language": "he", "violence_typology": "SV", "tier": "A", "duration_seconds": 4.0, "sample_rate": 16000, "channels": 1, "generation_date": "2026-01-01", "generator_version": "1", "is_synthetic": True,
            "speakers": SPEAKERS, "weak_label": {"has_violence": True, "violence_categories": ["VERB"], "max_intensity": 5, "violence_typology": "SV"}, "quality_flags": []} | more


def event(name, k, onset, offset, intensity, role, emotion="anger", **more):
    return {"event_id": f"{name}_EVT_{k:03d}", "clip_id": name, "onset": onset, "offset": offset, "tier1_category": "VERB", "tier2_subtype": "VERB_SHOUT", "intensity": intensity, "speaker_role": role, "emotional_state": emotion} | more


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("data") / "he" / "agg"
    d.mkdir(parents=True)

    def put(name, audio=None, doc=None, txt="[CLIP_ID: x]\nשלום לך\n", lines=None):
        for ext, data in (("wav", audio), ("json", doc and json.dumps(doc).encode()), ("txt", txt and txt.encode()), ("jsonl", None if lines is None else "\n".join(lines).encode())):
            if data is not None:
                (d / f"{name}.{ext}").write_bytes(data)

    good = [json.dumps(event("good_1", 0, 0.5, 1.5, 1, "AGG", "neutral")), "", "{broken", json.dumps(event("good_1", 1, 1.0, 2.0, 5, "AGG", "neutral")), json.dumps(event("good_1", 2, 2.5, 3.5, 4, None, None)), json.dumps(event("good_1", 3, 3.0, 2.0, 4, "VIC"))]
    put("good_1", wav(), clip("good_1", generation_metadata={"pipeline_version": "1", "tts_backend": {"a": "azure", "b": "google"}, "effective_prosody_caps": [{"turn_index": 0, "intensity": 5, "dim": "rate", "pre_cap": 1.3, "post_cap": 1.2}]}), lines=good)
    put("good_2", wav(), clip("other_id", violence_typology="IT", quality_flags=["low_snr"], extra_field=1), lines=[json.dumps(event("good_2", 0, 0.5, 1.0, 4, "VIC"))])
    put("no_labels", wav(), clip("no_labels", tier="B"))
    put("Bad_Name", wav(), clip("Bad_Name"))
    put("loud", wav(peak=1.0), clip("loud"))
    put("short", wav(seconds=2.0), clip("short"))
    put("no_text", wav(), clip("no_text"), txt=None)
    put("bad_doc", wav(), clip("bad_doc", violence_typology="XX"))
    put("wrong_type", wav(), clip("wrong_type", duration_seconds="long"))
    put("stereo", wav(channels=2), clip("stereo"))
    put("broken", b"RIFFnothing", clip("broken"))
    put("good_1_dirty", wav(peak=1.0), clip("good_1_dirty"))
    return str(d.parent)


def test_validation(spark, folder):
    results = validate.clip_results(files.sidecars(files.clean(files.listing(spark, folder))), files.clip_documents(spark, folder), files.audio(spark, folder))
    got = {r["stem"]: (r["errors"], r["warnings"]) for r in results.collect()}
    assert {s for s, (e, _) in got.items() if not e} == {"good_1", "good_2", "no_labels"}
    assert got["good_2"][1] == ["clip_id is not the name"] and got["no_labels"][1] == ["missing strong labels"]
    assert got["Bad_Name"] == (["disallowed characters in the name"], []) and got["no_text"][0] == ["missing transcript"]
    assert got["loud"][0] == ["peak exceeds -1 dBFS"] and got["short"][0] == ["duration is below 3 s"] and got["stereo"][0] == ["channels is not 1"]
    assert got["bad_doc"][0] == got["wrong_type"][0] == ["invalid metadata"] and got["broken"][0][0].startswith("Cannot load audio")


def test_readers(spark, folder):
    assert {r["stem"] for r in files.wavs(files.listing(spark, folder)).collect()} | {"good_1_dirty"} == {r["stem"] for r in files.wavs(files.listing(spark, folder), dirty=True).collect()}
    events = files.event_lines(spark, folder).where("stem = 'good_1'").orderBy("line").collect()
    assert [(r["line"], r["event"]["intensity"], r["event"]["confidence"], r["event"]["label_source"]) for r in events] == [(0, 1, 1.0, "auto"), (3, 5, 1.0, "auto"), (4, 4, 1.0, "auto")]
    with pytest.raises(Exception, match="bad label line"):
        files.strict_events(spark, folder).collect()
    assert {r["text"] for r in files.transcripts(spark, folder).collect()} == {"שלום לך"}
    with pytest.raises(Exception, match="no transcript"):
        files.corpus_clips(spark, folder).collect()


def test_quality_report(spark, folder, tmp_path):
    splits = spark.createDataFrame([("good_1", "train")], "clip_id string, split string")
    report = qa_run.run_qa(spark, folder, splits, summary=True)
    out = sinks.qa_report(report, str(tmp_path / "r.json"))
    s = out["stats"]
    assert not out["passed"] and out["failure_rate"] == round(8 / 11, 6) and s["total_clips"] == 3 and s["failed_clips"] == 8
    assert s["clips_by_typology"] == {"SV": 2, "IT": 1} and s["clips_by_split"] == {"train": 1, "unassigned": 2} and s["intensity_distribution"] == {"5": 3} and s["speaker_count"] == 2
    assert s["quality_flagged_clips"] == 1 and out["quality_flagged"] == {"other_id": ["low_snr"]} and s["clips_missing_strong_labels"] == 1
    assert s["clips_with_prosody_cap_activations"] == 1 and out["prosody_cap_activations"] == {"good_1": 1}
    assert out["structural_warnings"] == {"good_1": ["warn_emotion_downgrade"], "other_id": ["warn_no_overlap"]}
    # both AGG turns are of the same level: no escalation
    assert out["acoustic_warnings"] == {"good_1": ["agg_no_escalation"]}
    r = out["run_summary"]
    assert r["clips_by_tts_backend"] == {"azure": 1, "google": 1, "unknown": 2} and r["voices_by_gender"] == {"male": 1, "female": 1}
    assert r["overlap_ratio"] == 0.5 and r["clips_i4"] == 2 and r["downgrade_ratio"] == round(1 / 3, 6)
    assert set(r["run_warnings"]) == {"low_voice_diversity_male", "low_voice_diversity_female", "high_emotion_downgrade", "high_warning_rate"}
    levels = {(x["role"], x["intensity"]): x["rms_mean"] for x in r["role_intensity_stats"]}
    assert set(levels) == {("AGG", 1), ("AGG", 5), ("VIC", 4)} and all(abs(v - 20 * np.log10(0.5 / np.sqrt(2))) < 0.1 for v in levels.values())
    assert json.loads((tmp_path / "r.json").read_text())["stats"] == s


def test_empty_folder_passes(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "note.md").write_text("nothing")
    totals = qa_run.run_qa(spark, str(tmp_path / "x"))["totals"].first()
    assert totals["passed"] and totals["total_clips"] == 0


def test_manifest_csv(spark, folder, tmp_path):
    splits = spark.createDataFrame([("good_1", "train")], "clip_id string, split string")
    root = str(folder).rsplit("/", 1)[0]
    rows = qa_run.generate_manifest(spark, folder, splits, root=root, out=str(tmp_path / "m"))
    assert "bad_doc" not in {r["clip_id"] for r in rows.collect()}
    text = [line for p in sorted((tmp_path / "m").glob("part-*")) for line in csv.reader(p.open())]
    first = next(r for r in text if r[0] == "good_1")
    assert first == ["good_1", "she_proves", "SV", "A", "4.0", "AGG_M_30-45_000|VIC_F_30-45_001", "v0|v1", "True", "5", "", "train", "he/agg/good_1.wav", "he/agg/good_1.jsonl"]
    assert next(r for r in text if r[0] == "no_labels")[-3:] == ["", "he/agg/no_labels.wav", ""]
    sinks.manifest_csv(rows.where("false"), str(tmp_path / "none"))
    assert "clip_id,project" in "".join(p.read_text() for p in (tmp_path / "none").glob("part-*"))


def test_prosody_command(spark, folder):
    turns, stats, checks = qa_run.measure_prosody(spark, folder, [" agg "])
    assert {r["role"] for r in stats.collect()} == {"AGG"} and [(r["name"], r["passed"]) for r in checks.collect()] == [("agg_gain", False)]
    assert all(200 < r["f0_median_hz"] < 240 for r in turns.collect())


def test_agreement_command(spark, tmp_path):
    """Ten clips with all categories by both, ten with two empty files, and folders that don't count."""
    for k in range(20):
        d = tmp_path / "ann" / f"c{k:02d}"
        d.mkdir(parents=True)
        for who in "ab":
            lines = [json.dumps(event("x", i, i, i + 1, 3, "AGG") | {"tier1_category": t, "tier2_subtype": s}) for i, (t, s) in enumerate([("PHYS", "PHYS_HARD"), ("VERB", "VERB_SHOUT"), ("DIST", "DIST_CRY"), ("ACOU", "ACOU_SLAM"), ("EMOT", "EMOT_ISOL")])] if k < 10 else []
            (d / f"annotator_{who}.jsonl").write_text("\n".join(lines))
    for name, content in (("one", ["x.jsonl"]), ("three", ["x.jsonl", "y.jsonl", "z.jsonl"])):
        (tmp_path / "ann" / name).mkdir()
        [(tmp_path / "ann" / name / f).write_text("") for f in content]
    (tmp_path / "ann" / "bad").mkdir()
    [(tmp_path / "ann" / "bad" / f).write_text("{nothing") for f in ("a.jsonl", "b.jsonl")]
    report, verdict, apart = qa_run.run_iaa(spark, str(tmp_path / "ann"), 100)
    rows = {r["category"]: r for r in report.collect()}
    assert all(rows[c]["kappa"] == 1.0 and rows[c]["n"] == 20 and rows[c]["meets_target"] for c in iaa.CATEGORIES)
    assert (rows["INTENS"]["kappa"], rows["INTENS"]["n"]) == (1.0, 50) and (rows["EMOT"]["target"], rows["EMOT"]["least"]) == (0.55, 0.45)
    v = verdict.first()
    assert v["coverage"] == 0.2 and v["passes"] and apart.isEmpty()
    assert not iaa.iaa_verdict(report, files.annotation_pairs(spark, str(tmp_path / "ann"))[0], 101).first()["passes"]
    out = sinks.iaa_json(report, verdict, apart, str(tmp_path / "iaa.json"))
    assert "Overall: PASS" in sinks.iaa_summary(out)


def test_release(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="no version"):
        qa_run.package(spark, folder, str(tmp_path / "a.tar.gz"), "1", ["x"])
    with pytest.raises(RuntimeError, match="failed"):
        qa_run.package(spark, folder, str(tmp_path / "a.tar.gz"), "v1.0", ["x"])
    excluded = spark.createDataFrame([("good_2",), ("absent",)], "clip_id string")
    out = qa_run.package(spark, folder, str(tmp_path / "rel" / "a.tar.gz"), "v1.0", ["First"], excluded, most=1.0)
    with tarfile.open(out["archive"]) as tar:
        names = tar.getnames()
        card = tar.extractfile("DATASET_CARD.md").read().decode()
    assert "he/agg/good_1.wav" in names and not any("_dirty" in n or "good_2" in n for n in names) and out["files"] == len(names) - 1
    assert "| Clips | 3 |" in card and "66.7%" in card and "n<1K" in card
    sums = dict(line.split("  ")[::-1] for line in (tmp_path / "rel" / "a_SHA256SUMS.txt").read_text().splitlines())
    with tarfile.open(out["archive"]) as tar:
        assert all(hashlib.sha256(tar.extractfile(n).read()).hexdigest() == sums[n] for n in names)
    assert (tmp_path / "rel" / "a.tar.gz.sha256").read_text() == f"{hashlib.sha256((tmp_path / 'rel' / 'a.tar.gz').read_bytes()).hexdigest()}  a.tar.gz\n"


def test_writers(spark, tmp_path):
    events = spark.createDataFrame([("c1", 1.0), ("c1", 2.0), ("c2", 3.0)], "clip_id string, onset double")
    sinks.strong_labels(events, str(tmp_path / "labels"))
    back = [json.loads(line)["onset"] for p in (tmp_path / "labels" / "clip_id=c1").glob("*.json") for line in p.read_text().splitlines()]
    assert sorted(back) == [1.0, 2.0] and len(list((tmp_path / "labels" / "clip_id=c1").glob("*.json"))) == 1
    sinks.clip_metadata(events.limit(1), str(tmp_path / "meta"))
    assert "\n" in next((tmp_path / "meta").glob("clip_id=*/*.txt")).read_text()
    rows = spark.createDataFrame([(str(tmp_path / "w" / f"{k}.wav"), sinks.wav_bytes([0.0, 0.5, -1.0])) for k in range(3)], "path string, content binary")
    sinks.write_files(rows)
    x, rate = files.decode((tmp_path / "w" / "1.wav").read_bytes())
    assert rate == 16_000 and np.allclose(x[0], [0, 0.5, -1], atol=1e-4) and len(list((tmp_path / "w").iterdir())) == 3
    first = sinks.keep_original(str(tmp_path / "w" / "1.wav"), str(tmp_path / "dirty"), "c1")
    (tmp_path / "w" / "1.wav").write_bytes(b"changed")
    assert sinks.keep_original(str(tmp_path / "w" / "1.wav"), str(tmp_path / "dirty"), "c1") == first and open(first, "rb").read() != b"changed"
    for _ in range(2):
        sinks.append_new(events, str(tmp_path / "log"), "onset", spark)
    assert spark.read.json(str(tmp_path / "log")).count() == 3
    assert sinks.markdown(events.orderBy("onset"), 2).endswith("... and 1 more")


def test_audio_formats():
    for width, kind in ((1, "u1"), (2, "<i2"), (4, "<i4")):
        x = np.array([0.0, 0.5, -0.5])
        raw = ((x * 127) + 128).astype("u1") if width == 1 else (x * (2.0 ** (8 * width - 1) - 1)).astype(kind)
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(width), w.setframerate(8000)
            w.writeframes(raw.tobytes())
        y, rate = files.decode(out.getvalue())
        assert rate == 8000 and np.allclose(y[0], x, atol=0.01)


def test_configs(spark, tmp_path):
    good = "scene_id: S-1\nproject: she_proves\nviolence_typology: IT\ntier: A\nscript_template: t\nintensity_arc: [1, 3, 5]\ntarget_duration_minutes: 3\nspeakers:\n- {speaker_id: a, role: AGG}\n"
    for name, text in (("a", good), ("b", good.replace("tier: A", "tier: B")), ("c", good.replace("[1, 3, 5]", "[1, 6]")), ("d", "x: [1"), ("e", good.replace("she_proves", "elephant_in_the_room"))):
        (tmp_path / f"{name}.yaml").write_text(text)
    assert [r["project"] for r in files.scenes(spark, str(tmp_path), "she_proves", "A").collect()] == ["she_proves"]
    assert files.scenes(spark, str(tmp_path)).count() == 2
    speaker = "speaker_id: AGG_M_30-45_001\nrole: AGG\ngender: male\nage_range: 30-45\ncontext: both\ntts_voice_id: {v}\ntts_provider: google\nstyle_map:\n  1: {{style: calm, rate_multiplier: 1.0, pitch_delta_st: 0.0, volume_delta_db: 0.0}}\n"
    for folder, v in (("one", "first"), ("two", "second")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "speaker_x.yaml").write_text(speaker.format(v=v))
    (tmp_path / "two" / "speaker_y.yaml").write_text(speaker.format(v="z").replace("AGG_M_30-45_001", "bad id"))
    found = files.speakers(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert [r["tts_voice_id"] for r in found.collect()] == ["first"]
    assert found.select(F.size(validate.speaker_warnings())).first()[0] == 1
    run = files.from_dict(spark, {"run_id": "r", "project": "she_proves", "targets": [{"violence_typology": "SV", "count": 3}], "splits": {"train": 0.7, "val": 0.2, "test": 0.2}}, files.RUN)
    assert run.select(F.array_join(validate.run_errors(), ",")).first()[0] == "split fractions don't sum to 1"
    assert files.rendered("a {{ x }} b", {"x": "1"}) == "a 1 b"
    with pytest.raises(KeyError):
        files.rendered("{{ y }}", {})


def test_lines_are_parsed_once(spark):
    """Filters and fields that follow don't each get a parser of their own."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(QUERIES["S5_event_lines"](spark, "/root/testdata/sf0.001")).count("from_json(") == 1
    rows = spark.createDataFrame([("a", '{"event_id": 1'), ("b", None), ("c", ""), ("d", '{"event_id": "x"}')], "doc string, text string")
    out = files.parsed(rows, "text", files.EVENT, lambda doc: F.when(F.col(f"{doc}.event_id").isNull(), F.array(F.lit("no id"))).otherwise(F.array()))
    assert sorted(r["text"] or "" for r in out.collect()) == ["", "", '{"event_id": "x"}', '{"event_id": 1'] and [r["doc"]["event_id"] for r in out.where("doc IS NOT NULL").collect()] == ["x"]
