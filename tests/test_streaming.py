"""The streaming forms against their batch forms."""

from pyspark.sql import functions as F

from auralith.operators import qa_run, timeline
from auralith.sources import views as V
from auralith.streaming import windows

DATA = "/root/testdata/sf0.001"


def run(stream, name, mode, tmp_path):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return q


def test_streamed_windows(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    run(windows.streamed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))), "counts", "complete", tmp_path)
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, windows.sliding_counts(events).collect()))


def test_append_new_and_resume(spark, tmp_path):
    rows = spark.createDataFrame([(f"2026-01-01 00:00:{k:02d}", k % 5) for k in range(20)], "ts string, k int").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: windows.append_new(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), ["k"])
    write = lambda: stream().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    write()
    rows.withColumn("k", F.col("k") + 3).write.mode("append").parquet(str(tmp_path / "in"))
    write()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(8))


def test_streamed_drift(spark, tmp_path):
    turns = V.turns(spark, DATA).select("scene", "speaker", "idx", "role", "intensity")
    out = str(tmp_path / "in")
    stream = lambda: windows.streamed_drift(spark.readStream.schema(turns.schema).parquet(out)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    for part in (turns.where("idx < 3"), turns.where("idx >= 3")):
        part.coalesce(1).write.mode("append").parquet(out)
        stream()
    got = spark.read.parquet(str(tmp_path / "out")).select("scene", "speaker", "idx", *[F.round(c, 6).alias(c) for c in ("rate", "pitch", "volume", "breathiness")])
    want = timeline.speaker_drift(turns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_long_enough(spark):
    assert windows.long_enough(spark.createDataFrame([(0.0, 0.05), (0.0, 0.5)], "onset double, offset double")).count() == 1


def test_generated_clips_validate(spark, tmp_path):
    """From scripts to files, and the quality report of those files."""
    scenes = spark.createDataFrame([(1, "she_proves", "SV", "A", "one"), (2, "she_proves", "IT", "B", "two")], "scene long, project string, typology string, tier string, prompt string")
    cast = spark.createDataFrame([("AGG_M_30-45_001", "AGG", "male", "30-45", "v1", "f"), ("VIC_F_25-40_002", "VIC", "female", "25-40", "v2", "f")], "speaker_id string, role string, gender string, age_range string, tts_voice_id string, voice_family string")
    out = {r["clip_id"] for r in qa_run.generate(spark, scenes, cast, str(tmp_path / "he")).collect()}
    assert out == {"scene_1_00", "scene_2_00"}
    report = qa_run.run_qa(spark, str(tmp_path / "he"), summary=True)
    assert report["failed"].select("stem", F.array_join("errors", ",")).collect() == []
    totals = report["totals"].first()
    assert totals["passed"] and totals["total_clips"] == 2 and totals["clips_missing_strong_labels"] == 0 and report["run_summary"]["stats"].count() > 0
    rows = qa_run.generate_manifest(spark, str(tmp_path / "he")).collect()
    assert len(rows) == 2 and all(r["strong_labels_path"] for r in rows)
