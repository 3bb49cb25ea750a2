"""Writers of labels, metadata, manifests, reports, transcripts, audio and archives.

Tables are written by Spark; small reports are collected, each with a size that doesn't grow with the clips but for their lists of flagged ones.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import shutil
import tarfile
import wave
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auralith.functions import text as T
from auralith.operators import labels as L
from auralith.operators import manifest as M


def strong_labels(events: DataFrame, folder: str) -> None:
    """A folder of JSON lines a clip. events: clip_id and the fields of strong labels."""
    events.repartition("clip_id").write.partitionBy("clip_id").mode("overwrite").json(folder)


def clip_metadata(docs: DataFrame, folder: str) -> None:
    """K2: an indented JSON document a clip, in folders by clip."""
    pretty = F.to_json(F.struct(*docs.columns), {"pretty": "true", "ignoreNullFields": "false"})
    docs.select("clip_id", pretty.alias("value")).repartition("clip_id").write.partitionBy("clip_id").mode("overwrite").text(folder)


def manifest_text(rows: DataFrame) -> DataFrame:
    """K3: the manifest's columns as texts: True and False, numbers as they are."""
    return rows.select(*[F.when(F.col(c), "True").otherwise("False").alias(c) if c == "has_violence" else F.col(c).cast("string").alias(c) for c in M.COLUMNS])


def manifest_csv(rows: DataFrame, folder: str) -> None:
    """K3, L1: the manifest in path order, a header in each part, and one without rows too."""
    manifest_text(rows).orderBy("wav_path").write.mode("overwrite").option("header", True).option("emptyValue", "").csv(folder)


def prosody_text(turns: DataFrame) -> DataFrame:
    """K5: a turn's measures with two decimals, empty where there is none."""
    number = lambda c: F.coalesce(F.format_string("%.2f", F.col(c)), F.lit(""))
    return turns.select("clip_id", "speaker_role", "intensity", *[F.when(F.col(c).isNull(), "").otherwise(number(c)).alias(c) for c in ("f0_median_hz", "f0_std_hz", "rms_db")])


def prosody_csv(turns: DataFrame, folder: str) -> None:
    """K5."""
    prosody_text(turns).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(folder)


def _pairs(df: DataFrame) -> dict:
    return {str(k): v for k, v in sorted(tuple(r) for r in df.collect())}


def qa_report(report: dict, path: str) -> dict:
    """K4: the report of qa_run.run_qa as JSON; keys of maps are texts. The flagged clips are listed, so it grows with them."""
    h: dict[str, dict] = {}
    for r in report["histograms"].collect():
        h.setdefault(r["dim"], {})[str(r["key"])] = r["clips"]
    totals = report["totals"].first().asDict()
    lists = {name: {r["clip"]: r["value"] for r in report[name].collect()} for name in ("quality_flagged", "acoustic_warnings", "structural_warnings", "prosody_cap_activations")}
    out = {"passed": totals.pop("passed"), "failure_rate": totals.pop("failure_rate"), "stats": totals | {"clips_by_typology": h.get("typology", {}), "clips_by_split": h.get("split", {}), "clips_by_tier": h.get("tier", {}), "intensity_distribution": h.get("max_intensity", {})},
           "failed_clip_ids": [r["stem"] for r in report["failed"].orderBy("dir", "stem").collect()], **lists}
    if "run_summary" in report:
        s = report["run_summary"]
        out["run_summary"] = {"role_intensity_stats": [r.asDict() for r in s["stats"].orderBy("role", "intensity").collect()], "voices_by_gender": _pairs(s["voices"]), "clips_by_tts_backend": _pairs(s["backends"]),
                              **s["ratios"].first().asDict(), "outlier_clip_ids": sorted(r["clip"] for r in s["outliers"].collect()), "run_warnings": [r["warning"] for r in s["warnings"].collect()]}
    _write(path, json.dumps(out, indent=2))
    return out


def _write(path: str, text: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, "utf-8")


def iaa_json(report: DataFrame, verdict: DataFrame, disagreements: DataFrame, path: str) -> dict:
    """K6: six categories and the verdict; the clips in disagreement are listed."""
    rows = [r.asDict() for r in report.collect()]
    out = verdict.first().asDict() | {"disagreement_clip_ids": sorted(r["clip"] for r in disagreements.collect()), "category_results": rows}
    _write(path, json.dumps(out, indent=2))
    return out


def iaa_summary(report: dict) -> str:
    """The same as text."""
    mark = lambda b: "yes" if b else "no"
    lines = [f"{report['clips_reviewed']} clips reviewed ({report['coverage']:.1%} coverage)", "", f"{'category':<10}{'kappa':>8}{'target':>8}{'least':>8}{'target?':>9}{'least?':>8}"]
    lines += [f"{r['category']:<10}{r['kappa']:>8.3f}{r['target']:>8.2f}{r['least']:>8.2f}{mark(r['meets_target']):>9}{mark(r['meets_min']):>8}" for r in report["category_results"]]
    lines += ["", *[f"disagreement: {c}" for c in report["disagreement_clip_ids"]], f"Overall: {'PASS' if report['passes'] else 'FAIL'}"]
    return "\n".join(lines)


def markdown(df: DataFrame, most: int | None = None) -> str:
    """A table of all rows, or of the first with a line that counts the others."""
    rows = df.limit(most + 1).collect() if most is not None else df.collect()
    shown = rows[:most] if most is not None else rows
    out = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns), *["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in shown]]
    return "\n".join(out + ([f"... and {df.count() - most} more"] if len(rows) > len(shown) else []))


def dataset_card(totals: dict, shares: DataFrame, version: str, projects: list[str]) -> str:
    """K7: front matter and statistics of a release. totals: clips, seconds, speakers, failed, flagged; shares: A34's rows."""
    n = totals["clips"]
    rows = {d: shares.where(F.col("dim") == d).orderBy("key").select(F.col("key").alias(d), "clips", "share") for d in ("typology", "tier", "split")}
    parts = [f"---\nlanguage:\n- he\nlicense: cc-by-4.0\ntask_categories:\n- audio-classification\nsize_categories:\n- {L.size_name(n)}\n---", f"# Synthetic speech dataset {version}", "\n".join(f"- **{p}**" for p in projects),
             "## Statistics\n\n| Metric | Value |\n|-|-|\n" + "\n".join(f"| {k} | {v} |" for k, v in (("Clips", f"{n:,}"), ("Duration", f"{totals['seconds'] / 3600:.1f} h ({totals['seconds']:,.0f} s)"), ("Speakers", f"{totals['speakers']:,}"), ("Failed clips", f"{totals['failed']:,}"), ("Flagged clips", f"{totals['flagged']:,}"))),
             *[f"### By {d}\n\n{markdown(df)}" for d, df in rows.items()],
             "## Processing\n\n16 kHz mono PCM, 80 Hz high-pass, peak at -2 dBFS with a limit of -1 dBFS, half a second of silence at both ends."]
    return "\n\n".join(parts) + "\n"


def checksums(spark: SparkSession, folder: str, excluded: DataFrame | None = None) -> DataFrame:
    """Path (below the folder's parent), size, sha256 of the files an archive takes; hashed on executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    files = files.withColumn("stem", F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1)).where(~F.col("stem").contains("_dirty"))
    if excluded is not None:
        files = files.join(excluded.select(F.col("clip_id").alias("stem")).distinct(), "stem", "left_anti")
    return files.select(M.relative(F.col("path"), os.path.dirname(os.path.abspath(folder))).alias("path"), "size", "sha256")


def archive(spark: SparkSession, folder: str, out: str, card: str | None = None, excluded: DataFrame | None = None) -> dict:
    """K8: a .tar.gz of the folder, a list of checksums and the archive's own beside it; no retained originals, links or excluded clips. The packing itself is the driver's."""
    rows = [r for r in checksums(spark, folder, excluded).orderBy("path").collect() if not (Path(folder).parent / r["path"]).is_symlink()]
    Path(out).parent.mkdir(parents=True, exist_ok=True)
    sums = [f"{r['sha256']}  {r['path']}\n" for r in rows]
    with tarfile.open(out, "w:gz") as tar:
        for r in rows:
            tar.add(Path(folder).parent / r["path"], arcname=r["path"])
        if card is not None:
            data, info = card.encode(), tarfile.TarInfo("DATASET_CARD.md")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
            sums.append(f"{hashlib.sha256(data).hexdigest()}  DATASET_CARD.md\n")
    name, digest = Path(out).name, hashlib.file_digest(open(out, "rb"), "sha256").hexdigest()
    _write(str(Path(out).with_name(name.removesuffix(".tar.gz") + "_SHA256SUMS.txt")), "".join(sums))
    _write(out + ".sha256", f"{digest}  {name}\n")
    return {"archive": out, "sha256": digest, "files": len(rows), "bytes": sum(r["size"] for r in rows)}


def transcript_texts(turns: DataFrame) -> DataFrame:
    """K9: clip_id, value: a clip's whole transcript. turns: clip_id, idx, speaker_id, role, onset, offset, text, action, intensity."""
    line = T.transcript_lines(*[F.col(c) for c in ("speaker_id", "role", "onset", "offset", "text", "action", "intensity")])
    rows = turns.groupBy("clip_id").agg(F.sort_array(F.collect_list(F.struct("idx", line.alias("t")))).alias("ts"))  # the turns of one clip
    return rows.select("clip_id", F.concat(F.format_string("[CLIP_ID: %s]\n", "clip_id"), F.array_join(F.transform("ts", lambda t: t["t"]), "\n"), F.lit("\n")).alias("value"))


def wav_bytes(samples: list[float], rate: int = 16_000) -> bytes:
    """Mono 16-bit PCM in a WAV container."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.rint(np.asarray(samples, float) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def write_files(rows: DataFrame, path: str = "path", content: str = "content") -> None:
    """Each row's bytes to its path, by the executors, on a folder that they share; through a name of its own, so that a lost task leaves no half file."""

    def run(part) -> None:
        for r in part:
            Path(r[path]).parent.mkdir(parents=True, exist_ok=True)
            part_name = f"{r[path]}.{os.getpid()}.part"
            Path(part_name).write_bytes(bytes(r[content]))
            os.replace(part_name, r[path])

    rows.select(path, content).foreachPartition(run)


def keep_original(source: str, folder: str, clip: str) -> str:
    """A copy of the unprocessed file, never overwritten."""
    target = Path(folder) / f"{clip}_dirty{Path(source).suffix}"
    target.parent.mkdir(parents=True, exist_ok=True)
    if not target.exists():
        shutil.copy2(source, target)
    return str(target)


def append_new(rows: DataFrame, folder: str, key: str, spark: SparkSession) -> None:
    """Appends the rows whose key the table doesn't have yet, once each."""
    fresh = rows.dropDuplicates([key])
    if os.path.isdir(folder) and any(Path(folder).glob("*.json")):
        fresh = fresh.join(spark.read.schema(rows.schema).json(folder).select(key), key, "left_anti")
    fresh.write.mode("append").json(folder)


def percent_or_dash(n: Column, total: Column) -> Column:
    """P16."""
    return F.when(total == 0, "—").otherwise(F.format_string("%.1f%%", F.bround(100.0 * n / F.nullif(total, F.lit(0)), 1)))
