"""The label model's tables, derived from the driver's generic ones; VIEWS has the same derivations in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_US = 1_704_067_200_000_000
ROLE = "CASE event_id % 4 WHEN 0 THEN 'AGG' WHEN 1 THEN 'VIC' WHEN 2 THEN 'BYS' END"
TIER2 = "CASE event_type WHEN 'click' THEN 'VERB_SHOUT' WHEN 'error' THEN 'PHYS_HARD' WHEN 'purchase' THEN 'NONE_AMBIENT' WHEN 'signup' THEN 'EMOT_GASLIT' ELSE 'DIST_SCREAM' END"
EMOTION = "CASE WHEN event_id % 13 < 4 THEN 'neutral' WHEN event_id % 13 < 7 THEN 'anger' WHEN event_id % 13 < 10 THEN 'fear' ELSE 'calm' END"
TURN_ROLE = "CASE role WHEN 'user' THEN 'AGG' WHEN 'assistant' THEN 'VIC' ELSE 'BYS' END"
TYPOLOGY = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'SV' WHEN '2' THEN 'IT' WHEN '3' THEN 'NEG' ELSE 'NEU' END"
TIER = "CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE 'C' END"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event(onset: str) -> list[str]:
    return ["user_id * 100 + day(ts) AS clip", "event_id", f"{onset} AS onset_us", f"{onset} + CAST(round(value * 100) AS BIGINT) * 1000000 AS offset_us", "CAST(1 + event_id % 5 AS INT) AS intensity",
            f"{ROLE} AS role", f"{TIER2} AS tier2", f"split_part({TIER2}, '_', 1) AS tier1", f"{EMOTION} AS emotion"]


def _metrics() -> list[str]:
    return ["user_id * 100 + day(ts) AS clip", f"coalesce({ROLE}, 'UNK') AS role", "CAST(1 + event_id % 5 AS INT) AS intensity", "CASE WHEN event_id % 11 <> 0 THEN 80 + value END AS f0",
            "CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 37 AS DOUBLE) END AS f0_std", "-40 + CAST(event_id % 200 AS DOUBLE) / 10 AS rms", "CASE WHEN event_id % 17 <> 0 THEN -43 + CAST(event_id % 190 AS DOUBLE) / 10 END AS lufs"]


def _metrics_big() -> list[str]:
    return ["l_orderkey AS clip", "CASE l_returnflag WHEN 'A' THEN 'AGG' WHEN 'R' THEN 'VIC' ELSE 'BYS' END AS role", "CAST(1 + (l_linenumber - 1) % 5 AS INT) AS intensity",
            "CASE WHEN l_partkey % 11 <> 0 THEN 80 + l_extendedprice / 250 END AS f0", "CASE WHEN l_partkey % 11 <> 0 THEN l_quantity END AS f0_std", "-40 + 200 * l_discount - 50 * l_tax AS rms",
            "CASE WHEN l_partkey % 17 <> 0 THEN -43 + 200 * l_discount END AS lufs"]


def _clip() -> list[str]:
    return ["o_orderkey AS clip", f"{TYPOLOGY} AS typology", f"{TIER} AS tier", "o_totalprice / 1000 AS duration", "CAST(1 + o_orderkey % 5 AS INT) AS max_intensity", "o_custkey AS custkey",
            "CASE WHEN o_orderkey % 7 = 0 THEN 'unassigned' WHEN o_orderkey % 7 < 5 THEN 'train' ELSE 'val' END AS split", "o_orderkey % 9 AS slot",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'she_proves' ELSE 'elephant_in_the_room' END AS project", "CAST(o_orderkey % 4 AS INT) AS n_caps", "o_orderkey % 13 <> 0 AS has_strong_labels"]


def _turn() -> list[str]:
    return ["conv_id AS scene", "turn AS idx", f"{TURN_ROLE} AS role", "CAST(1 + length(text) % 5 AS INT) AS intensity", "CAST(length(text) % 97 AS DOUBLE) / 10 AS seconds", "text",
            f"{TURN_ROLE} || CASE WHEN turn % 4 = 3 THEN '_2' ELSE '_1' END AS speaker", "CAST(length(text) % 11 AS DOUBLE) / 10 - 0.1 AS amount",
            "CASE WHEN turn = 0 THEN 'sequential' WHEN length(text) % 5 = 3 THEN 'barge_in' WHEN length(text) % 5 = 4 THEN 'overlap' ELSE 'sequential' END AS mode",
            "CAST(length(text) % 97 * 1600 AS BIGINT) AS samples", "CAST(length(text) % 97 * 1600 - length(text) % 3 * 160 * CASE WHEN length(text) % 97 = 0 THEN 0 ELSE 1 END AS BIGINT) AS speech_end"]


def _label() -> list[str]:
    """Strong labels, some of them wrong in one way or another."""
    return ["user_id * 100 + day(ts) AS clip", "event_id", "value AS onset", "CASE WHEN event_id % 53 = 0 THEN value ELSE value + 5 END AS offset_s", f"CASE WHEN event_id % 17 = 0 THEN 'ACOU' ELSE split_part({TIER2}, '_', 1) END AS tier1",
            f"CASE WHEN event_id % 19 = 0 THEN 'PHYS_ODD' ELSE {TIER2} END AS tier2", "CAST(CASE WHEN event_id % 23 = 0 THEN 6 ELSE 1 + event_id % 5 END AS INT) AS intensity", f"CASE WHEN event_id % 29 = 0 THEN 'XXX' ELSE {ROLE} END AS role",
            f"CASE WHEN event_id % 31 = 0 THEN 'bored' ELSE {EMOTION} END AS emotion", "CAST(CASE WHEN event_id % 37 = 0 THEN 1.5 ELSE 1 END AS DOUBLE) AS confidence"]


DUCK_ONSET = f"(epoch_us(ts) - {EPOCH_US})"
SPARK_ONSET = f"(unix_micros(CAST(ts AS TIMESTAMP)) - {EPOCH_US})"
VIEWS = {
    "v_event": "SELECT " + ", ".join(_event(DUCK_ONSET)) + " FROM events",
    "v_label": "SELECT " + ", ".join(_label()) + " FROM events",
    "v_turn_metrics": "SELECT " + ", ".join(_metrics()) + " FROM events",
    "v_turn_metrics_big": "SELECT " + ", ".join(_metrics_big()) + " FROM lineitem",
    "v_clip": "SELECT " + ", ".join(_clip()) + " FROM orders",
    "v_clip_speaker": "SELECT DISTINCT l_orderkey AS clip, l_orderkey // 28 * 10 + l_suppkey % 3 AS speaker FROM lineitem",
    "v_clip_backend": "SELECT o_orderkey AS clip, CASE WHEN o_orderkey % 9 = 1 THEN MAP {} WHEN o_orderkey % 9 > 1 THEN MAP {'AGG': 'tts_' || (o_orderkey % 3), 'VIC': 'tts_' || (o_orderkey % 2)} END AS tts_backend FROM orders",
    "v_clip_flags": "SELECT o_orderkey AS clip, list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'low_snr' END, CASE WHEN o_orderkey % 3 = 0 THEN 'clipping' END], lambda x: x IS NOT NULL) AS quality_flags FROM orders",
    "v_turn": "SELECT " + ", ".join(_turn()) + " FROM conversations",
}


def events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").selectExpr(*_event(SPARK_ONSET))


def labels(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").selectExpr(*_label())


def turn_metrics(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").selectExpr(*_metrics())


def turn_metrics_big(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").selectExpr(*_metrics_big())


def clips(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").selectExpr(*_clip())


def clip_speakers(spark: SparkSession, d: str) -> DataFrame:
    """Clips of one block of order keys share three speakers, so that components are small."""
    return read(spark, d, "lineitem").selectExpr("l_orderkey AS clip", "l_orderkey DIV 28 * 10 + l_suppkey % 3 AS speaker").distinct()


def clip_suppliers(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as speakers, which connects nearly all clips; a row a line, so pairs are repeated."""
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("clip"), F.col("l_suppkey").alias("speaker"))


def clip_backends(spark: SparkSession, d: str) -> DataFrame:
    """clip, tts_backend: a map of role and backend; null and empty maps among them."""
    full = "map('AGG', concat('tts_', o_orderkey % 3), 'VIC', concat('tts_', o_orderkey % 2))"
    return read(spark, d, "orders").selectExpr("o_orderkey AS clip", f"CASE WHEN o_orderkey % 9 = 1 THEN CAST(map() AS MAP<STRING, STRING>) WHEN o_orderkey % 9 > 1 THEN {full} END AS tts_backend")


def clip_flags(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").selectExpr("o_orderkey AS clip", "array_compact(array(CASE WHEN o_orderkey % 5 = 0 THEN 'low_snr' END, CASE WHEN o_orderkey % 3 = 0 THEN 'clipping' END)) AS quality_flags")


def turns(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "conversations").selectExpr(*_turn())


def with_views(sql: str) -> str:
    """The SQL with the definitions of the views that it names."""
    used = [f"{n} AS ({q})" for n, q in VIEWS.items() if f"{n} " in sql.replace("\n", " ").replace(")", " ").replace(",", " ") + " "]
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    rest = body[len("WITH RECURSIVE ") :] if recursive else body[len("WITH ") :] if body.upper().startswith("WITH ") else None
    if not used:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(used) + (f", {rest}" if rest else f" {body}")
