"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auralith.llm import byte_bpe, html_render, license_scan, media_avi, mixture, quality_zstd, rules_mcd, simhash, toxicity, url_filter
from auralith.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(table(spark, sf_dir, "pages"))


def op4_media_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_avi.digests(media_avi.store(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.with_paths(table(spark, sf_dir, "documents")))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = simhash.components(table(spark, sf_dir, "documents"), words=4, bits=64, segments=3, radius=4)
    return named.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op7_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_zstd.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filtered(table(spark, sf_dir, "pages"))


def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_mcd.quality_rules(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_byte_bpe, op3_html_render, op4_media_avi, op5_license_scan, op6_simhash_dedup, op7_quality_zstd, op8_url_filter, op9_source_mixture, op10_quality_rules)
}
ORACLES: dict[str, str] = {"op9_source_mixture": mixture.ORACLE}
