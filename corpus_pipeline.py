"""Training-data pipeline: quality rules, toxicity, SimHash near-dedup, source mixture, byte-level BPE.

Each stage works on all that its predecessor kept; between stages run() writes the rows to the shared checkpoint folder and reads them again, and deletes what
no later stage reads. All stages take null, empty and very long texts, rows that repeat a doc_id or have none, empty tables and further columns; what becomes of
them is stated with each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from auralith.llm import byte_bpe, mixture, rules_mcd, simhash, toxicity
from auralith.llm.common import delete, shared_folder, table, tidy

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep; null and empty texts go (fewer than 20 words), repeated rows are judged alike."""
    tidy(spark)
    return rules_mcd.keep_good(docs, COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; null and empty texts have the score of no clause, repeated rows are judged alike."""
    tidy(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by exact Jaccard similarity of five-word shingles from 0.8 on; of rows that repeat a doc_id one, and all without doc_id. Texts without words are copies of each other."""
    tidy(spark)
    return simhash.remove_duplicates(docs, COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; null and empty texts stay once, a null source is a source of its own."""
    tidy(spark)
    return mixture.apply_mix(docs, COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and digests of the ids and of the bytes they decode to; null and empty texts have no ids, each row is encoded by itself."""
    tidy(spark)
    out = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    return byte_bpe.digests(out, ["lang", "source", "ids"])


STAGES = [("quality rules", quality), ("toxicity", clean), ("near-dedup", distinct), ("source mixture", mixed), ("byte-level BPE", encoded)]
#: SQL has no form of the scores and fingerprints; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            delete(spark, f"{folder}/{i - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
