"""What the operators of this subpackage share: table reads, checkpoints, small joins, label sampling, Arrow batching."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auralith.session import brief, checkpointed, shared_folder, tidied, tidy  # noqa: F401
from auralith.skew import BROADCAST_ROWS, HEAVY, SMALL, compact, heavy_keys, hot_values, join_skewed, join_small  # noqa: F401

#: Rows that a Python operator holds at once; long texts shorten its output batches further.
SLICE_ROWS, SLICE_BYTES = 512, 4_000_000
#: White space as the word rules of these operators define it (a Java, RE2 and Python character class).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bounds of a fit's sample: bytes of a text that takes part, and of all texts.
FIT_TEXT_BYTES, FIT_BYTES = 262_144, 24_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written as a table in the shared folder and read again, and its path: cuts lineage like a checkpoint, and later readers take only the
    columns they need. Whoever stores it deletes it."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder on the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows: int, size: int = FIT_BYTES) -> DataFrame:
    """(text, y) of at most `rows` labelled documents outside `held_out` and `size` bytes of text, chosen by a hash of doc_id; the bounds are the fit's parameters.

    held_out is a condition on `doc_id`. Documents with several labels count with the largest; null labels and ids count as none. Of rows that
    repeat a doc_id that with the smallest text counts; texts above FIT_TEXT_BYTES don't take part.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("__id"), F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= FIT_TEXT_BYTES)
    # `rows` bounds the broadcast table, an id and a label each, and the rows of the window
    found = texts.join(F.broadcast(chosen), F.col("__id") == F.col("doc_id")).groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return found.withColumn("__upto", F.sum(F.octet_length("text").cast("long")).over(order)).where(F.col("__upto") <= size).select("text", "y")


def fitted(sample: DataFrame, train: Callable[[list[tuple[str, int]]], Any]) -> Any:
    """What `train` makes of a bounded sample (text, y), as (text, 0 or 1) rows. It is trained in one task on an executor; the driver gets the model only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(t, int(y > 0)) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    made = sample.select("text", "y").coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else train([])


def crc_rest(column: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that one slice holds at most SLICE_ROWS rows and, but for one long row, SLICE_BYTES of `text` (or so many values of lists)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
        sizes = pc.fill_null(length(column), 0).to_pylist() if batch.num_rows else []
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= SLICE_ROWS or held + n > SLICE_BYTES):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(sizes) > start:
            yield batch.slice(start)


def map_texts(df: DataFrame, text: str, schema: str, work: Callable[[list[str]], list[pa.Array]]) -> DataFrame:
    """Appends columns that `work` computes from the whole texts of a slice (null: empty), Arrow in and out.

    schema: the appended columns, as DDL. Input columns of the same names are replaced.
    """
    return map_values(df, text, schema, lambda values: work([t or "" for t in values]))


def map_values(df: DataFrame, column: str, schema: str, work: Callable[[list], list[pa.Array]]) -> DataFrame:
    """As map_texts, for the plain values of any column (null: None)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    kept = [f for f in df.schema.fields if f.name not in added.names]
    out = StructType(kept + added.fields)
    arrow = to_arrow_schema(added)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            values = part.column(part.schema.get_field_index(column)).to_pylist()
            made = [a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, f.type) for a, f in zip(work(values), arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(n)) for n in names] + made, names=[*names, *arrow.names])

    return df.mapInArrow(run, out)
