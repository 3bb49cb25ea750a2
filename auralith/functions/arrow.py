"""Row functions in Python where no expression exists, Arrow in and out, in slices of a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that a worker turns into Python values at once.
SLICE = 64


def map_rows(df: DataFrame, columns: list[str], schema: str, work: Callable[..., tuple]) -> DataFrame:
    """Appends columns (schema, as DDL) that `work` computes from the values of the given columns, a row at a time. Input columns of the same names are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(schema)
    kept = [f for f in df.schema.fields if f.name not in added.names]
    arrow, names = to_arrow_schema(added), [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                values: list[list[Any]] = [part.column(part.schema.get_field_index(c)).to_pylist() for c in columns]
                made = [work(*row) for row in zip(*values, strict=True)]
                new = [pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(n)) for n in names] + new, names=[*names, *arrow.names])

    return df.mapInArrow(run, StructType(kept + added.fields))
