"""Appending columns computed in Python on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from ..runtime import ship_package

#: A batch is cut so that the texts in a piece hold about so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row order, cut so that `column` holds about `most` bytes in each piece."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def append(df: DataFrame, fields: Sequence[StructField], compute: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list]]], keep: Sequence[str] | None = None) -> DataFrame:
    """df's columns (only those in `keep`, if given) and the new fields; a column that clashes with a new field is replaced.

    `compute` gets the batches and yields (rows, one array for each new field).
    """
    ship_package(df.sparkSession)
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    names = [f.name for f in kept] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, arrays in compute(batches):
            columns = [rows.column(f.name) for f in kept] + [x if isinstance(x, pa.Array) else pa.array(x) for x in arrays]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, StructType([*kept, *fields]))


def texts_of(column: pa.Array) -> list[str]:
    """The texts, '' for null."""
    return ["" if t is None else t for t in column.to_pylist()]
