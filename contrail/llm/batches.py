"""Arrow batches cut into pieces of bounded text, for work inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

PIECE_BYTES = 2 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``max_bytes``; one row is never split.

    ``column`` is text or bytes, or an integer that says how much a row weighs.
    """
    for batch in batches:
        col = batch.column(column)
        sizes = (col if pa.types.is_integer(col.type) else pc.binary_length(col)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_pieces(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, column: str = "text",
               max_bytes: int = PIECE_BYTES, setup: Callable[[], object] | None = None) -> DataFrame:
    """``mapInArrow`` over pieces. ``fn(piece[, state])`` returns columns by name, as lists or arrays.

    ``setup`` runs once per task; its result is handed to every call.
    """
    spark_schema: StructType = _parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for piece in pieces(batches, column, max_bytes):
            out = fn(piece, state) if setup else fn(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema)

    return df.mapInArrow(run, spark_schema)
