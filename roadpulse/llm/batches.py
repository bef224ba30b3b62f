"""Arrow batches cut to bounded sizes, and text columns as byte buffers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of text worked on at once; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Rows of an Arrow batch between Spark and Python; the default of ten thousand long texts would be held several times over.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have the session send at most ``BATCH_ROWS`` rows at once, at every size; a smaller setting stays."""
    now = int(spark.conf.get(_ROWS))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 (or binary) bytes of a column and the n+1 offsets of its values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one piece holds at most ``limit`` bytes of ``column``, or a single row."""
    for batch in batches:
        _, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def with_column(df: DataFrame, source: str, out: str, kind: T.DataType, make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with ``out`` computed from ``source`` by Arrow pieces; an existing ``out`` is replaced."""
    kept = [f for f in df.schema.fields if f.name != out]
    order = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, source):
            columns = [piece.column(piece.schema.get_field_index(n)) for n in order]
            made = make(piece.column(piece.schema.get_field_index(source)))
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*order, out])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(out, kind)]))
