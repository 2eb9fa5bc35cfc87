"""Arrow batches inside tasks: cut to a bounded number of text bytes, columns replaced or added by name."""

from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shipping import map_batches

PIECE_BYTES = 4 * 1024 * 1024


def pieces(batch: pa.RecordBatch, text: str | None = None, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of its column ``text``; a longer row stands alone."""
    if text is None or batch.num_rows < 2:
        if batch.num_rows:
            yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, added: dict[str, pa.Array], without: Collection[str] = ()) -> pa.RecordBatch:
    """The batch with columns of the given names replaced or added at the end, and others left out."""
    columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name not in without} | added
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def schema_with(df: DataFrame, added: dict[str, T.DataType], without: Collection[str] = ()) -> T.StructType:
    """Schema of ``with_columns`` for a frame."""
    fields = {f.name: f.dataType for f in df.schema.fields if f.name not in without} | added
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def add_columns(
    df: DataFrame,
    text: str | None,
    added: dict[str, T.DataType],
    make: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    without: Collection[str] = (),
) -> DataFrame:
    """Map ``make`` over slices of the frame's batches; it gives the arrays of the columns to add or replace. Columns
    in ``without`` are read but do not come back."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text):
                yield with_columns(piece, make(piece), without)

    return map_batches(df, run, schema_with(df, added, without))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
