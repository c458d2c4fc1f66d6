"""What several operators share: tables, stored steps, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import stored

__all__ = ["chunks", "map_chunks", "map_rows", "record_batch", "stored", "table", "utf8"]

#: Bytes of text handled at once inside a task; longer texts are handled alone.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: str):
    """The text as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def map_chunks(
    df: DataFrame,
    fn: Callable[..., pa.RecordBatch | None],
    schema: str,
    text: int,
) -> DataFrame:
    """Apply ``fn(*columns as lists)`` to runs of rows with about ``CHUNK_BYTES`` of
    bytes in column number ``text``. ``fn`` returns a record batch or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                out = fn(*(c.to_pylist() for c in piece.columns))
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def map_rows(
    df: DataFrame,
    fn: Callable[..., pa.RecordBatch],
    schema: str,
    text: int,
    carry: Sequence[str] = (),
) -> DataFrame:
    """As ``map_chunks``, with one row out for each row in. ``fn`` does not see the
    columns of ``carry``; they are added to its result unchanged."""
    own = [c for c in df.columns if c not in carry]
    kinds = dict(df.dtypes)
    whole = ", ".join([schema, *(f"`{c}` {kinds[c]}" for c in carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                out = fn(*(piece.column(c).to_pylist() for c in own))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, *(piece.column(c) for c in carry)],
                    names=[*out.schema.names, *carry],
                )

    return df.mapInArrow(run, whole)


def chunks(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``CHUNK_BYTES`` of text each."""
    start = size = 0
    lengths = pc.binary_length(batch.column(text)).to_pylist()
    for i, n in enumerate(lengths):
        n = n or 0
        if i > start and size + n > CHUNK_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def record_batch(schema: str, *columns) -> pa.RecordBatch:
    """A batch from columns in the order of a schema like ``"a long, b string"``."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }
    names, types = zip(*(part.strip().split(" ") for part in schema.split(",")))
    arrays = [pa.array(c, type=kinds[t]) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))
