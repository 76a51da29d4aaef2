"""Small helpers for operators that run Python over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def id_and_text(docs: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, the text ('' for NULL) and the named columns, so that other columns are never read or clash."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in more],
    )


def schema_with(docs: DataFrame, columns: Sequence[str], extra: str) -> T.StructType:
    """The named columns of ``docs`` followed by those of a DDL string."""
    kept = [T.StructField(c, docs.schema[c].dataType, True) for c in columns]
    return T.StructType(kept + T.StructType.fromDDL(extra).fields)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, '' for NULL."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def small(batches: Iterable[pa.RecordBatch], column: int = 1, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, so that a worker holds few texts at a time."""
    for part in batches:
        sizes = pc.fill_null(pc.binary_length(part.column(column)), 0).to_pylist()
        for low, high in spans_by_size(sizes, limit):
            yield part.slice(low, high - low)


def batch(columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A list column from its flat values and the len + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def spans_by_size(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum up to about ``limit``; one large item is a range of its own."""
    first = total = 0
    last = -1
    for last, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, last
            first, total = last, 0
        total += size
    if last >= first:
        yield first, last + 1
