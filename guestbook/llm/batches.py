"""Arrow batches inside tasks: whole texts in, columns out. A null text counts as empty."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def texts_of(column: pa.Array) -> list[str]:
    return [text or "" for text in column.to_pylist()]


def encoded_texts_of(column: pa.Array) -> list[bytes]:
    """The texts in UTF-8, without decoding them."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(work, schema)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns alone, under the operator's own names: other columns cannot clash with them."""
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in columns.items()])


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def give_back() -> None:
    """Return what this worker has freed to the system: workers outlive their tasks, and an executor's memory is shared."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # the C library of Linux
        trim(0)
