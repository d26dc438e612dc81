"""Add columns that are made from a text column, one Arrow batch after the other."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import small_batches

Maker = Callable[[], Callable[[pa.Array], list[pa.Array]]]

#: Bytes of text that are handled at once; one longer text is handled alone.
PART_BYTES = 1 << 19


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`work`, and behind a task's last batch its freed memory goes back to the machine: workers stay for later tasks, and
    what their allocators keep counts as the executor's."""

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has this
            ctypes.CDLL(None).malloc_trim(0)

    return run


def lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(batch: pa.RecordBatch, column: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about `limit` bytes of text each, so that a task's memory is bounded."""
    if not batch.num_rows:
        return
    ends = np.cumsum(lengths(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def with_columns(df: DataFrame, text: str, fields: str, maker: Maker, keep: list[str] | None = None) -> DataFrame:
    """`df` (or its columns `keep`) and the columns `fields` (DDL) that the made function derives from column `text`.

    `maker` is called once in each task, so that vocabularies and tables are loaded once. A null text is handled as an
    empty one. A column of `df` that has the name of a new one is replaced.
    """
    small_batches(df.sparkSession)
    new = T._parse_datatype_string(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    hidden = "__text"
    source = df.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias(hidden))
    schema = T.StructType([f for f in source.schema.fields if f.name != hidden] + new.fields)

    def work(batches):
        make = maker()
        for batch in batches:
            for part in parts(batch, hidden):
                columns = [part.column(c) for c in kept] + list(make(part.column(hidden)))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new.names])

    return source.mapInArrow(released(work), schema)
