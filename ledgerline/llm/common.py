"""Helpers shared by the operators: table reads, shared scratch tables, text buffers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir

#: Called when a task ends, to empty what its Python worker holds between batches.
AFTER_TASK: list = []

#: Bytes of text that a task works on at once.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, gives the
    optimiser the real size, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str, text_col: str, *others) -> DataFrame:
    """Only the operator's own columns (``id``, ``text``, others), so that further
    columns of the input can have any name."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     *others)


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text each (a longer
    single row stays whole)."""
    ends = np.cumsum(text_lengths(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_lengths(col: pa.Array) -> np.ndarray:
    """UTF-8 bytes per row, null as 0."""
    data, offsets = text_buffer(col)
    return np.diff(offsets)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows' UTF-8 bytes back to back (uint8) and their ``len + 1`` offsets; a
    null row is an empty one."""
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type)
    if not large and not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def id_field(df: DataFrame, id_col: str, name: str = "doc_id"):
    """The id column's own type under the result's name."""
    from pyspark.sql import types as T
    return T.StructField(name, df.schema[id_col].dataType)


def tidy() -> None:
    """Give memory that the worker no longer uses back to the machine: workers outlive
    their tasks."""
    for empty in AFTER_TASK:
        empty()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(function):
    """``function`` over a task's batches, tidying up at its end."""
    def run(batches):
        try:
            yield from function(batches)
        finally:
            tidy()
    return run


def tidied_group(function):
    """``function`` of one group, or of two grouped tables, tidying up after each."""
    def one(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            tidy()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return function(left, right)
        finally:
            tidy()
    return two if function.__code__.co_argcount == 2 else one
