"""Shared plumbing: reading tables, cutting lineage, Arrow text access."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.functions.lineage import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet`` through Spark, whatever store it is in."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and text columns alone, as ``doc_id`` and ``text``; null texts become empty.

    Dropping every other column first keeps clashing extra columns out of joins
    and prunes the Parquet scan to two columns.
    """
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string")) % n


def fit_rows(labelled: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows of a labelled key table, chosen by a hash of the key.

    Only ids and labels pass through the top-k, so it stays small; the texts are
    joined afterwards. The choice depends on the keys alone, never on layout.
    """
    return labelled.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(bound)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte buffer and its row offsets, without copies."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def text_chunks(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a text column into runs of whole rows of about ``most`` bytes.

    Yields (first row, end row, bytes, offsets within those bytes). A longer
    single text is one chunk of its own.
    """
    data, at = utf8(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Keys that may be sent to every executor: 64 MB of longs at most.
BROADCAST_ROWS = 1 << 20


def join_few(docs: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Inner join with a table expected to be small: broadcast if its counted rows
    are within BROADCAST_ROWS, else a shuffled join."""
    few = cut(few)
    return docs.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, key)


def drop_ids(docs: DataFrame, rejected: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the keys of ``rejected``: an anti-join, broadcast only within BROADCAST_ROWS."""
    ids = cut(rejected.select(key).distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, key, "left_anti").select(*docs.columns)


_KEPT: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """A worker's large table, made once and kept for its next tasks of the same kind."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Give back what other tasks have left in this worker process.

    A task's function and what it holds are a cycle, so that its tables live until
    the collector comes. What the worker itself loaded is left out of that.
    """
    if not gc.get_freeze_count():
        gc.freeze()
    _KEPT.clear()
    release()


def release() -> None:
    """Return freed memory of this process to the system, which allocators would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """For map functions that keep nothing: workers are reused, so they first drop what others kept."""

    @functools.wraps(run)
    def started(batches: Iterable) -> Iterator:
        forget()
        yield from run(batches)

    return started
