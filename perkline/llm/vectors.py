"""Vectors of an array column as numpy blocks, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: stands for a NULL id inside tasks; as the largest long it loses all ties
NO_ID = np.iinfo(np.int64).max
#: rows that a task works on at once
BLOCK_ROWS = 8192


def dimension(df: DataFrame, column: str) -> int:
    """The most frequent length of the vectors (ties: the longer one); 0
    without any.  Rows of another length hold no comparable vector."""
    found = df.select(F.size(column).alias("d")).where("d > 0").groupBy("d").count()
    first = found.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of ``dim`` finite entries, and these as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.list_(pa.float64()))
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(length == dim)
    flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    x = np.ascontiguousarray(flat, dtype=np.float64).reshape(len(at), dim)
    good = np.isfinite(x).all(axis=1)
    return at[good], x[good]


def ids_of(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NO_ID).to_numpy(zero_copy_only=False)


def id_column(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    """Rows of a binary column that each hold ``width`` numbers of ``kind``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(column), width)


def packed(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * rows.dtype.itemsize * rows.shape[1]
    made = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])
    return made.cast(pa.binary())


def gathered(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """The batches of a task, joined to blocks of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def blocks(df: DataFrame, by: str, n: int, size: int) -> Iterator[DataFrame]:
    """``df`` of ``n`` rows in runs of about ``size`` rows, chosen by a hash of
    the distinct ids ``by``."""
    parts = max(1, -(-n // size))
    for k in range(parts):
        yield df.where(F.pmod(F.xxhash64(by), F.lit(parts)) == k) if parts > 1 else df


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id; of rows
    with one id only the best counts."""
    if len(ids) > 4 * k:
        # every row of a score among the k best distinct ids survives this
        floor = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= floor)
        if len(np.unique(ids[at])) < min(k, len(at)):
            at = np.arange(len(ids))
    else:
        at = np.arange(len(ids))
    at = at[np.lexsort((ids[at], -score[at]))]
    _, first = np.unique(ids[at], return_index=True)
    return at[np.sort(first)[:k]]


def first_by(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1; Spark limits each
    key before the shuffle too."""
    from pyspark.sql import Window

    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)
