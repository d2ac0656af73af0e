"""Embedding whitening by mixed-precision refinement.

An entry ``c`` becomes the long ``x = floor(scale * c) + offset``.

1. *Fit list.*  Each distinct x vector once, written to the shared folder.
2. *Covariance.*  Rows are centred at a whole number before multiplying, so
   every product and sum is exact; what the centre lacks to the mean is taken
   off exactly.  A result thus depends on no order of rows or tasks, and a
   large common offset costs no digit.  Tasks send one number per pair of
   dimensions, Spark adds them up, the driver gets ``dim ** 2`` numbers.
3. *Eigenvectors.*  Those of the float32 matrix, corrected by the iteration
   of Ogita and Aishima with products in extended precision: from
   ``R = I - X'X`` and ``S = X'VX`` follow the eigenvalues and a correction
   ``X <- X + XE`` that converges quadratically.  Pairs closer than the error
   bound form clusters; a cluster's columns are rotated by the eigenvectors
   of its own small matrix, shifted by its mean eigenvalue so that no digit
   is lost, and refined again.
4. *Whitening.*  ``(x - mean) . u / sqrt(e)`` for each row and component.

Defined cases: rows with a NULL vector, a NULL or non-finite entry, an entry
whose x passes 2^53, or another length than the most frequent one are left out
(an empty vector too); repeated rows are each returned, and once in the fit;
a NULL id stays NULL; components whose eigenvalue is zero to working precision
have no whitening and are left out, so a table of one distinct vector, or an
empty one, gives no rows; ``deviation`` is NULL where it passes a long; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm.vectors import dimension, packed, unpacked, usable

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
_EXACT = 1 << 53
_LONG = 1 << 63
_WIDE = np.longdouble


@dataclass
class Whitening:
    """What a fit found; as large as ``dim`` times the components."""

    scale: int
    offset: int
    dim: int
    n: int
    total: list[int]  # per-dimension sums of x
    basis: np.ndarray  # dim x components
    values: np.ndarray  # eigenvalues, falling
    trace: float
    identity_error: float = 0.0


# -- rows ---------------------------------------------------------------------
def _grid(column: pa.Array, dim: int, scale: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that take part, and their x as longs."""
    at, c = usable(column, dim)
    with np.errstate(over="ignore"):
        x = np.floor(scale * c)
    inside = (np.abs(x) + abs(offset) < _EXACT).all(axis=1)
    return at[inside], x[inside].astype(np.int64) + offset


def _distinct(df: DataFrame, vector: str, dim: int, scale: int, offset: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _grid(batch.column(0), dim, scale, offset)
            yield pa.RecordBatch.from_arrays([packed(x)], ["x"])

    return stored(map_arrow(df.select(vector), task, "x binary").distinct(), "whitening-fit")


def _sums(fit: DataFrame, task, kind: str) -> dict[int, object]:
    """Sums by slot of what tasks emit as ``slot, value``."""
    parts = map_arrow(fit, task, f"slot int, value {kind}")
    return {r["slot"]: r["v"] for r in parts.groupBy("slot").agg(F.sum("value").alias("v")).collect()}


def _emit(values, kind: pa.DataType) -> pa.RecordBatch:
    slots = pa.array(range(len(values)), pa.int32())
    return pa.RecordBatch.from_arrays([slots, pa.array(values, kind)], ["slot", "value"])


_WHOLE = pa.decimal128(38, 0)


def _totals(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows, and the sum of each dimension."""

    def task(batches):
        total, n = [0] * dim, 0
        for batch in batches:
            x = unpacked(batch.column(0), np.int64, dim)
            n += len(x)
            # at most 2^53 each, so that a batch's 2,000 or so cannot pass a long
            for at in range(0, len(x), 512):
                total = [a + int(b) for a, b in zip(total, x[at : at + 512].sum(axis=0), strict=True)]
        if n:
            yield _emit([Decimal(v) for v in [*total, n]], _WHOLE)

    got = _sums(fit, task, "decimal(38,0)")
    if not got:
        return 0, [0] * dim
    return int(got[dim]), [int(got[j]) for j in range(dim)]


def _products(fit: DataFrame, dim: int, centre: list[int]) -> np.ndarray:
    """Exact sums of ``(x_i - centre_i)(x_j - centre_j)``, as whole numbers."""
    upper = np.triu_indices(dim)
    middle = np.array(centre, dtype=np.int64)

    def task(batches):
        total, n = np.zeros(len(upper[0]), dtype=object), 0
        for batch in batches:
            d = unpacked(batch.column(0), np.int64, dim) - middle
            n += len(d)
            most = int(np.abs(d).max(initial=0))
            # doubles hold these sums exactly while they stay below 2^53
            step = min(len(d), _EXACT // max(1, most * most))
            for at in range(0, len(d), max(1, step)):
                part = d[at : at + max(1, step)]
                if step:
                    square = part.astype(np.float64)
                    total += (square.T @ square)[upper].astype(np.int64).astype(object)
                else:
                    wide = part.astype(object)
                    total += (wide.T @ wide)[upper]
        if n:
            yield _emit([Decimal(int(v)) for v in total], _WHOLE)

    got = _sums(fit, task, "decimal(38,0)")
    out = np.zeros((dim, dim), dtype=object)
    for slot, (i, j) in enumerate(zip(*upper, strict=True)):
        out[i, j] = out[j, i] = int(got[slot])
    return out


# -- eigenvectors -------------------------------------------------------------
def ratio(a: int, b: int) -> np.longdouble:
    """``a / b`` in extended precision, for whole numbers of any size."""
    shift = max(0, 72 - abs(a).bit_length() + b.bit_length())
    q = (abs(a) << shift) // b
    drop = max(0, q.bit_length() - 72)
    q, exponent = q >> drop, drop - shift
    out = np.ldexp(_WIDE(q >> 36), 36 + exponent) + np.ldexp(_WIDE(q & (1 << 36) - 1), exponent)
    return -out if a < 0 else out


def _norm(a: np.ndarray) -> np.longdouble:
    return np.sqrt((a * a).sum())


def _clusters(values: np.ndarray, width) -> list[np.ndarray]:
    """Runs of falling eigenvalues with neighbours at most ``width`` apart."""
    cut = np.flatnonzero(values[:-1] - values[1:] > width) + 1
    return [run for run in np.split(np.arange(len(values)), cut) if len(run) > 1]


def eigen(v: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the symmetric
    ``v`` in extended precision, from float32 ones by Ogita-Aishima steps."""
    v = v.astype(_WIDE)
    size = _norm(v)
    if not size:
        return np.zeros(len(v), dtype=_WIDE), np.eye(len(v), dtype=_WIDE)
    a = v / size
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start[:, ::-1].astype(_WIDE)
    noise = 8 * len(a) * np.finfo(_WIDE).eps
    for _ in range(rounds):
        s, r = x.T @ (a @ x), np.eye(len(a), dtype=_WIDE) - x.T @ x
        # alike on both sides of the diagonal: a small gap divides what is not
        s, r = (s + s.T) / 2, (r + r.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, s, r = x[:, order], values[order], s[np.ix_(order, order)], r[np.ix_(order, order)]
        off = s - np.diag(values)
        if np.abs(off - np.diag(np.diag(off))).max() <= noise and np.abs(r).max() <= noise:
            break
        bound = 2 * (_norm(off) + _norm(r))
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > bound
        e = r / 2
        e[far] = ((s + values[None, :] * r)[far]) / gap[far]
        x = x + x @ e
        for run in _clusters(values, bound):
            part = x[:, run]
            part = part @ (1.5 * np.eye(len(run), dtype=_WIDE) - 0.5 * (part.T @ part))
            shift = values[run].mean()
            small = part.T @ (a @ part - shift * part)
            scale = np.abs(small).max()
            if scale > noise:
                _, turn = np.linalg.eigh((small / scale).astype(np.float64))
                x[:, run] = part @ turn[:, ::-1].astype(_WIDE)
    return values * size, x / np.sqrt((x * x).sum(axis=0))


# -- fit and apply ------------------------------------------------------------
def _project(d: np.ndarray, lack: np.ndarray, basis: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (d - lack) @ basis / np.sqrt(values)


def fit(
    df: DataFrame, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, components: int = COMPONENTS
) -> Whitening:
    """The whitening of the distinct x vectors of ``df``."""
    dim = dimension(df, vector)
    none = Whitening(scale, offset, dim, 0, [0] * dim, np.zeros((dim, 0)), np.zeros(0), 0.0)
    if not dim:
        return none
    rows = _distinct(df, vector, dim, scale, offset)
    n, total = _totals(rows, dim)
    if not n:
        return none
    centre = [(2 * t + n) // (2 * n) for t in total]
    product = _products(rows, dim, centre)
    rest = [t - n * m for t, m in zip(total, centre, strict=True)]
    v = np.zeros((dim, dim), dtype=_WIDE)
    for i in range(dim):
        for j in range(i, dim):
            v[i, j] = v[j, i] = ratio(n * product[i, j] - rest[i] * rest[j], n * n)
    values, vectors = eigen(v)
    trace = np.trace(v)
    kept = values > trace * dim * np.finfo(np.float64).eps
    kept[components:] = False
    basis = vectors[:, kept]
    sign = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    out = Whitening(
        scale, offset, dim, n, total, (basis * sign).astype(np.float64), values[kept].astype(np.float64), float(trace)
    )
    out.identity_error = _identity_error(rows, out)
    return out


def _centred(model: Whitening) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A whole centre, what it lacks to the mean, and that times ``n``."""
    centre = [(2 * t + model.n) // (2 * model.n) for t in model.total]
    rest = [t - model.n * m for t, m in zip(model.total, centre, strict=True)]
    return np.array(centre, dtype=np.int64), np.array([r / model.n for r in rest]), np.array(rest, dtype=object)


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity."""
    k = len(model.values)
    if not k:
        return 0.0
    centre, lack, _ = _centred(model)
    basis, values, dim = model.basis, model.values, model.dim

    def task(batches):
        total, n = np.zeros(k * k + k), 0
        for batch in batches:
            w = _project(unpacked(batch.column(0), np.int64, dim) - centre, lack, basis, values)
            n += len(w)
            total += np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])
        if n:
            yield _emit(total, pa.float64())

    got = _sums(rows, task, "double")
    sums = np.array([got[i] for i in range(k * k + k)]) / model.n
    # whitened rows have a mean of zero but for rounding, which is taken off
    mean = sums[k * k :]
    return float(np.abs(sums[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``
    for each row that takes part and each component (numbered from 1)."""
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    k = len(model.values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    centre, lack, rest = _centred(model)
    explained = model.values / model.trace
    dim, n, basis, values = model.dim, model.n, model.basis, model.values
    scale, offset, error = model.scale, model.offset, model.identity_error
    most_rest = max(abs(int(r)) for r in rest)

    def deviations(d: np.ndarray) -> list[int | None]:
        bound = n * int(np.abs(d).max(initial=0)) + most_rest
        kind = np.int64 if dim * bound * bound < _LONG else object
        away = n * d.astype(kind) - rest.astype(kind)
        return [v if v < _LONG else None for v in map(int, (away * away).sum(axis=1))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _grid(batch.column(1), dim, scale, offset)
            if not len(at):
                continue
            d = x - centre
            w = _project(d, lack, basis, values)
            row = pa.array(np.repeat(np.arange(len(at)), k))
            size = len(at) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(size, n)),
                    pa.array(deviations(d), pa.int64()).take(row),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(size, error)),
                ],
                names=schema.names,
            )

    return map_arrow(df.select(key, vector), task, schema)
