"""Approximate nearest neighbours by a permutation index (largest inner product).

1. *Pivots.*  Up to ``PIVOTS`` vectors of a bounded sample, chosen by hash and
   kept apart from each other.  A vector gets one more coordinate that lifts
   it to the length of the longest one (a query gets zero there), so that the
   largest inner product is the smallest distance for vectors of any length.
2. *Permutation.*  A vector is represented by its ``POSTED`` nearest pivots, in
   order.  Every row is indexed; rows are laid out by their nearest pivot
   (ranges of pivot and id, so a crowded pivot is cut into several) and
   written to the shared folder.
3. *Inverted files.*  A task takes its rows in blocks and posts each under its
   pivots: a list per pivot of rows and positions.  Rows of a block have their
   first pivots in common, so most lists of a block are short or empty.
4. *Search.*  A query reads the lists of its ``ASKED`` nearest pivots; each
   entry lowers the footrule distance to that row.  Rows are ranked by it, and
   those within the radius are reranked by the exact product.
5. *Radius.*  ``SAMPLE`` queries are answered by comparing them with all rows;
   the radius is the smallest that holds the share ``RECALL`` of their true
   neighbours.  So the work follows what the data need, at any size.

Queries are shared with the tasks in runs of bounded size, each run is one pass
over the index, and its result is written before the next.  A query that finds
fewer than ``k`` rows within the radius is answered by comparing it with all.

Defined cases: rows whose vector is NULL, zero, of another length than the most
frequent one, or has a NULL or non-finite entry take no part.  Rows with one
``vec_id`` are one point: its nearness is the best of its rows, and none of
them is a candidate for its own query.  A NULL id is a candidate, last among
ties, and no query.  Where there are fewer than ``k`` candidates, all are
returned; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm.vectors import (
    best,
    blocks,
    dimension,
    first_by,
    gathered,
    id_column,
    ids_of,
    packed,
    unpacked,
    usable,
)
from perkline.session import scratch_path

#: pivots; the nearest ones a row is posted under; those a query asks
PIVOTS, POSTED, ASKED = 256, 64, 32
#: rows that pivots are chosen from, queries that the radius is fitted on
POOL, SAMPLE = 1024, 192
#: share of the sample's true neighbours within the radius
RECALL = 0.985
#: pivots of the pool that are nearer to another than this cosine come last
APART = 0.9
#: bytes of queries that are shared at once
QUERY_BYTES = 16 << 20
#: room for rounding when rows are preselected by a matrix product
_SLACK = 1e-12


@dataclass
class Index:
    """``rows`` holds ``id, vector, perm, first, query``, written; the rest is
    bounded by the pivots."""

    rows: DataFrame
    dim: int
    pivots: np.ndarray  # unit length, with the added coordinate
    longest: float
    posted: int
    asked: int


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that makes them ``longest`` long."""
    rest = np.sqrt(np.maximum(0.0, longest * longest - (x * x).sum(axis=1)))
    return np.column_stack([x, rest])


def _nearest(x: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` nearest pivots of each row, in order."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :m].astype(np.uint16)


def _as_queries(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.zeros(len(x))])


def _choose(pool: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` unit pivots, those apart from all before first."""
    unit = pool / np.sqrt((pool * pool).sum(axis=1, keepdims=True))
    unit = unit[np.sort(np.unique(unit, axis=0, return_index=True)[1])]
    apart, near = [], []
    for i in range(len(unit)):
        (near if apart and (unit[apart] @ unit[i]).max() > APART else apart).append(i)
    return unit[[*apart, *near][:count]]


def _vectors(df: DataFrame, key: str, vector: str, query: Column, dim: int) -> DataFrame:
    """``id, vector, query`` of the rows that take part."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = usable(batch.column(1), dim)
            some = (x != 0).any(axis=1)
            at, x = pa.array(at[some]), x[some]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), packed(x), batch.column(2).take(at)], ["id", "vector", "query"]
            )

    rows = df.select(F.col(key).cast("long").alias("id"), vector, F.coalesce(query, F.lit(False)).alias("query"))
    return map_arrow(rows, task, "id long, vector binary, query boolean")


def _longest(rows: DataFrame, dim: int) -> float:
    def task(batches):
        for batch in batches:
            x = unpacked(batch.column(0), np.float64, dim)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((x * x).sum(axis=1)).max())])], ["m"])

    return map_arrow(rows.select("vector"), task, "m double").agg(F.max("m")).first()[0] or 0.0


def build(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    query: Column | None = None,
    pivots: int = PIVOTS,
    posted: int = POSTED,
    asked: int = ASKED,
) -> Index | None:
    """The index of all rows of ``df``; ``query`` marks the rows to search for.
    None without a usable vector."""
    dim = dimension(df, vector)
    if not dim:
        return None
    rows = _vectors(df, key, vector, query if query is not None else F.lit(False), dim)
    longest = _longest(rows, dim)
    if not longest:
        return None
    pool = rows.select("vector").orderBy(F.xxhash64("id", "vector")).limit(POOL).toArrow()
    chosen = _choose(_lifted(unpacked(pool["vector"], np.float64, dim), longest), pivots)
    posted = min(posted, len(chosen))
    shared = df.sparkSession.sparkContext.broadcast((chosen, longest))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, longest = shared.value
        for batch in batches:
            perm = _nearest(_lifted(unpacked(batch.column(1), np.float64, dim), longest), chosen, posted)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, packed(perm), pa.array(perm[:, 0].astype(np.int32))], [*batch.schema.names, "perm", "first"]
            )

    made = map_arrow(rows, task, "id long, vector binary, query boolean, perm binary, first int")
    kept = stored(made.repartitionByRange(F.col("first"), F.col("id")), "permutation-index")
    return Index(kept, dim, chosen, longest, posted, min(asked, posted))


class Posting:
    """The inverted files of one block of rows: for each pivot the rows that
    have it among their nearest, and at which place."""

    def __init__(self, perm: np.ndarray, pivots: int, asked: int):
        n, m = perm.shape
        flat = perm.ravel()
        order = np.argsort(flat, kind="stable")
        self.rows, self.place = order // m, order % m
        self.start = np.searchsorted(flat[order], np.arange(pivots + 1))
        self.n = n
        # by how much an entry lowers the distance of a row without the pivot
        k = np.arange(asked)[:, None]
        self.gain = ((m - k) - np.abs(k - np.arange(m)[None, :])).astype(np.int32)

    def distances(self, asked: np.ndarray, most: int) -> np.ndarray:
        """Footrule distance of a query's pivots to all rows; ``most`` is that
        of a row with none of them."""
        out = np.full(self.n, most, dtype=np.int32)
        for k, p in enumerate(asked):
            a, b = self.start[p], self.start[p + 1]
            if a < b:
                out[self.rows[a:b]] -= self.gain[k][self.place[a:b]]
        return out


def farthest(posted: int, asked: int) -> int:
    """Footrule distance of a row that has none of the query's pivots."""
    return sum(posted - k for k in range(asked))


def _search(index: Index, ids: np.ndarray, x: np.ndarray, k: int, radius: int | None, shares: list) -> DataFrame:
    """``query_id, id, score, perm`` of each task's best ``k``; ``radius`` None
    compares with all rows.  What tasks share is added to ``shares``."""
    dim, posted, asked, pivots = index.dim, index.posted, index.asked, len(index.pivots)
    perms = _nearest(_as_queries(x), index.pivots, asked)
    shared = index.rows.sparkSession.sparkContext.broadcast((ids, x, perms))
    shares.append(shared)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, perms = shared.value
        most = farthest(posted, asked)
        held: list[tuple | None] = [None] * len(ids)
        for table in gathered(batches):
            own, rows = ids_of(table["id"]), unpacked(table["vector"], np.float64, dim)
            perm = unpacked(table["perm"], np.uint16, posted)
            lists = Posting(perm, pivots, asked) if radius is not None else None
            for q in range(len(ids)):
                if lists:
                    distance = lists.distances(perms[q], most)
                    near = np.flatnonzero((distance <= radius) & (own != ids[q]))
                    near = near[np.argsort(distance[near], kind="stable")]
                else:
                    near = np.flatnonzero(own != ids[q])
                if not len(near):
                    continue
                rough = rows[near] @ x[q]
                floor = held[q][1][-1] if held[q] and len(held[q][0]) == k else -np.inf
                slack = _SLACK * (1 + np.abs(rough).max())
                if len(near) > 8 * k and len(np.unique(own[near])) == len(near):
                    floor = max(floor, np.partition(rough, len(near) - k)[len(near) - k] - slack)
                near = near[rough >= floor - slack]
                # one way to add up, whatever else is in the block
                score = (rows[near] * x[q]).sum(axis=1)
                found = (own[near], score, perm[near])
                if held[q]:
                    found = tuple(np.concatenate(pair) for pair in zip(held[q], found, strict=True))
                at = best(found[0], found[1], k)
                held[q] = tuple(column[at] for column in found)
        for at in range(0, len(held), 1024):
            some = [(i, h) for i, h in enumerate(held[at : at + 1024], at) if h]
            if some:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(h[0]), ids[i]) for i, h in some])),
                        id_column(np.concatenate([h[0] for _, h in some])),
                        pa.array(np.concatenate([h[1] for _, h in some])),
                        packed(np.concatenate([h[2] for _, h in some])),
                    ],
                    ["query_id", "id", "score", "perm"],
                )

    rows = index.rows.select("id", "vector", "perm")
    return map_arrow(rows, task, "query_id long, id long, score double, perm binary")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query; a point counts with its best row."""
    points = found.groupBy("query_id", "id").agg(F.max_by("perm", "score").alias("perm"), F.max("score").alias("score"))
    return first_by(points, ["query_id"], [F.desc("score"), F.asc_nulls_last("id")], k)


def _queries(index: Index) -> DataFrame:
    return index.rows.where("query AND id IS NOT NULL").select("id", "vector").distinct()


def _local(index: Index, queries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bounded run of queries."""
    got = queries.toArrow()
    return ids_of(got["id"].combine_chunks()), unpacked(got["vector"], np.float64, index.dim)


def fit_radius(index: Index, k: int, recall: float = RECALL, sample: int = SAMPLE) -> int:
    """Footrule radius that holds the share ``recall`` of the true neighbours
    of ``sample`` queries, found by comparing these with all rows."""
    ids, x = _local(index, _queries(index).orderBy(F.xxhash64("id", "vector")).limit(sample))
    if not len(ids):
        return 0
    shares: list = []
    true = _merged(_search(index, ids, x, k, None, shares), k).select("query_id", "perm").toArrow()
    shares.pop().destroy()
    perms = dict(zip(ids.tolist(), _nearest(_as_queries(x), index.pivots, index.asked), strict=True))
    most, distance = farthest(index.posted, index.asked), []
    if not len(true):
        return most
    theirs = unpacked(true["perm"], np.uint16, index.posted)
    for query, perm in zip(true["query_id"].to_pylist(), theirs, strict=True):
        distance.append(Posting(perm[None, :], len(index.pivots), index.asked).distances(perms[query], most)[0])
    return int(np.sort(distance)[min(len(distance) - 1, int(np.ceil(recall * len(distance))))])


def search(index: Index | None, k: int = 20, recall: float = RECALL, spark=None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query of the index the ``k``
    nearest rows found, nearest first."""
    names = [F.col("query_id"), F.col("rank"), F.col("id").alias("vec_id"), F.col("score")]
    if index is None:
        empty = T.StructType.fromDDL("query_id long, id long, score double, rank int")
        return spark.createDataFrame([], empty).select(*names)
    spark = index.rows.sparkSession
    radius = fit_radius(index, k, recall)
    queries = stored(_queries(index), "permutation-queries")
    out = scratch_path(spark, "permutation-found")

    def answered(asked: DataFrame, radius: int | None) -> DataFrame | None:
        n = asked.count()
        paths = []
        for i, part in enumerate(blocks(asked, "id", n, max(1, QUERY_BYTES // (8 * index.dim)))) if n else ():
            ids, x = _local(index, part)
            paths.append(f"{out}/{'all' if radius is None else 'near'}-{i}")
            shares: list = []
            found = _merged(_search(index, ids, x, k, radius, shares), k).select("query_id", "id", "score", "rank")
            found.write.parquet(paths[-1])
            shares.pop().destroy()
        return spark.read.parquet(*paths) if paths else None

    near = answered(queries, radius)
    if near is None:
        return search(None, k, spark=spark)
    full = near.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = stored(queries.join(full, F.col("id") == F.col("query_id"), "left_anti"), "permutation-short")
    rest = answered(short, None)
    if rest is not None:
        near = near.join(full.select("query_id"), "query_id", "left_semi").unionByName(rest)
    return near.select(*names)


def nearest(
    df: DataFrame, query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """Index ``df`` and search it for its rows where ``query`` holds."""
    return search(build(df, key, vector, query), k, recall, spark=df.sparkSession)
