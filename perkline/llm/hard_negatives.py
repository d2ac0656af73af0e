"""Hard-negative mining by Kronecker-packed products.

Vectors are whole numbers: a component ``x`` becomes ``floor(scale * x)``.
Of a run of candidates, the components of one dimension lie side by side in
one wide integer, each raised by a bias to be positive, in fields wide enough
for any sum.  Multiplying that integer by an anchor's component gives all
these candidates' partial products at once; the sum over the dimensions,
raised by half a field so that no field borrows from the next, holds every
candidate's score, exactly, at its place.  Integers have no largest size, so
neither have the components or the run.

Anchors are shared with the tasks in runs of bounded size; each run reads all
rows twice, in blocks:

1. *Positives.*  Each task keeps an anchor's first rows of the same label.
2. *Negatives.*  With the positives known, each task keeps, for each anchor and
   positive, its first rows of another label whose score lies in the band.

Both lists are merged by Spark.  No row is skipped and none is compared with
anything but the anchors.

Defined cases: rows with a NULL label, a NULL vector, a NULL or non-finite
entry, or another length than the most frequent one take no part, nor do
entries past 2^53.  Rows that share a ``vec_id`` are one row to each other (none
is its own positive or negative); as a candidate the best of them counts, as
an anchor the least label and vector.  A NULL id is a candidate, last among
ties, and no anchor.  An anchor without positives, and a positive with an
empty band (a negative score has one), give no rows; an empty table none.
Scores that pass a long end the job with an error.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

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

SCALE = 256
POSITIVES = NEGATIVES = 5
#: a negative's score in percent of the positive's, at least and at most
BAND = (80, 100)
#: candidates side by side in one integer
FIELDS = 1024
#: bytes of anchors that are shared at once
ANCHOR_BYTES = 16 << 20
_EXACT = 1 << 53


class Packed:
    """Candidates (rows of whole numbers) packed for products with anchors."""

    def __init__(self, rows: np.ndarray, anchor_most: int, fields: int = FIELDS):
        self.n, self.fields = len(rows), fields
        self.bias = max(0, -int(rows.min(initial=0)))
        most = int(rows.max(initial=0)) + self.bias
        # a field holds sums of either sign: half a field is added at the end
        bits = (2 * rows.shape[1] * max(1, most) * max(1, anchor_most)).bit_length() + 1
        self.width = next((w for w in (16, 32, 64) if w >= bits), -(-bits // 64) * 64)
        self.runs = [self._run(rows[at : at + fields] + self.bias) for at in range(0, len(rows), fields)]
        self.half = 1 << self.width - 1
        self.halves = int.from_bytes(self.half.to_bytes(self.width // 8, "little") * fields, "little")

    def _run(self, raised: np.ndarray) -> list[int]:
        """One wide integer for each dimension."""
        step = self.width // 8
        cells = np.zeros((raised.shape[1], len(raised), step), dtype=np.uint8)
        eight = np.ascontiguousarray(raised.T.astype("<i8")).view(np.uint8).reshape(*cells.shape[:2], 8)
        cells[:, :, : min(8, step)] = eight[:, :, : min(8, step)]
        return [int.from_bytes(row.tobytes(), "little") for row in cells]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The anchor's inner product with every candidate."""
        out, lift = [], self.bias * sum(anchor)
        for run in self.runs:
            total = self.halves
            for a, wide in zip(anchor, run, strict=True):
                if a:
                    total += a * wide
            out.append(self._fields(total))
        got = np.concatenate(out)[: self.n] if out else np.zeros(0, np.int64)
        if self.width > 64:
            return np.array([_long(int(v) - self.half - lift) for v in got], dtype=np.int64)
        if self.width == 64:
            # the sums fit 62 bits and a sign, so that this cannot wrap
            return (got ^ np.uint64(1 << 63)).view(np.int64) - lift
        return got.astype(np.int64) - self.half - lift

    def _fields(self, total: int) -> np.ndarray:
        raw = total.to_bytes(self.fields * self.width // 8, "little")
        if self.width <= 64:
            return np.frombuffer(raw, dtype=f"<u{self.width // 8}")
        step = self.width // 8
        return np.array([int.from_bytes(raw[i : i + step], "little") for i in range(0, len(raw), step)], dtype=object)


def _long(v: int) -> int:
    if not -(1 << 63) <= v < 1 << 63:
        raise OverflowError("a score passes a long")
    return v


def _rows(df: DataFrame, key: str, vector: str, label: Column, anchor: Column, dim: int, scale: int) -> DataFrame:
    """``id, label, x, anchor`` of the rows that take part."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, c = usable(batch.column(2), dim)
            with np.errstate(over="ignore"):
                x = np.floor(scale * c)
            good = (np.abs(x) < _EXACT).all(axis=1)
            at, x = pa.array(at[good]), x[good].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), packed(x), batch.column(3).take(at)],
                ["id", "label", "x", "anchor"],
            )

    rows = df.select(
        F.col(key).cast("long").alias("id"),
        label.cast("string").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("label IS NOT NULL")
    return map_arrow(rows, task, "id long, label string, x binary, anchor boolean")


def _labels(column: pa.Array, known: dict[str, int]) -> np.ndarray:
    """Labels as numbers, equal to an anchor's where the label is; -1 for those
    that no anchor has."""
    coded = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = coded.dictionary_encode()
    number = np.array([known.get(v, -1) for v in coded.dictionary.to_pylist()], dtype=np.int64)
    return number[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)


def _scan(rows: DataFrame, dim: int, anchors: tuple, pick, shares: list) -> DataFrame:
    """``pick`` looks at the scores of every anchor and block of rows; a task
    emits what it holds in the end.  What tasks share is added to ``shares``."""
    ids, labels, x = anchors
    known = {v: i for i, v in enumerate(sorted(set(labels)))}
    most = int(np.abs(x).max(initial=0))
    numbers = np.array([known[v] for v in labels], dtype=np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((ids, numbers, x, known, pick))
    shares.append(shared)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, numbers, vectors, known, pick = shared.value
        held: dict = {}
        for table in gathered(batches):
            own, label = ids_of(table["id"]), _labels(table["label"], known)
            block = Packed(unpacked(table["x"], np.int64, dim), most)
            for i, anchor in enumerate(vectors.tolist()):
                pick.add(i, own, block.scores(anchor), label == numbers[i], own != ids[i], held)
        yield from pick.emit(ids, held)

    return map_arrow(rows.select("id", "label", "x"), task, pick.schema)


def _joined(held, key, ids: np.ndarray, score: np.ndarray, k: int) -> None:
    """Merges rows into the best ``k`` held under ``key``."""
    if key in held:
        ids, score = np.concatenate([held[key][0], ids]), np.concatenate([held[key][1], score])
    at = best(ids, score, k)
    held[key] = (ids[at], score[at])


class _Positives:
    """The first rows of the anchor's label."""

    schema = "anchor_id long, id long, score long"

    def __init__(self, k: int):
        self.k = k

    def add(self, i, own, score, same, other, held) -> None:
        at = np.flatnonzero(same & other)
        if len(at):
            _joined(held, i, own[at], score[at], self.k)

    def emit(self, ids, held):
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(v[0]), ids[i]) for i, v in held.items()])),
                    id_column(np.concatenate([v[0] for v in held.values()])),
                    pa.array(np.concatenate([v[1] for v in held.values()])),
                ],
                ["anchor_id", "id", "score"],
            )


class _Negatives:
    """The first rows of other labels in the band of each positive."""

    schema = "anchor_id long, positive_id long, positive_score long, id long, score long"

    def __init__(self, k: int, band: tuple[int, int], positives: list[list[tuple]]):
        self.k, self.band, self.positives = k, band, positives

    def add(self, i, own, score, same, other, held) -> None:
        if not self.positives[i]:
            return
        at = np.flatnonzero(~same & other)
        lo, hi = self.band
        for place, (_, p) in enumerate(self.positives[i]):
            # lo * p <= 100 * score <= hi * p, in whole numbers
            least, most = -(-lo * p // 100), hi * p // 100
            in_band = at[(score[at] >= least) & (score[at] <= most)]
            if len(in_band):
                _joined(held, (i, place), own[in_band], score[in_band], self.k)

    def emit(self, ids, held):
        if held:
            sizes = [len(v[0]) for v in held.values()]
            each = [(ids[i], *self.positives[i][place]) for i, place in held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([e[0] for e in each]), sizes)),
                    id_column(np.repeat(np.array([e[1] for e in each]), sizes)),
                    pa.array(np.repeat(np.array([e[2] for e in each]), sizes)),
                    id_column(np.concatenate([v[0] for v in held.values()])),
                    pa.array(np.concatenate([v[1] for v in held.values()])),
                ],
                ["anchor_id", "positive_id", "positive_score", "id", "score"],
            )


def mine(
    df: DataFrame,
    anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows where ``anchor`` holds."""
    spark = df.sparkSession
    dim = dimension(df, vector)
    out = scratch_path(spark, "hard-negatives")
    paths = []
    if dim:
        rows = _rows(df, key, vector, label, anchor, dim, scale)
        chosen = rows.where("anchor AND id IS NOT NULL").groupBy("id").agg(F.min(F.struct("label", "x")).alias("r"))
        chosen = stored(chosen.select("id", "r.label", "r.x"), "hard-negative-anchors")
        n = chosen.count()
        for i, part in enumerate(blocks(chosen, "id", n, max(1, ANCHOR_BYTES // (8 * dim)))) if n else ():
            got = part.toArrow()
            x = unpacked(got["x"], np.int64, dim)
            anchors = (ids_of(got["id"].combine_chunks()), got["label"].to_pylist(), x)
            paths.append(f"{out}/{i}")
            shares: list = []
            _mined(rows, dim, anchors, positives, negatives, band, shares).write.parquet(paths[-1])
            for shared in shares:
                shared.destroy()
    if not paths:
        names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], names)
    return spark.read.parquet(*paths)


def _mined(
    rows: DataFrame, dim: int, anchors: tuple, positives: int, negatives: int, band: tuple[int, int], shares: list
) -> DataFrame:
    """The result of one run of anchors."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    found = _scan(rows, dim, anchors, _Positives(positives), shares)
    found = found.groupBy("anchor_id", "id").agg(F.max("score").alias("score"))
    place = {v: i for i, v in enumerate(anchors[0].tolist())}
    theirs: list[list[tuple]] = [[] for _ in place]
    got = first_by(found, ["anchor_id"], order, positives).select("anchor_id", "id", "score").toArrow()
    ids = ids_of(got["id"].combine_chunks()) if len(got) else []
    for a, p, s in zip(got["anchor_id"].to_pylist(), ids, got["score"].to_pylist(), strict=True):
        theirs[place[a]].append((int(p), s))
    found = _scan(rows, dim, anchors, _Negatives(negatives, band, theirs), shares)
    keys = ["anchor_id", "positive_id", "positive_score"]
    found = found.groupBy(*keys, "id").agg(F.max("score").alias("score"))
    return first_by(found, keys, order, negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
