"""N-gram Jaccard join: near-duplicate classes by a count-vector R-tree.

A document's set holds the hashes of its distinct 4-word shingles.  Shingles
are hashed into groups; two sets share at most the sum over groups of the
smaller count, and equal sets need comparing but once.

1. *Sets.*  Equal sets are one node (a digest of the sorted hashes).
2. *Cells.*  If ``100 |A & B| >= p |A | B|`` and A is the smaller set, they
   differ in at most ``d = (100 - p) |A| / p`` shingles, so of ``m > d``
   groups at least ``m - d`` have the same content in both.  ``m`` depends on
   the size level of the smaller set only; a set is dealt under its own level
   and under each lower one that may hold a partner.  The content of each
   group of ``LEAST`` shingles or more is a key, and nodes with an equal key
   meet in a cell.  A set with so few such groups that none of them need agree
   also deals the prefix of its hash-ordered shingles, which two such sets
   must share (|A| - ceil(p |A| / 100) + 1 of them).  So no link is lost and
   there is no cap, and as a whole group must agree, a passage shared by many
   documents makes few cells.
3. *Spine.*  A cell's hub is its member that is found in most cells (the
   likely original of a family of copies).  Each node is compared with that
   of its hubs with which the count vectors bound the similarity highest, if
   high enough.  Found links are contracted to components.
4. *R-tree.*  Cells that still hold several components get a packed tree over
   their members' count vectors; the descent skips a node whose coordinate
   maxima bound the overlap below what its sizes need, or whose members are
   all in the query's component.  Surviving pairs are verified on the sets.
   A large cell is dealt out as pairs of blocks of ``BLOCK`` members.
5. The links of both rounds give the components.

Defined cases: a NULL or empty text has an empty set, is linked with nothing
and is its own component; one to three words are one shingle; repeated rows
and copies are members of one node; a NULL id counts as the largest; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm.components import components, forest_roots
from perkline.llm.words import NON_SPACE, Words, mix, split

SHINGLE = 4
PERCENT = 85
#: coordinates of the count vectors in the tree
GROUPS = 256
FANOUT = 8
BLOCK = 1024
STEP = 1.5
#: groups beyond those that must be there, in percent of those that may differ
SPARE = 35
#: a group of fewer shingles is no key: a shared phrase would make cells of it
LEAST = 2
_FIELD_BITS = 23


class Levels:
    """Size levels for similarity ``percent``: level ``k`` holds the sizes
    ``start[k] .. start[k + 1] - 1``, whose sets are cut into ``groups[k]``
    groups, at most ``differ[k]`` of which differ from a larger partner's."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        start = [1]
        while start[-1] <= largest:
            start.append(max(start[-1] + 1, int(start[-1] * STEP)))
        self.start = start
        self.differ = [(100 - percent) * (s - 1) // percent for s in start[1:]]
        self.groups = [d + 1 + -(-SPARE * d // 100) for d in self.differ]

    def of(self, size: int) -> list[int]:
        """Levels under which a set of this size is dealt: its own and those
        below that may hold a smaller partner."""
        own = int(np.searchsorted(self.start, size, "right")) - 1
        out = [own]
        while out[-1] > 0 and 100 * (self.start[out[-1]] - 1) >= self.percent * size:
            out.append(out[-1] - 1)
        return [k for k in out if self.differ[k] > 0]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Keys of the cells in which a set (sorted hashes) is found."""
        size, out = len(hashes), []
        for k in self.of(size):
            m = self.groups[k]
            group = (hashes >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            content = np.add.reduceat(mix(hashes ^ np.uint64(0xA24BAED4963EE407)), first)
            filled = np.diff(np.append(first, size)) >= LEAST
            first, content = first[filled], content[filled]
            tag = np.uint64(2 * k * 0x9FB21C651E98DF25 & (1 << 64) - 1)
            out.append(mix(content + tag + mix(group[first] + np.uint64(1))))
            if len(first) <= self.differ[k]:
                prefix = size - -(-self.percent * size // 100) + 1
                out.append(mix(hashes[:prefix] + tag + np.uint64(1)))
        return np.concatenate(out) if out else hashes[:0]


def shingle_sets(w: Words, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``n``
    are one shingle."""
    grams, whole = w.grams(n)
    short = [w.grams(k)[0] for k in range(1, n)]
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(short[b - a - 1][a : a + 1] ^ np.uint64(b - a))
        else:
            out.append(grams[:0])
    return out


def _node(hashes: np.ndarray) -> int:
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _dealt(percent: int):
    """Task: texts -> a row for each document, and one for each key of a set
    (once a task: its copies meet again in the node)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen, done = Levels(percent, 1 << 40), set(), 0
        for batch in batches:
            for a, b, w in split(batch.column("text"), NON_SPACE):
                sets = shingle_sets(w)
                nodes = [_node(s) if len(s) else None for s in sets]
                own = pa.StructArray.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("mark").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                    ],
                    names=["doc", "mark", "n"],
                )
                # documents are dealt out evenly, copies too
                place = np.arange(done, done + b - a, dtype=np.uint64)
                done += b - a
                key = mix(mix(batch.column("mark").slice(a, b - a).to_numpy().view(np.uint64)) + place)
                node = pa.array(nodes, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), node, own], names=["key", "node", "doc"])
                keys, of = [], []
                for s, x in zip(sets, nodes, strict=True):
                    if len(s) and x not in seen:
                        seen.add(x)
                        keys.append(levels.keys(s))
                        of.append(np.full(len(keys[-1]), x, dtype=np.int64))
                if keys:
                    key = pa.array(np.concatenate(keys).view(np.int64))
                    nothing = pa.nulls(len(key), own.type)
                    yield pa.RecordBatch.from_arrays([key, pa.array(np.concatenate(of)), nothing], names=["key", "node", "doc"])

    return task


def _in_field(field: bytes, hashes: pa.Array) -> np.ndarray:
    bits = np.frombuffer(field, dtype=np.uint8)
    bit = hashes.to_numpy().view(np.uint64) >> np.uint64(64 - _FIELD_BITS)
    return (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


_SETS = pa.schema([("node", pa.int64()), ("shingles", pa.binary()), ("vector", pa.binary())])


def _sets_of(field):
    """Task: texts whose mark may be in ``field`` -> their sets and vectors,
    each set once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            texts = batch.column("text").filter(pa.array(_in_field(field.value, batch.column("mark"))))
            for _, _, w in split(texts, NON_SPACE):
                rows = []
                for s in shingle_sets(w):
                    if len(s) and (x := _node(s)) not in seen:
                        seen.add(x)
                        vector = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=GROUPS)
                        rows.append({"node": x, "shingles": s.tobytes(), "vector": vector.astype("<u4").tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=_SETS)

    return task


def _only(field):
    """Task: rows whose ``node`` may be in ``field``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_field(field.value, batch.column("node"))))

    return task


def _bounded(percent: int):
    """Task: pairs with both count vectors -> those that may link, and the
    overlap's bound as a share of both sizes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 4096) for at in range(0, len(batch), 4096)):
                x, y = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), dtype="<u4").reshape(-1, GROUPS).astype(np.int64)
                    for c in ("a_vector", "b_vector")
                )
                bound, sizes = np.minimum(x, y).sum(axis=1), x.sum(axis=1) + y.sum(axis=1)
                share = pa.array(bound / np.maximum(sizes, 1))
                out = pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), share], names=["a", "b", "share"])
                yield out.filter(pa.array((100 + percent) * bound >= percent * sizes))

    return task


def _verify(percent: int):
    """Task: pairs with both sets -> those that link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a_set"), batch.column("b_set")
            link = np.zeros(len(batch), dtype=bool)
            last, of = None, None
            for i in range(len(batch)):
                x = np.frombuffer(a[i].as_buffer(), dtype=np.uint64)
                if last is None or b[i].as_buffer() != last:
                    last = b[i].as_buffer()
                    of = np.frombuffer(last, dtype=np.uint64)
                place = np.minimum(np.searchsorted(of, x), len(of) - 1)
                both = int((of[place] == x).sum())
                link[i] = 100 * both >= percent * (len(x) + len(of) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(link)], names=["a", "b", "link"]
            )

    return task


class CountTree:
    """Packed R-tree over count vectors: members sorted by size and first
    coordinates, ``FANOUT`` to a node, each with its coordinate maxima,
    smallest and largest size, and its component (or -1 if it has several)."""

    def __init__(self, vectors: np.ndarray, comp: np.ndarray, percent: int):
        self.percent = percent
        size = vectors.sum(axis=1)
        half = vectors[:, : vectors.shape[1] // 2].sum(axis=1)
        self.order = np.lexsort((half, size, comp))
        self.levels = [(vectors[self.order], size[self.order], size[self.order], comp[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            hi, low, high, one = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            same = np.minimum.reduceat(one, cut) == np.maximum.reduceat(one, cut)
            self.levels.append(
                (
                    np.maximum.reduceat(hi, cut, axis=0),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.where(same, np.minimum.reduceat(one, cut), -1),
                )
            )

    def search(self, vectors: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(query, member)`` pairs in different components that may link."""
        size, p = vectors.sum(axis=1), self.percent
        top = len(self.levels[-1][1])
        q, node = np.repeat(np.arange(len(size)), top), np.tile(np.arange(top), len(size))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, low, high, one = self.levels[depth]
            on = (one[node] != comp[q]) & (100 * high[node] >= p * size[q]) & (100 * size[q] >= p * low[node])
            q, node = q[on], node[on]
            keep = np.zeros(len(q), dtype=bool)
            for at in range(0, len(q), 8192):
                to = slice(at, at + 8192)
                bound = np.minimum(vectors[q[to]], hi[node[to]]).sum(axis=1)
                keep[to] = (100 + p) * bound >= p * (size[q[to]] + low[node[to]])
            q, node = q[keep], node[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                q = np.repeat(q, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q, node = q[node < below], node[node < below]
        return q, self.order[node]


def _search(percent: int):
    """Task: rows sorted by unit -> candidate pairs of each unit.  A unit has
    the members of one block, or of two."""

    def pairs(unit: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        i, j = unit[0][0][1:]
        node = np.array([r[2] for r in unit], dtype=np.int64)
        comp = np.unique(np.array([r[3] for r in unit], dtype=np.int64), return_inverse=True)[1]
        block = np.array([r[1] for r in unit], dtype=np.int64)
        vectors = np.stack([np.frombuffer(r[4], dtype="<u4") for r in unit]).astype(np.int64)
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return node[:0], node[:0]
        tree = CountTree(vectors[right], comp[right], percent)
        q, member = tree.search(vectors[left], comp[left])
        a, b = node[left[q]], node[right[member]]
        return np.maximum(a, b), np.minimum(a, b)

    def out(unit: list[tuple]) -> pa.RecordBatch:
        a, b = pairs(unit)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple] = []
        for batch in batches:
            cols = batch.to_pydict()
            for key, i, j, block, node, comp, vector in zip(
                cols["key"], cols["i"], cols["j"], cols["block"], cols["node"], cols["comp"], cols["vector"], strict=True
            ):
                if unit and unit[0][0] != (key, i, j):
                    yield out(unit)
                    unit = []
                unit.append(((key, i, j), block, node, comp, vector))
        if unit:
            yield out(unit)

    return task


def bit_field(marks: DataFrame) -> bytes:
    """Bit field of fixed size (1 MB) with the first bits of ``mark``; it
    only saves work, and lets some others through."""
    bit = F.expr(f"shiftrightunsigned(mark, {64 - _FIELD_BITS})")
    words = (
        marks.select(F.shiftright(bit, 5).alias("w"), F.expr("1L").alias("one"), bit.bitwiseAND(31).cast("int").alias("p"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(one, p)")).alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << _FIELD_BITS - 5, dtype="<u4")
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.tobytes()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with ``link``: whether their sets are similar enough.
    Only sets that a pair needs are moved."""
    pairs = stored(pairs.select("a", "b"), "ngram-pairs")
    need = pairs.select(F.col("a").alias("mark")).union(pairs.select("b"))
    field = pairs.sparkSession.sparkContext.broadcast(bit_field(need))
    sets = map_arrow(sets.select("node", "shingles"), _only(field), "node bigint, shingles binary").dropDuplicates(["node"])
    one = sets.select(F.col("node").alias("_a"), F.col("shingles").alias("a_set"))
    other = sets.select(F.col("node").alias("_b"), F.col("shingles").alias("b_set"))
    both = pairs.join(one, F.col("a") == F.col("_a")).join(other, F.col("b") == F.col("_b"))
    return map_arrow(both.select("a", "b", "a_set", "b_set"), _verify(percent), "a bigint, b bigint, link boolean")


def link(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, mark, n_shingles, node, root`` for each row of ``docs
    (doc_id, text)``: equal ``root`` means the same class, NULL an empty set;
    ``mark`` is the text's hash."""
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    schema = T.StructType().add("key", "long").add("node", "long")
    schema.add("doc", T.StructType().add("doc", docs.schema["doc_id"].dataType).add("mark", "long").add("n", "long"))
    dealt = map_arrow(marked, _dealt(percent), schema)
    # one shuffle by key: cells with several nodes stay, and the documents
    cell = Window.partitionBy("key")
    kept = (
        dealt.withColumn("lone", F.min("node").over(cell) == F.max("node").over(cell))
        .where(F.col("doc").isNotNull() | ~F.col("lone"))
        .drop("lone")
    )
    kept = stored(kept, "ngram-cells")
    rows = kept.where("doc IS NOT NULL").select("doc.*", "node")
    cells = kept.where("doc IS NULL").select("key", "node").distinct()
    cells = stored(cells, "ngram-cells-distinct")

    # sets of the nodes that meet another one, each from one of its texts
    members = cells.select("node").distinct()
    marks = rows.join(members, "node", "left_semi").groupBy("node").agg(F.min("mark").alias("mark")).select("mark")
    field = docs.sparkSession.sparkContext.broadcast(bit_field(marks))
    sets = map_arrow(marked.select("mark", "text"), _sets_of(field), "node bigint, shingles binary, vector binary")
    sets = stored(sets, "ngram-sets")
    vectors = stored(sets.select("node", "vector").dropDuplicates(["node"]), "ngram-vectors")

    # spine: each node against its likeliest hub
    often = cells.groupBy("node").agg(F.count("*").alias("often"))
    ranked = cells.join(often, "node").withColumn("rank", F.struct("often", "node"))
    hubs = ranked.groupBy("key").agg(F.max("rank").alias("hub"))
    tries = ranked.join(hubs, "key").select(F.col("node").alias("a"), F.col("hub.node").alias("b")).where("a != b").distinct()
    one = vectors.select(F.col("node").alias("_a"), F.col("vector").alias("a_vector"))
    other = vectors.select(F.col("node").alias("_b"), F.col("vector").alias("b_vector"))
    tries = tries.join(one, F.col("a") == F.col("_a")).join(other, F.col("b") == F.col("_b"))
    tries = map_arrow(
        tries.select("a", "b", "a_vector", "b_vector"), _bounded(percent), "a bigint, b bigint, share double"
    )
    spine = tries.groupBy("a").agg(F.max(F.struct("share", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    # a hub is found in more cells than the node, or is the larger of two in as
    # many: the spine is a forest
    found = _linked(spine, sets, percent).where("link").select("a", "b")
    roots = stored(forest_roots(found), "ngram-roots")

    # cells that still hold several components
    held = cells.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
    open_cells = (
        held.groupBy("key")
        .agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.count("*").alias("size"),
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("xor"),
        )
        .where("lo != hi")
        .groupBy("size", "sum", "xor")  # of cells with the same members one is enough
        .agg(F.min("key").alias("key"))
    )
    blocks = F.ceil(F.col("size") / BLOCK)
    units = (
        held.join(open_cells.select("key", "size"), "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "comp")
        .join(vectors, "node")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .select("key", "i", "j", "block", "node", "comp", "vector")
    )
    pairs = map_arrow(units, _search(percent), "a bigint, b bigint").distinct()
    more = _linked(pairs, sets, percent).where("link").select("a", "b")
    # these links join trees of the spine
    tree = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    for side in ("a", "b"):
        more = more.join(tree, F.col(side) == F.col("_n"), "left").withColumn(side, F.coalesce("_r", side)).drop("_n", "_r")
    joined = components(more).select(F.col("node").alias("_tree"), F.col("root").alias("_top"))
    own = F.coalesce("root", "node")
    return (
        rows.join(roots, "node", "left")
        .withColumn("root", own)
        .join(joined, F.col("root") == F.col("_tree"), "left")
        .select(
            F.col("doc").alias("doc_id"),
            "mark",
            F.col("n").alias("n_shingles"),
            "node",
            F.coalesce("_top", "root").alias("root"),
        )
    )


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (the smallest id of the class)."""
    linked = stored(link(docs, percent), "ngram-classes")
    least = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return linked.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each class, the one with the smallest id; rows
    with an empty set are all kept."""
    linked = stored(link(docs, percent), "ngram-classes")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    best = (
        linked.where("root IS NOT NULL")
        .groupBy("root")
        .agg(F.min(first).alias("f"))
        .select(F.col("f.doc_id").alias("id"), F.col("f.mark").alias("own"))
    )
    size = linked.groupBy(F.col("doc_id").alias("i"), F.col("mark").alias("m")).agg(F.count("*").alias("times"))
    best = best.join(size, best["id"].eqNullSafe(size["i"]) & (best["own"] == size["m"])).select("id", "own", "times")
    # the row as one column, so that no name of docs can clash
    blank = F.length(F.translate(F.coalesce("text", F.lit("")), " \t\n\x0b\f\r", "")) == 0
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"), blank.alias("blank"))

    def picked(winners: DataFrame) -> DataFrame:
        return rows.join(winners, rows["doc"].eqNullSafe(winners["id"]) & (rows["mark"] == winners["own"]))

    once = picked(best.where("times = 1")).select("row.*")
    several = picked(best.where("times > 1")).dropDuplicates(["id", "own"]).select("row.*")
    empty = rows.where("blank").select("row.*")
    return once.union(several).union(empty)
