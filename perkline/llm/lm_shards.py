"""The weighted backoff automaton of ``lm_score``, learned and scored by parts.

A part holds the states that end in one token, and their failure arcs: reading
a token needs the part of the token before it, and the root.  A shard is a
part, or several small ones together.  Tasks read the texts once, deal every
token with its history to the shard of the token before it, and send a packed
block a shard and slice of texts, not a row a token.  A shard's task counts the
n-grams of its training tokens, weighs arcs and failure arcs, and reads all its
tokens, also those held out, through them; per slice it gives back a packed
block with one sum a text.  Blocks name texts by their place in the slice; ids
go with one block of the slice, and the slice's blocks are added up text by
text in the end.  The root's weights of frequent tokens are broadcast (at most
``2^FREQUENT_BITS``, since shares add up to one); those of rare tokens are
joined to the shards that read them.

A shard reads about ``SHARD`` tokens, whatever the corpus has: the number of
shards grows with it.  A token that makes up a quarter of a shard is a shard of
its own.  One with ``BY_KEY`` occurrences would be more than a task should
hold; the states that end in it are learned and scored by key instead
(``lm_score``), with equal results.  Nothing is pruned.

Defined cases are those of ``lm_score``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm import lm_score
from perkline.llm.lm_score import (
    DISCOUNT,
    END,
    ORDER,
    _counted,
    _find,
    _spark_hash,
    learn_all,
    shared_out,
    summed,
    tokens,
)
from perkline.llm.words import NON_SPACE, Words, split

#: tokens with this share of all have a place in the broadcast list
FREQUENT_BITS = 22
#: tokens of a shard, and training occurrences from which a token's states go by key
SHARD, BY_KEY = 1 << 21, 1 << 22
#: about 2^_TOGETHER tokens of a shard are weighed at once, or one part if it has more
_TOGETHER = 17
#: bytes of text read together, and tokens of a task dealt out together (at least, and up to _SLICE more)
_SLICE, _DEAL = 4 << 20, 1 << 20
#: a token's code: its rank among the frequent ones, or from _RARE on its place in a list of rare ones
_RARE = 1 << FREQUENT_BITS
_NONE = (1 << 32) - 1
#: in a block a code takes three bytes, and the list holds the rare tokens of at most so many tokens and histories
_PACKED_NONE = (1 << 24) - 1
_BLOCK_CODES = 1 << 23


class Deal:
    """What every task holds: the frequent tokens and the rule of shards."""

    def __init__(self, order: int, total: int, kinds: int, hashes: np.ndarray, counts: np.ndarray, read: float, shard: int, by_key: int):
        """``hashes`` ascend; ``read`` is how many tokens are read for one
        that is learned."""
        self.order, self.total, self.kinds = order, total, kinds
        self.hashes = hashes
        ranked = np.argsort(-counts, kind="stable")
        self.rank = np.empty(len(hashes), dtype=np.uint32)
        self.rank[ranked] = np.arange(len(hashes), dtype=np.uint32)
        self.token, self.count = hashes[ranked], counts[ranked]
        self.few = max(1, int(np.ceil(total * read / shard)))
        self.alone = int((self.count * read * 4 >= shard).sum())
        self.keyed = int((self.count >= by_key).sum())

    def behind(self) -> np.ndarray:
        """Tokens whose states are learned by key."""
        return np.sort(self.token[: self.keyed])

    def read(self, t: np.ndarray, first: np.ndarray):
        """Codes of the tokens and of their histories (the last token first),
        the rare tokens, and each token's shard (-1: by key)."""
        full = np.append(t, END)
        at = _find(self.hashes, full)
        code = np.empty(len(full), dtype=np.uint32)
        held = at >= 0
        code[held] = self.rank[at[held]]
        rare, of = np.unique(full[~held], return_inverse=True)
        code[~held] = _RARE + of
        history = [np.roll(code[:-1], 1)]
        history[0][first[:-1]] = code[-1]
        last = full[np.roll(np.arange(len(t)), 1)] if len(t) else t
        last[first[:-1]] = END
        place = np.arange(len(t)) - np.repeat(first[:-1], np.diff(first))
        for k in range(2, self.order):
            longer = np.roll(history[-1], 1)
            longer[place < k - 1] = _NONE
            history.append(longer)
        shard = ((last >> np.uint64(24)) % np.uint64(self.few)).astype(np.int64)
        alone = history[0] < self.alone
        shard[alone] = self.few + history[0][alone]
        shard[history[0] < self.keyed] = -1
        return code[:-1], history, rare, shard


def _rare_readers(shared):
    """Task: texts -> the rare tokens that each shard reads."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Deal = shared.value
        for batch in batches:
            for _, _, w in split(batch.column("text"), NON_SPACE, 2 * _SLICE):
                code, _, rare, shard = own.read(*tokens(w))
                on = np.flatnonzero((code >= _RARE) & (shard >= 0))
                both = np.unique(shard[on] << 32 | (code[on] - _RARE).astype(np.int64))
                key = rare[both & 0xFFFFFFFF].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(both >> 32)], names=["key", "shard"])

    return task


def _pack(codes: np.ndarray) -> bytes:
    """Low, middle and high bytes of the codes apart, compressed."""
    planes = np.ascontiguousarray(codes.astype("<u4").reshape(-1).view(np.uint8).reshape(-1, 4)[:, :3].T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, rows: int, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=3 * rows * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(3, rows, n)
    return planes[0].astype(np.uint32) | planes[1].astype(np.uint32) << 8 | planes[2].astype(np.uint32) << 16


def _runs(dealt: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The places of each shard, in runs of at most ``most``."""
    for begin, end in zip(begins, ends, strict=True):
        for at in range(begin, end, most):
            yield dealt[at : min(at + most, end)]


_BLOCK = ["slice", "n", "codes", "rare", "m", "texts", "sizes", "head"]


class _Slice:
    """Texts of a task that are dealt out together."""

    def __init__(self) -> None:
        self.rows, self.rare, self.shard, self.text, self.head = [], [], [], [], []
        self.train, self.far, self.n, self.texts = [], 0, 0, 0

    def add(self, own: Deal, w: Words, batch: pa.RecordBatch) -> None:
        """``batch`` has the texts of ``w``."""
        t, first = tokens(w)
        code, history, rare, shard = own.read(t, first)
        rows = np.stack([code, *history])
        rows[(rows >= _RARE) & (rows != _NONE)] += np.uint32(self.far)
        here, often = shard >= 0, code < _RARE
        held = here & often
        base = np.zeros(len(code))
        base[held] = np.log10(own.count[code[held]] + 1.0)
        begin = first[:-1]
        sums = [np.add.reduceat(here.astype(np.int64), begin), np.add.reduceat(held.astype(np.int64), begin), np.add.reduceat(base, begin)]
        # copies, which don't keep the batch
        own_rows = pa.array(np.arange(batch.num_rows))
        columns = [batch.column("doc_id").take(own_rows), batch.column("mark").take(own_rows), *map(pa.array, sums)]
        self.head.append(pa.StructArray.from_arrays(columns, names=["doc_id", "mark", "n_tokens", "n_known", "base"]))
        self.rows.append(rows)
        self.rare.append(rare)
        self.shard.append(shard)
        self.text.append(np.repeat(np.arange(self.texts, self.texts + batch.num_rows), np.diff(first)))
        self.train.append(batch.column("train").to_numpy(zero_copy_only=False).astype(np.uint8))
        self.far += len(rare)
        self.n += len(t)
        self.texts += batch.num_rows

    def deal(self, own: Deal, nth: int) -> pa.RecordBatch | None:
        """A block a shard.  The first one also has the texts' ids, marks and
        the sums that need no shard."""
        rows, rare, shard, text = np.concatenate(self.rows, 1), *map(np.concatenate, (self.rare, self.shard, self.text))
        train, head = np.concatenate(self.train), pa.concat_arrays(self.head)
        self.__init__()
        # another order of rows, as an upstream task run again may give, is another slice
        digest = hashlib.blake2b(rows.tobytes() + head.field("mark").to_numpy().tobytes(), digest_size=8, key=nth.to_bytes(8))
        name = int.from_bytes(digest.digest(), signed=True)
        dealt = np.argsort(shard, kind="stable")
        begins = np.flatnonzero(np.diff(shard[dealt], prepend=-2))
        ends = np.append(begins[1:], len(dealt))
        out = []
        for on in _runs(dealt, begins, ends, _BLOCK_CODES // own.order):
            if shard[on[0]] < 0:
                continue
            block, whose = rows[:, on], text[on]
            far = (block >= _RARE) & (block != _NONE)
            kinds, of = np.unique(rare[block[far] - _RARE], return_inverse=True)
            block[far] = _RARE + of
            block[block == _NONE] = _PACKED_NONE
            new = np.flatnonzero(np.diff(whose, prepend=-1))
            texts = whose[new]
            sizes = np.diff(np.append(new, len(whose))) << 1 | train[texts]
            packed = _pack(block), kinds.tobytes(), len(texts), _pack(np.diff(texts, prepend=0)), _pack(sizes)
            out.append((int(shard[on[0]]), name, len(on), *packed))
        if not out:
            return None
        columns = [pa.array(x, pa.binary() if isinstance(x[0], bytes) else pa.int64()) for x in zip(*out, strict=True)]
        offsets = np.full(len(out) + 1, len(head), dtype=np.int32)
        offsets[0] = 0
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), head)], names=["shard", *_BLOCK])


def _blocks(shared):
    """Task: texts -> a block a slice and shard: the codes of its tokens and
    histories, the rare tokens among them, and the texts they come from."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Deal = shared.value
        held, nth = _Slice(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, w in split(batch.column("text"), NON_SPACE, _SLICE):
                held.add(own, w, batch.slice(a, b - a))
                if held.n >= _DEAL:
                    if (blocks := held.deal(own, nth)) is not None:
                        yield blocks
                    nth += 1
        if held.n and (blocks := held.deal(own, nth)) is not None:
            yield blocks

    return task


def weigh(own: Deal, c: np.ndarray, history: list[np.ndarray], known: list[np.ndarray], count: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """What each token's log10 probability adds to the root's.  ``history`` has
    the tokens before it, the last one first, ``known`` where there is one,
    ``learned`` which tokens the automaton learns from."""
    p = (count + 1.0) / (own.total + own.kinds + 1.0)
    root = np.log10(p)
    log = root.copy()
    state = np.zeros(len(c), dtype=np.uint64)
    for k, (token, here) in enumerate(zip(history, known, strict=True)):
        on = slice(None) if here.all() else np.flatnonzero(here)
        at_state = token[on] if k == 0 else _spark_hash(token[on], state[on])
        state[on] = at_state
        key = _spark_hash(c[on], at_state)
        arcs = np.unique(key)
        of, at = np.searchsorted(arcs, key), np.empty(len(arcs), dtype=np.int64)
        at[of] = np.arange(len(key))
        del key, arcs
        n = np.bincount(of, weights=learned[on], minlength=len(at))
        seen = np.flatnonzero(n)
        states, to = np.unique(at_state[at[seen]], return_inverse=True)
        size, kinds = np.bincount(to, n[seen], len(states)), np.bincount(to, minlength=len(states))
        # what the arcs leave, over what the same tokens leave in the next state
        lower = np.bincount(to, p[on][at[seen]], len(states))
        fail = np.log10(kinds * DISCOUNT / size) - np.log10(np.maximum(1 - lower, 1e-15))
        arc = np.zeros(len(at))
        arc[seen] = (n[seen] - DISCOUNT) / size[to]
        arc = arc[of]
        # no state, no weight: the token is read in the next state
        failed = np.append(fail, 0.0)[_find(states, at_state)]
        del of, at, at_state
        failed += log[on]
        taken = arc > 0
        failed[taken] = np.log10(arc[taken])
        log[on], p[on] = failed, arc
    log -= root
    return log


def by_parts(own: Deal, rows: np.ndarray, known: np.ndarray, count: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """``weigh`` for some parts at a time, which share nothing."""
    total = len(count)
    extra = np.empty(total)
    group = ((rows[1] & np.uint64(0xFFFFFF)) % np.uint64((total >> _TOGETHER) % 65535 + 1)).astype(np.uint16)
    dealt = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.diff(group[dealt].astype(np.int32), prepend=-1))
    for on in _runs(dealt, begins, np.append(begins[1:], total), total):
        extra[on] = weigh(own, rows[0][on], list(rows[1:, on]), list(known[1:, on]), count[on], learned[on])
    return extra


def _pack_sums(sums: np.ndarray) -> bytes:
    """The first bytes of the numbers, the second, ..., compressed."""
    planes = np.ascontiguousarray(sums.astype("<f8").reshape(-1).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack_sums(data: bytes, rows: int, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * rows * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, -1).T).view("<f8").reshape(rows, n)


def _shard_sums(shared, schema: pa.Schema):
    """Task of a shard: its blocks and the counts of its rare tokens -> a
    block a slice: sums of each text's tokens, in the texts' order."""

    def task(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        own: Deal = shared.value
        if not blocks.num_rows:
            return schema.empty_table()
        key = counts.column("key").to_numpy().view(np.uint64)
        by_key = np.argsort(key)
        key, of_key = key[by_key], counts.column("n").to_numpy()[by_key]
        total = sum(blocks.column("n").to_pylist())
        rows = np.empty((own.order, total), dtype=np.uint64)
        known = np.ones((own.order, total), dtype=bool)
        count, held = np.zeros(total), np.zeros(total, dtype=bool)
        learned, sizes, lo = np.zeros(total, dtype=bool), [], 0
        for i in range(blocks.num_rows):
            block = {name: blocks.column(name)[i].as_py() for name in ("n", "codes", "rare", "m", "sizes")}
            hi = lo + block["n"]
            codes = _unpack(block["codes"], own.order, block["n"])
            rare = np.frombuffer(block["rare"], dtype=np.uint64)
            frequent = codes < _RARE
            far = ~frequent & (codes != _PACKED_NONE)
            into = rows[:, lo:hi]
            into[frequent] = own.token[codes[frequent]]
            into[far] = rare[codes[far] - _RARE]
            known[:, lo:hi] = codes != _PACKED_NONE
            count[lo:hi][frequent[0]] = own.count[codes[0][frequent[0]]]
            held[lo:hi] = frequent[0]
            at = _find(key, into[0][far[0]])
            count[lo:hi][far[0]] = np.where(at >= 0, np.append(of_key, 0)[at], 0)
            size = _unpack(block["sizes"], 1, block["m"])[0]
            learned[lo:hi] = np.repeat((size & 1).astype(bool), size >> 1)
            sizes.append(size >> 1)
            lo = hi
        if (rows[1] == rows[1, 0]).all():
            extra = weigh(own, rows[0], list(rows[1:]), list(known[1:]), count, learned)
        else:
            extra = by_parts(own, rows, known, count, learned)
        del rows, known, learned
        size = np.concatenate(sizes).astype(np.int64)
        begin = np.cumsum(size) - size
        # those of frequent tokens are added up where the text is read
        count[held] = 0
        found = np.add.reduceat((count > 0).astype(np.int64), begin)
        sums = np.stack([np.add.reduceat(extra, begin), np.add.reduceat(np.log10(count + 1.0), begin)])
        ends = np.cumsum([len(x) for x in sizes])
        each = [slice(end - len(x), end) for x, end in zip(sizes, ends, strict=True)]
        packed = [pa.array([_pack(found[x]) for x in each], pa.binary()), pa.array([_pack_sums(sums[:, x]) for x in each], pa.binary())]
        kept = [blocks.column(name) for name in ("slice", "n", "m", "texts", "head")]
        return pa.Table.from_arrays([*kept, *packed], schema=schema)

    return task


def _slice_sums(schema: pa.Schema):
    """Task of a slice: what its shards found -> a row a text."""

    def task(found: pa.Table) -> pa.Table:
        head = pa.concat_arrays([x.flatten() for x in found.column("head").chunks])
        n_tokens, n_known, base = (head.field(c).to_numpy(zero_copy_only=False) for c in ("n_tokens", "n_known", "base"))
        if n_tokens.sum() != sum(found.column("n").to_pylist()):
            raise RuntimeError("a slice was read twice, in another order: store its rows first")
        n_known, base, extra = n_known.copy(), base.copy(), np.zeros(len(head))
        for i in range(found.num_rows):
            m, texts, known, sums = (found.column(name)[i].as_py() for name in ("m", "texts", "known", "sums"))
            at = np.cumsum(_unpack(texts, 1, m)[0])
            n_known[at] += _unpack(known, 1, m)[0]
            more = _unpack_sums(sums, 2, m)
            extra[at] += more[0]
            base[at] += more[1]
        columns = [np.ones(len(head), dtype=np.int64), n_tokens, n_known, base, extra]
        return pa.Table.from_arrays([head.field("doc_id"), head.field("mark"), *map(pa.array, columns)], schema=schema)

    return task


def score_corpus(
    docs: DataFrame, order: int = ORDER, frequent_bits: int = FREQUENT_BITS, shard: int = SHARD, by_key: int = BY_KEY
) -> tuple[DataFrame, int]:
    """``doc_id, mark, n_tokens, n_known, base_score, score`` of each row of
    ``docs (doc_id, text, train)``, under the automaton of the rows whose
    ``train`` is true; and how many tokens those have.  ``frequent_bits`` (at
    most ``FREQUENT_BITS``), ``shard`` and ``by_key`` decide only where the
    work is done."""
    spark = docs.sparkSession
    train = F.coalesce(F.col("train"), F.lit(False))
    learned = docs.where(train).select("text")
    unigrams = stored(_counted(learned, lambda: lambda t, first: t), "lm-tokens")
    sums = unigrams.agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).first()
    total, kinds = sums["total"] or 0, sums["kinds"]
    rows = docs.agg(F.count("*").alias("read"), F.count_if(train).alias("learned")).first()
    often = F.col("n").cast("double") * (1 << frequent_bits) >= total
    # at most 2^FREQUENT_BITS rows, as shares add up to one
    top = unigrams.where(often).toArrow()
    hashes, counts = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    ascending = np.argsort(hashes)
    read = rows["read"] / max(1, rows["learned"])
    deal = Deal(order, total, kinds, hashes[ascending], counts[ascending], read, shard, by_key)
    shared = spark.sparkContext.broadcast(deal)

    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), train.alias("train"), "text")
    readers = map_arrow(docs.select("text"), _rare_readers(shared), "key bigint, shard bigint")
    # rare keys: no key is hot in the join, and its shuffle serves distinct too
    root = readers.join(unigrams.where(~often), "key").select("key", "shard", "n").distinct()
    of = docs.schema["doc_id"].dataType
    text = T.StructType().add("doc_id", of).add("mark", "long").add("n_tokens", "long").add("n_known", "long").add("base", "double")
    block = T.StructType().add("shard", "long").add("slice", "long").add("n", "long").add("codes", "binary").add("rare", "binary")
    block.add("m", "long").add("texts", "binary").add("sizes", "binary").add("head", T.ArrayType(text))
    blocks = map_arrow(texts, _blocks(shared), block)

    from pyspark.sql.pandas.types import to_arrow_schema

    found = T.StructType([block[c] for c in ("slice", "n", "m", "texts", "head")]).add("known", "binary").add("sums", "binary")
    task = _shard_sums(shared, to_arrow_schema(found))
    answers = blocks.groupBy("shard").cogroup(root.groupBy("shard")).applyInArrow(task, found)
    row = T.StructType().add("doc_id", of).add("mark", "long")
    for name in ("times", "n_tokens", "n_known"):
        row.add(name, "long")
    row.add("base", "double").add("extra", "double")
    parts = answers.groupBy("slice").applyInArrow(_slice_sums(to_arrow_schema(row)), row)
    if deal.keyed:
        model = learn_all(learned, order, min(frequent_bits, lm_score.FREQUENT_BITS), deal.behind())
        # every text is a row there, whose end may be read here
        parts = parts.withColumn("times", F.lit(0).cast("long")).unionByName(summed(docs, model))
        adds = [F.sum(c).alias(c) for c in ("times", "n_tokens", "n_known", "base", "extra")]
        parts = parts.groupBy("doc_id", "mark").agg(*adds)
    return shared_out(parts, total, kinds), total
