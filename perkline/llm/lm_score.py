"""Language-model scoring with a weighted backoff automaton.

States are the root and every n-gram of fewer than ``ORDER`` training tokens,
arcs are all n-grams seen, also once, weighted by the absolutely discounted
estimate.  A state's failure arc leads to the state without its first token
and has the weight that makes the state's probabilities sum to one.  The
root's arcs are all training tokens and the unknown, with add-one estimates.
A text starts in the state of the end token.  Reading a token from left to
right takes the state's arc, or failure arcs until there is one, and adds the
log10 weights.  Nothing is pruned, and the model grows with the corpus.

All states that a token may be read in, and the failure arcs between them down
to the root, end in the token before it.  So the automaton falls into parts
by the last token of a state, and a traversal step needs one part and the
root.  ``lm_shards`` learns and scores by such parts (the registered query).
This module learns and scores by keys, which no hot key can hold up:
``learn_all`` counts all n-grams, or those *behind* some tokens, in Spark.

An arc exists only where those of all shorter states exist, so a text's score
is a sum over its n-grams of every order: what an arc adds over failing, and
the failure weights of the states.  The *frequent* tokens, n-grams and states
(at least ``2^-FREQUENT_BITS`` of all tokens, so at most ``2^FREQUENT_BITS`` of
an order) are broadcast.  They hold every hot key.  All others, which no text
repeats often, are joined by key: a text sends one row per distinct rare key
and adds up what comes back.

Defined cases: a NULL text is the empty text, which has only the end token; a
NULL id's fold is that of the empty id; repeated rows are each scored; with
no training token every token has probability 1 / (N + V + 1) = 1; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import fold, map_arrow, stored
from perkline.llm.words import NON_SPACE, Words, split
from perkline.session import scratch_path

FOLDS = 7
HELD_OUT = 2
FREQUENT_BITS = 20
DISCOUNT = 0.75
ORDER = 3
#: joins that learn broadcast the keys with this share of all tokens
HOT_BITS = 16
#: key of the end token (a word's hash is a bijection's image of another sum)
END = np.uint64(0x9AE16A3B2F90404F)
_FLUSH = 1 << 20


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, an end after each, and each text's first
    place."""
    n = np.diff(w.first)
    first = np.concatenate(([0], np.cumsum(n + 1)))
    out = np.empty(first[-1], dtype=np.uint64)
    ends = first[1:] - 1
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner], out[ends] = w.hash, END
    return out, first


class Sums:
    """Counts by key, merged as they come and handed out when many."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        key, n = np.unique(keys, return_counts=True)
        self.keys.append(key)
        self.counts.append(n)
        self.size += len(key)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        key, of = np.unique(np.concatenate(self.keys), return_inverse=True)
        n = np.bincount(of, weights=np.concatenate(self.counts), minlength=len(key)).astype(np.int64)
        self.keys, self.counts, self.size = [key], [n], len(key)
        return key, n

    def batch(self) -> pa.RecordBatch:
        key, n = self.merged()
        self.keys, self.counts, self.size = [], [], 0
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


def _counted(texts: DataFrame, keys_of) -> DataFrame:
    """``key, n`` over all ``texts``, added up in the tasks before the
    shuffle; ``keys_of(tokens, first)`` gives the keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, keys = Sums(), keys_of()
        for batch in batches:
            for _, _, w in split(batch.column("text"), NON_SPACE):
                sums.add(keys(*tokens(w)))
                if sums.size > 2 * _FLUSH:
                    sums.merged()
                    if sums.size > _FLUSH:
                        yield sums.batch()
        yield sums.batch()

    counts = map_arrow(texts.select("text"), task, "key bigint, n bigint")
    return counts.groupBy("key").agg(F.sum("n").alias("n"))


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class Model:
    """The automaton and the tables of its other weights: ``values (key,
    kind, value, more)``, kind 0 a token's log10(count + 1), kind 1 what an
    n-gram's arc adds over failing, kind 3 a state's failure weight."""

    def __init__(self, automaton: Whole, values: DataFrame):
        self.automaton, self.values = automaton, values


def _spark_hash(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    p1, p2, p3 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    x = value * p2
    x = (x << np.uint64(31) | x >> np.uint64(33)) * p1 ^ (seed + np.uint64(0x27D4EB2F165667C5 + 8))
    x = (x << np.uint64(27) | x >> np.uint64(37)) * p1 + np.uint64(0x85EBCA77C2B2AE63)
    x = (x ^ x >> np.uint64(33)) * p2
    x = (x ^ x >> np.uint64(29)) * p3
    return x ^ x >> np.uint64(32)


def pair(state: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Key of the n-gram that leads from ``state`` on and ends in ``low``, the
    n-gram without its first token: Spark's ``xxhash64(state, low)``."""
    return _spark_hash(low, _spark_hash(state, np.full(len(low), 42, dtype=np.uint64)))


def grams(t: np.ndarray, first: np.ndarray, order: int):
    """``places, state, low, key`` of the n-grams of 2 to ``order`` tokens,
    by the place of the last one; the token before a text is the end."""
    begin = first[:-1]
    place = np.arange(len(t)) - np.repeat(begin, np.diff(first))
    state = np.roll(t, 1)
    state[begin] = END
    low, on = t, np.arange(len(t))
    for k in range(2, order + 1):
        key = pair(state[on], low[on])
        yield k, on, state[on], low[on], key
        full = np.zeros(len(t), dtype=np.uint64)
        full[on] = key
        state, low, on = np.roll(full, 1), full, np.flatnonzero(place >= k - 1)


class GramSums:
    """Counts of n-grams by key, merged as they come and handed out when many."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, k: int, state: np.ndarray, low: np.ndarray, key: np.ndarray) -> None:
        key, at, n = np.unique(key, return_index=True, return_counts=True)
        self.parts.append((key, np.full(len(key), k, dtype=np.int32), state[at], low[at], n))
        self.size += len(key)

    def merge(self) -> None:
        if not self.parts:
            return
        key, k, state, low, n = map(np.concatenate, zip(*self.parts, strict=True))
        key, at, of = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(of, weights=n, minlength=len(key)).astype(np.int64)
        self.parts, self.size = [(key, k[at], state[at], low[at], n)], len(key)

    def batch(self) -> pa.RecordBatch:
        self.merge()
        none = np.zeros(0, np.uint64)
        _, k, state, low, n = self.parts[0] if self.parts else (none, none.astype(np.int32), none, none, none.view(np.int64))
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(state.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n.astype(np.int64))],
            names=["k", "state", "low", "n"],
        )


def before(t: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each; the end, at a text's begin."""
    out = np.roll(t, 1)
    out[first[:-1]] = END
    return out


def _gram_counts(order: int, behind: np.ndarray | None):
    """Task: texts -> counts of their tokens (led to by 0), and of the n-grams
    whose last token follows one of ``behind`` (None: any)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = GramSums()
        for batch in batches:
            for _, _, w in split(batch.column("text"), NON_SPACE):
                t, first = tokens(w)
                sums.add(1, np.zeros(len(t), dtype=np.uint64), t, t)
                near = None if behind is None else _find(behind, before(t, first)) >= 0
                for k, on, state, low, key in grams(t, first, order):
                    own = slice(None) if near is None else near[on]
                    sums.add(k, state[own], low[own], key[own])
                if sums.size > _FLUSH:
                    sums.merge()
                    if sums.size > _FLUSH // 2:
                        yield sums.batch()
        yield sums.batch()

    return task


class Whole:
    """What every task holds of the automaton: the frequent tokens and
    n-grams (sorted keys) with log10(count + 1) of tokens and what arcs add,
    and the frequent states (sorted keys) with their failure weights."""

    def __init__(self, order, total, kinds, behind, arcs, states):
        self.order, self.total, self.kinds = order, total, kinds
        #: only tokens behind these are scored (sorted; None: all)
        self.behind = behind
        (self.keys, self.bases, self.adds), (self.states, _, self.fails) = arcs, states

    def read(self, t: np.ndarray, first: np.ndarray):
        """Of each token: is it scored, is its count held, what is known of
        the base score and beyond it; and what to ask for: ``(kind, places,
        keys)``."""
        own = np.ones(len(t), bool) if self.behind is None else _find(self.behind, before(t, first)) >= 0
        at = np.where(own, _find(self.keys, t), -1)
        known, far = at >= 0, own & (at < 0)
        base, extra = np.zeros(len(t)), np.zeros(len(t))
        base[known] = self.bases[at[known]]
        asked = [(0, np.flatnonzero(far), t[far].view(np.int64))]
        for _, on, state, _, key in grams(t, first, self.order):
            on, state, key = on[own[on]], state[own[on]], key[own[on]]
            for kind, keys, table, weights in ((1, key, self.keys, self.adds), (3, state, self.states, self.fails)):
                at = _find(table, keys)
                held = at >= 0
                extra[on[held]] += weights[at[held]]
                asked.append((kind, on[~held], keys[~held].view(np.int64)))
        return own, known, base, extra, asked


def _looked_up(rows: DataFrame, on: str, table: DataFrame, names: list[str], total: int) -> DataFrame:
    """``rows`` with ``names`` of ``table (key, size, ...)`` at ``on``.  Keys
    that may be hot are broadcast (at most ``2^HOT_BITS``, as sizes add up to
    ``total`` at most), and their rows are spread in the other join."""
    often = F.col("size").cast("double") * (1 << HOT_BITS) >= total
    few = table.where(often).select(F.col("key").alias(on), F.lit(True).alias("_hot"), *[F.col(c).alias(f"_{c}") for c in names])
    rest = table.where(~often).select(F.col("key").alias("_key"), *names)
    at = F.when(F.col("_hot").isNull(), F.col(on)).otherwise(F.xxhash64(*rows.columns))
    spread = rows.join(F.broadcast(few), on, "left").withColumn("_at", at)
    found = spread.join(rest, (F.col("_at") == F.col("_key")) & F.col("_hot").isNull(), "left")
    return found.select(*rows.columns, *[F.coalesce(f"_{c}", c).alias(c) for c in names])


def learn_all(
    docs: DataFrame, order: int = ORDER, frequent_bits: int = FREQUENT_BITS, behind: np.ndarray | None = None
) -> Model:
    """The whole automaton of all texts of ``docs (text)``, or its states that
    end in one of ``behind`` (sorted token hashes); ``frequent_bits`` only
    decides where a weight is looked up."""
    spark = docs.sparkSession
    counts = map_arrow(docs.select("text"), _gram_counts(order, behind), "k int, state bigint, low bigint, n bigint")
    path = scratch_path(spark, "lm-grams")
    counts.groupBy("k", "state", "low").agg(F.sum("n").alias("n")).write.partitionBy("k").parquet(path)
    found = spark.read.schema("state bigint, low bigint, n bigint, k int").parquet(path)
    unigrams = found.where("k = 1").select(F.col("low").alias("key"), F.col("n").alias("size"))
    sizes = unigrams.agg(F.sum("size").alias("total"), F.count("*").alias("kinds")).first()
    total, kinds = sizes["total"] or 0, sizes["kinds"]
    # per order: key, size, p, and what the arc adds over failing
    arcs = unigrams.select("key", "size", ((F.col("size") + 1) / F.lit(float(total + kinds + 1))).alias("p"))
    nothing = F.lit(0.0)
    values = unigrams.select("key", "size", F.lit(0).alias("kind"), F.log10(F.col("size") + 1.0).alias("value"), nothing.alias("more"))

    for k in range(2, order + 1):
        own = found.where(F.col("k") == k).select("state", "low", "n")
        lower = arcs.select("key", "size", F.col("p").alias("p_low"))
        own = stored(_looked_up(own, "low", lower, ["p_low"], total), f"lm-lower-{k}")
        states = own.groupBy("state").agg(F.sum("n").alias("size"), F.count("*").alias("kinds"), F.sum("p_low").alias("p_low"))
        # what the arcs leave, over what the same tokens leave in the next state
        fail = F.log10(F.col("kinds") * DISCOUNT / F.col("size")) - F.log10(F.greatest(1 - F.col("p_low"), F.lit(1e-15)))
        states = stored(states.select(F.col("state").alias("key"), "size", F.col("size").alias("seen"), fail.alias("fail")), f"lm-states-{k}")
        led = _looked_up(own, "state", states, ["seen", "fail"], total)
        p = (F.col("n") - DISCOUNT) / F.col("seen")
        gain = F.log10(p) - F.log10("p_low") - F.col("fail")
        arcs = led.select(F.xxhash64("state", "low").alias("key"), F.col("n").alias("size"), p.alias("p"), gain.alias("gain"))
        arcs = stored(arcs, f"lm-arcs-{k}")
        for kind, table, more in ((1, arcs, "gain"), (3, states, "fail")):
            rows = table.select("key", "size", F.lit(kind).alias("kind"), nothing.alias("value"), F.col(more).alias("more"))
            values = values.unionByName(rows)
    values = stored(values, "lm-weights")
    often = F.col("size").cast("double") * (1 << frequent_bits) >= total

    def held(which) -> tuple[np.ndarray, ...]:
        # at most 2^FREQUENT_BITS rows an order
        top = values.where(often & which).select("key", "value", "more").toArrow()
        keys = top["key"].to_numpy().view(np.uint64)
        by_key = np.argsort(keys)
        return keys[by_key], top["value"].to_numpy()[by_key], top["more"].to_numpy()[by_key]

    automaton = Whole(order, total, kinds, behind, held(F.col("kind") < 3), held(F.col("kind") == 3))
    return Model(automaton, values.where(~often).select("key", "kind", "value", "more"))


def _requests(shared, keys: list[str]):
    """Task: texts -> what the automaton knows of each (kind 2), and a row
    for each distinct rare token (kind 0), possible arc (1) or state (3)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Whole = shared.value
        for batch in batches:
            for a, b, w in split(batch.column("text"), NON_SPACE, 1 << 20):
                t, first = tokens(w)
                text = np.repeat(np.arange(b - a), np.diff(first))
                scored, known, base, extra, asked = own.read(t, first)
                begin = first[:-1]
                n = np.add.reduceat(scored.astype(np.int64), begin)
                base, extra = np.add.reduceat(base, begin), np.add.reduceat(extra, begin)
                n_known = np.add.reduceat(known.astype(np.int64), begin)
                marks = batch.column("mark").slice(a, b - a)
                spread = marks.to_numpy(zero_copy_only=False)
                yield rows(batch, a, np.arange(b - a), spread, 2, n, base, extra, n_known)
                for kind, on, key in asked:
                    both = np.lexsort((key, text[on]))
                    x, k = text[on][both], key[both]
                    if not len(x):
                        continue
                    new = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (k[1:] != k[:-1]))))
                    times = np.diff(np.append(new, len(x)))
                    for at in range(0, len(new), 1 << 16):
                        to = slice(at, at + (1 << 16))
                        nothing = np.zeros(len(new[to]))
                        yield rows(batch, a, x[new[to]], k[new[to]], kind, times[to], nothing, nothing, nothing.astype(np.int64))

    def rows(batch, a, text, key, kind, n, base, extra, n_known) -> pa.RecordBatch:
        at = pa.array(text + a)
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(at) for c in keys],
                pa.array(key.astype(np.int64)),
                pa.array(np.full(len(text), kind, dtype=np.int32)),
                pa.array(n.astype(np.int32)),
                pa.array(base),
                pa.array(extra),
                pa.array(n_known.astype(np.int32)),
            ],
            names=[*keys, "key", "kind", "n", "base", "extra", "n_known"],
        )

    return task


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, mark, n_tokens, n_known, base_score, score`` of each row of
    ``docs (doc_id, text)``; both scores are log10 probabilities."""
    return shared_out(summed(docs, model), model.automaton.total, model.automaton.kinds)


def summed(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, mark, times, n_tokens, n_known, base, extra``: sums over
    equal rows of ``docs``, the base without its denominator."""
    keys = ["doc_id", "mark"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    schema = T.StructType(rows.select(*keys).schema.fields).add("key", "long").add("kind", "integer").add("n", "integer")
    schema.add("base", "double").add("extra", "double").add("n_known", "integer")
    shared = docs.sparkSession.sparkContext.broadcast(model.automaton)
    sent = map_arrow(rows, _requests(shared, keys), schema)
    answered = sent.join(model.values, ["key", "kind"], "left")
    own, value, more = F.col("kind") == 2, F.col("n") * F.col("value"), F.col("n") * F.col("more")
    seen = F.when((F.col("kind") == 0) & F.col("value").isNotNull(), F.col("n")).otherwise(0)
    base = F.when(own, F.col("base")).when(F.col("kind") == 0, value)
    extra = F.when(own, F.col("extra")).otherwise(more)
    return answered.groupBy(*keys).agg(
        F.sum(F.when(own, 1).otherwise(0)).alias("times"),
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("n_tokens"),
        F.sum(F.col("n_known") + seen).alias("n_known"),
        F.sum(base).alias("base"),
        F.coalesce(F.sum(extra), F.lit(0.0)).alias("extra"),
    )


def shared_out(sums: DataFrame, total: int, kinds: int) -> DataFrame:
    """Equal rows were added up together: each gets its share."""
    keys = ["doc_id", "mark"]
    unit = F.log10(F.lit(float(total + kinds + 1)))
    each = sums.select(
        *keys,
        (F.col("n_tokens") / F.col("times")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("times")).cast("long").alias("n_known"),
        (F.col("base") / F.col("times")).alias("base"),
        (F.col("extra") / F.col("times")).alias("extra"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_nth"),
    )
    base_score = F.col("base") - F.col("n_tokens") * unit
    return each.select(
        *keys, "n_tokens", "n_known", base_score.alias("base_score"), (base_score + F.col("extra")).alias("score")
    )


def held_out(doc_id="doc_id"):
    """Rows that learning never reads."""
    return fold(F.col(doc_id), FOLDS) == HELD_OUT
