"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree: after a context of up to ``ORDER``
bytes, a symbol seen ``c`` times out of ``n`` with ``q`` distinct ones costs
``-log2(c / (n + q))`` bits, and an unseen one the escape ``-log2(q / (n +
q))`` plus its cost in the context one byte shorter; below the empty context
every byte costs 8 bits.  Statistics are frozen after learning, so a byte's
cost depends only on the ``ORDER`` bytes before it; the tree is a table from
byte strings to costs in all languages, and a text's code length is a sum of
table look-ups, done for whole Arrow batches at once.  The language with the
shortest code wins; ``score`` is its posterior under equal priors.

Learning reads a bounded sample: about ``SAMPLE_DOCS`` labelled documents of
each language, picked by a hash of the whole row, each with its whole text.
The tree is broadcast; its size is bounded by the sample's (and by ``ORDER``).

Letters are lower-cased and every ASCII byte that is no letter becomes a
space, so that digits and markup weigh nothing between languages.

Defined cases: a NULL text, or one without a letter, is ``UNKNOWN`` with score
0, and so is every text when nothing was learned; rows without a label are
not learned from; equal code lengths go to the first language in code point
order; repeated rows are each judged; kept columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import fold, map_arrow
from perkline.llm.words import slices

UNKNOWN = "und"
ORDER = 4
SAMPLE_DOCS = 1500
FOLDS = 3
HELD_OUT = 1

_CLASS = np.full(256, 0x20, dtype=np.uint64)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 0x100)


def grams(buf: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """For each byte the last ``length`` bytes up to it as one number; what
    lies before the text counts as zeros."""
    sym = _CLASS[buf]
    place = np.arange(len(buf)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = sym.copy()
    for k in range(1, length):
        out[k:] |= np.where(place[k:] >= k, sym[:-k], np.uint64(0)) << np.uint64(8 * k)
    return out


def _tag(gram: np.ndarray, length: int) -> np.ndarray:
    return gram | np.uint64(length) << np.uint64(56)


class Table:
    """Hash table from tagged byte strings to rows of costs."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(4 * max(1, len(keys))).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.rows = np.zeros(1 << bits, dtype=np.int32)
        self.values = np.ascontiguousarray(values)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            _, first = np.unique(slot[left], return_index=True)
            first = first[self.keys[slot[left[first]]] == 0]
            put = left[first]
            self.keys[slot[put]], self.rows[slot[put]] = keys[put], put
            left = np.delete(left, first)
            slot[left] = slot[left] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key; -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.rows[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], slot[on] + 1 & self.mask
        return out


class Model:
    """Frozen context trees of all languages."""

    def __init__(self, langs: list[str], lang: np.ndarray, tagged: np.ndarray, count: np.ndarray, order: int):
        """``lang, tagged, count``: a byte string of 1 to ``order + 1`` bytes
        (tagged with its length), seen so often in that language."""
        self.langs, self.order = langs, order
        n_lang = len(langs)
        length = (tagged >> np.uint64(56)).astype(np.int64)
        gram = tagged & np.uint64((1 << 56) - 1)
        keys, costs, escapes = [], [], []
        lower: tuple[np.ndarray, np.ndarray] | None = None  # sorted strings one byte shorter, and their costs
        for size in range(1, order + 2):
            at = length == size
            strings, index = np.unique(gram[at], return_inverse=True)
            seen = np.zeros((len(strings), n_lang))
            np.add.at(seen, (index, lang[at]), count[at])
            contexts, of = np.unique(strings >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), n_lang)), np.zeros((len(contexts), n_lang))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(total + kinds) - np.log2(kinds), 0.0)
                known = np.log2((total + kinds)[of]) - np.log2(seen)
            if lower is None:
                below = np.full((len(strings), n_lang), 8.0)
            else:
                below = lower[1][np.searchsorted(lower[0], strings & np.uint64((1 << 8 * (size - 1)) - 1))]
            cost = np.where(seen > 0, known, escape[of] + below)
            keys.append(_tag(strings, size))
            costs.append(cost)
            escapes.append((_tag(contexts, 8 + size - 1), escape))  # kept beside the strings, tagged 8 and more
            lower = (strings, cost)
        self.costs = Table(np.concatenate(keys), np.concatenate(costs).astype(np.float32))
        self.escapes = Table(np.concatenate([k for k, _ in escapes]), np.concatenate([e for _, e in escapes]).astype(np.float32))

    def lengths(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text (row) in each language."""
        longest = grams(buf, offsets, self.order + 1)
        bits = np.zeros((len(buf), len(self.langs)), dtype=np.float32)
        left = np.arange(len(buf))
        for size in range(self.order + 1, 0, -1):
            part = longest[left] & np.uint64((1 << 8 * size) - 1)
            row = self.costs.find(_tag(part, size))
            found = row >= 0
            bits[left[found]] += self.costs.values[row[found]]
            left, part = left[~found], part[~found]
            row = self.escapes.find(_tag(part >> np.uint64(8), 8 + size - 1))
            known = row >= 0
            bits[left[known]] += self.escapes.values[row[known]]
        bits[left] += 8.0
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        some = np.flatnonzero(np.diff(offsets) > 0)
        if len(some):
            out[some] = np.add.reduceat(bits, offsets[:-1][some], axis=0, dtype=np.float64)
        return out


def _counts(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = np.asarray(batch.column("lang").to_numpy(zero_copy_only=False), dtype=object)
        for a, b, buf, offsets in slices(pc.utf8_lower(batch.column("text")), 1 << 20):
            own = np.repeat(lang[a:b], np.diff(offsets))
            for name in np.unique(lang[a:b].astype(str)):
                at = own == name
                for size in range(1, order + 2):
                    keys, n = np.unique(_tag(grams(buf, offsets, size)[at], size), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"],
                    )


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that learning never reads."""
    return fold(F.col(doc_id) if isinstance(doc_id, str) else doc_id, FOLDS) == HELD_OUT


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, order: int = ORDER) -> Model:
    """Context trees from labelled rows ``(doc_id, text, lang)`` that are not
    held out, a sample of about ``sample_docs`` for each language."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), order)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / (1 << 40)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(sample_docs / sizes[k]))])
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text")
    found = (
        map_arrow(sample, lambda batches: _counts(batches, order), "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    place = {k: i for i, k in enumerate(langs)}
    lang = np.array([place[x] for x in found["lang"].to_pylist()], dtype=np.int64)
    tagged = found["gram"].to_numpy().view(np.uint64)
    return Model(langs, lang, tagged, found["n"].to_numpy().astype(float), order)


def predict(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of ``docs`` with the predicted language and its score
    under ``names``; only ``text`` decides."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], lettered.alias("lettered"), "text")
    own = [f"_k{i}" for i in range(len(keep))]
    if "text" in keep:  # moved once only
        rows = rows.drop("text")
    source = own[keep.index("text")] if "text" in keep else "text"
    schema = T.StructType(rows.select(*own).schema.fields).add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names_of = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            for a, b, buf, offsets in slices(pc.utf8_lower(batch.column(source)), 1 << 19):
                best, score = np.full(b - a, len(model.langs)), np.zeros(b - a)
                if model.langs:
                    bits = model.lengths(buf, offsets)
                    best = bits.argmin(axis=1)
                    score = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                    best = np.where(lettered[a:b], best, len(model.langs))
                    score = np.where(lettered[a:b], score, 0.0)
                kept = [batch.column(n).slice(a, b - a) for n in own]
                out = [*kept, pa.array(names_of[best], pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(out, names=[*own, "lang_pred", "score"])

    out = map_arrow(rows, task, schema)
    found = [F.col(a).alias(b) for a, b in zip(("lang_pred", "score"), names, strict=True)]
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *found)


def identify(docs: DataFrame, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``predict`` with a model learned from the rows not held out."""
    return predict(docs, learn(docs), keep, names)
