"""Benchmark decontamination by winnowing.

Words are hashed; of every ``SPAN - K + 1`` consecutive k-gram hashes a text
keeps the smallest, so two texts that share ``SPAN`` consecutive words share a
kept fingerprint inside that stretch.  Fingerprints of documents and items are
joined, each hit is extended word by word to both sides, and stretches of at
least ``SPAN`` equal words are hits.  An item of fewer words is one window:
its whole-item hash is looked up at every place of a document.

Only fingerprints that pass a bit field of fixed size, filled from the items,
leave a task, with the words around them; the field only saves work, as the
join and the extension decide on the words themselves.  A passage that many
documents share is then one key with many rows on one side, which the
adaptive join splits.

Defined cases: a NULL or empty text has no words, hits and items; an item
without words is no window; a NULL item id counts as the empty id; repeated
documents are each judged; an id repeated among the items counts once; empty
tables give no hits; extra columns are not read (``clean`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm.words import LETTER_DIGIT, Words, split

SPAN = 13
K = 8
FIELD_BITS = 23
MIN_PERCENT = 5

_HIT = pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("off", pa.int32()), ("len", pa.int32()), ("words", pa.string())])
_HITS = T.ArrayType(
    T.StructType().add("fp", "long").add("at", "integer").add("off", "integer").add("len", "integer").add("words", "string")
)


def kept_places(w: Words, k: int = K, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed k-grams."""
    grams, whole = w.grams(k)
    window = span - k + 1
    n = len(grams)
    if n < span:
        return np.zeros(0, dtype=np.int64), grams[:0]
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    least = grams[: n - window + 1].copy()
    for o in range(1, window):
        np.minimum(least, grams[o : n - window + 1 + o], out=least)
    fits = np.arange(n - window + 1) + span <= w.first[1:][text[: n - window + 1]]
    keep = np.zeros(n, dtype=bool)
    for o in range(window):
        keep[o : n - window + 1 + o] |= fits & (grams[o : n - window + 1 + o] == least)
    at = np.flatnonzero(keep & whole)
    return at, grams[at]


def _hits(w: Words, short: list[int], field: np.ndarray | None) -> list[list[dict]]:
    """For each text its fingerprints (those in ``field``, if given)."""
    found: list[list[dict]] = [[] for _ in range(len(w.first) - 1)]
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    sets = [(K, SPAN - K, *kept_places(w))]
    for m in short:
        grams, whole = w.grams(m)
        if field is None:
            whole = whole & (w.first[:-1][text] + m == w.first[1:][text])
        at = np.flatnonzero(whole)
        sets.append((m, 0, at, grams[at] ^ np.uint64(m)))
    for length, around, at, fps in sets:
        if field is not None and len(at):
            bit = fps >> np.uint64(64 - FIELD_BITS)
            on = (field[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
            at, fps = at[on == 1], fps[on == 1]
        for p, fp in zip(at.tolist(), fps.view(np.int64).tolist(), strict=True):
            t = text[p]
            lo = max(int(w.first[t]), p - around)
            hi = min(int(w.first[t + 1]), p + length + around)
            words = b" ".join(w.text(i) for i in range(lo, hi)).decode("utf-8", "replace")
            found[t].append({"fp": fp, "at": p - int(w.first[t]), "off": p - lo, "len": length, "words": words})
    return found


def fingerprints(rows: DataFrame, keys: list[str], short: list[int], field=None) -> DataFrame:
    """``keys, n_words, hits`` for each row of ``rows (*keys, text)``."""
    schema = T.StructType(rows.select(*keys).schema.fields).add("n_words", "long").add("hits", _HITS)
    shared = field and rows.sparkSession.sparkContext.broadcast(field)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8) if shared else None
        for batch in batches:
            for a, b, w in split(batch.column("text"), LETTER_DIGIT):
                own = [batch.column(k).slice(a, b - a) for k in keys]
                n_words = pa.array(np.diff(w.first), type=pa.int64())
                hits = pa.array(_hits(w, short, bits), type=pa.list_(_HIT))
                yield pa.RecordBatch.from_arrays([*own, n_words, hits], names=[*keys, "n_words", "hits"])

    return map_arrow(rows.select(*keys, "text"), task, schema)


def _field(fps: DataFrame) -> bytes:
    """Bit field of fixed size (1 MB) with the fingerprints' first bits."""
    bit = F.expr(f"shiftrightunsigned(fp, {64 - FIELD_BITS})")
    words = (
        fps.select((F.shiftright(bit, 5)).alias("w"), F.expr("1L").alias("one"), (bit.bitwiseAND(31)).cast("int").alias("p"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(one, p)")).alias("b"))
        .toArrow()
    )
    out = np.zeros(1 << FIELD_BITS - 5, dtype="<u4")
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.tobytes()


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined hits -> stretches of equal words long enough."""
    for batch in batches:
        rows = batch.to_pydict()
        index, begin, end = [], [], []
        cols = zip(rows["at"], rows["off"], rows["len"], rows["words"], rows["i_off"], rows["i_len"], rows["i_words"], strict=True)
        for n, (at, off, length, words, i_off, i_len, i_words) in enumerate(cols):
            a, b = words.split(" "), i_words.split(" ")
            if length != i_len or a[off : off + length] != b[i_off : i_off + length]:
                continue
            left = right = 0
            while left < min(off, i_off) and a[off - left - 1] == b[i_off - left - 1]:
                left += 1
            while off + length + right < len(a) and i_off + length + right < len(b) and a[off + length + right] == b[i_off + length + right]:
                right += 1
            # a short item is its gram and no more
            if len(b) == length or left + length + right >= SPAN:
                index.append(n)
                begin.append(at - left)
                end.append(at + length + right)
        picked = batch.select(["doc_id", "mark", "item_id"]).take(pa.array(index, type=pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*picked.columns, pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
            names=["doc_id", "mark", "item_id", "begin", "end"],
        )


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, mark, n_words, n_hit, items`` (the items' ids as text,
    sorted), one row per row of ``docs (doc_id, text)``; ``mark`` is the
    text's hash."""
    bench = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    lengths = fingerprints(bench, ["item_id"], []).where(f"n_words > 0 AND n_words < {SPAN}")
    short = sorted(r[0] for r in lengths.select("n_words").distinct().collect())
    bench = stored(fingerprints(bench, ["item_id"], short), "decontaminate-items")
    bench = bench.select("item_id", F.explode("hits").alias("h")).select("item_id", "h.*")
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    found = stored(fingerprints(rows, ["doc_id", "mark"], short, _field(bench)), "decontaminate-documents")
    theirs = bench.select(
        "fp", "item_id", F.col("off").alias("i_off"), F.col("len").alias("i_len"), F.col("words").alias("i_words")
    ).distinct()
    ours = found.where(F.size("hits") > 0).select("doc_id", "mark", F.explode("hits").alias("h")).select("doc_id", "mark", "h.*")
    schema = T.StructType([docs.schema["doc_id"]]).add("mark", "long").add("item_id", "string")
    spans = map_arrow(ours.join(theirs, "fp"), _extend, schema.add("begin", "integer").add("end", "integer"))
    order = Window.partitionBy("doc_id", "mark").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(order), F.lit(0))), F.lit(0))
    per_doc = (
        spans.withColumn("fresh", fresh)
        .groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
        .agg(F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return found.join(per_doc, found["doc_id"].eqNullSafe(per_doc["_id"]) & (found["mark"] == per_doc["_mark"]), "left").select(
        "doc_id",
        "mark",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(min_percent: int = MIN_PERCENT):
    """Hit words make up ``min_percent`` of the document or more."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, all columns kept."""
    bad = find(docs, items).where(contaminated()).select(F.col("doc_id").alias("id"), F.col("mark").alias("own")).distinct()
    # the row as one column, so that no name of docs can clash
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"))
    return rows.join(bad, rows["doc"].eqNullSafe(bad["id"]) & (rows["mark"] == bad["own"]), "left_anti").select("row.*")
