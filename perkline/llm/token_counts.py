"""Token counts through a digest cache.

The cache is a Parquet folder per tokenizer version: content digest ->
token count.  Documents' digests are joined to it; only distinct digests that
miss are encoded, each once, and appended.  A digest is the SHA-256 of the
normalised content (NULL counts as empty; nothing else may change a count),
the version the SHA-256 of the tokenizer's file and the library's release.

Encoding is spread by Spark over the distinct misses.  The tokenizer splits
at white space before anything else and drops it, so a text's count is the
sum over its ``[^\\x20\\x09-\\x0D]+`` words; a task encodes a word once and
remembers its count.  Tokenizers without that property encode whole texts.

A run that fails leaves at most finished files in the cache, whose rows are
right; rows may repeat there, and reading takes one per digest.

Defined cases: a NULL text counts as empty (0 bytes, 0 tokens); repeated
texts are encoded once; an empty table appends nothing; extra columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.llm.common import map_arrow
from perkline.llm.words import NON_SPACE_EXACT, Words, split

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: words whose counts a task remembers before it starts anew
REMEMBERED = 1 << 20


def tokenizer_bytes(name: str = TOKENIZER) -> bytes:
    """The vocabulary file; its place is that of the installed package."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def version(content: bytes) -> str:
    import tokenizers

    return hashlib.sha256(content + tokenizers.__version__.encode()).hexdigest()[:24]


def splits_at_space(content: bytes) -> bool:
    """Whether the tokenizer's own rules drop white space before merging: its
    pre-tokenizer keeps only matches of a pattern that never hold any."""
    spec = json.loads(content)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    apart = first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"
    specials = [t["content"] for t in spec.get("added_tokens", [])]
    return bool(apart) and not any(c.isspace() for t in specials for c in t)


class Counter:
    """Token counts of texts, as the library gives them without added
    special tokens, truncation or padding."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = splits_at_space(content)
        # hash 0 stands for no word
        self.hashes, self.tokens = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.int64)

    def _encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        for at in range(0, len(texts), 4096):
            part = self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
            out[at : at + 4096] = [len(e) for e in part]
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        if not self.by_word:
            return self._encode([x or "" for x in texts.to_pylist()])
        out = np.zeros(len(texts), dtype=np.int64)
        for a, b, w in split(texts, NON_SPACE_EXACT):
            hashes, first, of = np.unique(w.hash, return_index=True, return_inverse=True)
            tokens = np.append(0, np.cumsum(self._words(w, hashes, first)[of]))
            out[a:b] = tokens[w.first[1:]] - tokens[w.first[:-1]]
        return out

    def _words(self, w: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Counts of distinct words; those met before are remembered."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        new = self.hashes[at] != hashes
        n = self.tokens[at]
        bytes_of = w.buf.tobytes()
        place = first[new]
        ends = zip(w.start[place].tolist(), w.end[place].tolist(), strict=True)
        n[new] = self._encode([bytes_of[i:j].decode() for i, j in ends])
        if len(self.hashes) > REMEMBERED:
            self.hashes, self.tokens = self.hashes[:1], self.tokens[:1]
        self.hashes = np.concatenate((self.hashes, hashes[new]))
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.tokens = self.hashes[order], np.concatenate((self.tokens, n[new]))[order]
        return n


def _encoded(spark: SparkSession, content: bytes):
    shared = spark.sparkContext.broadcast(content)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counter = None
        for batch in batches:
            counter = counter or Counter(shared.value)
            n = pa.array(counter.counts(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), n], names=["digest", "n_tokens"])

    return task


def count_tokens(docs: DataFrame, cache: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row of ``docs (doc_id, text)``.

    ``cache`` is a folder in a store that driver and executors share.
    """
    spark = docs.sparkSession
    content = tokenizer_bytes(tokenizer)
    path = f"{cache.rstrip('/')}/{version(content)}"
    schema = "digest binary, n_tokens bigint"
    # an empty file makes the folder, so that a first run reads it too
    spark.createDataFrame([], schema).write.mode("append").parquet(path)

    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    stored = spark.read.schema(schema).parquet(path)
    misses = (
        docs.select(digest.alias("digest"), text.alias("text"))
        .join(stored.select("digest"), "digest", "left_anti")
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
    )
    map_arrow(misses, _encoded(spark, content), schema).write.mode("append").parquet(path)

    counts = spark.read.schema(schema).parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("digest"))
    return rows.join(counts, "digest", "left").select("doc_id", "n_bytes", "n_tokens")
