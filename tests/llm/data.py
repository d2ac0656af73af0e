"""Helpers and small tables of the llm tests."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text: str | None) -> str:
    return (text or "").translate(_LOW)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(120_000))


def edge_docs(spark):
    """NULLs in every column, empty and very long texts, repeated rows, ties,
    and extra columns with names that the operators use themselves."""
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, "  \n\t ", "en", "a", 5),
        (4, "One two three four five six seven.", "en", None, 3),
        (4, "One two three four five six seven.", "en", None, 3),
        (None, "one TWO three four five six seven.", "de", "b", 3),
        (None, None, None, None, None),
        (5, LONG, "fr", "c", len(LONG)),
        (6, "é" * 50 + " 中文 \u00a0 x\x00y", "es", "é", 1),
        (7, "solo", "en", "b", 4),
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    private = ["_id", "_own", "_m", "_r", "_language", "_mark", "_times", "_host", "language", "mark", "row"]
    df = df.withColumns({c: F.lit("mine") for c in private})
    return df.withColumn("kept", F.lit("mine")).withColumn("score", F.lit(7)).withColumn("node", F.lit(None).cast("string"))


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark, texts, **more):
    rows = [(i, t, more.get("lang", "en"), "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
