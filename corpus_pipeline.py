"""Corpus pipeline: quality rules, language ID, near duplicates, benchmark
decontamination, and the mix, each over all that the stage before kept.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkline.llm import decontaminate, host_rules, lang_id, mixing, ngram_join
from perkline.llm.common import fresh, table
from perkline.session import scratch_path

#: a document whose best language has less of the posterior than this goes
MIN_LANGUAGE_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the text rules and come from an accepted host."""
    rows = docs.select(F.struct("*").alias("row"), "text", "source")
    return host_rules.judge(rows).where("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model names; the label column stays
    as it was."""
    language, score = fresh("language", docs.columns), fresh("language_score", docs.columns)
    named = lang_id.identify(docs, docs.columns, names=(language, score))
    good = (F.col(language) != lang_id.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return named.where(good).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group: the one with the smallest id.

    Links are op8's (4-word shingles, Jaccard 0.85), the rule that the
    brute-force test of the pipeline holds this stage to; pairs that only
    5-word shingles at 0.8 would link are both kept."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: a learned language model has no SQL form; tests hold run() against a
#: brute-force version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
