"""The registered queries against their twins, and the pipeline against a
brute-force version."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from perkline.llm import lang_id
from perkline.llm.queries import QUERIES, TWINS

from .data import SF, WORD, edge_docs, empty_docs
from .test_corpus_ops import brute_classes
from .test_filters import brute_measures
from .test_text_ops import brute_hits

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("key", sorted(TWINS))
def test_twin(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[key](spark, SF), con.sql(TWINS[key])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    ours = collections.Counter(tuple(r) for r in got.select(*columns).collect())
    theirs = collections.Counter(want.select(*columns).fetchall())
    assert ours == theirs


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_run_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {i: r for i, r in rows.items() if not brute_measures(r["text"])[-1]}
    named = lang_id.identify(docs.where(F.col("doc_id").isin(list(kept))), keep=["doc_id"]).collect()
    kept = {r["doc_id"]: kept[r["doc_id"]] for r in named if r["lang_pred"] != "und" and r["score"] >= 0.5}
    ids = sorted(kept)
    one = [ids[i] for i, _, top in brute_classes([kept[i]["text"] for i in ids]) if i == top]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = []
    for i in one:
        n, hit, _ = brute_hits(kept[i]["text"], items)
        if not (hit and 20 * hit >= n):
            clean.append(i)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == clean
    assert all(r["size"] == len(WORD.findall(rows[r["doc_id"]]["text"])) for r in got)


def test_stages_keep_columns_and_take_edges(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
            if docs.columns[-1] == "node":
                assert {r["kept"] for r in out.collect()} <= {"mine"}
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
