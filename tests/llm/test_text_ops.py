"""Decontamination, LM scoring, token counts, chat formatting."""

import collections
import functools
import hashlib
import math
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkline.llm import chat_format, decontaminate, lm_score, lm_shards, token_counts
from perkline.llm.queries import QUERIES
from perkline.session import scratch_path

from .data import LETTERS, LONG, SF, WORD, docs_of, edge_docs, empty_docs, lower


# -- decontamination ----------------------------------------------------------
def brute_hits(text, items):
    w, hit, ids = LETTERS.findall(lower(text)), set(), set()
    for item_id, item in items:
        v = LETTERS.findall(lower(item))
        m = min(13, len(v))
        windows = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i : i + m]) in windows:
                hit.update(range(i, i + m))
                ids.add("" if item_id is None else str(item_id))
    return len(w), len(hit), sorted(ids)


ITEMS = [
    (1, " ".join(f"q{i}" for i in range(30))),
    (2, "Short item here"),
    (2, "another text, same id"),
    (3, "eight words make one item of the gram size"[:40]),
    (4, "a b c d e f g h"),
    (5, ""),
    (6, None),
    (None, "null id item"),
    (7, "same same same same same same same same same same same same same same same"),
    (10, " ".join(f"q{i}" for i in range(5, 25))),
]


def test_decontamination_by_brute_force(spark):
    q = [f"q{i}" for i in range(30)]
    texts = [
        " ".join(q), "x " + " ".join(q[3:16]) + " y", "x " + " ".join(q[3:15]) + " y", " ".join(q[:12]), "SHORT  item, here!",
        "same " * 40, "same " * 12, "z a b c d e f g h z", "null id item " * 3, "prefix " * 500 + " ".join(q[10:28]), LONG + " " + " ".join(q[1:20]),
        " ".join(q[:13] + ["x"] + q[13:29]), " ".join(q) + " " + " ".join(q), None, "", "...", "another text same id",
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find(docs, items).collect()}
    assert got == {i: brute_hits(t, ITEMS) for i, t in enumerate(texts)}


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_on_few_words(spark, seed):
    import random

    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choices("ab", k=rnd.randint(1, 30)))) for i in range(12)]
    texts = [" ".join(rnd.choices("ab", k=rnd.randint(0, 80))) for _ in range(40)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find(docs_of(spark, texts), frame).collect()}
    assert got == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_decontamination_edges(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edge_docs(spark)
    found = decontaminate.find(docs, items)
    assert found.count() == 10
    assert decontaminate.clean(docs, items).count() == 10 and decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.find(empty_docs(spark), items).count() == 0
    assert decontaminate.find(docs, items.limit(0)).where("n_hit > 0").count() == 0
    twice = docs_of(spark, ["Short item here"]).union(docs_of(spark, ["Short item here"]))
    assert [r["n_hit"] for r in decontaminate.find(twice, items).collect()] == [3, 3]
    assert decontaminate.clean(twice, items).count() == 0


# -- LM scoring ---------------------------------------------------------------
def test_lm_is_better_than_its_base(spark):
    got = QUERIES["op4_lm_score"](spark, SF).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0]


def brute_whole(texts, train, order):
    """Scores by walking the automaton, state by state."""
    tok = {i: [*WORD.findall(lower(t)), None] for i, t in texts.items()}
    seen = collections.defaultdict(collections.Counter)
    for i, t in tok.items():
        for at in range(len(t)) if train(i) else ():
            past = (*["begin"][at >= order :], *t[max(0, at - order) : at])
            for k in range(min(order, len(past) + 1)):
                seen[tuple(None if x == "begin" else x for x in past[len(past) - k :])][t[at]] += 1
    root = seen[()]
    n, v = sum(root.values()), len(root)

    @functools.cache
    def p(state, w):
        if not state:
            return (root[w] + 1) / (n + v + 1)
        arcs = seen.get(state)
        if arcs is None:
            return p(state[1:], w)
        if w in arcs:
            return (arcs[w] - 0.75) / sum(arcs.values())
        left = 0.75 * len(arcs) / sum(arcs.values())
        return left / (1 - sum(p(state[1:], x) for x in arcs)) * p(state[1:], w)

    return tok, root, p


@pytest.mark.parametrize("order,bits", [(3, 20), (3, 6), (4, 9), (2, 8)])
def test_whole_lm_by_brute_force(spark, order, bits):
    docs = edge_docs(spark).select("text").distinct().withColumn("doc_id", F.monotonically_increasing_id())
    more = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600").limit(40).select("text", F.col("doc_id") + 10**12)
    docs = docs.union(more).localCheckpoint()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    tok, root, p = brute_whole(texts, lambda i: i % 3 != 1, order)
    got = lm_score.score(docs, lm_score.learn_all(docs.where("doc_id % 3 != 1"), order, bits)).collect()
    assert len(got) == len(tok)
    for r in got:
        t = tok[r["doc_id"]]
        want = sum(math.log10(p((None, *t[max(0, at - order) : at])[-min(order - 1, at + 1) :], w)) for at, w in enumerate(t))
        assert r["score"] == pytest.approx(want, rel=1e-9) and r["n_known"] == sum(root[w] > 0 for w in t)
    state = tuple(next(t for t in tok.values() if len(t) > 5)[1:order])
    assert sum(p(state, w) for w in root) + p(state, "no such token \0") == pytest.approx(1)


@pytest.mark.parametrize(
    "order,bits,shard,by_key", [(3, 20, 1 << 22, 1 << 22), (3, 6, 700, 10**9), (3, 9, 500, 30), (4, 9, 900, 25), (2, 8, 300, 12), (3, 20, 400, 1)]
)
def test_lm_by_parts_by_brute_force(spark, order, bits, shard, by_key):
    docs = edge_docs(spark).select("text").distinct().withColumn("doc_id", F.monotonically_increasing_id())
    more = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600").limit(40).select("text", F.col("doc_id") + 10**12)
    docs = docs.union(more).withColumn("train", F.expr("doc_id % 3 != 1"))
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    texts = {r["doc_id"]: r["text"] or "" for r in rows}
    tok, root, p = brute_whole(texts, lambda i: i % 3 != 1, order)
    scores, total = lm_shards.score_corpus(docs, order, bits, shard, by_key)
    got = scores.collect()
    n, v = sum(root.values()), len(root)
    assert total == n and sorted(r["doc_id"] for r in got) == sorted(tok)
    for r in got:
        t = tok[r["doc_id"]]
        want = sum(math.log10(p((None, *t[max(0, at - order) : at])[-min(order - 1, at + 1) :], w)) for at, w in enumerate(t))
        assert r["score"] == pytest.approx(want, rel=1e-9)
        assert r["base_score"] == pytest.approx(sum(math.log10((root[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(t), sum(root[w] > 0 for w in t))


@pytest.mark.parametrize("by_key", [1 << 22, 2])
def test_lm_by_parts_edges(spark, by_key):
    docs = edge_docs(spark).withColumn("train", F.col("doc_id") > 0)
    more = docs_of(spark, ["a b a b c", None]).select("doc_id", "text", F.lit(None).cast("boolean").alias("train"))
    both = docs.select("doc_id", "text", "train").unionByName(more)
    twice = both.unionByName(both)
    got = lm_shards.score_corpus(twice, shard=100, by_key=by_key)[0].collect()
    assert len(got) == twice.count()
    times = collections.Counter((r["doc_id"], r["mark"], r["n_tokens"], round(r["score"], 6)) for r in got)
    assert all(k % 2 == 0 for k in times.values())
    none, total = lm_shards.score_corpus(both.withColumn("train", F.lit(False)), by_key=by_key)
    assert total == 0 and all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in none.collect())
    empty, total = lm_shards.score_corpus(both.where("doc_id = -5 and text = 'x'"), by_key=by_key)
    assert total == 0 and empty.count() == 0


def rows_made(node, name):
    """Rows that the operators of this name made in an executed plan."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return rows_made(node.executedPlan(), name)
    if kind.endswith("QueryStageExec"):
        return rows_made(node.plan(), name)
    own = node.longMetric("pythonNumRowsReceived").value() if node.nodeName() == name else 0
    return own + sum(rows_made(node.children().apply(i), name) for i in range(node.children().size()))


def test_lm_shards_send_blocks_and_no_row_a_text(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i % 7 :: 1 + i % 3]) for i in range(200)]
    docs = docs_of(spark, texts).select("doc_id", "text", (F.col("doc_id") % 3 != 1).alias("train")).coalesce(2)
    scores, _ = lm_shards.score_corpus(docs, shard=100)
    assert len(scores.collect()) == 200
    made = rows_made(scores._jdf.queryExecution().executedPlan(), "FlatMapCoGroupsInArrow")
    # a slice a task and at most 62 kinds of tokens that are read behind
    assert 0 < made <= 2 * 62
    one, _ = lm_shards.score_corpus(docs, shard=10**6)
    want = {r["doc_id"]: r["score"] for r in one.collect()}
    assert all(r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-9) for r in scores.collect())


def test_lm_slice_with_blocks_missing_fails():
    import numpy as np
    import pyarrow as pa

    head = [{"doc_id": 1, "mark": 2, "n_tokens": 3, "n_known": 0, "base": 0.0}]
    sums = lm_shards._pack_sums(np.array([[0.5], [-1.5]])), lm_shards._pack(np.array([1])), lm_shards._pack(np.array([0]))
    names = ["n", "m", "head", "sums", "known", "texts"]
    whole = pa.table([pa.array([x]) for x in (3, 1, head, *sums)], names=names)
    schema = pa.schema([("doc_id", "int64"), ("mark", "int64"), *[(c, "int64") for c in ("times", "n_tokens", "n_known")], ("base", "double"), ("extra", "double")])
    task = lm_shards._slice_sums(schema)
    want = {"doc_id": 1, "mark": 2, "times": 1, "n_tokens": 3, "n_known": 1, "base": -1.5, "extra": 0.5}
    assert task(whole).to_pylist() == [want]
    with pytest.raises(RuntimeError):
        task(pa.table([pa.array([x]) for x in (2, 1, head, *sums)], names=names))


def test_lm_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    tok, root, p = brute_whole(texts, lambda i: zlib.crc32(str(i).encode()) % 7 != 2, 2)
    n, v = sum(root.values()), len(root)
    for r in QUERIES["op4_lm_score"](spark, SF).collect():
        t = tok[r["doc_id"]]
        assert r["train_tokens"] == n and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(sum(math.log10((root[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)


def test_lm_keeps_what_is_seen_once(spark, tmp_path):
    own = ["once upon a rare time", "other words here", "words of a third text"]
    docs_of(spark, own).write.parquet(str(tmp_path / "documents.parquet"))
    got = [r for r in QUERIES["op4_lm_score"](spark, str(tmp_path)).collect() if not r["held_out"]]
    assert got and all(r["score"] > r["base_score"] + 1 for r in got)
    none = lm_score.learn_all(empty_docs(spark))
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in lm_score.score(docs_of(spark, own), none).collect())


# -- token counts -------------------------------------------------------------
def library_counts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


ODD = [
    "a<|endoftext|>b <|startoftext|> x", "<|ENDOFTEXT|>", "It's we'll DON'T", "e\u0301 \u0301x", "a\u00a0b\u2003c\u3000d", "\x1c\x1d x\x85y",
    "ﬁ İ ẞ ΑΣ Σ", "1234 5.6", "\U0001f600\u200d\U0001f600", "  lead and trail \n", "中文字", "<|endoftext|", "\x00", "ab" * 3000,
]


def test_token_counts_by_the_library(spark):
    docs = edge_docs(spark).select("doc_id", "text").union(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"))
    cache = scratch_path(spark, "cache")
    got = token_counts.count_tokens(docs, cache).join(
        docs.select("doc_id", "text").distinct(), "doc_id"
    )
    rows = docs.collect()
    want = collections.Counter(
        (r["doc_id"], len((r["text"] or "").encode()), n) for r, n in zip(rows, library_counts([r["text"] for r in rows]), strict=True)
    )
    assert collections.Counter(map(tuple, token_counts.count_tokens(docs, cache).collect())) == want
    assert got is not None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_counting_by_word_is_exact(texts):
    import pyarrow as pa

    counter = test_counting_by_word_is_exact.counter
    assert counter.by_word
    assert counter.counts(pa.array(texts, pa.string())).tolist() == library_counts(texts)


test_counting_by_word_is_exact.counter = token_counts.Counter(token_counts.tokenizer_bytes())


def test_cache_encodes_only_misses(spark):
    cache = scratch_path(spark, "cache")
    path = f"{cache}/{token_counts.version(token_counts.tokenizer_bytes())}"
    docs = docs_of(spark, ["one text", "two texts", "one text", None, ""])
    assert token_counts.count_tokens(docs, cache).count() == 5
    assert spark.read.parquet(path).count() == 3
    more = docs_of(spark, ["two texts", "third"])
    assert [r["n_tokens"] for r in token_counts.count_tokens(more, cache).orderBy("doc_id").collect()] == library_counts(["two texts", "third"])
    assert spark.read.parquet(path).count() == 4
    # a stored count is used, not made anew
    planted = scratch_path(spark, "cache")
    digest = hashlib.sha256(b"planted").digest()
    spark.createDataFrame([(bytearray(digest), 99)], "digest binary, n_tokens long").write.parquet(f"{planted}/{path.rsplit('/', 1)[1]}")
    assert token_counts.count_tokens(docs_of(spark, ["planted"]), planted).first()["n_tokens"] == 99
    assert token_counts.count_tokens(empty_docs(spark), cache).count() == 0


def test_whole_texts_where_words_are_not_apart(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    name = "byte_bpe_50k.json"
    assert not token_counts.splits_at_space(token_counts.tokenizer_bytes(name))
    texts = ["two words", " lead", "a  b\n\nc", "<|endoftext|> x", LONG[:5000]]
    t = Tokenizer.from_file(public_tokenizers.path(name))
    want = [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
    got = token_counts.count_tokens(docs_of(spark, texts), scratch_path(spark, "cache"), name).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == want


# -- chat formatting ----------------------------------------------------------
CHAT = "conv_id long, turn long, role string, text string"


def chats_of(spark, rows):
    df = spark.createDataFrame(rows, CHAT)
    parts = chat_format.text_part(F.col("text"))
    return chat_format.format_chats(df.select("conv_id", "turn", "role", parts.alias("parts")))


NASTY = [
    "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|x", "<", "|", "<|", "\\", "<|im_start|>", "", None, "a<|b\\<|c", "\n", "<|image:0|>",
    "é<|中|>\U0001f600",
]


def test_chat_round_trip(spark):
    rows = [(c, t, r, x) for c, r in enumerate(["user", "assistant", "sys\ntem<|", None, "a\\nb"]) for t, x in enumerate(NASTY)]
    for r in chats_of(spark, rows).collect():
        own = [(role or "", text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert chat_format.parse(r["formatted"]) == own
        spans = [chat_format.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]]
        assert spans == [t for role, t in own if role == "assistant"]
        assert r["n_turns"] == len(own) and r["formatted"].count("<|im_end|>") == len(own)


def test_chat_digests_and_edges(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (None, None, None, None),
            (2, 1, "assistant", "x" * 200_000)]
    got = {r["conv_id"]: r for r in chat_format.read_back(chats_of(spark, rows)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"abb").hexdigest() and got[1]["loss_chars"] == 3
    assert got[None]["n_turns"] == 1 and got[None]["loss_chars"] == 0
    assert got[2]["loss_chars"] == 200_000
    assert chat_format.read_back(chats_of(spark, [])).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see <", None, None), ("text", "|this|>", None, None), ("image", None, "img/1", 4), ("document", None, "d/2", None),
             ("odd", "kept", None, None), ("audio", None, "a/3", 10), (None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("image", None, "img/9", 0)]), (1, 2, "user", None)],
                               "conv_id long, turn long, role string, parts array<struct<type: string, text: string, ref: string, units: int>>")
    r = chat_format.format_chats(df).first()
    turns = chat_format.parse(r["formatted"])
    assert turns[0] == ("user", "see <|this|><|image:0|><|document:1|>kept<|audio:2|>") and turns[2] == ("user", "")
    assert "see <\\|this|><|image:0|>" in r["formatted"]
    assert [(a["turn"], a["place"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (1, 0, "image", "img/1", 1024), (1, 1, "document", "d/2", 600), (1, 2, "audio", "a/3", 250), (2, 0, "image", "img/9", 256)]
    assert r["attachment_tokens"] == 2130
