"""Near duplicates, components, HTML extraction, mixing."""

import collections
import math
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkline.llm import html_extract, mixing, ngram_join
from perkline.llm.components import components
from perkline.llm.queries import QUERIES

from .data import DOCS, LONG, SF, WORD, docs_of, edge_docs, empty_docs, lower


# -- near duplicates ----------------------------------------------------------
def brute_set(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute_classes(texts, percent=85):
    sets = [brute_set(t) for t in texts]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


def family(rnd, size, copies, changes):
    base = [f"v{rnd.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randint(0, changes)):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**6)}"
        if rnd.random() < 0.3:
            w = w[rnd.randrange(3) :] + [f"t{rnd.randrange(100)}"] * rnd.randrange(3)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_classes_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    texts = []
    for size, copies, changes in ((8, 12, 1), (12, 15, 1), (30, 20, 2), (60, 25, 3), (120, 25, 6), (400, 20, 20), (5, 6, 1)):
        texts += family(rnd, size, copies, changes)
    texts += ["a b c", "A  b\nc", "a b", "x", "x", "", None, "   "]
    rnd.shuffle(texts)
    got = sorted(map(tuple, ngram_join.classes(docs_of(spark, texts)).collect()))
    assert got == brute_classes(texts)


def test_a_passage_in_all_documents_links_nothing(spark):
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"u{rnd.randrange(10**9)}" for _ in range(60)) for _ in range(200)]
    got = ngram_join.classes(docs_of(spark, texts)).collect()
    assert all(r["doc_id"] == r["component_id"] for r in got)


def test_large_blocks_are_dealt_as_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rnd = random.Random(7)
    texts = family(rnd, 100, 60, 9) + family(rnd, 60, 40, 6)
    got = sorted(map(tuple, ngram_join.classes(docs_of(spark, texts)).collect()))
    assert got == brute_classes(texts)


@settings(max_examples=200, deadline=None)
@given(st.integers(6, 400), st.integers(0, 10**6))
def test_linked_sets_share_a_key(size, seed):
    rnd = np.random.default_rng(seed)
    levels = ngram_join.Levels(85, 1 << 20)
    union = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
    apart = rnd.choice(len(union), rnd.integers(0, 15 * len(union) // 100 + 1), replace=False)
    side = rnd.random(len(apart)) < rnd.choice([0.0, 0.5, 1.0])
    a, b = np.delete(union, apart[side]), np.delete(union, apart[~side])
    both = len(union) - len(apart)
    assert 100 * both >= 85 * len(union)
    if len(apart):
        assert len(np.intersect1d(levels.keys(a), levels.keys(b)))


def test_tree_finds_all_that_may_link():
    rnd = np.random.default_rng(3)
    base = rnd.poisson(4, (12, ngram_join.GROUPS))
    vectors = np.maximum(0, np.repeat(base, 12, axis=0) + rnd.integers(-1, 2, (144, ngram_join.GROUPS)) * (rnd.random((144, ngram_join.GROUPS)) < 0.2))
    comp = np.repeat(np.arange(72), 2)
    tree = ngram_join.CountTree(vectors, comp, 85)
    q, m = tree.search(vectors, comp)
    size = vectors.sum(axis=1)
    want = {
        (i, j)
        for i in range(144)
        for j in range(144)
        if comp[i] != comp[j] and 185 * np.minimum(vectors[i], vectors[j]).sum() >= 85 * (size[i] + size[j])
        and 100 * min(size[i], size[j]) >= 85 * max(size[i], size[j])
    }
    assert set(zip(q.tolist(), m.tolist(), strict=True)) == want and len(want) > 100


def test_join_edges_and_keep_one(spark):
    docs = edge_docs(spark)
    got = collections.Counter(tuple(r) for r in ngram_join.classes(docs).collect())
    assert got[(4, 4, 4)] == 2 and got[(None, 4, 4)] == 1 and got[(1, 0, 1)] == 1 and got[(7, 1, 7)] == 1 and got[(None, 0, None)] == 1
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    assert ids == collections.Counter([1, 2, 3, 4, None, 5, 6, 7])
    assert ngram_join.classes(empty_docs(spark)).count() == 0 and ngram_join.keep_one(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components_by_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 540)] + [(700, i) for i in range(600, 700)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    want = {x: top(x) for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, got)) == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- HTML ---------------------------------------------------------------------
def texts_of(spark, rows, **k):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_extract.extract(df, **k).collect()}


def test_mark_up_that_is_no_article(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><nav><ul><li>Menu</li></ul></nav></header><!-- note <p>x</p> --><div class="cookie-notice">We use cookies</div>
    <div id="ad-1">Buy</div><aside>Side</aside><main><article><header><h1>Head &amp; line</h1></header>
    <p>One<br>two <b>bold</b>&nbsp;end<p>Three &lt;tag&gt; &#233;<script>var t="</p>";</script>
    <ul><li>first<li>second</ul><table><tr><td>a</td><td>b</td></tr></table>
    <form><label>Name</label><input></form><section class="comments"><p>first!</p></section></article></main>
    <footer>&copy; us</footer></body></html>"""
    got = texts_of(spark, [(1, "http://h.com/a", page)])[1]
    assert got == "Head & line\n\nOne two bold end\n\nThree <tag> é\n\nfirst\n\nsecond\n\na\n\nb"


def test_names_that_are_no_article_words_keep_their_text(spark):
    body = " ".join(f"w{k}" for k in range(40))
    pages = {
        '<div class="notice"><p>Long article body</p></div>': "Long article body",
        f'<article><p>{body}</p><p class="share-price">Up</p><div id="comment-on-law">Law</div></article>': f"{body}\n\nUp\n\nLaw",
        f'<article><div class="notice">{body}</div><p>End</p></article>': f"{body}\n\nEnd",
        f'<article><p>Short</p><div class="comments">{body}</div></article>': "Short",
        f'<p>Short</p><div id="comment-list">{body}</div>': "Short",
        f'<div class="ad">{body}</div><article><p>Short</p></article>': "Short",
        f'<div class="adBox2">Buy</div><div class="site-header">Site</div><p>{body}</p>': body,
        f'<main><div class="header"><h1>Title</h1></div><p>{body}</p></main>': f"Title\n\n{body}",
        f'<article class="comment">{body}</article><p>Short</p>': "Short",
        "<table><tr><td>Name</td><th>Age<td>Town</table>": "Name\n\nAge\n\nTown",
    }
    got = texts_of(spark, [(n, f"http://h{n}.com/", page) for n, page in enumerate(pages)])
    assert [got[n] for n in range(len(pages))] == list(pages.values())


@pytest.mark.parametrize("seed", range(3))
def test_counts_by_brute_force(spark, seed):
    """Blocks that recur, in boxes and as running text, beside and inside the
    main element, counted and deleted host by host in plain Python."""
    rnd = random.Random(seed)
    rows, parts = [], {}
    for i in range(150):
        host = rnd.choice(["a.com"] * 6 + ["b.com", "b.com", "c.com"])
        own = f"Own{i} " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(9))
        beside = [f"<div>Bar {k}</div>" for k in range(6) if rnd.random() < (k + 1) / 12]
        boxes = [f"<section>Box {k}</section>" for k in range(6) if rnd.random() < (k + 1) / 12]
        lines = [f"<p>Line {k}</p>" for k in range(9) if rnd.random() < (k + 1) / 12]
        parts[i] = host, beside, boxes, lines, own
        rows.append((i, f"http://{host}/{i}", f"<body>{''.join(beside)}<article><p>{own}</p>{''.join(boxes + lines)}</article></body>"))
    pages, often, sketches = collections.Counter(p[0] for p in parts.values()), collections.Counter(), collections.defaultdict(set)
    for host, beside, boxes, lines, own in parts.values():
        often.update((host, b) for b in beside + boxes + lines)
        words = " ".join([own, *(b.split(">")[1].split("<")[0] for b in boxes + lines)]).split()
        sketch = min(xxhash.xxh3_64_intdigest(" ".join(words[k : k + 4])) for k in range(len(words) - 3))
        for b in lines:
            sketches[host, b].add(sketch)

    def gone(host, block):
        n, root, texts = often[host, block], pages[host] ** 0.5, len(sketches[host, block])
        if block.startswith("<p>"):
            return texts >= max(20, 2 * root) and 2 * texts >= n
        return n >= max(5, 0.5 * root)

    got, removed = texts_of(spark, rows), 0
    for i, (host, beside, boxes, lines, own) in parts.items():
        blocks = [*beside, f"<p>{own}</p>", *boxes, *lines]
        kept = [b for b in blocks if not gone(host, b)]
        removed += len(blocks) - len(kept)
        assert got[i] == "\n\n".join(b.split(">")[1].split("<")[0] for b in kept)
    assert removed > 100


def test_site_templates_go_and_quoted_text_stays(spark):
    def page(i, article=True):
        own = f"<p>Story {i} begins</p><p>A passage that all pages quote.</p><div>Read more on our site</div>"
        body = f"<article>{own}</article>" if article else f"<div>{own}</div>"
        return f"<body><div><span>Plain site bar</span></div>{body}<div>Imprint of the site</div></body>"

    rows = [(i, "http://one.com/x", page(i)) for i in range(10)] + [(100 + i, "http://two.com/x", page(i, False)) for i in range(10)]
    rows += [(200, "http://lone.com/", page(7, False))]
    got = texts_of(spark, rows)
    for i in range(10):
        assert got[i] == f"Story {i} begins\n\nA passage that all pages quote."
        assert got[100 + i] == f"Story {i} begins"
    assert "Imprint" in got[200]


def test_counts_decide_inside_and_beside_the_article(spark):
    def page(i, tag):
        own = " ".join(f"w{i}x{k}" for k in range(30))
        return f"<body><p>Beside {i}</p><div>Bar of all pages</div><article><{tag}>Notice of the site</{tag}><p>{own}</p></article></body>"

    tags = ["p", "blockquote", "pre", "span", "h2"]
    rows = [(100 * n + i, f"http://h{n}.com/x", page(i, tag)) for n, tag in enumerate(tags) for i in range(30)]
    rows += [(1000 + i, "http://few.com/", page(i, "p")) for i in range(10)]
    for page_id, text in texts_of(spark, rows).items():
        assert "Beside" in text and "w" in text and "Bar" not in text
        assert ("Notice" in text) == (page_id >= 1000)


def test_a_hot_host_needs_no_share_of_its_pages(spark):
    rows = [(i, "http://h.com/", f"<div><p>Own {i}</p></div>" + "<div>Section menu</div>" * (i < 12)) for i in range(400)]
    rows += [(1000 + i, "http://h.com/", f"<div><p>More {i}</p></div>" + "<div>Quoted</div>" * (i < 8)) for i in range(20)]
    got = texts_of(spark, rows)
    assert got[3] == "Own 3" and got[1003] == "More 3\n\nQuoted"


def test_near_copies_of_an_article_stay(spark):
    body = "".join(f"<p>{' '.join(f'w{n}x{k}' for k in range(20))}</p>" for n in range(12))
    rows = [(i, "http://h.com/", f"<article><h1>Title {i}</h1>{body}</article>") for i in range(60)]
    for i, text in texts_of(spark, rows).items():
        assert text.count("w") == 240 and f"Title {i}" in text


def test_equal_pages_count_once(spark):
    html = "<body><div><p>All of it</p></div></body>"
    assert texts_of(spark, [(i, "http://a.com/", html) for i in range(20)])[3] == "All of it"


def test_html_edges(spark):
    rows = [(1, None, None), (2, "", ""), (None, "x", "plain"), (4, "http://a/", "<p>a<p>b"), (5, "http://a/", "<!-- open <p>x"),
            (6, "http://a/", "a < b <3 <"), (7, "http://a/", "<p>" + LONG + "</p>"), (8, "http://a/", '<a href="x>y</a><p>z'),
            (9, "http://a/", "<script>never closed <p>x"), (10, "http://a/", "<div>" * 3000 + "deep"), (10, "http://a/", "</p></div>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = collections.defaultdict(list)
    for r in html_extract.extract(df).collect():
        got[r["page_id"]].append(r["text"])
    assert got[1] == [""] and got[2] == [""] and got[None] == ["plain"] and got[4] == ["a\n\nb"] and got[5] == [""]
    assert got[6] == ["a < b <3 <"] and got[7] == [LONG] and got[9] == [""] and sorted(got[10]) == ["deep", "x"]
    assert len(got[8]) == 1
    assert html_extract.extract(df.limit(0)).count() == 0


def test_pages_of_the_test_data(spark):
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op9_html_extract"](spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]*>", " ", article)
        import html

        assert r["text"].split() == html.unescape(plain).split() and r["n_chars"] == len(r["text"])


# -- mixing -------------------------------------------------------------------
def brute_targets(sizes, weights=(5, 2, 1), passes=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > passes * sizes[s]]
        if not over:
            return {**share, **capped}
        for s in over:
            capped[s] = passes * sizes[s]
        left = sum(sizes.values()) - sum(capped.values())


def check_mix(spark, docs, near=0.03):
    rows = mixing.mix(docs).collect()
    size = collections.Counter()
    for r in docs.collect():
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    target, taken = brute_targets(size), collections.Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= near * t + 3, (s, taken[s], t)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))
    return rows


def brute_schedule(sources, n_slots, passes=3):
    """Slot by slot; ``sources`` in order, with their stretches."""
    rank, out = collections.Counter(), []
    for k in range(n_slots):
        at = (k * mixing.GOLDEN) % 1.0 * n_slots
        for s in sources:
            if s["lo"] <= at < s["hi"]:
                r, rank[s["src"]] = rank[s["src"]], rank[s["src"]] + 1
                if r < passes * s["blocks"]:
                    out.append((k, s["src"], r, r % s["blocks"]))
                break
    return out


@pytest.mark.parametrize("seed", range(2))
def test_schedule_and_taken_by_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_SLOTS", 64)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rnd = random.Random(seed)
    kinds = ["big"] * 12 + ["mid"] * 4 + ["small", None, "é"] + [f"s{k}" for k in range(30)]
    rows = [(i, "w " * rnd.choice([0, 1, 3, 30, 120]), "en", rnd.choice(kinds), 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    sized = docs.select("doc_id", "source", mixing.size_of(docs["text"]).alias("size"), F.xxhash64("doc_id", "text").alias("order"))
    sources = mixing.blocks_of(mixing.targets(sized), 64, 16)
    of = sorted(sources.collect(), key=lambda s: s["src"])
    n_slots = math.ceil(sum(s["slots"] for s in of))
    assert n_slots > 300
    want = brute_schedule([s for s in of if s["slots"] > 0], n_slots)
    got = mixing.schedule(sources, n_slots)
    assert sorted(map(tuple, got.collect())) == want
    # words of the shuffled documents, block by block
    times, taken = collections.Counter((s, b) for _, s, _, b in want), collections.Counter()
    buckets = max(1, len(rows) // 16)
    ordered = sorted(sized.collect(), key=lambda d: ((d["order"] >> 8) % buckets, d["order"], d["doc_id"], d["size"]))
    for s in of:
        at = 0
        for d in (d for d in ordered if d["source"] == s["source"]):
            taken[d["doc_id"]] = sum(times[s["src"], w * s["blocks"] // s["source_size"]] for w in range(at, at + d["size"]))
            at += d["size"]
    mixed = mixing.mix(docs, block_words=64, min_blocks=16)
    assert {r["doc_id"]: r["taken"] for r in mixed.collect()} == {i: taken[i] for i in range(len(rows))}


def test_no_table_of_slots_is_broadcast(spark):
    sources = spark.createDataFrame([(0, 10**7, 0.0, 1.5e7, 1.5e7), (1, 10**6, 1.5e7, 2e7, 5e6)], "src long, blocks long, lo double, hi double, slots double")
    plan = mixing.schedule(sources, 20_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Cartesian" not in plan


def test_mix_of_the_test_data(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(check_mix(spark, docs)) == docs.count()


def test_mix_with_caps_and_ties(spark):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randrange(200), "en", rnd.choice(["big"] * 20 + ["mid"] * 3 + ["small", None, "é"]), 0) for i in range(800)]
    rows += [(5000, "one two", "en", "tiny", 0), (5001, "x", "en", "one", 0), (5002, None, "en", "none", 0)] + [(6000, "same row", "en", "big", 0)] * 5
    check_mix(spark, spark.createDataFrame(rows, DOCS))


def test_mix_edges(spark):
    assert len(check_mix(spark, edge_docs(spark), near=0.05)) == 10
    assert mixing.mix(empty_docs(spark)).count() == 0
    only = mixing.mix(docs_of(spark, [None, ""])).collect()
    assert [r["taken"] for r in only] == [0, 0]


@pytest.mark.parametrize("seed", range(2))
def test_forest_roots(spark, seed):
    from perkline.llm.components import forest_roots

    rnd = random.Random(seed)
    parent = {i: rnd.randrange(i + 1, min(i + 4, 121)) for i in range(120) if rnd.random() < 0.9}
    parent |= {1000 + i: 1001 + i for i in range(40)}
    got = dict(map(tuple, forest_roots(spark.createDataFrame(list(parent.items()), "a long, b long")).collect()))

    def top(x):
        while x in parent:
            x = parent[x]
        return x

    assert got == {x: top(x) for x in {*parent, *parent.values()}}
    assert forest_roots(spark.createDataFrame([], "a long, b long")).count() == 0
