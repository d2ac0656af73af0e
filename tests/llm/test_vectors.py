"""Whitening, permutation index, hard negatives."""

import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkline.llm import hard_negatives, perm_index, whitening
from perkline.llm.queries import QUERIES, TWINS
from perkline.llm.vectors import best

from .data import SF

NAN, INF = float("nan"), float("inf")
EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def edge_vectors(spark, more=()):
    """NULLs everywhere, NaN, infinities, other lengths, zero, huge entries,
    repeated rows, ties, and extra columns with names the operators use."""
    rows = [
        (None, [0.5, 0.25, -0.5], 1),
        (0, [0.5, 0.25, -0.5], 1),
        (0, [0.5, 0.25, -0.5], 1),
        (20, None, 1),
        (40, [0.5, None, 1.0], 2),
        (60, [NAN, 0.0, 1.0], 2),
        (80, [INF, 0.0, 1.0], 2),
        (100, [1.0, 0.5, 0.25], 2),
        (101, [0.0, 0.0, 0.0], 1),
        (102, [], 1),
        (103, [1.0, 2.0], 1),
        (104, [1.0, 0.5, 0.25], None),
        (105, [3e38, 1.0, 1.0], 2),
        (106, [0.25, 0.25, 0.0], 2),
        (107, [0.25, 0.25, 0.0], 1),
        (108, [0.25, 0.25, 0.0], 2),
        *more,
    ]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    clash = ["id", "x", "vector", "query", "perm", "first", "score", "rank", "anchor", "n", "slot", "value", "component"]
    return df.withColumns({c: F.lit("mine") for c in clash})


def random_rows(seed, n, dim, labels=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(5, dim))
    x = centres[rnd.integers(5, size=n)] + rnd.normal(size=(n, dim)) * rnd.choice([0.001, 0.3, 1.0], size=(n, 1))
    x[n // 2 : n // 2 + n // 10] = x[0]
    return [(int(i), [float(v) for v in r], int(rnd.integers(labels))) for i, r in enumerate(x.astype(np.float32))]


def usable(rows, zero=True):
    return [
        (i, np.array(v, dtype=np.float32).astype(float), k)
        for i, v, k in rows
        if v is not None and len(v) == 3 and None not in v and np.isfinite(v).all() and (zero or any(v))
    ]


# -- whitening ----------------------------------------------------------------
def test_whiten_by_brute_force(spark):
    rows = random_rows(3, 400, 20)
    df = spark.createDataFrame(rows, EMBEDDINGS).repartition(5)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(df, whitening.fit(df)).collect()}
    x = np.array([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in r[1]] for r in rows], dtype=np.int64)
    list_ = np.unique(x, axis=0)
    n, s = len(list_), list_.sum(axis=0)
    d = (list_ - 1_000_000) - (list_ - 1_000_000).mean(axis=0)
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    want = (x - s / n) @ u / np.sqrt(e)
    mine = np.array([[got[i, c + 1].whitened for c in range(16)] for i in range(len(rows))])
    assert len(got) == 16 * len(rows)
    assert np.abs(mine - want * np.sign((mine * want).sum(axis=0))).max() < 1e-8
    for i in range(len(rows)):
        r = got[i, 1]
        assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
    whole = np.trace(d.T @ d / n)
    assert all(abs(got[0, c + 1].explained / (e[c] / whole) - 1) < 1e-9 for c in range(16))
    assert got[0, 1].identity_error < 1e-9


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 1], [1, 1 - 1e-9, 1 - 2e-9, 1e-6, 1e-6], [1e6, 3, 3 + 1e-12, 2, 1e-3]])
def test_eigen_of_clusters(values):
    """Close and equal eigenvalues: an orthonormal basis that diagonalises,
    and the separable ones' vectors to full precision."""
    rnd = np.random.default_rng(7)
    q, _ = np.linalg.qr(rnd.normal(size=(5, 5)))
    q = q.astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(5) - 0.5 * (q.T @ q))
    v = (q * np.array(values, dtype=np.longdouble)) @ q.T
    e, x = whitening.eigen((v + v.T) / 2)
    size = max(values)
    assert np.abs(np.sort(e) - np.sort(np.array(values, dtype=np.longdouble))).max() < 1e-17 * size * 10
    assert np.abs(x.T @ x - np.eye(5)).max() < 1e-17
    s = x.T @ v @ x
    assert np.abs(s - np.diag(np.diag(s))).max() < 1e-17 * size * 10
    for i, value in enumerate(values):
        if min(abs(value - w) for j, w in enumerate(values) if j != i) >= 1e-9 * size:
            j = np.abs(np.asarray(e - value, dtype=float)).argmin()
            assert abs(abs(float(q[:, i] @ x[:, j])) - 1) < 1e-15


@given(st.integers(-(10**40), 10**40), st.integers(1, 10**30))
def test_ratio(a, b):
    from fractions import Fraction

    got = whitening.ratio(a, b)
    hi = float(got)
    whole = Fraction(hi) + Fraction(float(got - np.longdouble(hi)))
    assert abs(whole - Fraction(a, b)) <= abs(Fraction(a, b)) / 2**60


def test_whiten_edges(spark):
    df = edge_vectors(spark)
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    ids = [i for i, v, _ in usable([(r.vec_id, r.embedding, r.label) for r in df.collect()]) if i != 105]
    assert sorted((str(r.vec_id) for r in got)) == sorted(str(i) for i in ids for _ in range(len(model.values)))
    assert model.n == 4 and 1 <= len(model.values) <= 3
    big = spark.createDataFrame([(i, [i * 1e13, 1.0 * i * i, -(3.0**i)], 0) for i in range(6)], "vec_id long, embedding array<double>, label int")
    far = whitening.whiten(big, whitening.fit(big)).collect()
    # two of the three eigenvalues are below the working precision of the trace
    assert len(far) == 6 and far[0].identity_error < 1e-4 and any(r.deviation is None for r in far)
    for none in (df.limit(0), df.where("vec_id = 20"), df.where("vec_id = 100"), df.where("vec_id = 0")):
        assert whitening.whiten(none, whitening.fit(none)).collect() == []


# -- permutation index --------------------------------------------------------
def brute_nearest(rows, k, query):
    """Best score of each id for each query id."""
    out = {}
    for q in {i for i, *_ in rows if i is not None and query(i)}:
        score = {}
        for i, v, _ in rows:
            if i != q:
                s = max(float((v * w).sum()) for j, w, _ in rows if j == q)
                score[i] = max(s, score.get(i, -INF))
        order = sorted(score.items(), key=lambda p: (-p[1], p[0] is None, p[0] or 0))[:k]
        out[q] = order
    return out


@pytest.mark.parametrize("seed", range(2))
def test_nearest_recall(spark, seed):
    rows = random_rows(seed, 1500, 24)
    df = spark.createDataFrame(rows, EMBEDDINGS).repartition(4)
    got = perm_index.nearest(df, F.col("vec_id") % 20 == 0).collect()
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
        assert abs(r.score - float((x[r.query_id] * x[r.vec_id]).sum())) < 1e-12
    hits = 0
    for q in range(0, len(rows), 20):
        s = x @ x[q]
        s[q] = -INF
        want = set(np.lexsort((np.arange(len(s)), -s))[:20].tolist())
        mine = [found[q][k] for k in range(1, 21)]
        hits += len(want & {i for i, _ in mine})
        assert [(-s, i) for i, s in mine] == sorted((-s, i) for i, s in mine)
    assert hits >= 0.93 * len(got)


def test_posting_is_the_footrule():
    rnd = np.random.default_rng(5)
    perm = np.argsort(rnd.random((60, 16)), axis=1)[:, :8].astype(np.uint16)
    asked = np.argsort(rnd.random(16))[:6]
    most = perm_index.farthest(8, 6)
    got = perm_index.Posting(perm, 16, 6).distances(asked, most)
    for row, d in zip(perm.tolist(), got, strict=True):
        assert d == sum(abs(k - (row.index(p) if p in row else 8)) for k, p in enumerate(asked.tolist()))


def test_nearest_edges(spark):
    df = edge_vectors(spark)
    got = perm_index.nearest(df, F.col("vec_id") % 20 == 0, k=4).collect()
    rows = usable([(r.vec_id, r.embedding, r.label) for r in df.collect()], zero=False)
    want = brute_nearest(rows, 4, lambda i: i % 20 == 0)
    assert {q: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in want} == want
    assert len(got) == sum(map(len, want.values()))
    for none in (df.limit(0), df.where("vec_id IN (20, 40, 60, 101, 102)"), df.where("vec_id = 0"), df.where("vec_id = 107")):
        assert perm_index.nearest(none, F.col("vec_id") % 20 == 0).collect() == []


def test_runs_of_queries(spark, monkeypatch):
    rows = random_rows(4, 600, 8)
    df = spark.createDataFrame(rows, EMBEDDINGS)
    one = sorted(perm_index.nearest(df, F.col("vec_id") % 20 == 0).collect())
    monkeypatch.setattr(perm_index, "QUERY_BYTES", 64 * 10)
    assert sorted(perm_index.nearest(df, F.col("vec_id") % 20 == 0).collect()) == one


# -- hard negatives -----------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 9), st.sampled_from([1, 3, 300, 2**20, 2**28, 2**52]))
def test_packed_products(seed, n, dim, most):
    rnd = random.Random(seed)
    rows = [[rnd.randint(-most, most) for _ in range(dim)] for _ in range(n)]
    anchor = [rnd.randint(-most, most) for _ in range(dim)]
    want = [sum(a * b for a, b in zip(anchor, r)) for r in rows]
    block = hard_negatives.Packed(np.array(rows, dtype=np.int64), max(map(abs, anchor)), fields=16)
    if max(map(abs, want)) < 2**63:
        assert block.scores(anchor).tolist() == want
    else:
        with pytest.raises(OverflowError):
            block.scores(anchor)


def brute_mine(rows, anchor, scale=256, k=5):
    """Rows as lists of whole numbers, in plain Python."""
    rows = [(i, [int(np.floor(scale * float(c))) for c in v], y) for i, v, y in rows if y is not None]
    out = []
    for a in sorted({i for i, *_ in rows if i is not None and anchor(i)}):
        _, av, ay = min((r for r in rows if r[0] == a), key=lambda r: (str(r[2]), np.array(r[1], dtype="<i8").tobytes()))
        best_ = [{}, {}]
        for i, v, y in rows:
            if i != a:
                s = sum(p * q for p, q in zip(av, v))
                side = best_[y == ay]
                side[i] = max(s, side.get(i, s))
        order = [sorted(d.items(), key=lambda p: (-p[1], p[0] is None, p[0] or 0)) for d in best_]
        for p, ps in order[1][:k]:
            hits = [(i, s) for i, s in order[0] if 80 * ps <= 100 * s <= 100 * ps][:k]
            out += [(a, p, r, i, ps, s) for r, (i, s) in enumerate(hits, 1)]
    return sorted(out, key=str)


def test_mine_by_brute_force(spark, monkeypatch):
    rows = random_rows(11, 700, 6, labels=4)
    df = spark.createDataFrame(rows, EMBEDDINGS).repartition(3)
    want = brute_mine(rows, lambda i: i % 50 == 0)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label"))
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == want and want
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 8 * 6 * 3)
    again = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label"))
    assert sorted(map(tuple, again.select(*names).collect()), key=str) == want


def test_mine_edges(spark):
    df = edge_vectors(spark)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, F.col("label")).select(*names)
    rows = [r for r in usable([(r.vec_id, r.embedding, r.label) for r in df.collect()]) if r[0] != 105]
    assert sorted(map(tuple, got.collect()), key=str) == brute_mine(rows, lambda i: i % 100 == 0)
    for none in (df.limit(0), df.where("vec_id IN (20, 40, 104)"), df.where("vec_id = 100"), df.where("vec_id = 107")):
        assert hard_negatives.mine(none, F.col("vec_id") % 100 == 0, F.col("label")).collect() == []


def test_twin(spark):
    got = QUERIES["op13_hard_negatives"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(TWINS["op13_hard_negatives"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_best():
    ids, score = np.array([5, 3, 3, 9, 1]), np.array([2.0, 2.0, 7.0, 1.0, 2.0])
    assert ids[best(ids, score, 3)].tolist() == [3, 1, 5]
    many = np.repeat(np.arange(10), 50)
    assert many[best(many, np.repeat(np.arange(10.0), 50), 4)].tolist() == [9, 8, 7, 6]
