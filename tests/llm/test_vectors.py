"""Whitening and hard negatives against plain numpy and Python."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmap.llm import hard_negatives as hn
from reachmap.llm import whitening as wh
from reachmap.llm.vectors import scaled, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, x string, row string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def odd_vectors():
    return [
        (900, None, 1), (901, [1.0, None, 0.5, 0.0], 1), (902, [1.0, math.nan, 0.5, 0.0], 2), (903, [math.inf, 0.0, 0.0, 0.0], 2),
        (904, [1.0, 2.0], 3), (905, [], 3), (None, [0.5, 0.25, 0.125, 0.0], 1), (906, [0.5, 0.25, 0.125, 0.0], None),
    ]


def random_rows(n, d, seed, labels=3, copies=4):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d)).astype(np.float32) * np.linspace(2, 0.5, d, dtype=np.float32)
    return [(i, [float(c) for c in v[i // copies if i < n // 3 else i]], int(r.integers(labels))) for i in range(n)]


def whole(rows):
    good = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    return [r for r in good if len(r[1]) == 4]


# Whitening


@pytest.mark.parametrize("seed", range(4))
def test_inertia_counts_and_eigenvectors_equal_numpy(seed):
    r = np.random.default_rng(seed)
    a = r.normal(size=(40, 24))
    v = a.T @ a / 40
    e = np.linalg.eigvalsh(v)[::-1]
    for s in np.r_[e + 1e-9, e - 1e-9, -1.0, 0.5]:
        assert wh.below(v, s) == (e < s).sum()
    indefinite = v - v.mean() * 30 * np.eye(24)[::-1]
    indefinite = (indefinite + indefinite.T) / 2
    for s in (-3.0, 0.0, 0.7):
        assert wh.below(indefinite, s) == (np.linalg.eigvalsh(indefinite) < s).sum()
    values, vectors = wh.leading(v, 16)
    assert np.allclose(values, e[:16], rtol=1e-13)
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12
    assert np.abs(vectors @ vectors.T - np.eye(16)).max() < 1e-12


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [3, 3 - 1e-10, 3 - 2e-10, 1, 0, 0], [1, 0, 0], [7], [4, 4, 4, 4], [0, 0]])
def test_equal_close_and_zero_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values),) * 2))[0]
    v = (q * values) @ q.T
    got, vectors = wh.leading((v + v.T) / 2, 16)
    want = [x for x in values if x > 0]
    assert np.allclose(got, want, rtol=1e-12)
    assert np.abs(vectors @ vectors.T - np.eye(len(want))).max(initial=0) < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * got).max(initial=0) < 1e-11


def whitened(spark, rows, most=16):
    df = whole_vectors(table(spark, rows)).select("vec_id", scaled(F.col("embedding"), wh.FACTOR, wh.BASE).alias("x"))
    return wh.whiten(df, wh.fit(df, most))


def test_whitening_equals_numpy_with_exact_deviations(spark):
    rows = random_rows(400, 4, 1) + [(7, *r[1:]) for r in random_rows(1, 4, 1)] + odd_vectors()
    x = {(r[0], k): [math.floor(64 * c) + 1_000_000 for c in r[1]] for k, r in enumerate(whole(rows))}
    once = sorted(set(map(tuple, x.values())))
    n, s = len(once), [sum(c) for c in zip(*once)]
    centred = np.array([[n * c - t for c, t in zip(v, s)] for v in once], dtype=object)
    v = np.array((centred.T @ centred) / n**3, dtype=float)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u.T[::-1]
    got = whitened(spark, rows).collect()
    assert len(got) == 4 * len(x) and {r["n"] for r in got} == {n}
    assert {r["identity_error"] < 1e-9 for r in got} == {True}
    signs, seen = {}, {}
    for r in got:
        seen.setdefault(r["vec_id"], []).append(r)
    for (i, _), vec in x.items():
        d = [n * c - t for c, t in zip(vec, s)]
        mine = [r for r in seen[i] if r["deviation"] == sum(c * c for c in d)]
        assert len(mine) >= 4
        for r in mine:
            k = r["component"] - 1
            want = float(np.dot([c / n for c in d], u[k]) / math.sqrt(e[k]))
            if abs(want) > 1e-6:
                assert signs.setdefault(k, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
            assert abs(r["whitened"]) == pytest.approx(abs(want), abs=1e-9)
            assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-12)


def test_whitening_of_nothing_of_copies_and_of_huge_entries(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], odd_vectors()[:4], [(i, [1.0, 2.0], 0) for i in range(5)]):
        got = whitened(spark, rows)
        assert got.columns == columns and got.count() == 0
    got = whitened(spark, [(1, [1e30, 0.0], 0), (2, [-1e30, 1.0], 0), (3, [0.0, 5.0], 0)]).collect()
    assert {(r["vec_id"], r["component"]) for r in got} >= {(1, 1), (2, 1), (3, 1)}
    assert {r["deviation"] is None for r in got if r["vec_id"] == 1} == {True}


# Hard negatives


def brute(rows, anchor=50, positives=5, negatives=3, dims=4):
    once = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or len(v) != dims or not all(c is not None and math.isfinite(c) for c in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        once[i] = min(once.get(i, (math.inf,)), (label, tuple(math.floor(256 * c) for c in v)))
    out = []
    for a, (label, q) in once.items():
        if a % anchor:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), i) for i, (_, v) in once.items() if i != a)
        for p, pid in [s for s in scores if once[s[1]][0] == label][:positives]:
            fit = [(s, i) for s, i in scores if once[i][0] != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, tmp_path):
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    df = hn.op13_hard_negatives(spark, str(tmp_path))
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_mining_equals_brute_force(spark, tmp_path, monkeypatch):
    for name, value in (("BLOCK", (50, 90)), ("CHUNK", (2, 3))):
        monkeypatch.setattr(hn, name, value)
    rows = random_rows(600, 4, 2, labels=2) + odd_vectors() + [(50, [1.0, 1.0, 1.0, 1.0], 1)]
    got = mined(spark, rows, tmp_path)
    assert got == brute(rows) and len(got) > 50


@pytest.mark.parametrize("rows", [[], odd_vectors(), [(i, [1.0, 2.0, 0.0, 0.5], 1) for i in range(3)], [(i, [1.0, 0.0, 0.0, 0.5], i % 2) for i in range(101)]])
def test_mining_of_nothing_and_of_ties(spark, tmp_path, rows):
    assert mined(spark, rows, tmp_path) == brute(rows)


def test_mining_of_huge_entries(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = [(i, [float(c) for c in (r.normal(size=4) * 1e6).astype(np.float32)], int(i % 3)) for i in range(120)]
    assert mined(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n,d,seed", [(1, 3, 0), (300, 3, 1), (2000, 6, 2), (700, 1, 3)])
def test_tree_holds_every_row_once_and_boxes_bound_their_rows(n, d, seed):
    r = np.random.default_rng(seed)
    m, labels = r.integers(-50, 50, size=(n, d)), r.integers(0, 4, size=n)
    tree = hn.Tree(np.arange(n), labels, m, leaf=16)
    assert sorted(tree.ids) == list(range(n))
    assert [a for a, _ in tree.spans] + [n] == [0] + [b for _, b in tree.spans]
    for (a, b), low, high in zip(tree.spans, tree.low, tree.high):
        assert b - a <= 16 and len(set(tree.labels[a:b])) == 1
        assert (tree.rows[a:b] >= low).all() and (tree.rows[a:b] <= high).all()
    for node, kids in enumerate(tree.children):
        if kids is not None:
            assert (tree.low[kids] >= tree.low[node]).all() and (tree.high[kids] <= tree.high[node]).all()


def test_boxes_prune_where_space_is_low_dimensional():
    r = np.random.default_rng(0)
    m, labels = r.integers(-500, 500, size=(20_000, 2)), r.integers(0, 2, size=20_000)
    tree = hn.Tree(np.arange(20_000), labels, m)
    boxes = tree.prepared(500)
    looked = []

    class Counting(hn.Best):
        def add(self, scores, ids):
            looked.append(len(scores))
            super().add(scores, ids)

    for q, label in itertools.product(([300.0, 100.0], [-20.0, 400.0]), (0, 1)):
        w = hn.search(tree, boxes, np.array(q), label, True, [Counting(5)])[0]
        s = m @ np.array(q)
        want = sorted((-s[i], i) for i in np.flatnonzero(labels == label))[:5]
        assert [(int(x), i) for x, i in want] == [(-x, i) for x, i in w.kept]
    assert sum(looked) < 0.1 * 4 * len(m)
