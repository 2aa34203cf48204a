"""Operators 11 and 12 against brute force in whole numbers and doubles."""

import hashlib
import math

import numpy as np
import pytest

from holdfast.llm import compression, whitening

NAN, INF = float("nan"), float("inf")
#: Rows that take no part: null, null or non-finite components, another length, no components.
JUNK = [(7, None), (8, [1.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]), (9, [NAN] * 8), (10, [INF] * 8), (11, [1.0] * 3), (12, [])]


def frame(spark, rows, kind="float"):
    """Rows (id, vector, label) beside columns whose names clash with those of the results."""
    schema = f"vec_id long, embedding array<{kind}>, label int, code string, error string, component string, x int"
    return spark.createDataFrame([(i, v, label, "a", "b", "c", 1) for i, v, label in rows], schema).repartition(3)


def singles(a):
    return [[float(np.float32(x)) for x in v] for v in a.tolist()]


def codes_by_hand(rows, entries, parts=4, rounds=4):
    x = np.array([[math.floor(1024 * c) for c in v] for _, v, _ in rows], object)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    codes, error, books = [], np.zeros(len(rows), object), []
    for part in np.array_split(np.arange(x.shape[1]), parts):
        p = x[:, part]
        book = p[order[:entries]].copy()
        own = lambda: np.array([int(np.argmin(((book - v) ** 2).sum(axis=1))) for v in p])  # noqa: B023, E731
        for _ in range(rounds):
            now = own()
            for e in set(now.tolist()):
                mine = p[now == e]
                book[e] = [int(v) // len(mine) for v in mine.sum(axis=0)]
        codes.append(own())
        error = error + ((p - book[codes[-1]]) ** 2).sum(axis=1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    by_label = {}
    for (_, _, label), e in zip(rows, error.tolist(), strict=True):
        by_label[label] = by_label.get(label, 0) + e
    cap = lambda e: min(int(e), 2**63 - 1)
    return sorted(((i, "".join(f"{c[k]:02x}" for c in codes), cap(error[k]), label, cap(by_label[label]), digest) for k, (i, _, label) in enumerate(rows)), key=str)


def vectors_of(kind, n, rng):
    if kind == "noise":
        return singles(rng.normal(size=(n, 8)) * 0.3)
    if kind == "ties":
        return singles(rng.integers(-2, 3, size=(n, 8)) / 4)
    return singles(np.round(rng.normal(size=(n, 6)) * 0.02, 3) + np.arange(n)[:, None] % 40)  # clustered; parts of unequal length


@pytest.mark.parametrize("kind, small", [("noise", 10), ("ties", 10), ("clustered", 0)])
def test_codes(spark, kind, small):
    rng = np.random.default_rng(3)
    n = 500
    v = vectors_of(kind, n, rng)
    rows = [(None if i % 9 == 0 else i // 2 if kind == "ties" else i, v[i], None if i % 7 == 0 else i % 5) for i in range(n)]
    junk = [(i, x, 1) for i, x in JUNK if x is None or len(x) != len(v[0]) or kind != "clustered"]
    out = compression.compress(frame(spark, rows + junk), entries=40, block_rows=120, leaf=6, small=small).collect()
    assert sorted(map(tuple, out), key=str) == codes_by_hand(rows, 40)


def test_balls_are_settled_whole():
    """On clusters most points go by the sums of balls; owners agree with plain search."""
    rng = np.random.default_rng(4)
    middles = rng.integers(-4000, 4000, size=(40, 5))
    points = np.unique((middles[rng.integers(0, 40, 3000)] + rng.integers(-20, 20, size=(3000, 5))).astype(float), axis=0)
    tree = compression.Tree(points, np.ones(len(points), int), 16)
    tree.cache(False)
    book = middles.astype(float)
    plain = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (compression.assign(tree, book) == plain).all()
    _, leaves = compression.owners(tree, book)
    assert sum(tree.hi[n] - tree.lo[n] for n, _ in leaves) < 0.3 * len(points)
    rows, sums = compression.totals(tree, book)
    assert (rows == np.bincount(plain, minlength=40)).all() and sums[plain[0]].tolist() == tree.whole[plain == plain[0]].sum(axis=0).tolist()


def test_codes_of_few_and_of_huge(spark):
    few = [(3, [1.0, 2.0], 1), (1, [0.0, 0.5], None), (3, [1.0, 2.0], 1)]  # fewer components than parts, fewer rows than entries
    assert sorted(map(tuple, compression.compress(frame(spark, few)).collect()), key=str) == codes_by_hand(few, 256)
    rng = np.random.default_rng(5)
    huge = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(0, 250)).tolist(), i % 3) for i in range(50)]
    out = compression.compress(frame(spark, huge, "double"), entries=20, leaf=4)
    assert sorted(map(tuple, out.collect()), key=str) == codes_by_hand(huge, 20)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 2)]):
        assert compression.compress(frame(spark, rows)).collect() == [] and whitening.whiten(frame(spark, rows)).collect() == []


def test_polynomial_and_roots():
    rng = np.random.default_rng(6)
    for x in (rng.integers(-50, 50, size=(40, 7)), rng.integers(-2, 3, size=(4, 9)), np.eye(6, dtype=int) * 7, rng.integers(0, 9, size=(5, 1))):
        n, s = len(x), x.sum(axis=0)
        a = (n * (x.T @ x) - np.outer(s, s)).tolist()
        d, m, c = len(a), [[0] * len(a) for _ in a], [0] * len(a) + [1]
        for k in range(1, d + 1):  # by traces of powers
            m = [[sum(a[i][q] * m[q][j] for q in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
            c[d - k] = -sum(sum(a[i][q] * m[q][i] for q in range(d)) for i in range(d)) // k
        moduli = [p for p, _ in zip(whitening.primes(), range(20), strict=False)]
        assert whitening.combine(whitening.polynomials(a, np.array(moduli)), moduli) == c
        plain = np.linalg.eigvalsh(np.array(a, float))[::-1]
        found = whitening.components(a, c, 4)
        assert len(found) == min(4, int((plain > 1e-6 * plain[0]).sum()))
        for (value, v), e in zip(found, plain, strict=False):
            assert float(value) == pytest.approx(e, rel=1e-9) and np.abs(np.array(a) @ v - float(value) * np.array(v)).max() < 1e-9 * plain[0]
        assert np.abs(np.array([v for _, v in found]) @ np.array([v for _, v in found]).T - np.eye(len(found))).max() < 1e-12


def test_roots_that_nearly_agree():
    """Eigenvalues 10**12 and 10**12 + 1 are told apart, and so are their components."""
    a = [[10**12 + 1, 0, 0], [0, 10**12, 0], [0, 0, 5]]
    moduli = [p for p, _ in zip(whitening.primes(), range(6), strict=False)]
    poly = whitening.combine(whitening.polynomials(a, np.array(moduli)), moduli)
    found = whitening.components(a, poly, 3)
    assert [float(v) for v, _ in found] == [10.0**12 + 1, 10.0**12, 5.0]
    assert [[abs(round(x, 15)) for x in v] for _, v in found] == [[1, 0, 0], [0, 1, 0], [0, 0, 1]]


@pytest.mark.parametrize("rows, d", [(300, 8), (300, 3), (5, 8)])
def test_whitened(spark, rows, d):
    rng = np.random.default_rng(7)
    v = singles(rng.normal(size=(rows, d)) * (1 + np.arange(d)) + 3)
    data = [(None if i % 50 == 3 else i, x, None) for i, x in enumerate(v)] + [(1, v[1], 1), (900, v[0], 1)]
    junk = [(i, x, 1) for i, x in JUNK if x is None or len(x) not in (d, 3) or (len(x) == d and d == 8)]
    out = whitening.whiten(frame(spark, data + junk)).collect()
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in data])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True)
    e, w = np.linalg.eigh(cov)
    order = np.argsort(-e)[: min(4, d)]
    e, w = e[order], w[:, order]
    rank = min(len(order), n - 1)
    assert len(out) == len(data) * len(order) and {r["n"] for r in out} == {n}
    sign = {}
    expected = {}
    for (i, _, _), row in zip(data, x, strict=True):
        dev = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True))
        for k in range(len(order)):
            y = (row - s / n) @ w[:, k] / math.sqrt(e[k]) if k < rank else None
            expected.setdefault((i, k + 1, dev), []).append(y)
    for r in out:
        k = r["component"] - 1
        ys = expected[r["vec_id"], k + 1, r["deviation"]]
        if k >= rank:
            assert r["whitened"] is None and r["explained"] == 0
            continue
        if k not in sign and abs(ys[0]) > 1e-3:
            sign[k] = 1 if r["whitened"] * ys[0] > 0 else -1
        assert any(r["whitened"] * sign.get(k, 1) == pytest.approx(y, abs=1e-7) for y in ys)
        assert r["explained"] == pytest.approx(e[k] / np.trace(cov), rel=1e-9) and r["identity_error"] < 1e-9


def test_equal_vectors_and_huge_ones(spark):
    out = whitening.whiten(frame(spark, [(1, [2.0, 3.0], 1), (2, [2.0, 3.0], 1)])).collect()
    assert sorted(tuple(r) for r in out) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    out = whitening.whiten(frame(spark, [(i, [(-1.0) ** i * 10.0**15 * i, 1.0 * i], 1) for i in range(4)], "double")).collect()
    assert {r["deviation"] for r in out} == {None} and all(r["identity_error"] < 1e-9 for r in out) and len(out) == 8
