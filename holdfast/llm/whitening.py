"""Operator 12: whitening of whole-number vectors by the exact characteristic polynomial of their scatter.

The fit list holds each distinct vector once. Tasks sum products of its vectors in whole numbers, and the scatter
``A = n * sum(x x') - S S'`` is exact; so is its characteristic polynomial: tasks reduce A to Hessenberg form modulo
primes, many primes at once, and the driver puts the coefficients together by Chinese remaindering, with so many primes that their product exceeds
twice the bound (1 + trace / d) ** d. As all roots are real, the sign changes of the polynomial moved to ``a`` count the
roots above ``a`` exactly, which isolates the greatest ones; bisection by the sign at exact points then narrows each.
A component spans the null space of A minus its root, found by inverse iteration in decimal arithmetic; roots that stay
together to ``digits`` digits share a space of as many dimensions.

Defined cases: vectors that are null, empty, of another length than most, or hold a null or non-finite component (also
after scaling) get no rows; rows that repeat, or have no id, each get theirs; a component without variance has null ``whitened`` and
explains 0 (null if nothing varies) and takes no part in ``identity_error``; vectors of fewer than ``components`` components give
as many; components beyond a long become the nearest long; a deviation beyond a long is null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, pick
from .exact import from_limbs, limbs_for, sum_arrays, to_limbs
from .vectors import finite

_LONG = 2**63 - 1


def primes() -> Iterator[int]:
    """Primes below 2**31, from the greatest down."""
    for p in range(2**31 - 1, 2, -2):
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(base, odd, p)
            if x in (1, p - 1):
                continue
            if not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
                break
        else:
            yield p


def polynomials(scatter: list[list[int]], moduli: np.ndarray) -> np.ndarray:
    """[primes, d + 1]: coefficients of det(t - A), lowest first, modulo each prime."""
    d, q, at = len(scatter), len(moduli), np.arange(len(moduli))
    p = moduli.astype(np.int64)
    h = np.array([[[v % m for v in row] for row in scatter] for m in p.tolist()], np.int64).reshape(q, d, d)
    inverse = lambda values: np.array([pow(v, -1, m) if v else 0 for v, m in zip(values.tolist(), p.tolist(), strict=True)], np.int64)
    for k in range(1, d - 1):
        pivot = k + (h[:, k:, k - 1] != 0).argmax(axis=1)  # exchange rows and columns so that the entry below the diagonal isn't 0
        rows, other = h[at, pivot].copy(), h[at, k].copy()
        h[at, k], h[at, pivot] = rows, other
        cols, other = h[at, :, pivot].copy(), h[at, :, k].copy()
        h[at, :, k], h[at, :, pivot] = cols, other
        factor = h[:, k + 1 :, k - 1] * inverse(h[:, k, k - 1])[:, None] % p[:, None]
        h[:, k + 1 :] = (h[:, k + 1 :] - factor[:, :, None] * h[:, k][:, None, :] % p[:, None, None]) % p[:, None, None]
        # columns: that of k gains the others by the factors, product by product below 2**62
        gain = np.zeros((q, d), np.int64)
        for j in range(d - k - 1):
            gain = (gain + h[:, :, k + 1 + j] * factor[:, j][:, None]) % p[:, None]
        h[:, :, k] = (h[:, :, k] + gain) % p[:, None]
    found = np.zeros((d + 1, q, d + 1), np.int64)
    found[0, :, 0] = 1
    for k in range(1, d + 1):
        row = np.zeros((q, d + 1), np.int64)
        row[:, 1:] = found[k - 1, :, :-1]
        row = (row - h[:, k - 1, k - 1][:, None] * found[k - 1]) % p[:, None]
        chain = np.ones(q, np.int64)
        for i in range(k - 1, 0, -1):
            chain = chain * h[:, i, i - 1] % p
            row = (row - (h[:, i - 1, k - 1] * chain % p)[:, None] * found[i - 1]) % p[:, None]
        found[k] = row
    return found[d]


def combine(residues: np.ndarray, moduli: list[int]) -> list[int]:
    """Whole numbers of least absolute value with the residues [primes, numbers]."""
    level = [([int(v) for v in row], m) for row, m in zip(residues, moduli, strict=True)]
    while len(level) > 1:
        new = []
        for (a, m), (b, w) in zip(level[::2], level[1::2], strict=False):
            inverse = pow(m, -1, w)
            new.append(([x + m * ((y - x) * inverse % w) for x, y in zip(a, b, strict=True)], m * w))
        level = new + level[len(level) - len(level) % 2 :]
    values, whole = level[0]
    return [v - whole if 2 * v > whole else v for v in values]


def above(poly: list[int], a: int) -> int:
    """How many roots of a polynomial with real roots only exceed ``a``: sign changes once it is moved to ``a``."""
    c = poly[::-1]
    for k in range(len(c) - 1):
        for i in range(1, len(c) - k):
            c[i] += a * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def greatest_roots(poly: list[int], count: int, digits: int) -> list[tuple[Decimal, int]]:
    """(root, multiplicity) of the greatest positive roots, ``count`` by multiplicity or all; roots are all real and not negative."""
    d = len(poly) - 1
    zeros = next(i for i, v in enumerate(poly) if v)
    count = min(count, d - zeros)
    out: list[tuple[Decimal, int]] = []
    ceiling = 1 - poly[d - 1] if d else 1  # the sum of the roots, and one
    while sum(m for _, m in out) < count:
        taken = sum(m for _, m in out)
        lo, hi, shift = 0, ceiling, 0  # over 2**shift; more than ``taken`` roots exceed lo, ``taken`` exceed hi
        scaled = poly
        n_lo, n_hi = d - zeros, taken
        sign = None
        while lo == 0 or (hi - lo) * 10**digits > lo:
            if hi - lo == 1:
                lo, hi, shift = lo << 32, hi << 32, shift + 32
                scaled = [v << (shift * (d - i)) for i, v in enumerate(poly)]
            mid = (lo + hi) // 2
            if n_lo - n_hi == 1:  # one simple root between: the sign tells the side
                if sign is None:
                    sign = _sign(scaled, hi, n_hi)
                value = _sign(scaled, mid, None)
                if value == 0:
                    lo = hi = mid
                    break
                lo, hi = (lo, mid) if value == sign else (mid, hi)
            else:
                n = above(scaled, mid)
                if n > taken:
                    lo, n_lo = mid, n
                else:
                    hi, n_hi = mid, n
        with localcontext() as ctx:
            ctx.prec = digits + 40
            out.append((Decimal(lo + hi) / (Decimal(2) ** (shift + 1)), n_lo - n_hi))
        ceiling = -((-hi) >> shift)
    return out


def _sign(poly: list[int], a: int, roots_above: int | None) -> int:
    """The sign at ``a``; just above it by the number of roots beyond, where that is given."""
    if roots_above is not None:
        return 1 if roots_above % 2 == 0 else -1
    value = 0
    for c in reversed(poly):
        value = value * a + c
    return (value > 0) - (value < 0)


def null_space(scatter: list[list[int]], root: Decimal, size: int, digits: int, steps: int = 4) -> list[list[Decimal]]:
    """Orthonormal vectors of the space that A maps onto ``root`` times itself, by inverse iteration; within ``localcontext``."""
    d = len(scatter)
    lu = [[Decimal(v) - (root if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(scatter)]
    tiny, order = root * Decimal(10) ** (-digits - 20), list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(lu[i][k]))
        lu[k], lu[best], order[k], order[best] = lu[best], lu[k], order[best], order[k]
        if abs(lu[k][k]) < tiny:
            lu[k][k] = tiny
        row = lu[k]
        for i in range(k + 1, d):
            if lu[i][k]:
                f = lu[i][k] / row[k]
                lu[i] = [*lu[i][:k], f, *(x - f * y for x, y in zip(lu[i][k + 1 :], row[k + 1 :], strict=True))]

    def solve(b: list[Decimal]) -> list[Decimal]:
        y: list[Decimal] = []
        for i in range(d):
            y.append(b[order[i]] - sum((lu[i][j] * y[j] for j in range(i)), Decimal(0)))
        x = [Decimal(0)] * d
        for i in range(d - 1, -1, -1):
            x[i] = (y[i] - sum((lu[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / lu[i][i]
        return x

    # fixed starts without a pattern that a component could be orthogonal to
    space = [[Decimal(pow(3 + 2 * s, j + 1, 10007) - 5003) for j in range(d)] for s in range(size)]
    for _ in range(steps):
        new: list[list[Decimal]] = []
        for v in space:
            v = solve(v)
            top = max(map(abs, v))
            v = [x / top for x in v]
            for w in new:
                dot = sum((a * b for a, b in zip(v, w, strict=True)), Decimal(0))
                v = [a - dot * b for a, b in zip(v, w, strict=True)]
            length = sum((x * x for x in v), Decimal(0)).sqrt()
            new.append([x / length for x in v])
        space = new
    return space


def components(scatter: list[list[int]], poly: list[int], count: int, digits: int = 50) -> list[tuple[Decimal, list[float]]]:
    """(eigenvalue, unit eigenvector) of the greatest positive eigenvalues, falling, by A and its characteristic polynomial."""
    out: list[tuple[Decimal, list[float]]] = []
    with localcontext() as ctx:
        ctx.prec = 2 * digits + 40
        for root, size in greatest_roots(poly, count, digits):
            out += [(root, [float(x) for x in v]) for v in null_space(scatter, root, size, digits)]
    return out[:count]


def _products(limbs: int, small: bool, rows_each: int):
    """Sums over the rows of a task: row i of the result has those of component i, then of its products with all."""

    def run(batches):
        total = None
        for batch in batches:
            for at in range(0, len(batch), rows_each):
                x = _whole(batch.column("x").slice(at, rows_each))
                one = np.concatenate([x.sum(axis=0)[:, None], (x.T @ x).astype(np.int64)], axis=1).astype(object) if small else _large(x)
                n = np.full((len(one), 1), len(x), object)
                one = np.concatenate([n, one], axis=1)
                total = one if total is None else total + one
        if total is not None:
            flat = to_limbs(total, limbs).reshape(len(total), -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(flat), pa.list_(pa.int64()))], ["i", "sums"])

    def _large(x):
        wide = x.astype(object)
        return np.concatenate([wide.sum(axis=0)[:, None], wide.T @ wide], axis=1)

    def _whole(lists):
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
        return x.astype(np.float64) if small else x

    return run


def _project(n: int, sums: list[int], vectors: np.ndarray, scales: np.ndarray):
    def run(batches):
        for batch in batches:
            lists = batch.column("x")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            most = max(abs(int(v)) for v in (x.max(initial=0), x.min(initial=0), *sums)) * (n + 1)
            moved = x * n - np.array(sums, np.int64) if most < 2**62 else x.astype(object) * n - np.array(sums, object)
            exact = moved if x.shape[1] * most * most < 2**63 else moved.astype(object)
            deviation = pa.array([v if v <= _LONG else None for v in (exact * exact).sum(axis=1).tolist()], pa.int64())
            white = (moved.astype(np.float64) / n) @ vectors.T / scales
            columns = [pa.array(np.ascontiguousarray(white[:, k])) for k in range(len(vectors))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, *columns], ["vec_id", "deviation", *[f"y{k}" for k in range(len(vectors))]])

    return run


def scatter_of(fit: DataFrame, d: int, n: int, top: int, rows_each: int = 1024) -> tuple[list[list[int]], list[int], int]:
    """(A, S, n): the exact scatter of whole-number vectors ``x`` of length ``d``, each at most ``top``."""
    limbs = limbs_for(n * max(top, 1) ** 2)
    small = rows_each * top * top < 2**53
    sums = fit.mapInArrow(_products(limbs, small, rows_each), "i int, sums array<long>")
    by_row = {r["i"]: [from_limbs(r["sums"][limbs * j : limbs * (j + 1)]) for j in range(d + 2)] for r in sum_arrays(sums, ["i"], "sums", limbs * (d + 2)).collect()}
    n, s = by_row[0][0], [by_row[i][1] for i in range(d)]
    return [[n * by_row[i][2 + j] - s[i] * s[j] for j in range(d)] for i in range(d)], s, n


def characteristic(fit: DataFrame, scatter: list[list[int]], each: int = 16) -> list[int]:
    """Coefficients of det(t - A), lowest first: tasks take ``each`` primes at a time."""
    d = len(scatter)
    bound, product, moduli = 2 * (2 + sum(scatter[i][i] for i in range(d)) // d) ** d, 1, []
    for p in primes():
        if product > bound:
            break
        moduli.append(p)
        product *= p

    def run(batches):
        for batch in batches:
            p = batch.column("p").to_numpy()
            for at in range(0, len(p), each):
                some = p[at : at + each]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(polynomials(scatter, some)), pa.list_(pa.int64()))], ["p", "c"])

    rows = fit.sparkSession.createDataFrame(pa.table({"p": pa.array(moduli, pa.int64())})).repartition(max(1, -(-len(moduli) // each)), "p").mapInArrow(run, "p long, c array<long>").collect()
    return combine(np.array([r["c"] for r in rows], np.int64), [r["p"] for r in rows])


def whiten(rows: DataFrame, count: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row that takes part and each of its first ``count`` components.

    The driver sees the scatter and the polynomial: d * d and d + 1 whole numbers for vectors of length d.
    """
    kept, d, top = finite(pick(rows, id=id_col, vector=vector_col), scale)
    kind = dict(kept.dtypes)["id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return rows.sparkSession.createDataFrame([], schema)
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    kept = kept.select("id", whole.alias("x"))
    fit = materialise(kept.select("x").distinct(), "whitening-fit")
    scatter, sums, n = scatter_of(fit, d, fit.count(), min(_LONG + 1, math.floor(scale * top) + 1))
    trace = sum(scatter[i][i] for i in range(d))
    found = components(scatter, characteristic(fit, scatter), count) if trace else []
    shown = min(count, d)
    if not found:
        vectors, scales = np.zeros((0, d)), np.zeros(0)
    else:
        vectors = np.array([v for _, v in found])
        scales = np.array([float(value.sqrt()) / n for value, _ in found])
    columns = [f"y{k}" for k in range(len(found))]
    project = _project(n, sums, vectors, scales)
    projected = f"vec_id {kind}, deviation long" + "".join(f", {c} double" for c in columns)
    error = None
    if found:
        pairs = [(i, j) for i in range(len(found)) for j in range(i, len(found))]
        at = fit.select(F.lit(None).cast(kind).alias("id"), "x").mapInArrow(project, projected).agg(*[F.covar_pop(f"y{i}", f"y{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(at[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = [float(value / trace) for value, _ in found] + [0.0 if trace else None] * (shown - len(found))
    out = kept.mapInArrow(project, projected)
    item = lambda k: F.struct(F.lit(k + 1).alias("component"), (F.col(f"y{k}") if k < len(found) else F.lit(None).cast("double")).alias("whitened"), F.lit(explained[k]).cast("double").alias("explained"))
    out = out.select("vec_id", "deviation", F.explode(F.array(*[item(k) for k in range(shown)])).alias("c"))
    return out.select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error"))
