"""Operator 11: codes of vectors by a codebook for each part, fitted exactly on metric trees.

Vectors of whole numbers are cut into parts. Blocks of rows are written once, each with a tree over the distinct values
of every part: anchors take the points nearest to them, the furthest point of the widest one becomes the next anchor and
takes over from the others, by the triangle inequality without looking at points that are too near to their own; about
the square root of all points are anchors, each is built up alike below, and above them the two balls that fit into the
smallest common one are joined until a single one is left. A ball knows the sum and the number of its points.

In each round a ball inherits the list of entries that may own some of its points. From the entry nearest to its middle,
those behind a bisector that the ball doesn't reach leave the list. When one is left the whole ball goes to it by its
cached sum; lists that reach the leaves are settled point by point. The partial sums of a task are as many as entries,
are summed in Spark, and the entries that the driver gets make the next round's codebook.

Distances are whole numbers below 2**53 in doubles, and Python's whole numbers where they may be larger; the bounds on balls
allow for rounding. Results don't depend on blocks.

Defined cases: vectors that are null, empty, of another length than most, or hold a null or non-finite component (also
after scaling) get no row; a row without an id is coded, its id sorts last for the first codebook; rows that repeat are each coded, ties of ids there going
by vector; with fewer rows than entries a codebook has as many entries as there are rows; a length that
``parts`` doesn't divide makes the first parts one longer; an empty table gives no rows. Errors beyond a long are its largest value.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, pick
from .exact import from_limbs, limbs_for, sum_arrays, to_limbs
from .vectors import finite, matrix

_LARGEST = 2**63 - 1


def anchors(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each point, distance to it): each new anchor is the furthest point of the widest one so far."""
    owner = np.zeros(len(points), np.int64)
    far = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    pivots = [0]
    while len(pivots) < count:
        new = int(far.argmax())
        if far[new] == 0:
            break
        gap = np.sqrt(((points[pivots] - points[new]) ** 2).sum(axis=1))
        near = np.flatnonzero(far * 2 >= gap[owner])  # others can't be nearer to the new one
        dist = np.sqrt(((points[near] - points[new]) ** 2).sum(axis=1))
        taken = dist < far[near]
        owner[near[taken]], far[near[taken]] = len(pivots), dist[taken]
        pivots.append(new)
    return owner, far


def _furthest(points: np.ndarray, middle: np.ndarray) -> float:
    return float(np.sqrt(((points - middle.astype(np.float64)) ** 2).sum(axis=1).max()))


class Tree:
    """Balls over distinct points: middle, radius, range of points in the tree's order, number and sum of rows, children (-1: leaf).

    Points are divided by ``unit``, a power of two that keeps the squares of very large ones in range.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray, leaf: int, unit: float = 1.0):
        self.leaf, self.nodes, self.order, self.unit = leaf, [], [], unit
        points = points / unit
        self.points = points
        root = self._grow(np.arange(len(points)))
        # number points so that each ball has a range of them
        self.lo, self.hi = np.zeros(len(self.nodes), np.int64), np.zeros(len(self.nodes), np.int64)
        at, stack = 0, [(root, False)]
        while stack:
            node, done = stack.pop()
            _, _, left, right, own = self.nodes[node]
            if done:
                self.hi[node] = at
                continue
            self.lo[node] = at
            stack.append((node, True))
            if own is None:
                stack += [(right, False), (left, False)]
            else:
                self.order.append(own)
                at += len(own)
        self.order = np.concatenate(self.order)
        self.root = root
        self.middle = np.stack([x[0] for x in self.nodes]).astype(np.float32)
        self.left, self.right = np.array([x[2] for x in self.nodes], np.int32), np.array([x[3] for x in self.nodes], np.int32)
        del self.nodes
        points = points[self.order]
        self.radius = np.array([_furthest(points[a:b], m) for a, b, m in zip(self.lo.tolist(), self.hi.tolist(), self.middle, strict=True)])
        small = next((k for k in (np.int16, np.int32) if unit == 1 and np.abs(points).max(initial=0) <= np.iinfo(k).max), np.float64)
        self.points, self.weights = points.astype(small), weights[self.order].astype(np.int32)

    def _grow(self, own: np.ndarray) -> int:
        """The node of a set of points: anchors, each grown by itself, then joined from the middle up."""
        if len(own) > self.leaf:
            owner, _ = anchors(self.points[own], max(2, int(np.sqrt(len(own)))))
            groups = [own[owner == k] for k in range(owner.max() + 1)]
            if len(groups) > 1:
                return self._join([self._grow(g) for g in groups], [len(g) for g in groups])
        middle = self.points[own].mean(axis=0)
        self.nodes.append((middle, _furthest(self.points[own], middle), -1, -1, own))
        return len(self.nodes) - 1

    def _join(self, balls: list[int], sizes: list[int]) -> int:
        """Join the two balls of the smallest common ball until one is left."""
        m = len(balls)
        middle, radius = np.stack([self.nodes[b][0] for b in balls]), np.array([self.nodes[b][1] for b in balls])
        size, node = np.array(sizes, float), np.array(balls)
        cost = np.full((m, m), np.inf)

        def fit(k: int, others: np.ndarray) -> np.ndarray:
            """Radius of the ball around k and each of the others, about their common middle."""
            share = size[others] / (size[others] + size[k])
            gap = np.sqrt(((middle[others] - middle[k]) ** 2).sum(axis=1))
            return np.maximum(share * gap + radius[k], (1 - share) * gap + radius[others])

        for k in range(1, m):
            cost[k, :k] = fit(k, np.arange(k))
        live = np.ones(m, bool)
        for _ in range(m - 1):
            a, b = divmod(int(cost.argmin()), m)
            reach = cost[a, b]
            middle[b] = (size[a] * middle[a] + size[b] * middle[b]) / (size[a] + size[b])
            radius[b], size[b] = reach, size[a] + size[b]
            self.nodes.append((middle[b].copy(), float(reach), int(node[b]), int(node[a]), None))
            node[b] = len(self.nodes) - 1
            live[a] = False
            cost[a, :] = cost[:, a] = np.inf
            rest = np.flatnonzero(live)
            rest = rest[rest != b]
            new = fit(b, rest)
            cost[np.maximum(rest, b), np.minimum(rest, b)] = new
        return int(node[np.flatnonzero(live)[0]])

    def cache(self, wide: bool) -> None:
        """Numbers and sums of the rows of each ball, and the points as whole numbers."""
        kind = object if wide else np.int64
        whole = np.array([[int(x * self.unit) for x in row] for row in self.points.tolist()], object).reshape(self.points.shape) if wide else self.points.astype(np.int64)
        weights = self.weights.astype(kind)
        self.points = self.points.astype(np.float64)
        pad = np.zeros((1, whole.shape[1]), kind)
        sums = np.concatenate([pad, np.cumsum(whole * weights[:, None], axis=0, dtype=kind)])
        counts = np.concatenate([[0], np.cumsum(self.weights)])
        self.whole, self.sums, self.counts = whole, sums[self.hi] - sums[self.lo], counts[self.hi] - counts[self.lo]


def owners(tree: Tree, book: np.ndarray):
    """Goes down a tree; yields (nodes, entries) of balls wholly owned and (range, entries) of points settled in leaves.

    ``book``: the entries, whole numbers; the lower index wins ties.
    """
    k = len(book)
    near = book.astype(np.float64) / tree.unit
    first = np.unique(book.astype(np.float64) if book.dtype != object else np.array([str(r) for r in book.tolist()]), axis=0, return_index=True)[1]
    norm = (near**2).sum(axis=1)
    apart = np.sqrt(np.maximum(norm[:, None] + norm[None, :] - 2 * near @ near.T, 0))
    listed = np.zeros((1, k), bool)
    listed[0, first] = True  # of equal entries only the first can own
    nodes = np.array([tree.root])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    leaves: list[tuple[int, np.ndarray]] = []
    while len(nodes):
        middle = tree.middle[nodes].astype(np.float64)
        scale = (middle**2).sum(axis=1)
        far = np.where(listed, scale[:, None] + norm[None, :] - 2 * middle @ near.T, np.inf)
        best = far.argmin(axis=1)
        at = np.arange(len(nodes))
        slack = 1e-9 * (1 + scale + norm.max())  # far above what rounding can do
        ahead = far - far[at, best][:, None] - 2 * tree.radius[nodes][:, None] * (1 + 1e-9) * apart[best] - slack[:, None]
        keep = listed & ~(ahead > 0)
        keep[at, best] = True
        one = keep.sum(axis=1) == 1
        done.append((nodes[one], best[one]))
        leaf = ~one & (tree.left[nodes] < 0)
        leaves += [(n, np.flatnonzero(row)) for n, row in zip(nodes[leaf].tolist(), keep[leaf], strict=True)]
        inner = ~one & ~leaf
        nodes, listed = np.concatenate([tree.left[nodes[inner]], tree.right[nodes[inner]]]), np.concatenate([keep[inner], keep[inner]])
    return done, leaves


def assign(tree: Tree, book: np.ndarray) -> np.ndarray:
    """The entry of each point, in the tree's order."""
    out = np.zeros(len(tree.points), np.int64)
    done, leaves = owners(tree, book)
    for nodes, entries in done:
        for n, e in zip(nodes.tolist(), entries.tolist(), strict=True):
            out[tree.lo[n] : tree.hi[n]] = e
    _settle(tree, book, leaves, out)
    return out


def _settle(tree: Tree, book: np.ndarray, leaves, out: np.ndarray) -> None:
    """Entries of the points of leaves, some leaves at once over the entries that any of them lists."""
    norm = (book * book).sum(axis=1)
    leaves = sorted(leaves, key=lambda x: tree.lo[x[0]])
    for i in range(0, len(leaves), 32):
        some = leaves[i : i + 32]
        listed = np.unique(np.concatenate([e for _, e in some]))
        sizes = [int(tree.hi[n] - tree.lo[n]) for n, _ in some]
        at = np.concatenate([np.arange(tree.lo[n], tree.hi[n]) for n, _ in some])
        p = tree.whole[at] if book.dtype == object else tree.points[at]
        may = np.zeros((len(some), len(listed)), bool)
        for k, (_, entries) in enumerate(some):
            may[k, np.searchsorted(listed, entries)] = True
        far = norm[listed] - 2 * (p @ book[listed].T)
        out[at] = listed[np.where(np.repeat(may, sizes, axis=0), far, np.inf).argmin(axis=1)]


def totals(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sums) of each entry over a tree."""
    k, kind = len(book), tree.sums.dtype
    rows, sums = np.zeros(k, np.int64), np.zeros((k, tree.points.shape[1]), kind)
    done, leaves = owners(tree, book)
    for nodes, entries in done:
        np.add.at(rows, entries, tree.counts[nodes])
        np.add.at(sums, entries, tree.sums[nodes])
    if leaves:
        out = np.empty(len(tree.points), np.int64)
        _settle(tree, book, leaves, out)
        at = np.concatenate([np.arange(tree.lo[n], tree.hi[n]) for n, _ in leaves])
        np.add.at(rows, out[at], tree.weights[at])
        np.add.at(sums, out[at], tree.whole[at] * tree.weights[at].astype(kind)[:, None])
    return rows, sums


def _cuts(d: int, parts: int) -> list[tuple[int, int]]:
    ends = np.cumsum([d // parts + (i < d % parts) for i in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _blocks(cuts, scale: float, unit: float, rows_each: int, leaf: int):
    def pack(ids, labels, vectors):
        x = np.floor(scale * np.concatenate(vectors)) + 0.0
        trees, places = [], []
        for a, b in cuts:
            points, where, weights = np.unique(x[:, a:b], axis=0, return_inverse=True, return_counts=True)
            tree = Tree(points, weights, leaf, unit)
            back = np.empty(len(points), np.int32)
            back[tree.order] = np.arange(len(points))
            del tree.order
            trees.append(tree)
            places.append(back[where.reshape(-1)])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (pa.concat_arrays(ids), pa.concat_arrays(labels))]
        return pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps((trees, places))], pa.binary())], ["ids", "labels", "trees"])

    def run(batches):
        ids, labels, vectors, held = [], [], [], 0
        for batch in batches:
            for at in range(0, len(batch), rows_each):
                part = batch.slice(at, rows_each)
                if held + len(part) > rows_each:
                    yield pack(ids, labels, vectors)
                    ids, labels, vectors, held = [], [], [], 0
                ids.append(part.column("id"))
                labels.append(part.column("label"))
                vectors.append(matrix(part.column("vector")))
                held += len(part)
        if held:
            yield pack(ids, labels, vectors)

    return run


def _round(books: list[np.ndarray], wide: bool, limbs: int):
    def run(batches):
        sums = None
        for batch in batches:
            for data in batch.column("trees"):
                trees, _ = pickle.loads(data.as_buffer())
                found = []
                for tree, book in zip(trees, books, strict=True):
                    tree.cache(wide)
                    found.append(totals(tree, book))
                sums = found if sums is None else [(r + a, s + b) for (r, s), (a, b) in zip(found, sums, strict=True)]
        for part, (rows, values) in enumerate(sums or []):
            used = np.flatnonzero(rows)
            flat = to_limbs(values[used], limbs).reshape(len(used), -1)
            arrays = pa.array(list(np.concatenate([rows[used][:, None], flat], axis=1)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), part, np.int32)), pa.array(used.astype(np.int32)), arrays], ["part", "entry", "sums"])

    return run


def _code(books: list[np.ndarray], wide: bool, digits: int):
    def run(batches):
        for batch in batches:
            for i, data in enumerate(batch.column("trees")):
                trees, places = pickle.loads(data.as_buffer())
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                error, codes = np.zeros(len(ids), object if wide else np.int64), []
                for tree, book, place in zip(trees, books, places, strict=True):
                    tree.cache(wide)
                    own = assign(tree, book)
                    apart = tree.whole - book[own].astype(tree.whole.dtype)
                    error = error + (apart * apart).sum(axis=1)[place]
                    codes.append(own[place])
                names = np.array([f"{e:0{digits}x}" for e in range(max(map(len, books)))])
                code = names[codes[0]]
                for c in codes[1:]:
                    code = np.char.add(code, names[c])
                limits = pa.array([min(int(e), _LARGEST) for e in error.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(code, pa.string()), limits, labels], ["vec_id", "code", "error", "label"])

    return run


def compress(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_rows: int = 4096, leaf: int = 48, small: int = 1_000_000, salts: int = 16) -> DataFrame:
    """(vec_id, code, error, label, label_error, codebooks_sha256) of each row that takes part.

    A block and its trees are one row of a table in the shared folder, so memory is bounded by ``block_rows``. The driver gets the sums of
    ``parts * entries`` entries a round. Errors by label are joined back by broadcast up to ``small`` labels; beyond, in
    ``salts`` shares of each label.
    """
    spark = rows.sparkSession
    kept, d, top = finite(pick(rows, id=id_col, vector=vector_col, label=label_col), scale)
    kinds = dict(kept.dtypes)
    schema = f"vec_id {kinds['id']}, code string, error long, label {kinds['label']}, label_error long, codebooks_sha256 string"
    if not d:
        return spark.createDataFrame([], schema)
    most = int(scale * top) + 1
    n = kept.count()
    cuts = _cuts(d, parts)
    width = cuts[0][1] - cuts[0][0]
    wide = 4 * d * most * most >= 2**53
    limbs, unit = limbs_for(n * most), 2.0 ** max(0, most.bit_length() - 400)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    whole = np.floor(scale * matrix(first.column("vector"))) + 0.0
    kind = object if wide else np.float64
    lists = [[[int(x) for x in row] for row in whole[:, a:b].tolist()] for a, b in cuts]
    book_of = lambda lists, i: np.array(lists[i], kind).reshape(len(lists[i]), cuts[i][1] - cuts[i][0])
    blocks = materialise(kept.mapInArrow(_blocks(cuts, scale, unit, block_rows, leaf), f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, trees binary"), "compression-blocks")
    trees = blocks.select("trees")
    for _ in range(rounds):
        books = [book_of(lists, i) for i in range(parts)]
        sums = trees.mapInArrow(_round(books, wide, limbs), "part int, entry int, sums array<long>")
        for r in sum_arrays(sums, ["part", "entry"], "sums", 1 + limbs * width).collect():
            count, flat, size = int(r["sums"][0]), r["sums"][1:], len(lists[r["part"]][0])
            lists[r["part"]][r["entry"]] = [from_limbs(flat[limbs * j : limbs * (j + 1)]) // count for j in range(size)]
    digest = hashlib.sha256(",".join(str(x) for part in lists for entry in part for x in entry).encode()).hexdigest()
    books, digits = [book_of(lists, i) for i in range(parts)], max(1, -(-(entries - 1).bit_length() // 4))
    coded = blocks.mapInArrow(_code(books, wide, digits), f"vec_id {kinds['id']}, code string, error long, label {kinds['label']}")
    coded = materialise(coded, "compression-codes")
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    by_label = by_label.select(F.col("label").alias("of"), F.least("total", F.lit(_LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = materialise(by_label, "compression-labels")
    if by_label.count() <= small:
        joined = coded.join(F.broadcast(by_label), F.col("label").eqNullSafe(F.col("of")))
    else:
        share = F.pmod(F.xxhash64("code", "error", "vec_id"), F.lit(salts)).cast("int")
        shares = by_label.withColumn("salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = coded.withColumn("salt", share).join(shares, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("salt_of")))
    return joined.select("vec_id", "code", "error", "label", "label_error", F.lit(digest).alias("codebooks_sha256"))
