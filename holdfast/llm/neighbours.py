"""Operator 7: approximate nearest neighbours by a robust-pruned directed graph in each shard.

Vectors are dealt over shards by their length, in steps of ``ratio``, and by a hash of their values, so many that a shard
holds about ``shard_size``. Equal vectors are one node; of its ids only the least ``k + 1`` can be in any result, so no more
are kept. A shard's graph is one of directions: nodes enter it in batches; a greedy search from the middle of the shard
proposes neighbours, and pruning keeps the nearest of them but drops those that some kept neighbour is nearer to by more
than a factor ``alpha``; links back are pruned alike. As a shard's vectors are about equally long, those of the largest
inner product are among those of the nearest direction. A query runs a beam search in every shard, scores what it met
exactly in double precision, and the shards' best are merged.

Defined cases: vectors that are null, empty, zero, of another length than most or hold null or non-finite components
take no part, nor do null ids; ids that repeat take part with their least vector; with fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, pick

_RESULT = "query_id long, vec_id long, score double"


def usable(rows: DataFrame) -> DataFrame:
    """(id, vector) that take part: vectors of the most frequent length (of the shortest such)."""
    ok = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), "n").first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0)).groupBy("id").agg(F.min("vector").alias("vector"))


class Graph:
    """Adjacency [nodes, degree] (-1: none) over rows of equally long vectors, and the node where searches begin."""

    def __init__(self, vectors: np.ndarray, degree: int, beam: int, alpha: float, seed: int = 5):
        self.v = np.ascontiguousarray(vectors, np.float32)
        self.degree, self.beam, self.alpha = degree, beam, alpha
        n = len(self.v)
        self.links = np.full((n, degree), -1, np.int32)
        self.start = int((self.v @ self.v.mean(axis=0)).argmax()) if n else 0
        self.norm = float((self.v[0] ** 2).sum()) if n else 0.0
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]]).astype(np.int64) if n else order
        done, step = 1, 1
        while done < n:
            batch = order[done : done + step]
            self._insert(batch)
            done, step = done + len(batch), min(2 * step, 256)
        for at in range(0, n, 256):  # a second pass, when all nodes are there
            self._insert(order[at : at + 256])

    def _insert(self, batch: np.ndarray) -> None:
        found, _ = self.search(self.v[batch], self.beam)
        new: dict[int, list[int]] = {}
        for node, near in zip(batch.tolist(), found, strict=True):
            near = np.union1d(near[near >= 0], self.links[node][self.links[node] >= 0])
            keep = self._prune(node, near[near != node])
            self.links[node] = -1
            self.links[node, : len(keep)] = keep
            for other in keep.tolist():
                new.setdefault(other, []).append(node)
        for node, more in new.items():
            own = self.links[node][self.links[node] >= 0]
            both = np.union1d(own, np.array(more, np.int32))
            if len(both) > self.degree:
                both = self._prune(node, both)
            self.links[node] = -1
            self.links[node, : len(both)] = both

    def _prune(self, node: int, near: np.ndarray) -> np.ndarray:
        """Nearest first, without those that a kept one is nearer to by more than the factor alpha."""
        if not len(near):
            return near.astype(np.int32)
        far = np.maximum(2 * self.norm - 2 * (self.v[near] @ self.v[node]), 0)
        order = np.argsort(far, kind="stable")[: 4 * self.degree]
        near, far = near[order], far[order]
        between = np.maximum(2 * self.norm - 2 * (self.v[near] @ self.v[near].T), 0)
        left, keep = np.ones(len(near), bool), []
        for i in range(len(near)):
            if left[i]:
                keep.append(i)
                if len(keep) == self.degree:
                    break
                left &= self.alpha**2 * between[i] > far
        return near[keep].astype(np.int32)

    def search(self, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(nodes [queries, beam], similarities), best first, -1 where there are fewer; all queries step together."""
        n, q = len(self.v), len(queries)
        beam = min(beam, n)
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -np.inf, np.float32)
        opened = np.ones((q, beam), bool)
        seen = np.zeros((q, n), bool)
        ids[:, 0], sims[:, 0], opened[:, 0] = self.start, queries @ self.v[self.start], False
        seen[:, self.start] = True
        live = np.arange(q)
        while len(live):
            open_sims = np.where(opened[live], -np.inf, sims[live])
            top = np.argsort(-open_sims, axis=1)[:, :width]
            valid = np.take_along_axis(open_sims, top, 1) > -np.inf
            opened[live[:, None], top] = True
            nodes = np.where(valid, ids[live[:, None], top], -1)
            near = np.where(nodes[:, :, None] >= 0, self.links[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            # a node that several opened ones propose counts once
            order = np.argsort(near, axis=1, kind="stable")
            ranked = np.take_along_axis(near, order, 1)
            again = np.zeros_like(fresh)
            np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            fresh &= ~again
            at, col = np.nonzero(fresh)
            node = near[at, col]
            seen[live[at], node] = True
            near_sims = np.full(near.shape, -np.inf, np.float32)
            near_sims[at, col] = np.einsum("ij,ij->i", self.v[node], queries[live[at]])
            all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
            all_sims = np.concatenate([sims[live], near_sims], axis=1)
            all_open = np.concatenate([opened[live], ~fresh], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live], opened[live] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_sims, all_open))
            live = live[~opened[live].all(axis=1)]
        return ids, sims


def _directions(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # squares of very large or small components stay in range
    return (wide / np.sqrt((wide**2).sum(axis=1, keepdims=True))).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    data = column.combine_chunks()
    flat = data.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(data), -1)


def _build(degree: int, beam: int, alpha: float):
    def run(key, data):
        vectors = _matrix(data.column("vector"))
        graph = Graph(_directions(vectors), degree, beam, alpha)
        ids = data.column("ids").combine_chunks()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "vectors": pa.array([vectors.tobytes()], pa.binary()), "size": pa.array([len(vectors)], pa.int64()), "links": pa.array([graph.links.tobytes()], pa.binary()), "start": pa.array([graph.start], pa.int64()), "ids": pa.array([ids.flatten().to_numpy().astype("<i8").tobytes()], pa.binary()), "id_counts": pa.array([np.diff(ids.offsets.to_numpy()).astype("<i4").tobytes()], pa.binary())})

    return run


def _search(kind: str, degree: int, beam: int, k: int):
    def run(key, index, queries):
        if not len(index) or not len(queries):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        row = {c: index.column(c)[0].as_py() for c in ("vectors", "size", "links", "start", "ids", "id_counts")}
        vectors = np.frombuffer(row["vectors"], kind).reshape(row["size"], -1)
        graph = Graph.__new__(Graph)
        graph.v, graph.links, graph.start = _directions(vectors), np.frombuffer(row["links"], np.int32).reshape(-1, degree), row["start"]
        counts = np.frombuffer(row["id_counts"], "<i4")
        ids, first = np.frombuffer(row["ids"], "<i8"), np.cumsum(counts) - counts
        names, q = queries.column("id").to_numpy(), _matrix(queries.column("vector"))
        out = []
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            found, _ = graph.search(_directions(part), beam)
            for i, near in enumerate(found):
                near = near[near >= 0]
                # exact: row by row, the same sum for equal vectors
                exact = (vectors[near].astype(np.float64) * part[i].astype(np.float64)).sum(axis=1)
                c = counts[near]
                flat = ids[np.arange(c.sum()) + np.repeat(first[near] - (np.cumsum(c) - c), c)]
                score = np.repeat(exact, c)
                other = flat != names[at + i]
                flat, score = flat[other], score[other]
                top = np.lexsort((flat, -score))[:k]
                out.append((np.full(len(top), names[at + i]), flat[top], score[top]))
        cols = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return run


def _length_class(ratio: float) -> Column:
    """Whole steps of ``ratio`` in a vector's length; length 1 lies in the middle of step 0. The largest component is taken out first, so that squares stay in range."""
    top = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    rest = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x.cast("double") / top) * (x.cast("double") / top))
    return F.floor((F.log(top) + F.log(rest) / 2) / float(np.log(ratio)) + 0.5).cast("int")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_size: int = 4000, block: int = 20000, degree: int = 32, beam: int = 100, search_beam: int = 160, alpha: float = 1.2, ratio: float = 1.1) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product of each row that ``is_query`` (on column id) picks.

    The counts by steps of length alone come to the driver: some 15,000 at most, as many as double precision has. A
    shard's index is sent once for each ``block`` queries.
    """
    spark = rows.sparkSession
    kind = "<f4" if "float" in dict(rows.dtypes)[vector_col] else "<f8"
    vectors = materialise(usable(pick(rows, id=id_col, vector=vector_col).withColumn("id", F.col("id").cast("long"))).withColumn("step", _length_class(ratio)), "neighbours-vectors")
    counts = {r["step"]: r["n"] for r in vectors.groupBy("step").agg(F.count("*").alias("n")).collect()}
    queries = vectors.where(is_query).drop("step")
    n_queries = queries.count()
    if not counts or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # a step's shards are numbered on from those of the steps before
    pieces = [-(-counts[s] // shard_size) for s in sorted(counts)]
    firsts = np.cumsum([0, *pieces]).tolist()
    shards, blocks = firsts[-1], -(-n_queries // block)
    steps = spark.createDataFrame(pa.table({"step": pa.array(sorted(counts), pa.int32()), "first": pa.array(firsts[:-1], pa.int64()), "pieces": pa.array(pieces, pa.int64())}))
    # equal vectors: the least ids of each
    ranked = vectors.withColumn("r", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = ranked.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("step").alias("step"))
    nodes = nodes.join(F.broadcast(steps), "step").select("vector", "ids", (F.col("first") + F.pmod(F.xxhash64("vector"), F.col("pieces"))).alias("shard"))
    schema = "shard long, vectors binary, size long, links binary, start long, ids binary, id_counts binary"
    index = materialise(nodes.repartition(shards, "shard").groupBy("shard").applyInArrow(_build(degree, beam, alpha), schema), "neighbours-index")
    every = lambda m, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(name)
    left = index.select("*", every(blocks, "block"))
    right = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long")).select("*", every(shards, "shard"))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_search(kind, degree, search_beam, k), _RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
