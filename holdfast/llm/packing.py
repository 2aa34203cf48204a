"""Operator 4: packing documents into as few sequences of bounded length as it can.

A document is its token ids and an end id. Longer ones are cut into pieces of full length, the first of which may be
shorter. Pieces are packed by their lengths alone, of which there are at most ``capacity``: the driver sees the counts
of lengths, never pieces, and plans runs of equal sequences. Pieces above a third of the capacity come first: at most two
of them share a sequence, so they are matched greedily, each with the longest that still fits. Smaller pieces go,
longest first, into the tightest gap that holds them; a new sequence is opened where there is none. Each piece then
finds its place by its rank among those of its length.

Defined cases: a null text is an empty one, which is the end id alone; rows that repeat are packed each for itself;
an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import materialise, pick

END_ID = 2


def _cut(path: str, capacity: int):
    def run(batches):
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for lo, hi, ids, at in tokens.encode_slices(batch.column("text"), path):
                ids, end = ids.astype("<u4"), np.array([END_ID], "<u4").tobytes()
                for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    n = b - a + 1
                    data = ids[a:b].tobytes() + end
                    size = n if n <= capacity else (n - 1) % capacity + 1
                    s = 0
                    for i in range(-(-n // capacity)):
                        row.append(lo + k)
                        piece.append(i)
                        start.append(s)
                        length.append(size)
                        crc.append(zlib.crc32(data[4 * s : 4 * (s + size)]))
                        s, size = s + size, capacity
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece; ``tokenizer`` is a byte-level BPE file on each worker."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_cut(tokenizer, capacity), f"doc_id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, n, first sequence, offset): n pieces of that length go to n sequences, one each."""
    rows: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = {}
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: runs (first sequence, how many)
    opened = 0

    def put(length: int, n: int, bin_: int, offset: int) -> None:
        rows.append((length, used.get(length, 0), n, bin_, offset))
        used[length] = used.get(length, 0) + n

    # matching of the large ones
    large = {s: c for s, c in counts.items() if 3 * s > capacity and c}
    sizes = sorted(large, reverse=True)
    for a in sizes:
        for b in (s for s in sizes if s <= a and s + a <= capacity):
            if not large[a]:
                break
            k = large[a] // 2 if a == b else min(large[a], large[b])
            if not k:
                continue
            large[a] -= k
            large[b] -= k
            put(a, k, opened, 0)
            put(b, k, opened, a)
            gaps[capacity - a - b].append((opened, k))
            opened += k
        if large[a]:
            put(a, large[a], opened, 0)
            gaps[capacity - a].append((opened, large[a]))
            opened += large[a]
            large[a] = 0
    # the others, longest first, into the tightest gap
    for s in sorted((s for s, c in counts.items() if 3 * s <= capacity and c), reverse=True):
        left, g = counts[s], s
        while left and g <= capacity:
            if not gaps[g]:
                g += 1
                continue
            first, n = gaps[g].pop()
            k = min(left, n)
            if k < n:
                gaps[g].append((first + k, n - k))
            put(s, k, first, capacity - g)
            gaps[g - s].append((first, k))
            left -= k
            g = g - s if g - s >= s else g
        each = capacity // s
        for n, full in ((left // each, each), (1 if left % each else 0, left % each)):
            if n:
                for j in range(full):
                    put(s, n, opened, j * s)
                gaps[capacity - full * s].append((opened, n))
                opened += n
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", per_salt: int = 500_000, small: int = 1_000_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of a length are numbered in groups of about ``per_salt``. The tables of groups and of the plan, whose runs are
    as many as pairs of lengths at most, are broadcast up to ``small`` rows, and joined by a shuffle beyond.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, capacity, id_col, text_col), "packing-pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    runs = plan(counts, capacity)
    few = lambda df, n: F.broadcast(df) if n <= small else df
    groups = {k: -(-n // per_salt) for k, n in counts.items()}
    salts = few(spark.createDataFrame(pa.table({"length": pa.array(list(groups), pa.int64()), "salts": pa.array(list(groups.values()), pa.int64())})), len(groups))
    salted = cut.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    at = Window.partitionBy("length").orderBy("salt")
    starts = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("ahead", F.sum("n").over(at) - F.col("n")).select("length", "salt", "ahead")
    places = spark.createDataFrame(pa.Table.from_arrays([pa.array([r[i] for r in runs], pa.int64()) for i in range(5)], ["length", "first", "n", "bin", "at"]))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
    ranked = ranked.join(few(materialise(starts, "packing-groups"), sum(groups.values())), ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("ahead") - 1)
    inside = (F.col("c.length") == F.col("p.length")) & (F.col("c.rank") >= F.col("p.first")) & (F.col("c.rank") < F.col("p.first") + F.col("p.n"))
    placed = ranked.alias("c").join(few(places, len(runs)).alias("p"), inside)
    return placed.select("c.doc_id", "c.piece", "c.start", F.col("c.length").alias("length"), "c.ids_crc32", (F.col("p.bin") + F.col("c.rank") - F.col("p.first")).alias("sequence_id"), F.col("p.at").alias("offset"))
