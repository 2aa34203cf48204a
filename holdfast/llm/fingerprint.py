"""Operator 6: document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of a text; it depends on the 32 bytes before a place only. A chunk ends where the
hash meets a mask: a hard mask below the normal chunk size and an easy one above it, between a least and a most
size, so that sizes gather about the normal one. An insertion shifts the places and not the cuts, so the digests of
all chunks but those at the edit stay. A fingerprint is the set of chunk digests with their lengths. The likeness
of a text to another is containment: the share of the text's distinct chunks, weighted by length, that the other
has too.

Defined cases: null and empty texts have the empty fingerprint ``""``; two empty ones are alike (1), an empty and another
not (0). Rows are taken in ascending id, null ids first and repeated ids by text; the row after the last is the first; a
single row is its own next.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

#: One random number for each byte, from a fixed seed.
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
LEAST, NORMAL, MOST = 16, 48, 192
_HARD, _EASY = np.uint32(0xFE000000), np.uint32(0xF0000000)  # 7 and 4 bits
_DIGEST = 7


def cuts(data: bytes) -> list[int]:
    """Where the chunks of a text end."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    # after step k each value holds the last 2**(k+1) bytes, the latest unshifted
    for k in (1, 2, 4, 8, 16):
        late = h[:-k] << np.uint32(k)
        h[k:] += late
    easy = np.flatnonzero(h & _EASY == 0)
    hard = (h[easy] & _HARD == 0).tolist()
    ends, out, start = (easy + 1).tolist(), [], 0
    i, m = 0, len(ends)
    while start < n:
        stop = min(start + MOST, n)
        while i < m and ends[i] < start + LEAST:
            i += 1
        j = i
        while j < m and ends[j] < stop:
            if hard[j] or ends[j] >= start + NORMAL:
                stop = ends[j]
                break
            j += 1
        out.append(stop)
        start = stop
    return out


def chunks(data: bytes) -> dict[bytes, int]:
    """The digests of a text's chunks with the chunks' lengths."""
    out, start = {}, 0
    for end in cuts(data):
        out[hashlib.blake2b(data[start:end], digest_size=_DIGEST).digest()] = end - start
        start = end
    return out


def written(parts: dict[bytes, int]) -> str:
    """A fingerprint as text: base64 of the sorted digests, each with its length in a byte."""
    return base64.b64encode(b"".join(d + bytes([parts[d]]) for d in sorted(parts))).decode()


def read(fingerprint: str) -> dict[bytes, int]:
    raw, step = base64.b64decode(fingerprint), _DIGEST + 1
    return {raw[i : i + _DIGEST]: raw[i + _DIGEST] for i in range(0, len(raw), step)}


def likeness(parts: dict[bytes, int], other: dict[bytes, int]) -> float:
    if not parts or not other:
        return float(not parts and not other)
    return sum(n for d, n in parts.items() if d in other) / sum(parts.values())


def _fingerprints(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([written(chunks((t or "").encode())) for t in batch.column("text").to_pylist()])], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row."""
    return pick(docs, id=id_col, text=text_col).mapInArrow(_fingerprints, f"doc_id {dict(docs.dtypes)[id_col]}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the first as many code points of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _compare(batches):
    """Rows of a range in order, the first row of the next range behind them: each against the one after it."""
    last = None
    for batch in batches:
        out = []
        for part, doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "text", "guest")), strict=True):
            text = text or ""
            own = chunks(text.encode())
            if last is not None and last[0] == part and not last[4]:
                changed = edited(last[2], text)
                raw = changed.encode()
                other = chunks(raw)
                out.append((last[1], len(last[2]), hashlib.sha256(raw).hexdigest(), written(last[3]), written(other), likeness(last[3], other), likeness(last[3], own)))
            last = part, doc_id, text, own, guest
        if out:
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and both likenesses (near_edited, near_next).

    Rows are dealt by ranges of ids; the least row of a range also goes, as a guest, to the range before it, so that
    every row meets its next one in a task without a global order.
    """
    spark = docs.sparkSession
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10000) if parts > 1 else F.lit(None), F.min("id"), F.count("*"), F.count("id")).first()
    if not at[2]:
        return spark.createDataFrame([], _SCHEMA)
    # ranges begin at ids that exist; nulls lie before all
    starts = sorted({at[1], *(at[0] or [])}) if at[3] else []
    if at[2] > at[3]:
        starts = [None, *starts]
    n = len(starts)
    number = _range_of(F.col("id"), [s for s in starts if s is not None], at[2] > at[3])
    rows = rows.withColumn("part", number)
    first = Window.partitionBy("id").orderBy("text")
    bounds = [s for s in starts if s is not None]
    edge = F.coalesce(F.col("id").isin(bounds), F.lit(False)) | F.col("id").isNull()
    guests = rows.where(edge).withColumn("k", F.row_number().over(first)).where("k = 1").drop("k").withColumn("part", F.pmod(F.col("part") - 1, F.lit(n)).cast("int"))
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    dealt = both.repartition(parts, "part").sortWithinPartitions("part", "guest", "id", "text")
    return dealt.mapInArrow(_compare, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _range_of(key: Column, bounds: list[int], nulls: bool) -> Column:
    """The number of the range that holds the key: the place of the last bound not above it."""
    out = F.lit(0)
    if bounds:
        table = F.array(*map(F.lit, bounds))
        out = F.when(key.isNull(), 0).otherwise(F.size(F.filter(table, lambda b: b <= key)) - (0 if nulls else 1))
    return out.cast("int")
