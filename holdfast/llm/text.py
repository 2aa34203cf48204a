"""Vectorised text handling over Arrow buffers: whole batches of documents, no loop over characters.

Everything here works inside Spark tasks (``mapInArrow``) on slices of a batch, whose size bounds the memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document makes a slice of its own.
SLICE_BYTES = 1 << 18

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWERED = LOWER.astype(np.uint64) + np.uint64(1)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = _inverse = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd 64-bit base, and of its inverse modulo 2**64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << max(12, int(n - 1).bit_length())

        def table(base: int) -> np.ndarray:
            out = np.full(size, np.uint64(base))
            out[0] = np.uint64(1)
            return np.cumprod(out, dtype=np.uint64)

        _powers, _inverse = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _powers[:n], _inverse[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of runs of rows; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + texts.offset + 1)[texts.offset :]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def split_words(raw: np.ndarray, offsets: np.ndarray, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, between bytes that ``gap`` marks: (solid bytes, starts, ends, first word of each text and the total)."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none.astype(bool), none, none, np.zeros(len(offsets), np.int64)
    solid = ~gap[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return solid, starts, ends, np.searchsorted(starts, offsets)


def hash_from(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans that begin at ``starts``; ``values`` is one more than each byte, or 0 outside all spans.

    A span's polynomial is taken at its place in the whole and then moved to the front by an inverse power.
    """
    power, inverse = powers(len(values))
    return mix(np.add.reduceat(values * power, starts) * inverse[starts] + lens.astype(np.uint64) * _MULT)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word with A-Z lowered, first word of each text and the total)."""
    solid, starts, ends, firsts = split_words(raw, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), firsts
    return hash_from(_LOWERED[raw] * solid, starts, ends - starts), firsts


def text_hash(word: str) -> int:
    """The hash that ``word_hashes`` gives a single word."""
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(word_hashes(raw, np.array([0, len(raw)]))[0][0])


def doc_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[firsts[1:]] - total[firsts[:-1]]
