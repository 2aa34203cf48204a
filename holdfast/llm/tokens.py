"""Byte-level BPE ids of whole batches: words are told apart by vectorised rules, and each distinct word is encoded once.

A byte-level BPE first cuts a text into pieces (a letter run with the space before it, and so on) and then encodes
each piece by itself, so the ids of a text are those of its pieces in a row. Pieces are looked up by a 64-bit hash in
a table of bounded size that each worker keeps; those it doesn't hold are encoded by the tokenizer itself.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from . import text as T

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 0
_VALUES = np.arange(1, 257, dtype=np.uint64)


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point, by the classes that the pieces' rule names."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for kind, rule in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(rule, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            if a < 0xD800 <= b:
                out[a:0xD800] = kind
                a = 0xE000
            out[a : b + 1] = kind
    return out


def pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin in the UTF-8 bytes, and the first piece of each text and the total.

    The rule: 's 't 're 've 'm 'll 'd | ?letters | ?digits | ?others | spaces not before a non-space | spaces.
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    n = len(raw)
    kind = _kinds()[:256].copy()
    kind[128:] = OTHER
    kind = kind[raw]
    wide = np.flatnonzero(raw >= 0xC0)
    if len(wide):
        byte = lambda k: raw[np.minimum(wide + k, n - 1)].astype(np.int32) & 0x3F
        c, b1, b2, b3 = raw[wide].astype(np.int32), byte(1), byte(2), byte(3)
        code = np.where(c < 0xE0, (c & 0x1F) << 6 | b1, np.where(c < 0xF0, (c & 0x0F) << 12 | b1 << 6 | b2, (c & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        of = _kinds()[code]
        for k, least in enumerate((0, 0, 0xE0, 0xF0)):  # all bytes of a code point have its kind
            kind[wide[c >= least] + k] = of[c >= least]
    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    begin = text_start[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last_space = space.copy()  # the last of a run that a non-space of the same text follows
    last_space[:-1] &= ~space[1:]
    last_space &= ~text_start[1:]
    joined = np.flatnonzero(last_space & (raw == 32))  # the space goes with what follows
    begin |= last_space
    late = np.flatnonzero(last_space & ((raw & 0xC0) == 0x80))
    begin[late] = False
    while len(late):  # a wide space begins at its first byte
        late = late - 1
        first = (raw[late] & 0xC0) != 0x80
        begin[late[first]] = True
        late = late[~first]
    begin[joined + 1] = False
    # contractions: an apostrophe that begins a piece, with letters behind it
    quote = np.flatnonzero(raw == 39)
    quote = quote[begin[quote]]
    if len(quote):
        same = lambda k: np.where(quote + k < n, raw[np.minimum(quote + k, n - 1)], 0) * ~_crosses(text_start, quote, k)
        one, two = same(1), same(2)
        pair = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        single = np.isin(one, (115, 116, 109, 100))
        for size, q in ((2, quote[single]), (3, quote[pair & ~single])):
            begin[q + 1] = False
            inside = q + size
            begin[inside[inside < n]] = True
    start = np.flatnonzero(begin)
    return start, np.searchsorted(start, offsets)


def _crosses(text_start: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Whether another text begins within the next ``k`` bytes."""
    out = np.zeros(len(place), bool)
    for j in range(1, k + 1):
        out |= text_start[np.minimum(place + j, len(text_start) - 1)]
    return out


class HashIndex:
    """A table of 64-bit keys other than 0, of bounded size: a slot for each key, found for whole arrays at once."""

    def __init__(self, bits: int):
        self.keys = np.zeros(1 << bits, np.uint64)
        self.held = 0

    def clear(self) -> None:
        self.keys[:] = 0
        self.held = 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot that holds each key, or the free slot where it would go; and whether it is held."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (keys & mask).astype(np.int64)
        held = self.keys[slot]
        found = held == keys
        left = np.flatnonzero(~found & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            held = self.keys[slot[left]]
            found[left] = held == keys[left]
            left = left[(held != keys[left]) & (held != 0)]
        return slot, found

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """The slots of new, distinct keys. Of keys that want one slot, one gets it and the others look on."""
        out, todo = np.empty(len(keys), np.int64), np.arange(len(keys))
        while len(todo):
            slot, _ = self.find(keys[todo])
            _, winner = np.unique(slot, return_index=True)
            out[todo[winner]] = slot[winner]
            self.keys[slot[winner]] = keys[todo[winner]]
            todo = np.delete(todo, winner)
        self.held += len(keys)
        return out


class Encoder:
    """Ids of batches of texts by one tokenizer file, with the pieces met so far."""

    def __init__(self, path: str, bits: int = 21, most_ids: int = 1 << 24):
        from tokenizers import Tokenizer

        self.most_ids = most_ids  # of all pieces that are kept; a piece has as many as it has bytes, at most

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [s.content for s in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_special = re.compile("|".join(map(re.escape, self.special)).encode()) if self.special else None
        self.letters = dict(enumerate(byte_letters()))
        self.index = HashIndex(bits)
        self.clear()

    def clear(self) -> None:
        self.index.clear()
        self.first = np.zeros(len(self.index.keys), np.int64)
        self.size = np.zeros(len(self.index.keys), np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        model, letters = self.tokenizer.model, self.letters
        ids = [[t.id for t in model.tokenize(w.translate(letters))] for w in words]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        slots = self.index.insert(keys)
        self.first[slots], self.size[slots] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(flat)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and the total)."""
        data = raw.tobytes() if self.has_special else b""
        if self.has_special and self.has_special.search(data):
            return self._plainly(data, offsets)
        starts, firsts = pieces(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(raw))
        keys = hash_pieces(raw, starts, ends)
        slot, found = self.index.find(keys)
        if not found.all():
            new, where = np.unique(keys[~found], return_index=True)
            where = np.flatnonzero(~found)[where]
            full = lambda: self.index.held + len(new) > len(self.index.keys) // 2 or self.used + int((ends[where] - starts[where]).sum()) > self.most_ids
            if full():
                self.clear()
                new, where = np.unique(keys, return_index=True)
                if full():
                    return self._plainly(raw.tobytes(), offsets)
            raw_bytes = data or raw.tobytes()
            self._learn(new, [raw_bytes[a:b].decode("latin-1") for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            slot, _ = self.index.find(keys)
        size = self.size[slot].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(self.first[slot] - total[:-1], size)]
        return ids, total[firsts]

    def _plainly(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(at[-1])), at


def hash_pieces(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash, never 0, of each of the adjacent pieces that cover ``raw``."""
    return T.hash_from(_VALUES[raw], starts, ends - starts) | np.uint64(1)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_slices(texts: pa.Array, path: str):
    """For runs of rows: (first row, end row, ids, where each row's begin and the total)."""
    known = encoder(path)
    for lo, hi, raw, offsets in T.slices(texts):
        ids, at = known.encode(raw, offsets)
        yield lo, hi, ids, at
