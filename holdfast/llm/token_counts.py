"""Operator 13: token counts of whole texts by byte-level BPE with word ends, merged by ranks in arrays.

A text is normalised (NFC, lower case), cut into pre-tokens (contractions, letter runs, single digits, runs of other
signs; white space goes), and each pre-token is a sequence of byte symbols, the last of which carries the word end. All
pre-tokens of a slice that aren't known yet lie in one ragged array: in each round every sequence finds the lowest rank
among its adjacent pairs and joins all pairs of that rank at once, from the left where they overlap; sequences without a
ranked pair leave with the number of symbols they have. Counts are kept by a 64-bit hash of the pre-token, in a table
of bounded size for each worker.

Lower case and code point classes come from tables for characters whose composition doesn't depend on their neighbours;
words that hold others go through the normaliser of the file, each distinct word of a slice once. Strings of special
tokens inside a text count one each and part what is around them.

Defined cases: a null text is an empty one, of no bytes and no tokens; rows that repeat are counted each for itself.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T
from .common import pick
from .tokens import DIGIT, OTHER, SPACE, HashIndex, _crosses, _kinds, byte_letters, hash_pieces

#: No pair of symbols.
NONE = np.int32(2**31 - 1)
#: Symbols of a sequence that is merged by itself, with its pairs in order of rank.
LONG = 512


@lru_cache(maxsize=1)
def _cases() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case, and whether that and NFC are known without its neighbours and keep its bytes' number."""
    lower, sure = np.arange(0x110000, dtype=np.int32), np.zeros(0x110000, bool)
    joins = set()  # characters that can be the later part of a composed one
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) > 1 and not parts[0].startswith("<"):
            joins.update(parts[1:])
    joins = {int(p, 16) for p in joins} | set(range(0x1100, 0x1200))  # and Hangul parts
    for code in range(0x10000):
        c = chr(code)
        if code in joins or unicodedata.category(c) in ("Cs", "Cn") or unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c):
            continue
        small = c.lower()
        if len(small) == 1 and len(small.encode()) == len(c.encode()) and unicodedata.is_normalized("NFC", small):
            lower[code], sure[code] = ord(small), True
    return lower, sure


class Counter:
    """Counts tokens of slices of texts by one tokenizer file, with the counts of pre-tokens met so far."""

    def __init__(self, path: str, bits: int = 20):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        self.normalizer = Tokenizer.from_file(path).normalizer
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)).encode()) if special else None
        vocab, letters = model["vocab"], byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.order = np.argsort(key, kind="stable")
        self.keys, self.joined = key[self.order], np.array([vocab[a + b] for a, b in merges], np.int32)
        self.index = HashIndex(bits)
        self.known = np.zeros(1 << bits, np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, or NONE."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE).astype(np.int32)

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many symbols are left of each sequence; ``symbols`` holds them in a row, each of at least one symbol."""
        out = np.ones(len(sizes), np.int32)
        whole = np.flatnonzero(sizes > LONG)
        starts = np.cumsum(sizes) - sizes
        for k in whole.tolist():
            out[k] = self._merged_long(symbols[starts[k] : starts[k] + sizes[k]])
        name = np.flatnonzero((sizes > 1) & (sizes <= LONG))
        symbols = symbols[np.repeat((sizes > 1) & (sizes <= LONG), sizes)]
        sizes = sizes[name]
        while len(name):
            starts = np.cumsum(sizes) - sizes
            rank = np.full(len(symbols), NONE, np.int32)  # of each symbol with the next one
            rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
            rank[starts[1:] - 1] = NONE
            least = np.minimum.reduceat(rank, starts)
            hit = (rank == np.repeat(least, sizes)) & (rank != NONE)
            hit = _from_left(hit)
            place = np.flatnonzero(hit)
            symbols = symbols.copy()
            symbols[place] = self.joined[rank[place]]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            left = np.add.reduceat(stay.astype(np.int64), starts)
            out[name] = left
            going = (least != NONE) & (left > 1)
            symbols = symbols[stay & np.repeat(going, sizes)]
            name, sizes = name[going], left[going]
        return out

    def _merged_long(self, symbols: np.ndarray) -> int:
        """The same for one long sequence: its pairs wait by rank, and a round touches only those of the lowest one."""
        n, symbols = len(symbols), symbols.copy()
        after, before, left = np.arange(1, n + 1), np.arange(-1, n - 1), n
        rank = np.full(n, NONE, np.int32)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        lowest: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] != NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            values, begins = np.unique(rank[places], return_index=True)
            for r, part in zip(values.tolist(), np.split(places, begins[1:]), strict=False):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(lowest, r)
                waiting[r].append(part)

        wait(np.arange(n))
        while lowest:
            r = heapq.heappop(lowest)
            place = np.unique(np.concatenate(waiting.pop(r)))
            place = place[rank[place] == r]
            if not len(place):
                continue
            follows = np.zeros(len(place), bool)  # begins where the pair before it ends
            follows[1:] = after[place[:-1]] == place[1:]
            place = place[_alternate(follows)]
            right = after[place]
            symbols[place], rank[right], after[place] = self.joined[r], NONE, after[right]
            inner = after[place] < n
            before[after[place[inner]]] = place[inner]
            left -= len(place)
            touched = np.concatenate([place, before[place[before[place] >= 0]]])
            touched = np.unique(touched)
            ends = after[touched] >= n
            rank[touched] = np.where(ends, NONE, self.ranks(symbols[touched], symbols[np.minimum(after[touched], n - 1)]))
            wait(touched)
        return left

    def _learn(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token counts of pre-tokens, which lie anywhere in ``raw``."""
        sizes = ends - starts
        at = np.cumsum(sizes) - sizes
        data = raw[np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes)]
        symbols = self.first[data]
        closing = at + sizes - 1
        symbols[closing] = self.last[data[closing]]
        return self.merged(symbols, sizes)

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of each text; ``raw`` holds their UTF-8 bytes in a row."""
        n = len(offsets) - 1
        total = np.zeros(n, np.int64)
        if not len(raw):
            return total
        raw = raw.copy()
        if self.special is not None:
            for k in range(n) if self.special.search(raw.tobytes()) else ():
                for m in self.special.finditer(raw[offsets[k] : offsets[k + 1]].tobytes()):
                    total[k] += 1
                    raw[offsets[k] + m.start() : offsets[k] + m.end()] = 32
        raw = T.LOWER[raw]
        wide = np.flatnonzero(raw >= 0xC0)
        code = _codes(raw, wide)
        lower, sure = _cases()
        odd = wide[~sure[code]]
        if len(odd):
            total += self._count_odd(raw, offsets, odd)
            wide = np.flatnonzero(raw >= 0xC0)
            code = _codes(raw, wide)
        change = lower[code] != code
        _write(raw, wide[change], lower[code[change]])
        return total + self._count_plain(raw, offsets)

    def _count_odd(self, raw: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """Tokens of words with the characters at ``odd``, which become spaces in ``raw``; the file's normaliser sees each distinct word once."""
        _, starts, ends, _ = T.split_words(raw, offsets)
        words = np.unique(np.searchsorted(starts, odd, side="right") - 1)
        row = np.searchsorted(offsets, starts[words], side="right") - 1
        texts = [raw[a:b].tobytes() for a, b in zip(starts[words].tolist(), ends[words].tolist(), strict=True)]
        place = {t: i for i, t in enumerate(dict.fromkeys(texts))}
        normal = [self.normalizer.normalize_str(t.decode()).encode() if self.normalizer else t for t in place]
        counts = self._count_plain(np.frombuffer(b"".join(normal), np.uint8), np.cumsum([0, *map(len, normal)]))
        sizes = ends[words] - starts[words]
        raw[np.arange(int(sizes.sum())) + np.repeat(starts[words] - (np.cumsum(sizes) - sizes), sizes)] = 32
        return np.bincount(row, counts[[place[t] for t in texts]], len(offsets) - 1).astype(np.int64)

    def _count_plain(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of texts that are normalised already."""
        if not len(raw):
            return np.zeros(len(offsets) - 1, np.int64)
        starts, space = pre_tokens(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        keys = hash_pieces(raw, starts, ends)
        starts, ends, keys = starts[~space], ends[~space], keys[~space]
        size = self._sizes(raw, starts, ends, keys)
        at, total = np.searchsorted(starts, offsets), np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        return total[at[1:]] - total[at[:-1]]

    def _sizes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        slot, found = self.index.find(keys)
        if found.all():
            return self.known[slot]
        new, where = np.unique(keys[~found], return_index=True)
        where = np.flatnonzero(~found)[where]
        learnt = self._learn(raw, starts[where], ends[where])
        out = np.zeros(len(keys), np.int32)
        out[found], out[~found] = self.known[slot[found]], learnt[np.searchsorted(new, keys[~found])]
        if self.index.held + len(new) > len(self.index.keys) // 2:
            self.index.clear()
        if len(new) <= len(self.index.keys) // 2:
            self.known[self.index.insert(new)] = learnt
        return out


def _alternate(follows: np.ndarray) -> np.ndarray:
    """Of items in runs (``follows``: goes on the run of the one before), every other one from each run's first."""
    at = np.arange(len(follows))
    return (at - np.maximum.accumulate(np.where(follows, 0, at))) % 2 == 0


def _from_left(hit: np.ndarray) -> np.ndarray:
    """Of hits next to each other, which overlap, those that are taken going from the left."""
    follows = np.zeros(len(hit), bool)
    follows[1:] = hit[1:] & hit[:-1]
    return hit & _alternate(follows)


def _codes(raw: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The code points whose first bytes are at ``wide``."""
    byte = lambda k: raw[np.minimum(wide + k, len(raw) - 1)].astype(np.int32) & 0x3F
    c, b1, b2, b3 = raw[wide].astype(np.int32), byte(1), byte(2), byte(3)
    return np.where(c < 0xE0, (c & 0x1F) << 6 | b1, np.where(c < 0xF0, (c & 0x0F) << 12 | b1 << 6 | b2, (c & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))


def _write(raw: np.ndarray, place: np.ndarray, code: np.ndarray) -> None:
    """Put code points of two or three bytes in the place of others of as many."""
    two = code < 0x800
    a, c = place[two], code[two]
    raw[a], raw[a + 1] = 0xC0 | c >> 6, 0x80 | c & 0x3F
    a, c = place[~two], code[~two]
    raw[a], raw[a + 1], raw[a + 2] = 0xE0 | c >> 12, 0x80 | c >> 6 & 0x3F, 0x80 | c & 0x3F


def pre_tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of normalised texts begin, white space too, and which are white space.

    The rule: 's 't 're 've 'm 'll 'd | letters | a digit | others.
    """
    n = len(raw)
    kind = _kinds()[:256].copy()
    kind[128:] = OTHER
    kind = kind[raw]
    wide = np.flatnonzero(raw >= 0xC0)
    of = _kinds()[_codes(raw, wide)]
    for k, least in enumerate((0, 0, 0xE0, 0xF0)):  # all bytes of a code point have its kind
        kind[wide[raw[wide] >= least] + k] = of[raw[wide] >= least]
    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    begin = text_start[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    begin |= (kind == DIGIT) & ((raw & 0xC0) != 0x80)
    quote = np.flatnonzero(raw == 39)
    quote = quote[begin[quote]]
    if len(quote):
        letter = lambda k: np.where(quote + k < n, raw[np.minimum(quote + k, n - 1)], 0) * ~_crosses(text_start, quote, k)
        one, two = letter(1), letter(2)
        single = np.isin(one, list(b"stmd"))
        pair = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        for size, q in ((2, quote[single]), (3, quote[pair & ~single])):
            begin[q + 1] = False
            begin[(q + size)[q + size < n]] = True
    starts = np.flatnonzero(begin)
    return starts, kind[starts] == SPACE


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def _run(path: str, limit: int):
    def run(batches):
        for batch in batches:
            size, n_tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, raw, offsets in T.slices(batch.column("text")):
                size.append(np.diff(offsets))
                n_tokens.append(counter(path).count(raw, offsets))
            n = np.concatenate(n_tokens)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate(size)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row; ``tokenizer`` is a file of such a BPE on each worker."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_run(tokenizer, limit), f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes long, n_tokens long, over_limit boolean")
