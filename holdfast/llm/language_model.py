"""Operator 5: scoring texts by an interpolated modified Kneser-Ney model of word triples.

Counting, in Spark, three times from tasks to shards: words by their hash (the dictionary, which
numbers them), triples by their first two words, and pairs by their first word, whose pairs are dealt over the more
shards the more often it occurs. A shard comes together in a task and is written to the shared folder as flat sorted
arrays; what triples say of pairs, and pairs of words, goes on to the next round. Scoring: workers memory-map the
shards, so that all workers of a machine share one copy in the page cache, and look up by binary search.

With counts c of triples, k(v w) the number of distinct words before a pair, k(w) that before a word, discounts D from the
counts of counts at each level, and each gamma what its level's discounts leave over,

    p(w | u v) = (c(u v w) - D3(c(u v w))) / c(u v) + gamma(u v) * p(w | v)
    p(w | v)   = (k(v w) - D2(k(v w))) / k(v .) + gamma(v) * p(w)
    p(w)       = (k(w) - D1(k(w))) / k(.) + gamma * 1 / (V + 1)

with V training tokens and one for all unknown ones. A text starts behind two implied begin marks and ends with an end
token, which is predicted and counted. The model grows with the corpus: some 5 bytes a distinct triple
and as many for each of its contexts, 5 a pair, 60 a word. Numbers of words are below 2**32, which is checked.

Defined cases: null and empty texts are one end token; without any training text every probability is 1. A file of
the model that has gone is an error.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import fold, materialise, pick, release, shared_dir

#: Hash of the end token, which a word has by a chance of 2**-64.
END = np.uint64(0x5BD1E9955BD1E995)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Kept for each word: as the first of pairs (k(v .), pairs of k 1, 2, more), as the second (k(w)).
_FIELDS = 5
#: Contexts a block of the table of triples, for which the place of the first entry is kept.
_BLOCK = 64
#: Contexts of more entries have their sums stored.
_LONG = 16


def tokens_of(texts: pa.Array):
    """For runs of rows: (first row, token hashes with each text's end token, place of each text's first token)."""
    for lo, hi, raw, offsets in T.slices(texts):
        words, firsts = T.word_hashes(raw, offsets)
        rows = hi - lo
        out = np.empty(len(words) + rows, np.uint64)
        ends = firsts[1:] + np.arange(rows)
        mask = np.ones(len(out), bool)
        mask[ends] = False
        out[mask] = words
        out[ends] = END
        yield lo, out, np.concatenate([[0], ends + 1])


def before(ids: np.ndarray, at: np.ndarray, begin: int) -> np.ndarray:
    """The token before each, or the begin mark."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[at[:-1]] = begin
    return out


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length; sorted ones are given as differences. Bytes of equal weight lie together, and are compressed."""
    planes = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in arrays)
    return np.array([len(arrays[0]), len(planes)], "<u8").tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    k, size = np.frombuffer(block, "<u8", 2).tolist()
    raw, at, out = np.frombuffer(pa.decompress(memoryview(block)[16:], decompressed_size=size, codec="zstd"), np.uint8), 0, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + k * width].reshape(width, k).T).view(kind).ravel())
        at += k * width
    return out


def _differences(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.zeros(1, x.dtype))


def _blocks(to: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(targets, packed rows of each): the rows keep their order within a target."""
    order = np.argsort(to, kind="stable")
    to, arrays = to[order], [x[order] for x in arrays]
    cuts = np.append(_runs(to), len(to))
    return to[cuts[:-1]], [_pack(_differences(arrays[0][a:b]), *(x[a:b] for x in arrays[1:])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _gathered(data: pa.Table, *kinds: str) -> list[np.ndarray]:
    """The rows of all blocks, the first column's differences added up again."""
    parts = [_unpack(b.as_buffer(), *kinds) for b in data.column("block").combine_chunks()]
    for x in parts:
        x[0] = np.cumsum(x[0], dtype=np.uint64)
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _large(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts in a byte each, and places and values of those that are larger."""
    at = np.flatnonzero(n > 255)
    return np.minimum(n, 255).astype(np.uint8), at.astype("<u8"), n[at].astype("<u8")


def _of_large(at: np.ndarray, small: np.ndarray, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    n = small[at].astype(np.int64)
    full = np.flatnonzero(n == 255)
    if len(full) and len(places):
        spot = np.minimum(np.searchsorted(places, at[full].astype(np.uint64)), len(places) - 1)
        n[full] = np.where(places[spot] == at[full].astype(np.uint64), values[spot], 255)
    return n


def _put(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Write arrays one behind the other; a repeated task replaces the file by an equal one."""
    url = urlparse(folder)
    if url.scheme in ("", "file"):
        os.makedirs(url.path, exist_ok=True)
        part = f"{url.path}/.{name}-{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            for x in arrays:
                out.write(np.ascontiguousarray(x).data)
        os.replace(part, f"{url.path}/{name}")
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        for x in arrays:
            out.write(np.ascontiguousarray(x).data)
    store.move(part, f"{path}/{name}")


@lru_cache(maxsize=1)
def _local_copies() -> str:
    return tempfile.mkdtemp(prefix="holdfast-model-")


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str) -> np.ndarray:
    """A file of the model as memory-mapped bytes; from a remote store it is fetched once by each worker."""
    url = urlparse(folder)
    path = f"{url.path}/{name}"
    if url.scheme not in ("", "file"):
        from pyarrow import fs

        store, remote = fs.FileSystem.from_uri(f"{folder}/{name}")
        path = f"{_local_copies()}/{uuid.uuid4().hex}"
        with store.open_input_stream(remote) as src, open(path, "wb") as out:
            shutil.copyfileobj(src, out)
    if os.path.getsize(path) == 0:
        return np.zeros(0, np.uint8)
    return np.memmap(path, np.uint8, "r").view(np.ndarray)


def _kinds(n: np.ndarray) -> list[int]:
    """How many things are counted once, twice, three and four times."""
    return [int((n == j).sum()) for j in (1, 2, 3, 4)]


def _write(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Arrays behind a table of their lengths in bytes, each at a multiple of eight."""
    sizes = np.array([len(arrays), *(x.nbytes for x in arrays)], "<u8")
    padded = [np.frombuffer(np.ascontiguousarray(x).tobytes() + bytes(-x.nbytes % 8), np.uint8) for x in arrays]
    _put(folder, name, sizes, *padded)


@lru_cache(maxsize=4096)
def _arrays(folder: str, name: str, kinds: str) -> tuple[np.ndarray, ...]:
    data = _mapped(folder, name)
    sizes = data[8 : 8 + 8 * int(data[:8].view("<u8")[0])].view("<u8").tolist()
    at, out = 8 + 8 * len(sizes), []
    for size, kind in zip(sizes, kinds.split(), strict=True):
        out.append(data[at : at + size].view(kind))
        at += size + -size % 8
    return tuple(out)


#: Classes of words by the binary logarithm of their counts.
_CLASSES = 48


def _class(counts: np.ndarray) -> np.ndarray:
    """0 for the most frequent words."""
    return _CLASSES - 1 - np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), _CLASSES - 1)


@dataclass(frozen=True)
class Dictionary:
    """Words by number. Frequent words have small numbers, which pack well: a number tells the class of a word's count,
    then its shard by hash, then its place among the shard's words of that class."""

    folder: str
    held: np.ndarray  # [classes, shards] how many words
    tokens: int

    @property
    def words(self) -> int:
        return int(self.held.sum())

    @property
    def shards(self) -> int:
        return self.held.shape[1]

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """[classes, shards] the first number of each, and the first place of each in its shard."""
        flat = self.held.ravel()
        return (np.cumsum(flat) - flat).reshape(self.held.shape), np.cumsum(self.held, axis=0) - self.held

    def shard(self, s: int) -> tuple[np.ndarray, ...]:
        """Sorted hashes, their places in the shard's order of classes, and the counts in that order."""
        return _arrays(self.folder, f"words-{s}", "<u8 <u4 <u8")

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 for unknown ones."""
        first, local = self._tables()
        out = np.full(len(hashes), -1, np.int64)
        for s, mine in _by_shard((hashes % np.uint64(self.shards)).astype(np.int64), self.held.any(axis=0)):
            keys, places, counts = self.shard(s)
            at = np.minimum(np.searchsorted(keys, hashes[mine]), len(keys) - 1)
            place = places[at].astype(np.int64)
            kind = _class(counts[place])
            out[mine] = np.where(keys[at] == hashes[mine], first[kind, s] + place - local[kind, s], -1)
        return out

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, place in it) of each number; the begin mark, the number after all words, is the last shard's last."""
        first, local = self._tables()
        cell = np.searchsorted(first.ravel(), ids, side="right") - 1
        kind, s = np.divmod(cell, self.shards)
        place = local[kind, s] + ids - first[kind, s]
        begin = ids == self.words
        return np.where(begin, self.shards - 1, s), np.where(begin, self.held[:, -1].sum(), place)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often each word occurs; 0 for unknown ones and the begin mark."""
        out = np.zeros(len(ids), np.int64)
        some = np.flatnonzero((ids >= 0) & (ids < self.words))
        to, place = self.places(ids[some])
        for s, mine in _by_shard(to, self.held.any(axis=0)):
            out[some[mine]] = self.shard(s)[2][place[mine]]
        return out


def _count_words(shards: int, most: int = 1 << 20):
    """(shard, block) of a task's words and their counts."""

    def run(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            to, blocks = _blocks((keys % np.uint64(shards)).astype(np.int64), keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "block"])

        for batch in batches:
            for _, tokens, _ in tokens_of(batch.column("text")):
                new, n = np.unique(tokens, return_counts=True)
                keys, counts = _added(np.concatenate([keys, new]), np.concatenate([counts, n]))
                if len(keys) > most:
                    yield out()
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield out()

    return run


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and their sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = _runs(keys)
    return keys[at], np.add.reduceat(n[order], at) if len(at) else n


def _merge_words(folder: str):
    def run(key, data):
        keys, counts = _added(*_gathered(data, "<u8", "<i8"))
        kind = _class(counts)
        order = np.argsort(kind, kind="stable")
        places = np.empty(len(keys), "<u4")
        places[order] = np.arange(len(keys))
        _write(folder, f"words-{key[0].as_py()}", keys, places, counts[order])
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "words": pa.array([np.bincount(kind, minlength=_CLASSES).tolist()], pa.list_(pa.int64())), "tokens": [int(counts.sum())]})

    return run


def dictionary(rows: DataFrame, folder: str, shards: int) -> Dictionary:
    counted = rows.mapInArrow(_count_words(shards), "shard int, block binary").groupBy("shard").applyInArrow(_merge_words(folder), "shard int, words array<long>, tokens long").collect()  # a row a shard
    held = np.zeros((_CLASSES, shards), np.int64)
    for r in counted:
        held[:, r["shard"]] = r["words"]
    if held.sum() >= (1 << 32) - 1:
        raise ValueError("more distinct words than numbers")
    return Dictionary(folder, held, sum(r["tokens"] for r in counted))


def _sorted_triples(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """An order by (context, word): by context first, then within those that stand more than once."""
    order = np.argsort(context)
    own = context[order]
    same = own[1:] == own[:-1]
    again = np.zeros(len(own), bool)
    again[1:] |= same
    again[:-1] |= same
    some = np.flatnonzero(again)
    order[some] = order[some][np.lexsort((word[order[some]], own[some]))]
    return order


def _count_triples(words: Dictionary, shards: int, chunk: int):
    """One row for each chunk and shard: the packed triples (contexts, words, counts)."""
    size = words.words + 1

    def flush(context, word):
        order = _sorted_triples(context, word)
        context, word = context[order], word[order]
        at = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
        n = np.diff(np.append(at, len(word))).astype("<u4")
        context, word = context[at], word[at].astype("<u4")
        to, blocks = _blocks((T.mix(context) % np.uint64(shards)).astype(np.int64), context, word, n)
        return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "block"])

    def run(batches):
        context, word, held = np.empty(chunk, np.uint64), np.empty(chunk, np.uint64), 0
        for batch in batches:
            for _, tokens, at in tokens_of(batch.column("text")):
                kinds, where = np.unique(tokens, return_inverse=True)
                ids = words.ids(kinds)[where]
                one = before(ids, at, words.words)
                both = before(one, at, words.words).astype(np.uint64) * np.uint64(size) + one.astype(np.uint64)
                for a in range(0, len(ids), chunk):  # a very long text may exceed a chunk by itself
                    k = min(chunk, len(ids) - a)
                    if held + k > chunk:
                        yield flush(context[:held], word[:held])
                        held = 0
                    context[held : held + k], word[held : held + k] = both[a : a + k], ids[a : a + k].astype(np.uint64)
                    held += k
        if held:
            yield flush(context[:held], word[:held])

    return run


def _pair_shard(first: np.ndarray, second: np.ndarray, splits: np.ndarray, shards: int) -> np.ndarray:
    part = T.mix(second.astype(np.uint64)) % splits.astype(np.uint64)
    return (T.mix(first.astype(np.uint64) * _STEP + part) % np.uint64(shards)).astype(np.int64)


def _splits(counts: np.ndarray, most: int) -> np.ndarray:
    """Over how many shards a first word's pairs are dealt, by how often it occurs."""
    return counts // most + 1


def _merge_triples(words: Dictionary, folder: str, shards: int, most: int):
    """Add up a shard's triples, store them, and return what they say of pairs."""
    size = np.uint64(words.words + 1)

    def run(key, data):
        context, word, n = _gathered(data, "<u8", "<u4", "<u4")
        order = _sorted_triples(context, word)
        context, word, n = context[order], word[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
        context, word, n = context[at], word[at], np.add.reduceat(n, at)
        starts = _runs(context)
        lens = np.diff(np.append(starts, len(context)))
        small, places, values = _large(n)
        long = np.flatnonzero(lens > _LONG)
        sums = np.stack([np.add.reduceat(x.astype(np.int64), starts)[long] for x in (n, n == 1, n == 2, n > 2)])
        beyond = np.flatnonzero(lens > 255)
        name = f"triples-{key[0].as_py()}"
        _write(folder, name, *_keys(context[starts]), starts[::_BLOCK].astype("<u8"), np.minimum(lens, 255).astype(np.uint8), beyond.astype("<u8"), np.concatenate([[0], np.cumsum(lens[beyond] - 255)]).astype("<i8"), word, small, places, values, long.astype("<u8"), sums.ravel().astype("<i8"))
        pair, k = np.unique((context % size) * size + word, return_counts=True)
        first, second = pair // size, pair % size
        to, blocks = _blocks(_pair_shard(first, second, _splits(words.counts(first.astype(np.int64)), most), shards), pair, k.astype("<u4"))
        rest = len(to) - 1
        return pa.table({"shard": pa.array(to, pa.int32()), "block": pa.array(blocks, pa.binary()), "from": pa.array([key[0].as_py()] + [None] * rest, pa.int32()), "triples": pa.array([_kinds(n)] + [[0] * 4] * rest, pa.list_(pa.int64()))})

    return run


def _keys(sorted_keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted numbers as their upper halves, where each begins, and lower halves; whole where upper halves are many."""
    upper = sorted_keys >> np.uint64(32)
    at = _runs(upper)
    if 16 * len(at) > len(upper):
        return np.zeros(0, "<u8"), np.zeros(0, "<u8"), sorted_keys.astype("<u8")
    return upper[at].astype("<u8"), np.append(at, len(upper)).astype("<u8"), sorted_keys.astype("<u4")


def _find_key(upper: np.ndarray, starts: np.ndarray, keys: np.ndarray, count: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether found) of each wanted number."""
    if not len(upper):
        keys = keys.view("<u8")
        place = np.minimum(np.searchsorted(keys, wanted), count - 1)
        return place, keys[place] == wanted
    high = wanted >> np.uint64(32)
    of = np.minimum(np.searchsorted(upper, high), len(upper) - 1)
    there = upper[of] == high
    start = starts[of].astype(np.int64)
    place, found = _within(keys.view("<u4"), start, np.where(there, starts[of + 1].astype(np.int64), start), wanted.astype(np.uint32))
    return np.minimum(place, count - 1), found


def _merge_pairs(words: Dictionary, folder: str):
    """Add up a shard's pairs, store them, and return what they say of words."""
    size = np.uint64(words.words + 1)

    def run(key, data):
        pair, k = _added(*_gathered(data, "<u8", "<u4"))
        k = k.astype(np.int64)
        first, second = (pair // size).astype(np.int64), (pair % size).astype("<u4")
        starts = _runs(first)
        small, places, values = _large(k)
        _write(folder, f"pairs-{key[0].as_py()}", first[starts].astype("<u4"), np.append(starts, len(first)).astype("<u8"), second, small, places, values)
        sums = np.stack([np.add.reduceat(x.astype(np.int64), starts) for x in (k, k == 1, k == 2, k > 2)])
        kinds, times = np.unique(second, return_counts=True)
        ids = np.union1d(first[starts], kinds.astype(np.int64))
        stats = np.zeros((_FIELDS, len(ids)), np.int64)
        stats[:4, np.searchsorted(ids, first[starts])] = sums
        stats[4, np.searchsorted(ids, kinds)] = times
        to, place = words.places(ids)
        to, blocks = _blocks(to, place.astype(np.uint64), *(x.astype("<u4") if stats.max() < 1 << 32 else x for x in stats))
        rest = len(to) - 1
        triples = np.array(data.column("triples").to_pylist()).sum(axis=0).tolist()
        came = [x for x in data.column("from").to_pylist() if x is not None]
        lists = lambda first, kind: pa.array([first] + [[0] * len(first) if kind == pa.int64() else []] * rest, pa.list_(kind))
        return pa.table({"from": pa.array([key[0].as_py()] * len(to), pa.int32()), "shard": pa.array(to, pa.int32()), "wide": pa.array([bool(stats.max() >= 1 << 32)] * len(to)), "block": pa.array(blocks, pa.binary()), "counts": lists(_kinds(k), pa.int64()), "triples": lists(triples, pa.int64()), "came": lists(came, pa.int32())})

    return run


def _merge_stats(words: Dictionary, folder: str):
    """Add up what all pairs say of a shard's words, store it, and return the totals."""

    def run(key, data):
        s = key[0].as_py()
        stats = np.zeros((_FIELDS, int(words.held[:, s].sum()) + 1), np.int64)  # one more for the begin mark
        for wide, block in zip(data.column("wide").to_pylist(), data.column("block").combine_chunks(), strict=True):
            at, *columns = _unpack(block.as_buffer(), "<u8", *(["<i8" if wide else "<u4"] * _FIELDS))
            at = np.cumsum(at, dtype=np.uint64).astype(np.int64)
            for j, x in enumerate(columns):
                stats[j, at] += x.astype(np.int64)
        _write(folder, f"stats-{s}", stats.ravel().astype("<i8" if stats.max() >= 1 << 31 else "<i4"))
        k = stats[4]
        return pa.table({"shard": pa.array([s], pa.int32()), "pairs": [int(k.sum())], "counts": pa.array([[*_kinds(k), int((k > 2).sum())]], pa.list_(pa.int64()))})

    return run


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many things are counted once to four times; where they can't be told, 1/2."""
    out = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    for j in (1, 2, 3):
        d = j - (j + 1) * y * n[j] / n[j - 1] if n[j - 1] else 0.5
        out.append(min(max(d, 0.05), float(j)))
    return tuple(out)


def _left(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts less their discounts."""
    return np.maximum(n - d[np.minimum(n, 3)], 0)


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, which shards there are, and the totals."""

    dictionary: Dictionary
    folder: str
    triple_shards: np.ndarray  # whether each has any
    pair_shards: np.ndarray
    stat_shards: np.ndarray
    most: int  # a first word's occurrences a shard of its pairs
    pairs: int
    discounts: tuple[tuple[float, ...], ...]  # of triples, pairs and words
    left_over: float

    @property
    def tokens(self) -> int:
        return self.dictionary.tokens

    def stats(self, ids: np.ndarray) -> np.ndarray:
        """[fields, ids] of words' and the begin mark's sums; zeros for unknown ones."""
        out = np.zeros((_FIELDS, len(ids)), np.int64)
        some = np.flatnonzero(ids >= 0)
        to, place = self.dictionary.places(ids[some])
        for s, mine in _by_shard(to, self.stat_shards):
            n = int(self.dictionary.held[:, s].sum()) + 1
            (flat,) = _arrays(self.folder, f"stats-{s}", "u1")
            flat = flat.view("<i8" if len(flat) == 8 * n * _FIELDS else "<i4")
            out[:, some[mine]] = flat.reshape(_FIELDS, n)[:, place[mine]]
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """k of each pair; ``counts``: how often the first word occurs."""
        out = np.zeros(len(first), np.int64)
        to = _pair_shard(first, second, _splits(counts, self.most), len(self.pair_shards))
        for s, mine in _by_shard(to, self.pair_shards):
            names, starts, words, *counts_ = _arrays(self.folder, f"pairs-{s}", "<u4 <u8 <u4 u1 <u8 <u8")
            place = np.minimum(np.searchsorted(names, first[mine].astype(np.uint32)), len(names) - 1)
            mine, place = mine[names[place] == first[mine]], place[names[place] == first[mine]]
            at, found = _within(words, starts[place].astype(np.int64), starts[place + 1].astype(np.int64), second[mine].astype(np.uint32))
            out[mine[found]] = _of_large(at[found], *counts_)
        return out

    def triple_counts(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts of triples, [4, contexts] sums of each context); a ``word`` below 0 is none."""
        out, sums = np.zeros(len(context), np.int64), np.zeros((4, len(context)), np.int64)
        to = (T.mix(context) % np.uint64(len(self.triple_shards))).astype(np.int64)
        for s, mine in _by_shard(to, self.triple_shards):
            upper, begins, keys, bases, lens, beyond, extra, words, small, places, values, long, stored = _arrays(self.folder, f"triples-{s}", "<u8 <u8 u1 <u8 u1 <u8 <i8 <u4 u1 <u8 <u8 <u8 <i8")
            mine = mine[np.argsort(context[mine])]
            place, held = _find_key(upper, begins, keys, len(lens), context[mine])
            mine, place = mine[held], place[held]
            if not len(mine):
                continue
            kinds, where = np.unique(place, return_inverse=True)
            block = kinds // _BLOCK
            start = bases[block].astype(np.int64)
            for j in range(_BLOCK - 1):
                ahead = block * _BLOCK + j
                start += np.where(ahead < kinds, lens[np.minimum(ahead, len(lens) - 1)], 0)
            more = lambda x: extra[np.searchsorted(beyond, x.astype(np.uint64))]
            start += more(kinds) - more(block * _BLOCK)
            stop = start + lens[kinds] + more(kinds + 1) - more(kinds)
            own = np.zeros((4, len(kinds)), np.int64)
            short = np.flatnonzero(stop - start <= _LONG)
            size = (stop - start)[short]
            ends = np.cumsum(size)
            entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[short] - (ends - size), size)
            n = _of_large(entry, small, places, values)
            if len(short):
                own[:, short] = np.stack([np.add.reduceat(x.astype(np.int64), ends - size) for x in (n, n == 1, n == 2, n > 2)])
            rest = np.flatnonzero(stop - start > _LONG)
            own[:, rest] = stored.reshape(4, -1)[:, np.searchsorted(long, kinds[rest].astype(np.uint64))]
            sums[:, mine] = own[:, where]
            ask = np.flatnonzero(word[mine] >= 0)
            at, found = _within(words, start[where[ask]], stop[where[ask]], word[mine[ask]].astype(np.uint32))
            out[mine[ask[found]]] = _of_large(at[found], small, places, values)
        return out, sums

    def score(self, tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, base score, score) of each token."""
        if not self.tokens:
            none = np.zeros(len(tokens))
            return none.astype(bool), none, none
        kinds, where = np.unique(tokens, return_inverse=True)
        begin = self.dictionary.words
        ids = np.append(self.dictionary.ids(kinds), begin)
        count, stats = self.dictionary.counts(ids), self.stats(ids)
        d3, d2, d1 = (np.array([0.0, *x]) for x in self.discounts)
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.dictionary.words + 1)))
        p = (_left(stats[4], d1) / self.pairs + self.left_over / (self.dictionary.words + 1))[where]
        word, one = where, before(where, at, len(kinds))
        two = before(one, at, len(kinds))
        known = ids[word] >= 0
        # pairs
        total = stats[0, one]
        ask = np.flatnonzero(known & (total > 0))
        k = np.zeros(len(tokens), np.int64)
        k[ask] = self.pair_counts(ids[one[ask]], ids[word[ask]], count[one[ask]])
        gamma = np.where(stats[0] > 0, d2[1:] @ stats[1:4] / np.maximum(stats[0], 1), 1.0)[one]
        p = _left(k, d2) / np.maximum(total, 1) + gamma * p
        # triples
        ask = np.flatnonzero((ids[one] >= 0) & (ids[two] >= 0))
        context = ids[two[ask]].astype(np.uint64) * np.uint64(begin + 1) + ids[one[ask]].astype(np.uint64)
        n, sums = self.triple_counts(context, ids[word[ask]])
        there = sums[0] > 0
        p[ask] = np.where(there, _left(n, d3) / np.maximum(sums[0], 1) + d3[1:] @ sums[1:] / np.maximum(sums[0], 1) * p[ask], p[ask])
        return known, base[word], np.log10(p)


def _by_shard(to: np.ndarray, full: np.ndarray):
    order = np.argsort(to, kind="stable")
    cuts = np.append(_runs(to[order]), len(to))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        s = int(to[order[a]])
        if full[s]:
            yield s, order[a:b]


def _within(values: np.ndarray, start: np.ndarray, stop: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether found) of each wanted value in its own sorted range."""
    low, high = start.copy(), stop.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        less = values[mid] < wanted[open_]
        low[open_] = np.where(less, mid + 1, low[open_])
        high[open_] = np.where(less, high[open_], mid)
    found = (low < stop) & (values[np.minimum(low, len(values) - 1)] == wanted)
    return low, found


def train(docs: DataFrame, text_col: str = "text", shard_bytes: int = 8 << 20, chunk: int = 5 << 18, most: int = 1 << 20) -> Model:
    """Count all of ``docs``. The number of shards follows from the bytes of text; a task holds ``chunk`` tokens; a first
    word's pairs go to one shard more for every ``most`` occurrences."""
    rows = pick(docs, text=text_col)
    folder = shared_dir(docs.sparkSession, "language-model")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-size // shard_bytes))
    words = dictionary(rows, folder, max(2, shards // 4))
    none = lambda n: np.zeros(n, bool)
    if not words.tokens:
        return Model(words, folder, none(shards), none(shards), none(1), most, 0, ((0.5,) * 3,) * 3, 1.0)
    kinds = lambda df, column, n: [int(x or 0) for x in df.agg(*[F.sum(F.col(column)[i]) for i in range(n)]).first()]
    full = lambda df, column, n: np.isin(np.arange(n), [r[0] for r in df.select(column).distinct().collect()])  # noqa: E731  a number a shard
    triples = rows.mapInArrow(_count_triples(words, shards, chunk), "shard int, block binary")
    pairs = triples.groupBy("shard").applyInArrow(_merge_triples(words, folder, shards, most), "shard int, block binary, from int, triples array<long>")
    of_words = pairs.groupBy("shard").applyInArrow(_merge_pairs(words, folder), "from int, shard int, wide boolean, block binary, counts array<long>, triples array<long>, came array<int>")
    of_words = materialise(of_words, "language-model-words")
    stats = materialise(of_words.groupBy("shard").applyInArrow(_merge_stats(words, folder), "shard int, pairs long, counts array<long>"), "language-model-stats")
    *once, many = kinds(stats, "counts", 5)
    d = _discounts(kinds(of_words, "triples", 4)), _discounts(kinds(of_words, "counts", 4)), _discounts(once)
    total = stats.agg(F.sum("pairs")).first()[0]
    left_over = (d[2][0] * once[0] + d[2][1] * once[1] + d[2][2] * many) / total
    came = of_words.select(F.explode("came").alias("from"))
    model = Model(words, folder, full(came, "from", shards), full(of_words, "from", shards), full(stats, "shard", words.shards), most, total, d, left_over)
    release(of_words, stats)
    return model


def _score(model: Model, chunk: int):
    def run(batches):
        for batch in batches:
            held, size, rows = [], 0, []

            def flush(held=held, rows=rows):
                tokens = np.concatenate([x for x, _ in held])
                sizes = np.concatenate([np.diff(at) for _, at in held])
                at = np.concatenate([[0], np.cumsum(sizes)])
                known, base, score = model.score(tokens, at)
                rows.append((sizes, *(np.add.reduceat(x, at[:-1]) for x in (known.astype(np.int64), base, score))))

            for _, tokens, at in tokens_of(batch.column("text")):
                held.append((tokens, at))
                size += len(tokens)
                if size >= chunk:
                    flush(held, rows)
                    held, size = [], 0
            if held:
                flush(held, rows)
            if rows:
                sizes, known, base, score = (np.concatenate(x) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), model.tokens)), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text", chunk: int = 1 << 19) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Perplexity: 10 ** (-score / n_tokens)."""
    rows = pick(docs, id=id_col, text=text_col).withColumn("held_out", held_out)
    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(_score(model, chunk), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Learn from the rows whose fold isn't 0, score all rows."""
    model = train(docs.where(fold(docs[id_col], folds) != 0), text_col)
    return score(docs, model, fold(F.col("id"), folds) == 0, id_col, text_col)
