"""Operator 8: sampled segmentations into subword pieces, and their decoding.

All segmentations of a text into pieces of a SentencePiece vocabulary form a lattice. One is drawn in proportion to the
product of its pieces' probabilities (to the power ``alpha``): a forward pass sums the weight of all ways to each place, a
backward pass draws the last piece, then the one before it, and so on. No piece has a space behind another character,
so the lattice falls apart before each run of spaces; the forward pass is made once for each distinct part that a worker
meets and kept in a table, which is emptied when it has many parts or arcs. A text's parts are taken up to 256 KB at a time; a
longer part is gone through in windows, whose forward sums are made again on the way back, so that memory is bounded for any text. Draws depend on the row's key, the part's place and the place in the part
only, so a row's segmentation doesn't depend on where or in which company it is computed.

The vocabulary's merges have ranks in place of probabilities; piece of rank r gets weight 1 / (r + 10), summing to 1.
Characters without a piece become byte pieces. Text isn't normalised, and an underline mark that stands for spaces in
the vocabulary's file is not one in a text, so decoding gives back every text.

Defined cases: null and empty texts have no pieces; rows that repeat a key and text have the same pieces; a null key is 0.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import pick
from .tokens import HashIndex, hash_pieces

_MARK = "▁"
#: Arcs (29 bytes each) that a worker keeps before its table is emptied.
_MOST_ARCS = 1 << 21
#: Bytes of a window of a long part.
_WINDOW = 1 << 16


class Segmenter:
    """The vocabulary, and the lattices of the parts met so far."""

    def __init__(self, path: str, alpha: float, bits: int = 20):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.byte_ids, data, pieces = np.zeros(256, np.int32), [b""] * size, {}
        for i in range(size):
            if model.is_byte(i):
                b = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_ids[b], data[i] = i, bytes([b])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i).replace(_MARK, " ")
                pieces[piece], data[i] = (i, -model.get_score(i)), piece.encode()
        total = sum(1 / (r + 10) for _, r in pieces.values())
        names = sorted(p.encode() for p in pieces)
        known = [pieces[p.decode()] for p in names]
        self.pieces = {p: (i, (1 / (r + 10) / total) ** alpha) for p, (i, r) in pieces.items()}
        sizes = np.array([len(p) for p in names])
        self.lengths = sorted({*sizes.tolist()})
        self.chunk = min(T.SLICE_BYTES, (1 << bits) // 4)
        flat = np.frombuffer(b"".join(names), np.uint8)
        self.vocabulary = HashIndex(17)
        at = self.vocabulary.insert(hash_pieces(flat, np.cumsum(sizes) - sizes, np.cumsum(sizes)))
        self.piece_id, self.weight = np.zeros(1 << 17, np.int32), np.zeros(1 << 17)
        self.piece_id[at] = [i for i, _ in known]
        self.weight[at] = [(1 / (r + 10) / total) ** alpha for _, r in known]
        self.bytes_size = np.array([len(x) for x in data])
        self.bytes_first = np.cumsum(self.bytes_size) - self.bytes_size
        self.bytes_pool = np.frombuffer(b"".join(data), np.uint8)
        self.index = HashIndex(bits)
        self.clear()

    def clear(self) -> None:
        self.index.clear()
        self.base = np.zeros(len(self.index.keys), np.int64)  # by slot: the part's first state
        self.length = np.zeros(len(self.index.keys), np.int32)  # in bytes, as all places are
        self.first = np.zeros(1 << 16, np.int32)  # by state: its first arc; longer pieces come first
        # by arc: cumulative probability in its state, bytes, ids
        self.arcs = [np.zeros(1 << 16), np.zeros(1 << 16, np.int32), np.zeros((1 << 16, 4), np.int32), np.zeros(1 << 16, np.int8)]
        self.n_arcs, self.n_states = 0, 0

    def _arcs(self, raw: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
        """(last byte, bytes, piece or -1 for bytes, weight) of all arcs; ``offset``: how far back a byte's arcs may begin."""
        n = len(raw)
        power, inverse = T.powers(n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
        stop, size, piece, weight = [], [], [], []
        live = np.arange(n)
        for k in self.lengths:
            live = live[offset[live] >= k]
            if not len(live):
                break
            begin = live + 1 - k
            key = T.mix((total[live + 1] - total[begin]) * inverse[begin] + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) | np.uint64(1)
            slot, found = self.vocabulary.find(key)
            stop.append(live[found])
            size.append(np.full(len(stop[-1]), k))
            piece.append(self.piece_id[slot[found]])
            weight.append(self.weight[slot[found]])
        # a character without a piece of its own becomes its bytes
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), n)
        last, wide = lead[1:] - 1, np.diff(lead)
        covered = np.zeros(n, np.int64)
        for s, k in zip(stop, size, strict=True):
            covered[s] |= 1 << np.minimum(k, 8)
        bare = np.flatnonzero((covered[last] >> wide) & 1 == 0)
        stop.append(last[bare])
        size.append(wide[bare])
        piece.append(np.full(len(bare), -1, np.int32))
        weight.append(np.full(len(bare), 1e-9))
        return tuple(map(np.concatenate, (stop, size, piece, weight)))

    def _lattices(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The arcs of all parts, by the place they end at and longer ones first: (first arc of each byte, arcs' columns)."""
        n = len(raw)
        origin = np.repeat(starts, ends - starts)
        offset = np.arange(n) - origin + 1  # bytes of its part up to and with each
        stop, size, piece, weight = self._arcs(raw, offset)
        # forward pass: all parts at once, place by place
        order = np.lexsort((-size, stop, offset[stop]))
        stop, size, piece, weight = stop[order], size[order], piece[order], weight[order]
        ahead = np.zeros(n + 1)  # by the place behind a byte, shared by no two parts
        share, steps = np.empty(len(stop)), np.append(np.flatnonzero(np.diff(offset[stop], prepend=0)), len(stop))
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            into, back = stop[a:b], size[a:b]
            way = np.where(offset[into] == back, 1.0, ahead[into + 1 - back]) * weight[a:b]
            runs = np.flatnonzero(np.diff(into, prepend=-1))
            sums = np.add.reduceat(way, runs)
            of = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, b - a)))
            share[a:b] = np.cumsum(way / sums[of]) - of  # each place's shares sum to 1
            share[a:b][np.append(runs[1:], b - a) - 1] = 1.0
            ends_here = into[runs]
            ahead[ends_here + 1] = sums
            low = ends_here[sums < 1e-150]
            if len(low):  # only ratios of the last places matter
                for k in range(self.lengths[-1] + 1):
                    near = low[offset[low] > k]
                    ahead[near + 1 - k] *= 1e150
        order = np.lexsort((-size, stop))
        stop, size, piece, share = stop[order], size[order], piece[order], share[order]
        ids, count = np.zeros((len(stop), 4), np.int32), np.ones(len(stop), np.int8)
        ids[:, 0] = piece
        bare = np.flatnonzero(piece < 0)
        count[bare] = size[bare]
        for j in range(4):
            some = bare[size[bare] > j]
            ids[some, j] = self.byte_ids[raw[stop[some] + 1 - size[some] + j]]
        return np.searchsorted(stop, np.arange(n)), [share, size, ids, count]

    def _learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        lens = ends - starts
        firsts = np.cumsum(lens) - lens
        own = raw[np.arange(lens.sum()) + np.repeat(starts - firsts, lens)]
        arc_of, arcs = self._lattices(own, firsts, firsts + lens)
        slots = self.index.insert(keys)
        self.base[slots], self.length[slots] = self.n_states + firsts, lens
        while self.n_states + len(own) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.first[self.n_states : self.n_states + len(own)] = self.n_arcs + arc_of
        self.n_states += len(own)
        k = len(arcs[0])
        for j, x in enumerate(arcs):
            while self.n_arcs + k > len(self.arcs[j]):
                self.arcs[j] = np.concatenate([self.arcs[j], np.zeros_like(self.arcs[j])])
            self.arcs[j][self.n_arcs : self.n_arcs + k] = x
        self.n_arcs += k

    def sample(self, raw: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and the total)."""
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        space = raw == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[offsets[:-1][offsets[:-1] < len(raw)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(raw))
        firsts = np.searchsorted(starts, offsets)
        # one random stream for each part: by the row's seed and the part's number in the row
        count = np.diff(firsts)
        stream = T.mix(np.repeat(seeds, count) + (np.arange(len(starts)) - np.repeat(firsts[:-1], count)).astype(np.uint64))
        total, out, a = np.zeros(len(starts), np.int64), [], 0
        while a < len(starts):
            b = int(np.searchsorted(ends, starts[a] + self.chunk, side="right"))
            if b > a:
                ids, total[a:b] = self._sample_parts(raw[starts[a] : ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a], stream[a:b])
            else:
                b = a + 1
                ids = self._sample_long(raw[starts[a] : ends[a]], stream[a:b])
                total[a] = len(ids)
            out.append(ids)
            a = b
        return np.concatenate(out), np.concatenate([[0], np.cumsum(total)])[firsts]

    def _sample_parts(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of adjacent parts in a row, how many each has)."""
        keys = hash_pieces(raw, starts, ends)
        slots, found = self.index.find(keys)
        if not found.all():
            where = np.flatnonzero(~found)
            new, first = np.unique(keys[where], return_index=True)
            where = where[first]
            if self.index.held + len(new) > len(self.index.keys) // 3 or self.n_arcs > _MOST_ARCS:
                self.clear()
                new, where = np.unique(keys, return_index=True)
            self._learn(new, raw, starts[where], ends[where])
            slots, _ = self.index.find(keys)
        base, place = self.base[slots], self.length[slots].astype(np.int64)
        cdf, back, _, size = (x[: self.n_arcs] for x in self.arcs)
        drawn, live, total = [], np.arange(len(starts)), np.zeros(len(starts), np.int64)
        while len(live):
            state = base[live] + place[live] - 1
            r = _draws(stream[live], place[live])
            arc = self.first[state]
            on = np.flatnonzero(cdf[arc] <= r)
            while len(on):
                arc[on] += 1
                on = on[cdf[arc[on]] <= r[on]]
            drawn.append((live, arc))
            total[live] += size[arc]
            place[live] -= back[arc]
            live = live[place[live] > 0]
        stop = np.cumsum(total)
        out = np.empty(int(stop[-1]), np.int32)
        at = stop.copy()
        for who, arc in drawn:
            n = size[arc]
            at[who] -= n
            for j in range(int(n.max())):
                some = n > j if j else slice(None)
                out[at[who[some]] + j] = self.arcs[2][arc[some], j]
        return out, total

    def _sample_long(self, raw: np.ndarray, stream: np.ndarray) -> np.ndarray:
        """The ids of one long part. Forward sums are kept where windows begin, for as many places as a piece is long."""
        reach = self.lengths[-1]
        marks, ahead = [], [0.0] * (reach - 1) + [1.0]  # of the places up to and with the window's begin
        for lo in range(0, len(raw), _WINDOW):
            marks.append(ahead)
            *_, sums = self._window(raw, lo, ahead)
            ahead = sums[-reach:]
        place, out = len(raw), []
        for lo in range(len(marks) - 1, -1, -1):
            lo *= _WINDOW
            first, size, piece, share, _ = self._window(raw, lo, marks.pop())
            hi = min(lo + _WINDOW, len(raw))
            draw = _draws(np.repeat(stream, hi - lo), np.arange(lo + 1, hi + 1)).tolist()
            ids = []
            while place > lo:
                arc = first[place - lo - 1]
                while share[arc] <= draw[place - lo - 1]:
                    arc += 1
                k = size[arc]
                ids += [piece[arc]] if piece[arc] >= 0 else self.byte_ids[raw[place - k : place]][::-1].tolist()
                place -= k
            out.append(np.array(ids, np.int32)[::-1])
        return np.concatenate(out[::-1])

    def _window(self, raw: np.ndarray, lo: int, ahead: list[float]) -> tuple[list, ...]:
        """Of a window that begins at ``lo``: each place's first arc, the arcs' bytes, pieces and cumulative shares, and the forward sums of ``ahead`` and all places."""
        hi = min(lo + _WINDOW, len(raw))
        reach = len(ahead)
        left = max(0, lo - reach - 4)
        left += int(np.argmax((raw[left : lo + 1] & 0xC0) != 0x80)) if left else 0
        right = min(len(raw), hi + 4)
        stop, size, piece, weight = self._arcs(raw[left:right], np.arange(1, right - left + 1))
        stop = stop + left - lo
        order = np.lexsort((-size, stop))
        order = order[(stop[order] >= 0) & (stop[order] < hi - lo) & (size[order] <= stop[order] + lo + 1)]
        size, piece, weight = (x[order].tolist() for x in (size, piece, weight))
        first = np.searchsorted(stop[order], np.arange(hi - lo + 1)).tolist()
        sums, share = list(ahead), []
        for at in range(hi - lo):
            x, own = 0.0, []
            for arc in range(first[at], first[at + 1]):
                x += sums[at + reach - size[arc]] * weight[arc]
                own.append(x)
            sums.append(x)
            if own:
                share += [y / x for y in own[:-1]] + [1.0] if x else [1.0] * len(own)
            if 0 < x < 1e-150:  # only ratios of the last places matter
                for k in range(reach):
                    sums[at + reach - k] *= 1e150
        return first, size, piece, share, sums

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The UTF-8 bytes of a row of ids."""
        size = self.bytes_size[ids]
        stop = np.cumsum(size)
        return self.bytes_pool[np.arange(stop[-1] if len(ids) else 0) + np.repeat(self.bytes_first[ids] - (stop - size), size)]


def _draws(stream: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (T.mix(stream + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53


@lru_cache(maxsize=4)
def segmenter(path: str, alpha: float) -> Segmenter:
    return Segmenter(path, alpha)


def _sampled(path: str, alpha: float, seed: int):
    """(first row, end row, bytes, offsets, ids, where each row's ids begin) for runs of rows."""

    def run(batch):
        known = segmenter(path, alpha)
        keys = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        seeds = T.mix(keys * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(seed))
        for lo, hi, raw, offsets in T.slices(batch.column("text")):
            ids, at = known.sample(raw, offsets, seeds[lo:hi])
            yield lo, hi, raw, offsets, ids, at

    return run


def encode(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): a sampled segmentation of each row; ``model`` is a vocabulary file on each worker."""
    sampled = _sampled(model, alpha, seed)

    def run(batches):
        for batch in batches:
            flat, at = [], [np.zeros(1, np.int64)]
            for *_, ids, cuts in sampled(batch):
                flat.append(ids)
                at.append(cuts[1:] + at[-1][-1])
            if flat:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(np.concatenate(at), pa.int32()), pa.array(np.concatenate(flat)))], ["doc_id", "ids"])

    return pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""

    def run(batches):
        known = segmenter(model, 1.0)
        for batch in batches:
            texts = [None if x is None else known.decode(np.array(x, np.int64)).tobytes().decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, ids_crc32 (unsigned, of little-endian unsigned 32-bit ids), decoded_sha256, lossless."""
    import hashlib

    sampled = _sampled(model, alpha, seed)

    def run(batches):
        for batch in batches:
            known = segmenter(model, alpha)
            n, crc, sha, same = [], [], [], []
            for lo, hi, raw, offsets, ids, at in sampled(batch):
                packed, back, source = ids.astype("<u4").tobytes(), known.decode(ids).tobytes(), raw.tobytes()
                sizes = np.concatenate([[0], np.cumsum(known.bytes_size[ids])])[at]
                for k in range(hi - lo):
                    text = back[sizes[k] : sizes[k + 1]]
                    n.append(int(at[k + 1] - at[k]))
                    crc.append(zlib.crc32(packed[4 * at[k] : 4 * at[k + 1]]))
                    sha.append(hashlib.sha256(text).hexdigest())
                    same.append(text == source[offsets[k] : offsets[k + 1]])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"])

    return pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long")).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean")
