"""Operator 3: documents that share most of their word n-grams.

A document's set holds the 64-bit hashes of its distinct word n-grams (lower-cased A-Z, words between
ASCII white space; a document of fewer words has its whole sequence as one n-gram, one without words has none).
Two documents link when the Jaccard similarity of their sets reaches ``threshold``, a ratio of integers.

The method is a prefix-filtered set join:

1. One pass gives each document's set size and the hash of its set, and counts all n-grams of the corpus in a table of
   fixed size by hash. (count, hash) is a total order of n-grams, rare ones first, whatever collides in the table.
2. Documents of equal sets form one class, named by the set's hash; from here on there is one row per class.
3. Each class sends its prefix, the rarest ``n - ceil(t * n) + 1`` n-grams. Linked classes share at least one.
4. First the classes of each n-gram are compared with its two lead classes only, so large groups of near copies
   come together with a number of pairs in proportion to their size. Connected components follow. Two rounds more compare
   neighbours in a random order of each n-gram's classes, where components still differ.
5. Then every pair of classes that shares a prefix n-gram and lies in *different* components is a candidate. A pair is
   made at the first n-gram that both prefixes share: the positional filter counts nothing before the n-gram at hand,
   and where both classes have the same shared n-gram just before it, that one has made the pair already. Pairs inside
   a component need no look: they can't change the result. So only n-grams of several components are joined, and there
   the classes outside the largest component with all others; the join itself holds the suffix filter, so that a large
   group and the texts beside it that don't link with it make no rows.
6. Candidates pass a suffix filter, a lower bound of the sets' Hamming distance from the parities of their n-grams by
   hash; each of those left is verified once, in full.
7. Where links are asked for, all pairs of classes inside each component are compared, exactly. A component's classes
   are split by size and hash into blocks of bounded size; a task compares two blocks at a time. Linked classes are always
   of one component and of the same or neighbouring size groups, so no link is lost.

Defined cases: null or blank texts have no set, link with nothing and are their own component; rows that repeat
a document id count as one document: all that any of its rows links with is of its component; a null id takes part in
links, and is nobody's smallest id. Ids are integers or null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import materialise, pick, release
from .components import connected, extended

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
#: Words of 64 parities that pairs are compared by before whole sets are: a bit tells whether an odd number of a set's
#: n-grams fall to it. Two sets differ in as many n-grams as their parities do, at least.
_WIDE = 64
#: Words that the parities are folded to where they travel with postings.
_NARROW = 16
#: Pairs whose texts are verified at once.
_AT_ONCE = 32


def sets_of(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: (first row, the distinct n-gram hashes of all rows, sorted per row, and each row's first)."""
    for lo, hi, raw, offsets in T.slices(texts):
        words, firsts = T.word_hashes(raw, offsets)
        counts = np.diff(firsts)
        grams = np.zeros(len(words), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(min(n, len(words))):
                grams[: len(words) - j] = T.mix(grams[: len(words) - j] * _STEP + words[j:])
        each = []
        for k in range(hi - lo):
            a, b = firsts[k], firsts[k + 1]
            if counts[k] >= n:
                each.append(np.unique(grams[a : b - n + 1]))
            elif counts[k]:
                h = np.zeros(1, np.uint64)
                for w in words[a:b]:
                    h = T.mix(h * _STEP + w)
                each.append(T.mix(h + np.uint64(counts[k])))
            else:
                each.append(np.zeros(0, np.uint64))
        yield lo, np.concatenate(each), np.cumsum([0, *map(len, each)])


def set_hashes(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each sorted set; 0 for the empty one."""
    size = np.diff(at)
    out = np.zeros(len(size), np.uint64)
    full = np.flatnonzero(size)
    if len(full):
        with np.errstate(over="ignore"):
            place = np.arange(len(flat)) - np.repeat(at[:-1], size)
            out[full] = T.mix(np.add.reduceat(T.mix(flat + place.astype(np.uint64) * _STEP), at[:-1][full]) * _STEP + size[full].astype(np.uint64))
    return out


def _nodes(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """The classes' names, below zero so that no document's id is one; null for empty sets."""
    hashes = set_hashes(flat, at)
    return pa.array((hashes | np.uint64(1 << 63)).view(np.int64), mask=np.diff(at) == 0)


_PROFILE = "id long, size long, node long, block int, counts binary"


def _profile(n: int, bits: int):
    """Rows of documents, and at each task's end its counts of n-grams by hash, in blocks."""

    def run(batches):
        counts = np.zeros(1 << bits, np.uint32)  # a task would need 2**32 n-grams of one place to fill it
        for batch in batches:
            sizes, nodes = [], []
            for _, flat, at in sets_of(batch.column("text"), n):
                places, times = np.unique((flat >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
                counts[places] += times.astype(np.uint32)
                sizes.append(np.diff(at))
                nodes.append(_nodes(flat, at))
            if not sizes:
                continue
            k = len(batch)
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(np.concatenate(sizes), pa.int64()), pa.concat_arrays(nodes), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], ["id", "size", "node", "block", "counts"])
        blocks = counts.reshape(-1, 1 << min(bits, 14))
        full = [i for i in range(len(blocks)) if blocks[i].any()]
        if full:
            none = pa.nulls(len(full), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(full, pa.int32()), pa.array([_packed(blocks[i]) for i in full], pa.binary())], ["id", "size", "node", "block", "counts"])

    return run


def _parities(flat: np.ndarray, at: np.ndarray, words: int = _WIDE) -> np.ndarray:
    bits = 64 * words
    size = np.diff(at)
    place = np.repeat(np.arange(len(size)), size) * bits + (flat % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits * len(size)) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").reshape(len(size), words)


def _packed(counts: np.ndarray) -> bytes:
    """Counts as the smallest of four integer types, named by the first byte."""
    kind = next(k for k, top in ((1, 1 << 8), (2, 1 << 16), (4, 1 << 32), (8, 1 << 63)) if counts.max() < top)
    return bytes([kind]) + counts.astype(f"<u{kind}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


def _add_blocks(batches):
    """One row for each block that a task holds: partial sums, for a further round by block."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            sums[block] = sums.get(block, 0) + _unpacked(data)
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([_packed(x) for x in sums.values()], pa.binary())], ["block", "counts"])


def gram_counts(profile: DataFrame, bits: int) -> np.ndarray:
    """The table of counts by hash: 2**bits entries, whatever the size of the corpus."""
    blocks = max(1, (1 << bits) >> 14)
    parts = profile.where("block is not null").select("block", "counts").repartition("block").mapInArrow(_add_blocks, "block int, counts binary")
    out = np.zeros((blocks, (1 << bits) // blocks), np.uint32)
    for row in parts.collect():  # 2**bits counts at most; each block once
        counts = _unpacked(bytes(row["counts"]))
        if out.itemsize == 4 and counts.max() >= 1 << 32:
            out = out.astype(np.int64)
        out[row["block"]] = counts
    return out.ravel()


def _prefixes(n: int, num: int, den: int, bits: int, counts, usual: int, hot: int, remembered: int = 1 << 16):
    """For each class: its prefix n-grams with their places. salt: one of the groups of a frequent n-gram, else -1.

    Of rows with equal sets a task sends one, as far as it remembers; the rest are dropped where the n-gram's rows meet.
    """

    def run(batches):
        table, sent = counts.value, set()
        for batch in batches:
            for _, flat, at in sets_of(batch.column("text"), n):
                names = set_hashes(flat, at) | np.uint64(1 << 63)
                fresh = np.zeros(len(names), bool)
                for k, name in enumerate(names.tolist()):
                    if at[k] < at[k + 1] and name not in sent:
                        fresh[k] = True
                        sent.add(name)
                if len(sent) > remembered:
                    sent.clear()
                size = np.diff(at)
                flat = flat[np.repeat(fresh, size)]
                names, size = names[fresh].view(np.int64), size[fresh]
                first = np.cumsum(size) - size
                often = table[(flat >> np.uint64(64 - bits)).astype(np.int64)]
                doc = np.repeat(np.arange(len(size)), size)
                order = np.lexsort((flat, often, doc))
                place = np.arange(len(flat)) - np.repeat(first, size)
                keep = place < np.repeat(size - -(-num * size // den) + 1, size)
                chosen = order[keep]
                owner = names[doc[chosen]]
                deal = np.maximum(0, often[chosen].astype(np.int64) - usual) // hot
                salt = np.where(deal > 0, (T.mix(owner.view(np.uint64)) % (1 + deal).astype(np.uint64)).astype(np.int64), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[chosen].view(np.int64)), pa.array(owner), pa.array(size[doc[chosen]], pa.int32()), pa.array(place[keep], pa.int32()), pa.array(salt.astype(np.int32))],
                    ["gram", "node", "size", "place", "salt"],
                )

    return run


def _with_nodes(n: int):
    def run(batches):
        for batch in batches:
            nodes = [_nodes(flat, at) for _, flat, at in sets_of(batch.column("text"), n)]
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(nodes), batch.column("text")], ["node", "text"])

    return run


def _thin(n: int):
    """Each class's size and parities, whole and folded."""

    def run(batches):
        for batch in batches:
            sizes, wide, narrow = [], [], []
            for _, flat, at in sets_of(batch.column("text"), n):
                sizes.append(np.diff(at))
                for lo in range(0, len(at) - 1, 256):
                    some = at[lo : lo + 257]
                    odd = _parities(flat[some[0] : some[-1]], some - some[0])
                    wide += [x.tobytes() for x in odd]
                    narrow += np.bitwise_xor.reduce(odd.reshape(len(odd), -1, _NARROW), axis=1).tolist()
            if sizes:
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(np.concatenate(sizes), pa.int64()), pa.array(wide, pa.binary()), pa.array(narrow, pa.list_(pa.int64()))], ["node", "size", "wide", "narrow"])

    return run


def _near(num: int, den: int):
    """Suffix filter: the pairs that their sets' parities allow."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(batch), _WIDE) for c in ("a_wide", "b_wide"))
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            both = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(differ <= both - 2 * -(-num * both // (num + den)), pa.bool_()))

    return run


def _sets(nodes: np.ndarray, texts: pa.Array, n: int) -> dict[int, np.ndarray]:
    """The set of each distinct node."""
    nodes, first = np.unique(nodes, return_index=True)
    out = {}
    for lo, flat, at in sets_of(texts.take(pa.array(first)), n):
        out |= {int(nodes[lo + k]): flat[at[k] : at[k + 1]] for k in range(len(at) - 1)}
    return out


def _verify(n: int, num: int, den: int):
    """Exact comparison of the pairs' sets."""

    def run(batches):
        for whole in batches:
            for lo in range(0, len(whole), _AT_ONCE):
                batch = whole.slice(lo, _AT_ONCE)
                a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
                left, right = _sets(a, batch.column("a_text"), n), _sets(b, batch.column("b_text"), n)
                keep = []
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    x, y = left[i], right[j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * both >= num * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Groups(NamedTuple):
    rows: DataFrame  #: id, size, node of each row, and home: the node that names the row's component
    classes: DataFrame  #: node, size, first (its smallest id that has no other set)
    parts: DataFrame  #: node, part of the classes that have a link, but those that name their part
    components: DataFrame  #: node, class_id, component


class _Join:
    """The steps of one join over the rows (id, text)."""

    def __init__(self, rows: DataFrame, n: int, num: int, den: int, bits: int, hot: int, small_ids: int, rounds: int = 2):
        self.rows, self.n, self.num, self.den, self.bits, self.hot, self.small_ids, self.rounds = rows, n, num, den, bits, hot, small_ids, rounds

    def few(self, df: DataFrame, k: int) -> DataFrame:
        """Marked for a broadcast where its ``k`` rows are within the bound."""
        return F.broadcast(df) if k <= self.small_ids else df

    def classify(self) -> None:
        """Reads all texts: rows, the table of counts, ids with several sets, classes."""
        self.profile = materialise(self.rows.mapInArrow(_profile(self.n, self.bits), _PROFILE), "jaccard-profile")
        self.counts = gram_counts(self.profile, self.bits)
        rows = self.profile.where("block is null").select("id", "size", "node")
        by_id = rows.where("id is not null").groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("node").alias("full"), F.count("*").alias("k"))
        self.repeats = materialise(by_id.where("lo < hi or full between 1 and k - 1").select("id", "lo"), "jaccard-repeats")
        k = self.repeats.count()
        self.several = k > 0
        self.repeats = self.few(self.repeats, k)
        if self.several:
            rows = rows.join(self.repeats, "id", "left").select("id", "size", "node", F.coalesce("node", "lo").alias("home"), "lo")
        else:
            rows = rows.select("id", "size", "node", F.col("node").alias("home"), F.lit(None).cast("long").alias("lo"))
        self.of_row = rows
        own = F.when(F.col("lo").isNull(), F.col("id"))
        self.classes = materialise(rows.where("node is not null").groupBy("node").agg(F.max("size").alias("size"), F.min(own).alias("first"), F.min("id").alias("least")), "jaccard-classes")
        self.unnamed = not self.classes.where("first is null").isEmpty()

    def texts(self, nodes: DataFrame, k: int) -> DataFrame:
        """(node, text) of the ``k`` classes in ``nodes`` (node), once or more often each."""
        wanted = self.classes.join(self.few(nodes, k), "node", "left_semi")
        named = self.rows.join(self.few(wanted.where("first is not null").select(F.col("first").alias("id"), "node"), k), "id").select("node", "text")
        if not self.unnamed:
            return named
        rest = self.rows.join(self.repeats.select("id"), "id", "left_semi").unionByName(self.rows.where("id is null")) if self.several else self.rows.where("id is null")
        rest = rest.select("text").mapInArrow(_with_nodes(self.n), "node long, text string").join(self.few(wanted.where("first is null").select("node"), k), "node", "left_semi")
        return named.unionByName(rest)

    def one_text(self, nodes: DataFrame, k: int) -> DataFrame:
        return self.texts(nodes, k).groupBy("node").agg(F.first("text").alias("text"))

    def thin(self, nodes: DataFrame, k: int) -> DataFrame:
        """(node, size, wide, narrow) of the ``k`` classes in ``nodes`` (node)."""
        each = self.texts(nodes, k).mapInArrow(_thin(self.n), "node long, size long, wide binary, narrow array<long>")
        return each.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "wide", "narrow")])

    def verified(self, pairs: DataFrame, thin: DataFrame | None = None) -> DataFrame | None:
        """The pairs (a, b) that link, None where none does; only the texts of classes in some pair are read. ``thin``: of their classes, where known."""
        pairs = materialise(pairs.distinct(), "jaccard-pairs")
        ends = materialise(_ends(pairs), "jaccard-ends")
        held, out = [pairs, ends], None
        if k := ends.count():
            thin = self.thin(ends, k) if thin is None else thin
            of = lambda s: thin.select(F.col("node").alias(s), F.col("size").alias(f"{s}_size"), F.col("wide").alias(f"{s}_wide"))
            near = materialise(pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(_near(self.num, self.den), "a long, b long"), "jaccard-near")
            near_ends = materialise(_ends(near), "jaccard-ends")
            held += [near, near_ends]
            if k := near_ends.count():
                text = self.one_text(near_ends, k)
                of = lambda s: text.select(F.col("node").alias(s), F.col("text").alias(f"{s}_text"))
                out = materialise(near.join(of("a"), "a").join(of("b"), "b").mapInArrow(_verify(self.n, self.num, self.den), "a long, b long"), "jaccard-links")
        release(*held)
        return None if out is None or out.isEmpty() else out

    def possible(self, x: str, y: str, ahead):
        """Length and positional filter of two postings that share an n-gram; ``ahead``: how many they may share before it."""
        c = lambda s, k: F.col(f"{s}.{k}").cast("long")
        need = F.ceil(self.num * (c(x, "size") + c(y, "size")) / (self.num + self.den))
        rest = F.least(c(x, "size") - c(x, "place"), c(y, "size") - c(y, "place"))
        return (self.den * c(x, "size") >= self.num * c(y, "size")) & (self.den * c(y, "size") >= self.num * c(x, "size")) & (rest + ahead >= need)

    def shared_postings(self) -> DataFrame:
        """The postings of n-grams that more than one class has, with the group's lead and the posting before."""
        table = self.rows.sparkSession.sparkContext.broadcast(self.counts)
        usual = 2 * int(self.counts.mean())
        self.counts = None
        posts = self.rows.select("text").mapInArrow(_prefixes(self.n, self.num, self.den, self.bits, table, usual, self.hot), "gram long, node long, size int, place int, salt int")
        group = Window.partitionBy("gram", "salt").orderBy("size", "node")
        posts = posts.withColumn("before", F.lag("node").over(group)).where("before is null or before <> node").drop("before")
        whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        me = F.struct("size", "node", "place")
        posts = posts.withColumn("n_posts", F.count("*").over(whole)).withColumn("lead", F.first(me).over(whole)).withColumn("prev", F.lag(me).over(group))
        out = materialise(posts.where("n_posts > 1 or salt >= 0").withColumn("more", F.expr("n_posts > 3 or salt >= 0")).drop("n_posts"), "jaccard-postings")
        table.destroy()
        return out

    def star_pairs(self, posts: DataFrame) -> DataFrame:
        """Each posting with its group's lead and the one before; a group of a frequent n-gram by its lead with the n-gram's first."""
        me = F.struct("size", "node", "place")
        leads = posts.where("salt >= 0").groupBy("gram", "salt").agg(F.min("lead").alias("lead"))
        top = leads.groupBy("gram").agg(F.min("lead").alias("top"))
        stars = posts.select(me.alias("x"), F.explode(F.array("lead", "prev")).alias("y")).unionByName(leads.join(top, "gram").select(F.col("lead").alias("x"), F.col("top").alias("y")))
        return _pair(stars.where(F.col("x.node") != F.col("y.node")).where(self.possible("x", "y", F.least("x.place", "y.place").cast("long"))))

    def neighbour_pairs(self, posts: DataFrame, parts: DataFrame, seed: int) -> DataFrame:
        """Neighbours in a random order of each n-gram's classes, where their components differ."""
        me = F.struct("size", "node", "place", "part")
        near = posts.join(self.few(parts, parts.count()), "node", "left").withColumn("part", F.coalesce("part", "node"))
        near = near.select(me.alias("x"), F.lag(me).over(Window.partitionBy("gram", "salt").orderBy(F.xxhash64("node", "gram", F.lit(seed)), "node")).alias("y"))
        return _pair(near.where(F.col("x.part") != F.col("y.part")).where(self.possible("x", "y", F.least("x.place", "y.place").cast("long"))))

    def open_postings(self, posts: DataFrame, parts: DataFrame) -> DataFrame:
        """The postings of n-grams whose classes are of several components, with the class's (part), the n-gram's largest (main) and the class's n-gram before."""
        at = posts.select("gram", "node", "size", "place").withColumn("pred", F.lag("gram").over(Window.partitionBy("node").orderBy("place")))
        at = at.join(self.few(parts, parts.count()), "node", "left").withColumn("part", F.coalesce("part", "node"))
        mains = at.groupBy("gram", "part").agg(F.count("*").alias("k")).groupBy("gram").agg(F.sum("k").alias("k"), F.max(F.struct("k", "part")).alias("main"))
        return materialise(at.join(mains.where("k > main.k").select("gram", F.col("main.part").alias("main")), "gram"), "jaccard-open")

    def cross_pairs(self, at: DataFrame, thin: DataFrame) -> DataFrame:
        """Pairs of classes in different components that parities allow, made at the first n-gram that both prefixes share."""
        at = at.join(thin.select("node", "narrow"), "node")
        first = F.coalesce(F.col("x.pred") != F.col("y.pred"), F.lit(True))
        once = (F.col("x.part") != F.col("y.part")) & ((F.col("y.part") == F.col("y.main")) | (F.col("x.part") < F.col("y.part")))
        differ = reduce(add, [F.bit_count(F.col("x.narrow")[i].bitwiseXOR(F.col("y.narrow")[i])) for i in range(_NARROW)])
        both = F.col("x.size").cast("long") + F.col("y.size")
        near = differ <= both - 2 * F.ceil(self.num * both / (self.num + self.den))
        cross = (F.col("x.gram") == F.col("y.gram")) & once & first & self.possible("x", "y", F.lit(0)) & near
        return _pair(at.where("part <> main").alias("x").join(at.alias("y"), cross))

    def crossed(self, posts: DataFrame, parts: DataFrame) -> DataFrame | None:
        """The links between components."""
        at = self.open_postings(posts, parts)
        nodes = materialise(at.select("node").distinct(), "jaccard-open-nodes")
        held, out = [at, nodes], None
        if k := nodes.count():
            thin = materialise(self.thin(nodes, k), "jaccard-thin")
            held.append(thin)
            out = self.verified(self.cross_pairs(at, thin), thin)
        release(*held)
        return out

    def grouped(self) -> _Groups:
        self.classify()
        posts = self.shared_postings()
        links = self.verified(self.star_pairs(posts))
        if self.several:  # rows of one id are of one component
            same = self.of_row.where("lo is not null and node is not null").select(F.col("lo").alias("a"), F.col("node").alias("b")).where("a <> b")
            links = same if links is None else links.unionByName(same)
        # of n-grams with up to three classes all pairs are compared by now
        rest = materialise(posts.where("more").select("gram", "node", "size", "place", "salt"), "jaccard-rest")
        release(posts)
        parts = connected(self.rows.sparkSession.createDataFrame([], "a long, b long") if links is None else links)
        for seed in range(self.rounds):
            if (more := self.verified(self.neighbour_pairs(rest, parts, seed))) is not None:
                parts = extended(parts, more)
        if (more := self.crossed(rest, parts)) is not None:
            parts = extended(parts, more)
        release(rest)
        of_class = self.classes.join(parts, "node", "left").select("node", "first", "least", F.coalesce("part", "node").alias("part"))
        smallest = of_class.groupBy("part").agg(F.min("least").alias("component"))
        of_class = of_class.join(smallest, "part").select("node", F.coalesce("first", "node").alias("class_id"), "component")
        return _Groups(self.of_row, self.classes, parts, materialise(of_class, "jaccard-components"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _pair(df: DataFrame) -> DataFrame:
    return df.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, bits: int = 22, hot: int = 20000, small_ids: int = 200_000) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of each row; ``num / den`` is the least similarity.

    class_id is the smallest id of the documents with the same set (a number below zero where only null ids, or ids
    with several sets, have it), null without a set. ``bits``: log2 of the table of counts, which alone is sent to the
    driver and broadcast (16 MB at 22). ``hot``: counted occurrences of an n-gram per group of its postings.
    ``small_ids``: most ids to broadcast (3 MB); more are joined by a shuffle.
    """
    groups = _Join(pick(docs, id=id_col, text=text_col), n, num, den, bits, hot, small_ids).grouped()
    return groups.rows.join(groups.components.withColumnRenamed("node", "home"), "home", "left").select(*_columns())


def _columns() -> list:
    return [F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.when(F.col("home").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"), F.when(F.col("size") > 0, F.col("class_id")).alias("class_id")]


def with_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, bits: int = 22, hot: int = 20000, small_ids: int = 200_000, block: int = 512) -> DataFrame:
    """The columns of similar_groups and ``n_links``: with how many other documents each one links, of its own class too.

    Rows without an id count one by one; an id with several texts counts once for each. ``block``: classes of a component that are compared at a time.
    """
    join = _Join(pick(docs, id=id_col, text=text_col), n, num, den, bits, hot, small_ids)
    groups = join.grouped()
    weights = materialise(groups.rows.where("size > 0").groupBy("node").agg((F.count_distinct("id") + F.count_if(F.col("id").isNull())).alias("weight")), "jaccard-weights")
    two, more = _linked(join, groups, weights, block, False)
    counts = two.select(F.explode(F.array(F.struct("lo.node", F.col("hi.weight").alias("n")), F.struct("hi.node", F.col("lo.weight").alias("n")))).alias("x")).select("x.*").unionByName(more)
    others = weights.join(counts.groupBy("node").agg(F.sum("n").alias("n")), "node", "left").select(F.col("node").alias("own"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("others"))
    found = groups.components.join(others, F.col("node") == F.col("own")).select(F.col("node").alias("home"), "class_id", "component", "others")
    return groups.rows.join(found, "home", "left").select(*_columns(), F.when(F.col("size") > 0, F.col("others")).otherwise(0).cast("long").alias("n_links"))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, bits: int = 22, hot: int = 20000, small_ids: int = 200_000, block: int = 512) -> DataFrame:
    """(class_a, class_b): all links between different texts, by the class_id of similar_groups, the smaller first.

    Documents of one class link with each other and share their class's links, so these pairs and class_id hold every link.
    """
    join = _Join(pick(docs, id=id_col, text=text_col), n, num, den, bits, hot, small_ids)
    groups = join.grouped()
    weights = groups.classes.select("node", F.lit(1).cast("long").alias("weight"))
    two, more = _linked(join, groups, weights, block, True)
    pairs = two.select(F.col("lo.node").alias("a"), F.col("hi.node").alias("b")).unionByName(more).distinct()
    name = lambda s: groups.components.select(F.col("node").alias(s), F.col("class_id").alias(f"{s}_id"))
    named = pairs.join(name("a"), "a").join(name("b"), "b")
    return named.select(F.least("a_id", "b_id").alias("class_a"), F.greatest("a_id", "b_id").alias("class_b"))


def _linked(join: _Join, groups: _Groups, weights: DataFrame, block: int, as_pairs: bool) -> tuple[DataFrame, DataFrame]:
    """(lo, hi) of components of two classes, which link unless an id ties them; and of the others all pairs (a, b), or each class's sums (node, n) of linked weights."""
    num, den = join.num, join.den
    # sizes of linked classes differ by den / num at most, so they fall to the same or neighbouring buckets
    bucket = F.floor(F.log(F.col("size").cast("double")) / float(np.log(den / num * (1 + 1e-9)))).alias("bucket")
    parts = groups.parts.union(groups.parts.select(F.col("part").alias("node"), "part").distinct())
    at = materialise(parts.join(groups.classes.select("node", "size"), "node").join(weights, "node").select("part", "node", "size", "weight", bucket), "jaccard-linked")
    one = F.struct("node", "weight")
    by_part = at.groupBy("part").agg(F.count("*").alias("k"), F.min(one).alias("lo"), F.max(one).alias("hi"))
    known = 0 if join.several else 2  # a component of two has their link, unless rows of one id made it
    at = at.join(by_part.where(F.col("k") > known).select("part"), "part", "left_semi")
    blocks = materialise(at.groupBy("part", "bucket").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / (block << 10))).alias("k")), "jaccard-blocks")
    beside = lambda step, k: blocks.select("part", (F.col("bucket") - step).alias("bucket"), F.col("k").alias(k))
    at = at.join(blocks, ["part", "bucket"]).join(beside(1, "above"), ["part", "bucket"], "left").join(beside(-1, "below"), ["part", "bucket"], "left")
    own, mine = F.col("bucket"), F.pmod(F.xxhash64("node"), F.col("k"))
    to = lambda low, i, high, j, right: F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), right.alias("right"))
    each = lambda k, f: F.when(F.col(k).isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.col(k) - 1), f)).otherwise(F.array())
    tasks = F.concat(
        each("k", lambda j: to(own, F.least(mine, j), own, F.greatest(mine, j), mine > j)),
        each("above", lambda j: to(own, mine, own + 1, j, F.lit(False))),
        each("below", lambda j: to(own - 1, j, own, mine, F.lit(True))),
    )
    at = materialise(at.select("part", "node", "weight", tasks.alias("tasks")), "jaccard-tasks")
    key = ["part", "low", "i", "high", "j"]
    sent = at.join(join.one_text(at.select("node"), at.count()), "node").select("part", "node", "weight", "text", F.explode("tasks").alias("task")).select("part", "task.*", "node", "weight", "text")
    out = sent.repartition(*key).sortWithinPartitions(*key).mapInArrow(_inside(join.n, num, den, as_pairs), "a long, b long" if as_pairs else "node long, n long")
    return by_part.where(F.col("k") == known).select("lo", "hi"), out


def _inside(n: int, num: int, den: int, as_pairs: bool):
    """Of runs of rows with one key, two blocks of classes each: the pairs that link, or the sums of linked weights."""

    def run(batches):
        held, key = [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "low", "i", "high", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            done = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if key is not None and tuple(keys[lo]) != key:
                    done.append(_block_links(held, n, num, den, as_pairs))
                    held = []
                key = tuple(keys[lo])
                held.append(batch.slice(lo, hi - lo))
            yield from pa.Table.from_batches(done).combine_chunks().to_batches() if done else []
        if held:
            yield _block_links(held, n, num, den, as_pairs)

    return run


def _block_links(held: list, n: int, num: int, den: int, as_pairs: bool) -> pa.RecordBatch:
    rows = {}
    for batch in held:
        cols = [batch.column(c).to_pylist() for c in ("node", "weight", "right")]
        for lo, flat, at in sets_of(batch.column("text"), n):
            signs = _parities(flat, at, 8).view(np.uint64)
            for k in range(len(at) - 1):
                node, weight, right = (c[lo + k] for c in cols)
                rows[node] = (right, node, weight, signs[k], flat[at[k] : at[k + 1]])
    same = batch.column("low")[0] == batch.column("high")[0] and batch.column("i")[0] == batch.column("j")[0]
    left = [d for d, x in rows.items() if not x[0]]
    right = left if same else [d for d, x in rows.items() if x[0]]
    x, y = _linked_pairs([rows[d][1:] for d in left], [rows[d][1:] for d in right], same, num, den)
    if as_pairs:
        a, b = (np.array(side, np.int64)[k] for side, k in ((left, x), (right, y)))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    wx, wy = (np.array([rows[d][2] for d in side], np.int64) for side in (left, right))
    sums = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
    np.add.at(sums[0], x, wy[y])
    np.add.at(sums[1], y, wx[x])
    return pa.RecordBatch.from_arrays([pa.array(left + right, pa.int64()), pa.array(np.concatenate(sums))], ["node", "n"])


def _linked_pairs(left: list, right: list, same: bool, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` (node, weight, signs, grams) of the pairs that link; within one block each pair once."""
    if not left or not right:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    nodes, sizes, signs = ([np.array([f(r) for r in side]) for side in (left, right)] for f in (lambda r: r[0], lambda r: len(r[3]), lambda r: r[2]))
    xs, ys = [], []
    for lo in range(0, len(left), 64):  # the parities of all pairs first
        differ = np.bitwise_count(signs[0][lo : lo + 64, None] ^ signs[1][None]).sum(axis=2, dtype=np.int64)
        both = sizes[0][lo : lo + 64, None] + sizes[1][None]
        fit = (differ <= both - 2 * -(-num * both // (num + den))) & (nodes[0][lo : lo + 64, None] != nodes[1][None])
        x, y = np.nonzero(np.triu(fit, lo + 1) if same else fit)
        xs.append(x + lo)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    if len(x) <= 4 * (len(left) + len(right)):
        shared = np.array([len(np.intersect1d(left[a][3], right[b][3], assume_unique=True)) for a, b in zip(x, y, strict=True)], np.int64)
    else:
        shared = _overlaps([r[3] for r in left], [r[3] for r in right], same)[x, y]
    keep = den * shared >= num * (sizes[0][x] + sizes[1][y] - shared)
    return x[keep], y[keep]


def _overlaps(left: list, right: list, same: bool, width: int = 2048) -> np.ndarray:
    """The number of shared n-grams of each pair, by products of matrices over the n-grams that can be shared."""
    if same:
        grams, count = np.unique(np.concatenate(left), return_counts=True)
        grams = grams[count > 1]
    else:
        grams = np.intersect1d(np.concatenate(left), np.concatenate(right))
    found = []
    for side in (left,) if same else (left, right):
        flat, row = np.concatenate(side), np.repeat(np.arange(len(side)), [len(g) for g in side])
        place = np.searchsorted(grams, flat)
        hit = (place < len(grams)) & (grams[np.minimum(place, len(grams) - 1)] == flat) if len(grams) else np.zeros(len(flat), bool)
        order = np.argsort(place[hit], kind="stable")
        found.append((place[hit][order], row[hit][order], len(side)))
    out = np.zeros((len(left), len(right)), np.int64)
    for lo in range(0, len(grams), width):
        dense = []
        for place, row, k in found:
            a, b = np.searchsorted(place, (lo, lo + width))
            m = np.zeros((k, min(width, len(grams) - lo)), np.float32)
            m[row[a:b], place[a:b] - lo] = 1
            dense.append(m)
        out += (dense[0] @ dense[-1].T).astype(np.int64)  # exact: a product counts up to ``width``
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small_ids: int = 200_000, **how) -> DataFrame:
    """The rows of ``docs`` but those whose group has a document of smaller id. Rows without an id stay."""
    groups = similar_groups(docs, id_col, text_col, small_ids=small_ids, **how)
    drop = materialise(groups.where("component_id < doc_id").select(F.col("doc_id").alias("_dropped")).distinct(), "jaccard-dropped")
    side = F.broadcast(drop) if drop.count() <= small_ids else drop
    return docs.join(side, docs[id_col] == side["_dropped"], "left_anti")
