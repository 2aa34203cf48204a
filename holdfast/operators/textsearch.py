"""Text search over names, raw fields, passages."""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import graph, stages


def exact(c: Column, query: str) -> Column:
    return F.lower(S.text(c)) == query.strip().lower()


def contains(c: Column, query: str) -> Column:
    return F.contains(F.lower(c), F.lit(query.lower()))


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def fulltext(rows: DataFrame, key: str, name: str, query: str, k: int) -> DataFrame:
    """(key, score): rows that share words with the query, by the sum of ln(1 + rows / rows with the word); ties by key.

    The score tells relevance only. A word counts once for a key, however many rows the key has. Weights are summed in ascending
    order, so that the same words give the same score to the last bit and ties are by key wherever rows lie.
    """
    terms = sorted({w for w in "".join(ch.lower() if unicodedata.category(ch)[0] in "LN" else " " for ch in query).split()})
    total = rows.agg(F.count("*").alias("n_rows"))
    found = rows.select(key, F.explode(F.array_distinct(F.filter(words(F.col(name)), lambda w: w.isin(terms)))).alias("term")).distinct()
    idf = found.groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(total)).select("term", F.log(1 + F.col("n_rows") / F.col("df")).alias("idf"))
    score = F.aggregate(F.array_sort(F.collect_list("idf")), F.lit(0.0), lambda x, y: x + y)
    return found.join(F.broadcast(idf), "term").groupBy(key).agg(score.alias("score")).orderBy(F.desc("score"), key).limit(k)


def near_matches(names: DataFrame, name: str, query: str, most: int) -> DataFrame:
    """(name, distance, is_suggestion): exact matches, or else names within an edit distance, which are suggestions only."""
    q = query.strip().lower()
    d = names.select(F.col(name).alias("name")).distinct().withColumn("distance", F.levenshtein(F.lower("name"), F.lit(q))).where(F.col("distance") <= most)
    best = d.agg(F.min("distance").alias("best"))
    d = d.join(F.broadcast(best)).where((F.col("best") > 0) | (F.col("distance") == 0))
    return d.select("name", "distance", (F.col("distance") > 0).alias("is_suggestion"))


def _shortened(c: Column, most: int) -> Column:
    """Hashes of all strings that up to ``most`` deletions of a character leave of a string, itself included."""
    without = lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))
    forms = F.array(c)
    for _ in range(most):
        forms = F.array_distinct(F.concat(forms, F.flatten(F.transform(F.filter(forms, lambda s: s != ""), without))))
    return F.transform(forms, lambda s: F.xxhash64(s))


def near_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, most: int = 1) -> DataFrame:
    """(left, right, distance): all pairs of distinct names within an edit distance, case aside.

    Two names within ``most`` edits leave a common string after as many deletions on either side, so names are joined by
    what deletions leave of them, and a candidate is compared where it is met. Only so many distinct names leave one string as
    there are ways to put characters into it, so no join key is large. The strings are many times the names, which a plan's
    sizes don't show: neither side may be broadcast.
    """

    def side(df, c, n):
        own = stages.spread(df.select(F.col(c).alias(n)).where(F.col(n).isNotNull()), n).distinct()
        return own.withColumn("form", F.explode(_shortened(F.lower(n), most))).hint("merge")

    l, r = F.lower("left"), F.lower("right")
    met = side(left, left_name, "left").join(side(right, right_name, "right"), "form").where(F.abs(F.length(l) - F.length(r)) <= most)
    # equal names meet at all their strings and count at the whole one only
    found = met.where((l != r) | (F.col("form") == F.xxhash64(l))).select("left", "right", F.levenshtein(l, r, most).alias("distance"))
    return found.where(F.col("distance").between(0, most)).distinct()


def near_matches_of(queries: DataFrame, names: DataFrame, query: str, name: str, most: int = 1) -> DataFrame:
    """(query, name, distance, is_suggestion): for each query its exact matches, or else names within an edit distance, which are suggestions only."""
    found = near_pairs(queries, names, query, name, most).select(F.col("left").alias("query"), F.col("right").alias("name"), "distance")
    best = F.min("distance").over(Window.partitionBy("query"))
    return found.withColumn("_best", best).where("distance = 0 or _best > 0").select("query", "name", "distance", (F.col("distance") > 0).alias("is_suggestion"))


_WORD = regex.compile(r"[\p{L}\p{N}]+")
_BASE = 0x9E3779B97F4A7C15
#: Names of more words are looked for by the first so many.
_HEAD = 4


def _rolling(text: str) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """A text's words in lower case, their offsets, and what gives the hash of any run of them: sums of hashes times powers, and inverse powers."""
    found = list(_WORD.finditer(text))
    folded = [m.group().lower() for m in found]
    h = hash_array(np.array(folded, object)) if folded else np.zeros(0, np.uint64)
    power, inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), base, np.uint64)]), dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    return folded, [m.start() for m in found], np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)]), inverse


def _phrases(batches):
    """Of each name: its words as one string, their number and hash, and that of the first few."""
    for batch in batches:
        rolled = [_rolling(t or "") for t in batch.column("name").to_pylist()]
        rows = [(" ".join(w), len(w), *(int((sums[[n]] * inverse[:1]).view(np.int64)[0]) for n in (len(w), min(len(w), _HEAD)))) for w, _, sums, inverse in rolled]
        cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("name"), *cols], ["name", "phrase", "n_words", "hash", "head"])


def _among(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in a sorted array that isn't empty."""
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _hits(sizes: np.ndarray, hashes: np.ndarray, heads: np.ndarray):
    """Of each text: the runs of words whose hash a name of as many words has.

    Short names are looked for everywhere; longer ones, of however many lengths, only where a text has the first words of one.
    """
    short = {int(n): np.sort(hashes[sizes == n]) for n in np.unique(sizes) if n <= _HEAD}
    long = {int(n): np.sort(hashes[sizes == n]) for n in np.unique(sizes) if n > _HEAD}
    pairs = np.unique(np.stack([heads[sizes > _HEAD], sizes[sizes > _HEAD].astype(np.int64)], 1), axis=0)

    def found(sums, inverse):
        def of(at, n):
            return ((sums[at + n] - sums[at]) * inverse[at]).view(np.int64)

        for n, known in short.items():
            at = np.arange(max(0, len(sums) - n))
            yield n, at[_among(known, of(at, n))]
        at = np.arange(max(0, len(sums) - _HEAD))
        if len(pairs) and len(at):
            head = of(at, _HEAD)
            here = _among(pairs[:, 0], head)
            at, head = at[here], head[here]
            low, high = (np.searchsorted(pairs[:, 0], head, side) for side in ("left", "right"))
            which = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange((high - low).sum())
            at, n_words = np.repeat(at, high - low), pairs[which, 1]
            for n in np.unique(n_words).tolist():
                own = at[(n_words == n) & (at + n_words < len(sums))]
                yield n, own[_among(long[n], of(own, n))]

    def run(batches):
        for batch in batches:
            row, word, size, start, phrase = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                folded, offsets, sums, inverse = _rolling(text or "")
                for n, places in found(sums, inverse):
                    for i in places.tolist():
                        row.append(k)
                        word.append(i)
                        size.append(n)
                        start.append(offsets[i])
                        phrase.append(" ".join(folded[i : i + n]))
            cols = [pa.array(x, pa.int32()) for x in (word, size, start)]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row, pa.int64())), *cols, pa.array(phrase, pa.string())], ["row", "word", "n_words", "start", "phrase"])

    return run


def mentions(rows: DataFrame, keys: list[str], text: str, names: DataFrame, name: str, at_once: int = 2_000_000) -> DataFrame:
    """(keys, name, word, n_words, start): where texts hold names, word by word, case and signs aside; of nested places the longest.

    ``word`` is the first word's number from 0, ``start`` its offset in code points. Names are grouped by their number of words; a
    text has one rolling hash, from which that of any run of words follows, so each number of words up to four is one pass of array
    operations, and longer names are looked for where their first four words are.
    Runs whose hash a name has are compared with names word by word, by a join. ``at_once`` names' hashes (16 MB) go to
    the tasks at a time; more take further passes. ``keys`` tell rows apart.
    """
    named = names.select(F.col(name).alias("name")).where("name is not null").distinct().mapInArrow(_phrases, "name string, phrase string, n_words int, hash long, head long").where("n_words > 0")
    named = stages.written(named, "mentions-names")
    passes = max(1, -(-named.count() // at_once))
    own = rows.select(F.struct(*keys).alias("row"), F.col(text).alias("text"))
    found = []
    for i in range(passes):
        part = named.where(F.pmod("hash", F.lit(passes)) == i).select("n_words", "hash", "head").distinct().toArrow()
        found.append(own.mapInArrow(_hits(*(part.column(c).to_numpy() for c in ("n_words", "hash", "head"))), f"row {own.schema['row'].dataType.simpleString()}, word int, n_words int, start int, phrase string"))
    hits = reduce(DataFrame.unionByName, found).join(named.select("phrase").distinct(), "phrase", "left_semi")
    end = F.col("word") + F.col("n_words")
    earlier = Window.partitionBy("row").orderBy("word", F.desc("n_words")).rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("_reach", F.max(end).over(earlier)).where(F.col("_reach").isNull() | (F.col("_reach") < end))
    return hits.join(named.select("phrase", "name"), "phrase").select("row.*", "name", "word", "n_words", "start")


def passages(docs: DataFrame, key: str, text: str, separator: str = "\n") -> DataFrame:
    """(key, passage, start, passage_text): non-empty parts between separators with their offsets in the text."""
    parts = docs.select(key, F.split(text, separator, -1).alias("parts")).select(key, F.posexplode("parts").alias("passage", "passage_text"))
    before = Window.partitionBy(key).orderBy("passage").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("passage_text") + len(separator)).over(before), F.lit(0))
    return parts.withColumn("start", start).where("passage_text <> ''").select(key, "passage", "start", "passage_text")


def raw_field(raw: Column, name: str) -> Column:
    """A raw field by its case-sensitive name."""
    return F.try_element_at(raw, F.lit(name))


def vector_topk(rows: DataFrame, key: str, vector: str, given: list[float], k: int) -> DataFrame:
    """(key, similarity): the k rows of largest cosine similarity to one given vector; ties by key. Zero and null vectors have none."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    q = F.array(*[F.lit(float(x)) for x in given])
    own = F.sqrt(dot(F.col(vector), F.col(vector)))
    scored = rows.where(F.size(vector) == len(given)).select(key, F.try_divide(dot(F.col(vector), q), own * F.sqrt(dot(q, q))).alias("similarity"))
    return scored.where("similarity is not null").orderBy(F.desc("similarity"), key).limit(k)


def vector_expanded(rows: DataFrame, key: str, vector: str, given: list[float], k: int, edges: DataFrame, relations: list[str], depth: int = 1) -> DataFrame:
    """(root, similarity, node, depth): the k nearest rows of ``vector_topk`` (depth 0), and what each reaches along the relations in up to ``depth`` steps."""
    found = stages.written(vector_topk(rows, key, vector, given, k).select(F.col(key).cast("string").alias("root"), "similarity"), "vector-top")
    near = graph.neighbours(found.select("root"), edges, relations, depth)
    reached = found.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).unionByName(near)
    return reached.join(found, "root").select("root", "similarity", "node", "depth")
