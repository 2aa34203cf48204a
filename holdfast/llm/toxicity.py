"""Operator 9: toxic passages, found as maximal scoring segments of token log-odds.

Training, on a bounded sample of labelled rows, of which a third is held back: in how many toxic and clean texts each
word, and each beginning of words of four to six bytes, occurs. Its score is the log-odds ratio between the classes under
a Dirichlet prior in proportion to its overall frequency; features whose ratio is significantly above zero are kept.
Words run over letters. All that follows is fitted on the third that the odds haven't seen.

Scoring: a word scores as its best feature less a drift, other words the negative drift. One linear scan finds all maximal
scoring segments of a text, disjoint and none extendable. Scores of segments in clean text follow an extreme-value
law, P(S >= s) = 1 - exp(-K n exp(-lambda s)). lambda solves the clean words' moment equation, that the mean of
exp(lambda * score) is 1; K is the most likely one for the best segments of clean texts, given lambda. Segments that would be rare in a clean text of that length are toxic passages, and the evidence of a text is
the sum of theirs; its logarithm is calibrated to a probability by a logistic fit weighted to the classes' true shares.

Defined cases: null and empty texts have no passages; rows without a label don't train; an id with both labels counts as
toxic; of rows that repeat an id one text trains; without labelled rows of both classes every text scores 0. Where a
class has fewer than 20 rows in either part of the sample, nothing is held back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import fold, keep_rows, materialise, pick
from .sampling import bounded

#: Bytes that aren't part of words: ASCII but letters.
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[65:91] = GAP[97:123] = False
#: Bytes of the beginnings that count as features beside whole words.
STEMS = (4, 5, 6)
_FILTER_BITS = 20


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted hashes of features
    odds: np.ndarray
    drift: float
    rate: float  # lambda
    scale: float  # K
    slope: float
    offset: float
    cutoff: float = 0.05  # expected number of such segments in a clean text

    def filter(self) -> np.ndarray:
        out = np.zeros(1 << _FILTER_BITS, bool)
        out[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -30, 30)))


def _words(raw: np.ndarray, offsets: np.ndarray):
    """Words' (starts, ends, first of each text and the total), and the hashes of their features: [features, words]."""
    solid, starts, ends, firsts = T.split_words(raw, offsets, GAP)
    if not len(starts):
        return starts, ends, firsts, np.zeros((1 + len(STEMS), 0), np.uint64)
    power, inverse = T.powers(len(raw) + 1)
    values = np.zeros(len(raw) + 1, np.uint64)
    values[:-1] = (T.LOWER.astype(np.uint64) + np.uint64(1))[raw] * solid * power[:-1]
    lens = ends - starts
    out = []
    for k, size in enumerate((None, *STEMS)):
        stop = ends if size is None else np.minimum(starts + size, ends)
        cuts = np.column_stack([starts, stop]).ravel()
        h = np.add.reduceat(values, cuts)[::2] * inverse[starts]
        h = T.mix(h + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        out.append(h if size is None else np.where(lens >= size, h, np.uint64(0)))
    return starts, ends, firsts, np.array(out)


def _presence(batches):
    """Counts over a task's texts: feature, texts of either class that hold it. Feature 0 counts the texts."""
    for batch in batches:
        toxic, clean = [], []
        label = batch.column("toxic").to_numpy(zero_copy_only=False)
        for lo, hi, raw, offsets in T.slices(batch.column("text")):
            _, _, firsts, h = _words(raw, offsets)
            for k in range(hi - lo):
                own = np.unique(h[:, firsts[k] : firsts[k + 1]])
                (toxic if label[lo + k] else clean).append(own[own != 0])
        sides = [np.unique(np.concatenate([np.zeros(0, np.uint64), *x]), return_counts=True) for x in (toxic, clean)]
        keys = np.union1d(sides[0][0], sides[1][0])
        counts = []
        for k, n in sides:
            full = np.zeros(len(keys), np.int64)
            full[np.searchsorted(keys, k)] = n
            counts.append(full)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts[0]), pa.array(counts[1])], ["feature", "in_toxic", "in_clean"])


def segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first, last, score), by one pass over the positive words.

    ``places`` are the positive words' positions and ``scores`` theirs; all words between score ``-drift``. A segment leads
    straight to the nearest earlier one that it may join, so the pass is linear.
    """
    found: list[list] = []  # first, last, total before the segment, total after it, nearest earlier segment of smaller total before it
    total, after = 0.0, None
    for place, score in zip(places, scores, strict=True):
        if after is not None:
            total -= drift * (place - after - 1)
        after = place
        new = [place, place, total, total + score, -1]
        total += score
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                break
            new[0], new[2], k = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = k
        new[4] = j
        found.append(new)
    return [(a, b, r - s) for a, b, s, r, _ in found]


def _scan(model: Model, texts: pa.Array):
    """Per text: (evidence, best segment score, words, its passages as (first byte, end byte, score, expected), scores of words above the drift)."""
    near = model.filter()
    shift = np.uint64(64 - _FILTER_BITS)
    for _, hi, raw, offsets in T.slices(texts):
        starts, ends, firsts, h = _words(raw, offsets)
        odds = np.zeros(len(starts))
        for row in h:
            maybe = np.flatnonzero(near[(row >> shift).astype(np.int64)])
            if len(maybe) and len(model.keys):
                at = np.minimum(np.searchsorted(model.keys, row[maybe]), len(model.keys) - 1)
                hit = model.keys[at] == row[maybe]
                odds[maybe[hit]] = np.maximum(odds[maybe[hit]], model.odds[at[hit]])
        positive = np.flatnonzero(odds > model.drift)
        cuts = np.searchsorted(positive, firsts)
        for k in range(len(offsets) - 1):
            own = positive[cuts[k] : cuts[k + 1]]
            n = int(firsts[k + 1] - firsts[k])
            if not len(own):
                yield 0.0, 0.0, n, [], []
                continue
            parts = segments(own.tolist(), (odds[own] - model.drift).tolist(), model.drift)
            evidence, passages = 0.0, []
            for a, b, s in parts:
                rare = model.rate * s - np.log(model.scale * n)  # less the logarithm of the expected number
                if rare >= -np.log(model.cutoff):
                    evidence += rare
                    passages.append((int(starts[a] - offsets[k]), int(ends[b] - offsets[k]), float(s), float(np.exp(-rare))))
            yield evidence, max(s for _, _, s in parts), n, passages, odds[own] - model.drift


def _evidence(model: Model):
    """Of each text: its class, evidence, best segment, words and the scores of those above the drift."""

    def run(batches):
        for batch in batches:
            out = list(_scan(model, batch.column("text")))
            tops = [np.array(x[4], np.float32).tobytes() for x in out]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.float64(), pa.float64(), pa.int64()))), pa.array(tops, pa.binary())], ["toxic", "evidence", "best", "words", "tops"])

    return run


def moment_rate(scores: np.ndarray, others: int, drift: float) -> float:
    """The positive lambda at which the mean of exp(lambda * score) is 1, over ``scores`` and ``others`` words of score -drift.

    Without such a root, as no word scores above zero or the mean isn't negative, 1.
    """
    n = len(scores) + others
    if not len(scores) or scores.sum() - drift * others >= 0:
        return 1.0
    excess = lambda x: np.exp(x * scores).sum() + others * np.exp(-x * drift) - n
    low, high = 0.0, 1.0
    while excess(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def law_scale(best: np.ndarray, words: np.ndarray, rate: float) -> float:
    """The most likely K of P(S < s) = exp(-K n exp(-rate s)), where a text without a segment says S < 0 only."""
    return max(int((best > 0).sum()), 1) / max(float((words * np.exp(-rate * best)).sum()), 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 10_000, prior: float = 0.3, least_z: float = 3.5, drift: float = 0.5) -> Model | None:
    """Fit on at most ``per_class`` labelled rows of each class, written to a table. The features that this sample shows to be
    toxic and, of each row held back, four numbers and the scores of its toxic words come to the driver.

    ``prior`` is the prior's weight as a share of the smaller class.
    """
    named = pick(labels, id=id_col, toxic=label_col).where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen, counts = bounded(named, "toxic", F.col("id"), per_class)
    if len(counts) < 2:
        return None
    sample = pick(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    sample = materialise(sample.select("toxic", "text", (F.pmod(F.xxhash64("id", F.lit(29)), F.lit(3)) == 0).alias("back")), "toxicity-sample")
    sizes = {(int(r["toxic"]), r["back"]): r["n"] for r in sample.groupBy("toxic", "back").agg(F.count("*").alias("n")).collect()}
    if len({k for k, _ in sizes}) < 2:
        return None
    apart = all(sizes.get((k, back), 0) >= 20 for k in (0, 1) for back in (True, False))
    seen, unseen = (sample.where("not back"), sample.where("back")) if apart else (sample, sample)
    # texts stand for the words' totals: presence in n texts of either class
    nt, nc = (float(sizes.get((k, False), 0) + (0 if apart else sizes.get((k, True), 0))) for k in (1, 0))
    held = seen.mapInArrow(_presence, "feature long, in_toxic long, in_clean long").groupBy("feature").agg(F.sum("in_toxic").alias("t"), F.sum("in_clean").alias("c"))
    prior = max(1.0, prior * min(nt, nc))
    a = (F.col("t") / nt + F.col("c") / nc) / 2 * prior + 0.01
    t, c = F.col("t") + a, F.col("c") + a
    odds = F.log(t / (nt + prior - t + 1)) - F.log(c / (nc + prior - c + 1))
    scored = held.where("t >= 3").withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / t + 1 / c)).where(F.col("z") >= least_z)
    kept = scored.select("feature", "odds").toArrow()
    keys, values = kept.column("feature").to_numpy().view(np.uint64), kept.column("odds").to_numpy()
    order = np.argsort(keys)
    model = Model(keys[order], values[order], drift, 1.0, 1.0, 1.0, 0.0, cutoff=np.inf)
    measured = lambda m: unseen.mapInArrow(_evidence(m), "toxic int, evidence double, best double, words long, tops binary")
    clean = measured(model).where("toxic = 0").select("best", "words", "tops").toPandas()
    tops = np.frombuffer(b"".join(clean.tops), np.float32).astype(np.float64)
    rate = moment_rate(tops, int(clean.words.sum()) - len(tops), drift)
    scale = law_scale(clean.best.to_numpy(), clean.words.to_numpy(), rate)
    model = Model(model.keys, model.odds, drift, rate, scale, 1.0, 0.0)
    found = measured(model).select("toxic", "evidence").toPandas()
    share = {k: counts.get(k, 0) / max(1, (found.toxic == k).sum()) for k in (0, 1)}
    slope, offset = _logistic(found.evidence.to_numpy(), found.toxic.to_numpy(), np.where(found.toxic == 1, share[1], share[0]))
    return Model(model.keys, model.odds, drift, rate, scale, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of one variable's logarithm by Newton steps, lightly held towards small slopes; the slope isn't negative."""
    x, top = np.log1p(x), weight.sum()
    design = np.column_stack([x, np.ones(len(x))])
    beta = np.array([1.0, -1.0])
    ridge = np.diag([1e-4, 1e-6]) * top
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - y)) + ridge @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def _score(model: Model | None):
    kind = pa.list_(pa.struct([("first_byte", pa.int64()), ("end_byte", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches):
        for batch in batches:
            found = list(_scan(model, batch.column("text"))) if model else [(0.0, 0.0, 0, [], [])] * len(batch)
            p = model.probability(np.array([x[0] for x in found])) if model else np.zeros(len(batch))
            passages = [[dict(zip(("first_byte", "end_byte", "score", "expected"), y, strict=True)) for y in x[3]] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(p, pa.float64()), pa.array(passages, kind)], ["doc_id", "held_out", "score", "passages"])

    return run


def score(docs: DataFrame, model: Model | None, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, passages (bytes of the UTF-8 text, segment score, expected number)."""
    rows = pick(docs, id=id_col, text=text_col).withColumn("held_out", F.lit(False) if held_out is None else held_out)
    out = rows.mapInArrow(_score(model), f"doc_id {dict(docs.dtypes)[id_col]}, held_out boolean, score double, passages array<struct<first_byte:long,end_byte:long,score:double,expected:double>>")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""

    def mask(batch: pa.RecordBatch) -> np.ndarray:
        if model is None:
            return np.ones(len(batch), bool)
        return model.probability(np.array([x[0] for x in _scan(model, batch.column("text"))])) < threshold

    return keep_rows(docs, docs[text_col], mask)


def train_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from labels of the rows whose fold isn't ``held``, score all rows."""
    model = train(docs, labels.where(fold(labels[id_col], folds) != held), id_col, text_col)
    return score(docs, model, fold(F.col("id"), folds) == held, id_col, text_col)
