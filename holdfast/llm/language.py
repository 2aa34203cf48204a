"""Operator 10: the language of each text, by averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of three and of four bytes of the text (A-Z lowered, a space at both ends). Each has an embedding
by its hash; a text is the average of its subwords' embeddings, and a linear layer with softmax gives the languages'
probabilities. Embeddings and layer are trained together by stochastic gradient descent in numpy on a bounded sample
of labelled rows (``per_language``). A part of the sample is held back to calibrate the temperature of the softmax. For
use, embeddings and layer are multiplied out into one row of logits for each bucket.

Probabilities tell languages apart, not whether a text is of any. That is told by how familiar its subwords are, those of letters and spaces alone: their mean
log-likelihood ratio, under all languages in equal shares (a text may mix them), against all buckets alike. Each text of the sample is measured
without its own counts, which gives the usual value, its spread among texts and that from counting few subwords; a text is rejected if
it lies further below than ``slack`` times what all but 0.2 % of the sample do.

Defined cases: null texts and texts without any letter are ``und`` with score 0; rows without a language don't train;
without any labelled row everything is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import fold, keep_rows, materialise, pick, release
from .sampling import bounded

UNKNOWN = "und"
#: Bytes that are neither part of letters nor a space.
_OTHER = np.zeros(256, bool)
_OTHER[:128] = True
_OTHER[65:91] = _OTHER[97:123] = _OTHER[32] = False


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    logits: np.ndarray  # [buckets + 1, languages]; the last row is of no subword
    bias: np.ndarray
    temperature: float
    least: float  # texts of lower probability are rejected
    bits: int
    known: np.ndarray  # [buckets + 1]: log-likelihood ratios of subwords; the last one is of no subword
    usual: float  # mean ratio of a text
    spread: float  # its variance among texts
    noise: float  # and its variance for one subword
    most: float  # texts further below the usual mean, in standard deviations, are rejected

    def strange(self, mean: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How far texts of so many subwords lie below the usual mean, in standard deviations."""
        return (self.usual - mean) / np.sqrt(self.noise / np.maximum(sizes, 1) + self.spread)


def _subwords(raw: np.ndarray, offsets: np.ndarray, bits: int):
    """For each size of subword: the buckets at each byte (the last bucket where none begins), those of letters and spaces alone, and texts' first places."""
    rows = len(offsets) - 1
    firsts = offsets + 2 * np.arange(rows + 1)
    padded = np.full(firsts[-1] + 3, 32, np.uint32)
    padded[np.arange(len(raw)) + np.repeat(2 * np.arange(rows) + 1, np.diff(offsets))] = T.LOWER[raw]
    two = padded[:-1] | padded[1:] << np.uint32(8)
    n = int(firsts[-1])
    other = _OTHER[np.minimum(padded, 255)]
    other[:-1] |= other[1:]
    for size in (3, 4):
        code = (two[:n] | (padded[2 : n + 2] if size == 3 else two[2 : n + 2]) << np.uint32(16)) + np.uint32(size)
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)
        bucket = ((code ^ (code >> np.uint32(13))) * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
        bucket = bucket.astype(np.int32)
        for back in range(1, size):
            at = firsts[1:] - back
            bucket[at[at >= firsts[:-1]]] = 1 << bits
        signs = other[:n] | other[size - 2 : n + size - 2]
        yield bucket, np.where(signs, np.int32(1 << bits), bucket), firsts


def _features(bits: int):
    def run(batches):
        for batch in batches:
            out = []
            for lo, hi, raw, offsets in T.slices(batch.column("text")):
                parts = list(_subwords(raw, offsets, bits))
                for k in range(hi - lo):
                    own = np.concatenate([b[f[k] : f[k + 1]] for b, _, f in parts])
                    buckets, counts = np.unique(own[own < 1 << bits], return_counts=True)
                    out.append((buckets.astype("<i4").tobytes(), (counts / max(1, counts.sum())).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["lang", "buckets", "weights"])

    return run


#: Subwords that a text counts for at most when familiarity is learnt, so that a long text doesn't stand for its language.
_COUNTED = 2000
#: Variance from the median of squares, and what a subword adds to each bucket's count.
_OF_MEDIAN, _PRIOR = 2.198, 0.5


def _plain_counts(texts: pa.Array, bits: int):
    """Of each text: its buckets of letters and spaces alone, their numbers (scaled down for long texts) and how many subwords those are."""
    for lo, hi, raw, offsets in T.slices(texts):
        parts = list(_subwords(raw, offsets, bits))
        for k in range(hi - lo):
            own = np.concatenate([p[f[k] : f[k + 1]] for _, p, f in parts])
            buckets, times = np.unique(own[own < 1 << bits], return_counts=True)
            n = int(times.sum())
            yield buckets, times * min(1.0, _COUNTED / max(n, 1)), n


def _counted(languages: tuple, bits: int):
    """A task's counts of buckets by language."""

    def run(batches):
        counts = np.zeros((len(languages), 1 << bits))
        for batch in batches:
            for lang, (buckets, times, _) in zip(batch.column("lang").to_pylist(), _plain_counts(batch.column("text"), bits), strict=True):
                counts[languages.index(lang), buckets] += times
        of, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[of, bucket])], ["of", "bucket", "n"])

    return run


def _ratio(counts: np.ndarray, sums: np.ndarray, bits: int) -> np.ndarray:
    """Log-likelihood ratios of buckets' counts [buckets, languages] against all buckets alike, languages in equal shares."""
    return np.log(((counts + _PRIOR) / (sums + _PRIOR * (1 << bits)) * (1 << bits)).mean(axis=1))


def _measured(languages: tuple, counts: np.ndarray, bits: int):
    """Of each text: its mean ratio by the others' counts, and its number of subwords."""
    sums = counts.sum(axis=0)

    def run(batches):
        for batch in batches:
            means, sizes = [], []
            for lang, (buckets, times, n) in zip(batch.column("lang").to_pylist(), _plain_counts(batch.column("text"), bits), strict=True):
                rest, whole, label = counts[buckets].copy(), sums.copy(), languages.index(lang)
                rest[:, label] -= times
                whole[label] -= times.sum()
                means.append(float(times @ _ratio(np.maximum(rest, 0), whole, bits) / times.sum()) if n else 0.0)
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(means, pa.float64()), pa.array(sizes, pa.int64())], ["mean", "n"])

    return run


def _familiarity(sample: DataFrame, languages: tuple, bits: int, slack: float) -> dict:
    """The fields of a model that tell familiar texts; counts of 2**bits buckets and two numbers a text come to the driver."""
    counts = np.zeros((1 << bits, len(languages)))
    rows = sample.mapInArrow(_counted(languages, bits), "of int, bucket int, n double").groupBy("of", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[rows.column("bucket").to_numpy(), rows.column("of").to_numpy()] = np.round(rows.column("n").to_numpy(), 6)
    known = np.append(_ratio(counts, counts.sum(axis=0), bits), 0).astype(np.float32)
    texts = sample.mapInArrow(_measured(languages, counts, bits), "mean double, n long").where("n > 0").toArrow()
    m, n = texts.column("mean").to_numpy(), texts.column("n").to_numpy()
    if not len(n):
        return {"known": known, "usual": 0.0, "spread": 1.0, "noise": 1.0, "most": np.inf}
    long, short = n >= np.quantile(n, 0.5), n <= np.quantile(n, 0.3)
    usual = float(np.median(m[long]))
    spread = max(1e-4, _OF_MEDIAN * float(np.median((m[long] - usual) ** 2)))
    noise = max(1e-4, _OF_MEDIAN * float(np.median((m[short] - usual) ** 2 * n[short])))
    below = np.sort((usual - m) / np.sqrt(noise / n + spread))
    return {"known": known, "usual": usual, "spread": spread, "noise": noise, "most": slack * max(3.0, float(below[-1 - int(0.002 * len(below))]))}


def _train(rows: list, bits: int, size: int, epochs: int, rate: float, seed: int, familiar: dict) -> Model:
    languages = tuple(sorted({r["lang"] for r in rows}))
    rng = np.random.default_rng(seed)
    rows = sorted(rows, key=lambda r: (r["lang"], r["buckets"], r["weights"]))
    order = rng.permutation(len(rows))
    labels = np.array([languages.index(rows[i]["lang"]) for i in order])
    buckets = [np.frombuffer(rows[i]["buckets"], "<i4") for i in order]
    weights = [np.frombuffer(rows[i]["weights"], "<f4") for i in order]
    test = np.arange(len(rows)) % 5 == 4 if len(rows) >= 10 * len(languages) else np.zeros(len(rows), bool)
    embed = rng.normal(0, 0.1, (1 << bits, size)).astype(np.float32)
    layer = rng.normal(0, 0.5, (size, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    train = np.flatnonzero(~test)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            if not len(buckets[i]):
                continue
            mean = weights[i] @ embed[buckets[i]]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= step * np.outer(mean, p)
            bias -= 0.1 * step * p
            # the mean spreads a gradient thinly: the buckets' share is made up for by their number
            embed[buckets[i]] -= step * min(64.0, len(buckets[i])) * np.outer(weights[i], back)
    logits = np.concatenate([embed @ layer, np.zeros((1, len(languages)), np.float32)]).astype(np.float32)
    held = np.flatnonzero(test) if test.any() else np.arange(len(rows))
    z = np.array([weights[i] @ logits[buckets[i]] + bias if len(buckets[i]) else bias for i in held])
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.002, 20, 120):
        p = _softmax(z / t)
        loss = -np.log(np.maximum(p[np.arange(len(held)), labels[held]], 1e-12)).mean()
        if loss < best:
            best, temperature = loss, float(t)
    sure = np.sort(_softmax(z / temperature).max(axis=1))
    # nearly all of the held-back texts stay above; chance alone is always too little
    least = max(1.02 / len(languages) if len(languages) > 1 else 0.0, 0.6 * float(sure[int(0.002 * len(sure))]))
    return Model(languages, logits, bias, temperature, min(least, 0.5), bits, **familiar)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 400, bits: int = 16, size: int = 16, epochs: int = 6, rate: float = 1.0, seed: int = 7, slack: float = 1.5) -> Model | None:
    """Fit on at most ``per_language`` rows of each language, written to a table; those rows' subword weights and counts alone come to the driver."""
    rows = pick(docs, text=text_col, lang=lang_col).where("text is not null")
    sample = materialise(bounded(rows, "lang", F.xxhash64("text"), per_language)[0].select("lang", "text"), "language-sample")
    found = sample.mapInArrow(_features(bits), "lang string, buckets binary, weights binary").toArrow().to_pylist()
    model = None
    if found:
        familiar = _familiarity(sample, tuple(sorted({r["lang"] for r in found})), bits, slack)
        model = _train(found, bits, size, epochs, rate, seed, familiar)
    release(sample)
    return model


def _judge(model: Model | None, texts: pa.Array, lettered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language's number or -1, its probability, whether accepted) of each text."""
    n = len(texts)
    if model is None:
        return np.full(n, -1), np.zeros(n), np.zeros(n, bool)
    z, known, sizes, plain = np.zeros((n, len(model.languages))), np.zeros(n), np.zeros(n), np.zeros(n)
    for lo, hi, raw, offsets in T.slices(texts):
        for bucket, own, firsts in _subwords(raw, offsets, model.bits):
            add = lambda values, **how: np.add.reduceat(values, firsts[:-1], **how)  # noqa: B023, E731
            z[lo:hi] += add(model.logits[bucket], axis=0, dtype=np.float64)
            known[lo:hi] += add(model.known[own], dtype=np.float64)
            sizes[lo:hi] += add((bucket < 1 << model.bits).astype(np.int64))
            plain[lo:hi] += add((own < 1 << model.bits).astype(np.int64))
    prob = _softmax((z / np.maximum(sizes, 1)[:, None] + model.bias) / model.temperature)
    best, p = np.where(lettered, prob.argmax(axis=1), -1), np.where(lettered, prob.max(axis=1), 0)
    strange = model.strange(known / np.maximum(plain, 1), plain)
    return best, p, (best >= 0) & (p >= model.least) & (strange <= model.most)


def _predict(model: Model | None):
    names = [*(model.languages if model else ()), UNKNOWN]

    def run(batches):
        for batch in batches:
            best, p, accepted = _judge(model, batch.column("text"), np.asarray(batch.column("lettered")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array([names[k] for k in best]), pa.array(p, pa.float64()), pa.array(accepted)], ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return run


def _lettered(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told surely enough."""
    return keep_rows(docs, docs[text_col], lambda b: _judge(model, b.column("text"), np.asarray(b.column("lettered")))[2], lettered=_lettered(docs[text_col]))


def predict(docs: DataFrame, model: Model | None, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (its calibrated probability), accepted (sure enough)."""
    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.withColumn("held_out", F.lit(False) if held_out is None else held_out).withColumn("lettered", _lettered(F.col("text")))
    return rows.mapInArrow(_predict(model), f"doc_id {dict(docs.dtypes)[id_col]}, held_out boolean, lang_pred string, score double, accepted boolean")


def train_and_predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1) -> DataFrame:
    """Learn from the rows whose fold isn't ``held``, predict all rows."""
    model = train(docs.where(fold(docs[id_col], folds) != held), text_col, lang_col)
    return predict(docs, model, fold(F.col("id"), folds) == held, id_col, text_col)
