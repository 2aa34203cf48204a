"""Operators 9 and 10 against brute force: segments, the extreme-value law, scores, features and softmax."""

import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import language, toxicity

from test_llm import table, words


def maximal_segments(scores, lo, hi):
    """By definition: the best run, then the same on either side of it."""
    best = max(((sum(scores[a:b]), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    s, a, b = best
    return maximal_segments(scores, lo, a) + [(a, b - 1, round(s, 6))] + maximal_segments(scores, b, hi)


def test_segments_are_those_of_the_definition():
    rng = random.Random(2)
    for _ in range(200):
        scores = [rng.choice([-0.5, -0.5, -0.5, rng.uniform(0.01, 3)]) for _ in range(rng.randrange(1, 25))]
        places = [i for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(places, [scores[i] for i in places], 0.5)
        assert [(a, b, round(s, 6)) for a, b, s in got] == maximal_segments(scores, 0, len(scores))


def test_segments_of_a_text_of_isolated_hits():
    """Time grows with the hits, whether each begins below or above all before it."""
    n = 200_000
    for gap in (10, 1):
        began = time.process_time()
        found = toxicity.segments(list(range(0, n * gap, gap)), [1.0, 0.2] * (n // 2), 0.5)
        assert time.process_time() - began < 2 and found


def test_moment_equation_and_scale():
    rng = np.random.default_rng(3)
    scores, others = rng.uniform(0.1, 3, 50), 950
    rate = toxicity.moment_rate(scores, others, 0.5)
    assert (np.exp(rate * scores).sum() + others * math.exp(-0.5 * rate)) / 1000 == pytest.approx(1)
    assert toxicity.moment_rate(np.zeros(0), 10, 0.5) == toxicity.moment_rate(np.full(9, 2.0), 1, 0.5) == 1.0
    # best segments drawn from the law give its scale back
    k, lam, n = 0.3, 1.2, np.full(20000, 200.0)
    best = np.maximum(0, np.log(k * n / -np.log(rng.uniform(size=20000))) / lam)
    assert toxicity.law_scale(best, n, lam) == pytest.approx(k, rel=0.05)


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(400):
        t = words(rng, rng.randrange(5, 60)).split()
        if bad := i % 4 == 0:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(["Idiot,", "scum", "vilest"]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    return rows, labels


def test_scores_against_brute_force(spark, toxic_rows):
    rows, labels = toxic_rows
    model = toxicity.train(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    odds = dict(zip(model.keys.tolist(), model.odds.tolist(), strict=True))

    def word_odds(w):
        raw = np.frombuffer(w, np.uint8)
        _, _, _, h = toxicity._words(raw, np.array([0, len(raw)]))
        return max([odds.get(int(x), 0.0) for x in h[:, 0]])

    def by_hand(text):
        found = re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())
        scores = [max(word_odds(w), 0.0) - model.drift for w in found]
        evidence = 0.0
        for *_, s in maximal_segments(scores, 0, len(scores)):
            expected = model.scale * len(found) * math.exp(-model.rate * s)
            evidence -= math.log(expected) if expected <= model.cutoff else 0.0
        return 1 / (1 + math.exp(-(model.slope * math.log1p(evidence) + model.offset)))

    docs = [*rows[:60], (900, None), (901, "!!"), (902, "été idiotic SCUMMY scum")]
    for r in toxicity.score(table(spark, docs), model).collect():
        assert r["score"] == pytest.approx(by_hand(dict(docs)[r["doc_id"]]), abs=1e-6)


def test_toxicity_of_empty_and_contradicting_tables(spark, toxic_rows):
    rows, labels = toxic_rows
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.train_and_score(table(spark, []), marks).count() == 0
    both = marks.union(marks.withColumn("toxic", marks.toxic * 0))  # an id with both labels is toxic
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.train_and_score(table(spark, rows), m).collect()} for m in (marks, both))
    assert a == b


def test_language_features_and_softmax(spark):
    rng = random.Random(11)
    parts = {"aa": ["tion", "the", "ing"], "bb": ["schen", "über", "keit"]}
    rows = [(i, " ".join("".join(rng.choice(parts[x]) for _ in range(3)) for _ in range(rng.randrange(2, 30))), x) for i, x in enumerate(rng.choices(sorted(parts), k=120))]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=12)

    def bucket(gram):
        code = (int.from_bytes(gram, "little") + len(gram)) & 0xFFFFFFFF
        code = (code ^ code >> 15) * 0x9E3779B1 & 0xFFFFFFFF
        return ((code ^ code >> 13) * 0x85EBCA77 & 0xFFFFFFFF) >> 32 - 12

    def by_hand(text):
        raw = b" " + bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()) + b" "
        grams = [raw[i : i + k] for k in (3, 4) for i in range(len(raw) - k + 1)]
        z = (sum((model.logits[bucket(g)].astype(float) for g in grams), np.zeros(2)) / max(1, len(grams)) + model.bias) / model.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    texts = [t for _, t, _ in rows[:30]] + ["a", "Tion über THE", "é", "x" * 3000]
    best, p, _ = language._judge(model, pa.array(texts), np.ones(len(texts), bool))
    for t, k, x in zip(texts, best, p, strict=True):
        assert by_hand(t)[k] == pytest.approx(x, abs=1e-4) and x == pytest.approx(by_hand(t).max(), abs=1e-4)


ENDINGS = {"aa": ["tion", "the", "ing", "ment", "ous"], "bb": ["schen", "über", "keit", "ung", "lich"], "cc": ["ción", "ando", "idad", "ños", "que"], "dd": ["eaux", "ère", "ouille", "ais", "çon"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(ENDINGS[lang]) + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_rejection_of_junk_and_of_languages_left_out(spark):
    rng = random.Random(12)
    texts = {x: [prose(rng, x, rng.choice([4, 12, 40, 150])) for _ in range(300)] for x in ENDINGS}
    fit = lambda langs: language.train(spark.createDataFrame([(t, x) for x in langs for t in texts[x][:150]], "text string, lang string"))
    judged = lambda model, some: language._judge(model, pa.array(some), np.ones(len(some), bool))[2].mean()
    model = fit(ENDINGS)
    clean = [t for x in ENDINGS for t in texts[x][150:]]
    assert judged(model, clean) >= 0.99
    consonants = [" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randrange(2, 9))) for _ in range(30)) for _ in range(100)]
    shuffled = ["".join(rng.sample(t, len(t))) for t in clean if len(t) > 100]
    greek = ["Η γλώσσα είναι ένα σύστημα επικοινωνίας που χρησιμοποιούν οι άνθρωποι"] * 3
    for junk in (consonants, shuffled, greek, ["日本語は主に日本で使われている言語である。" * 3]):
        assert judged(model, junk) <= 0.1
    for out in ENDINGS:
        assert judged(fit([x for x in ENDINGS if x != out]), [t for t in texts[out] if len(t) > 100]) <= 0.1


def test_rejection_learnt_from_few_rows(spark):
    few = spark.createDataFrame([("the tion", "aa"), ("schen über", "bb"), ("", "aa"), ("!", "bb")], "text string, lang string")
    best, _, accepted = language._judge(language.train(few), pa.array(["the tion", "the", "x" * 50000]), np.ones(3, bool))
    assert accepted[0] and best[0] == 0
