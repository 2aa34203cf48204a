"""Operator 13 against the tokenizer library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from holdfast.llm import token_counts
from holdfast.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
#: What cuts or joins pre-tokens in its own way: special strings, contractions, case, composition, digits, spaces.
SIGNS = [
    "<|startoftext|>", "<|endoftext|>", "<|", "|>", "'s", "'RE", "'ll", "''s", "!'s", "x'sam", "'", "-", "_", "…", "A", "z", "The", "the" * 9, "a" * 40,
    "İ", "ΑΣ", "Σ", "é", "é", "́", "가", "ᆨ", "가", "日本", "\U0001f600", "ß", "ẞ", "K", "Å", "ﬁ", "̈́", "ǅ", "Ⅷ", "ⓐ", "あ゙", "Ɤ",
    "1", "23", "½", "²", "٣", " ", " ", " ", "\n", "\t", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "​", "　", " ",
]


@pytest.fixture(scope="module")
def library():
    known = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in known.encode_batch(texts, add_special_tokens=False)]


def counted(counter, texts):
    data = [t.encode() for t in texts]
    return counter.count(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])).tolist()


def test_like_the_library(library):
    rng, counter = random.Random(8), token_counts.Counter(PATH)
    mixed = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(14))) for _ in range(4000)]
    wide = ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(32, 127)])) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for texts in (mixed, wide, ["", " ", "\n"], []):
        assert counted(counter, texts) == library(texts)


def test_long_words_and_a_small_table(library):
    rng = random.Random(9)
    long = ["".join(rng.choice("abcdeéo") for _ in range(n)) for n in (510, 511, 512, 513, 514, 3000, 40000)] + ["a" * 5001, "ab" * 3000, "the" * 2000, "é" * 1111, "haha" * 700]
    words = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(5)]
    for bits in (4, 20):
        counter = token_counts.Counter(PATH, bits=bits)
        for texts in (long, words, words[::-1]):
            assert counted(counter, texts) == library(texts)
        assert counter.index.held <= len(counter.index.keys) // 2


def test_runs_of_one_pair_join_from_the_left():
    hit = np.array([True, True, True, False, True, True, False, True])
    assert token_counts._from_left(hit).tolist() == [True, False, True, False, True, False, False, True]


def test_rows(spark, library):
    long = "Straße 12 and <|endoftext|> it's " * 30000  # a slice of its own
    texts = [None, "", " ", "Hello, World", "Hello, World", long]
    rows = [(i if i != 4 else 3, t, "x", 5) for i, t in enumerate(texts)] + [(None, "a", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    out = token_counts.counts(docs, PATH, limit=4)
    plain = [t or "" for t in [*texts, "a"]]
    expected = [(r[0], len(t.encode()), n, n > 4) for r, t, n in zip(rows, plain, library(plain), strict=True)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
    assert token_counts.counts(docs.limit(0), PATH).collect() == []
