"""What happens beyond the usual bounds: large filters, small tables of parts, long parts, many groups of pieces."""

import random
from collections import Counter

import numpy as np

from holdfast.llm import packing, segmentation, tokens, url_filter
from holdfast.llm.queries import RULES, tokenizer_path

from test_llm import by_hand, table, words

VOCABULARY = "piece_bpe_32k.model"


def test_rules_by_a_join_where_filters_are_too_large(spark):
    urls = [None, "http://a.example.com/en/8", "http://a.example.com/en/7", "http://net/de/1", "http://c.org/es/#", "http://b.example.net/de/81", "x"] * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, RULES, most_bits=1).collect()}
    assert out == {i: by_hand(u) for i, u in enumerate(urls)}


def test_parts_beyond_the_table():
    known = segmentation.Segmenter(tokenizer_path(VOCABULARY), 1.0, bits=8)
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(10**6)}é" for _ in range(3000)).encode()
    raw, at, seed = np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.array([7], np.uint64)
    ids, cuts = known.sample(raw, at, seed)
    assert known.decode(ids).tobytes() == text and cuts.tolist() == [0, len(ids)]
    whole = segmentation.Segmenter(tokenizer_path(VOCABULARY), 1.0)
    assert whole.sample(raw, at, seed)[0].tolist() == ids.tolist()  # how parts are taken together doesn't matter


def test_long_parts_are_drawn_like_short_ones(monkeypatch):
    known = segmentation.Segmenter(tokenizer_path(VOCABULARY), 1.0)
    monkeypatch.setattr(segmentation, "_WINDOW", 64)
    rng = random.Random(2)
    for text in ("the" * 300 + "日本語é" * 40 + "\U0001f600" * 9, "x", "Strassenbahnhaltestelle" * 20, "".join(chr(rng.randrange(33, 0x250)) for _ in range(700))):
        raw = np.frombuffer(text.encode(), np.uint8)
        for seed in range(3):
            stream = np.array([seed], np.uint64)
            ids = known._sample_long(raw, stream)
            short, _ = known._sample_parts(raw, np.array([0]), np.array([len(raw)]), stream)
            assert known.decode(ids).tobytes() == raw.tobytes() and ids.tolist() == short.tolist()


def test_a_text_without_spaces_in_bounded_memory():
    import tracemalloc

    known = segmentation.Segmenter(tokenizer_path(VOCABULARY), 1.0)
    raw = np.frombuffer(("unbroken" * 40_000).encode(), np.uint8)  # 320 KB, a part of its own
    tracemalloc.start()
    ids, _ = known.sample(raw, np.array([0, len(raw)]), np.array([1], np.uint64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert known.decode(ids).tobytes() == raw.tobytes() and peak < 100e6


def test_encoder_keeps_a_bounded_number_of_ids():
    path = tokenizer_path("byte_bpe_50k.json")
    small, plain = tokens.Encoder(path, bits=6, most_ids=100), tokens.Encoder(path)
    rng = random.Random(3)
    for _ in range(20):
        texts = [words(rng, 15, 10**5) for _ in range(3)]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        at = np.cumsum([0, *map(len, texts)])
        assert small.encode(raw, at)[0].tolist() == plain.encode(raw, at)[0].tolist()
        assert small.used <= 100


def test_packing_in_many_groups_and_by_joins(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.choice([0, 3, 40, 100]))) for i in range(120)] + [(5, "x")] * 3
    out = packing.pack(table(spark, rows), tokenizer_path("byte_bpe_50k.json"), capacity=64, per_salt=4, small=0).collect()
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    # as many sequences as planning the pieces one by one needs
    lengths = Counter(r["length"] for r in out)
    assert len(by_sequence) == sum(1 for _ in {r for run in packing.plan(lengths, 64) for r in range(run[3], run[3] + run[2])})


def test_pieces_against_brute_force(spark):
    import zlib

    from tokenizers import Tokenizer

    plain, rng = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), random.Random(5)
    rows = [(1, None), (2, ""), (3, words(rng, 100, 10**4)), (4, "é" * 40), (5, words(rng, 7, 10**4))]
    expected = set()
    for i, t in rows:
        ids, s = [*plain.encode(t or "", add_special_tokens=False).ids, 2], 0
        for k in range(-(-len(ids) // 32)):
            size = (len(ids) - 1) % 32 + 1 if k == 0 else 32
            expected.add((i, k, s, size, zlib.crc32(np.array(ids[s : s + size], "<u4").tobytes())))
            s += size
    assert {tuple(r) for r in packing.pieces(table(spark, rows), tokenizer_path("byte_bpe_50k.json"), 32).collect()} == expected
