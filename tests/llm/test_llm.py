"""The training-data operators against brute force on small hand-made tables: nulls, empty and long texts, ties,
repeated rows, empty tables, columns of clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.llm import components, fingerprint, jaccard, language, language_model, line_dedup, neighbours, packing, segmentation, text, tokens, toxicity, url_filter
from holdfast.llm.queries import RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, key string"


def table(spark, rows):
    """Documents with columns whose names operators also use inside."""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "r", "i", "k") for i, t in rows], DOCS)


def words(rng, n, pool=40):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


# text -------------------------------------------------------------------------------------------------------------


def test_words_and_hashes():
    texts = ["A b", "c\x0bd é", "", None, "  ", "B" * 3000, "x y"]
    got = []
    for lo, hi, raw, offsets in text.slices(pa.array(texts), limit=8):
        h, firsts = text.word_hashes(raw, offsets)
        got += [h[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    assert got == [[text.text_hash(w) for w in WORD.findall((t or "").translate(LOWER))] for t in texts]


# 1 URL rules ------------------------------------------------------------------------------------------------------


def by_hand(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else None
    host, path = ("", "") if rest is None else (re.match(r"[^/?#]*", rest)[0].translate(LOWER), re.match(r"[^/?#]*([^?#]*)", rest)[1])
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), r.shape[0]), default=None)
    return host, path, best and best.key, best.action if best else "allow"


def test_url_rules(spark):
    urls = [None, "", "nothing", "://", "http://", "https://EXAMPLE.com/en/7x?q#f", "http://a.example.com/en/8", "x://notexample.com/en/", "http://net/de/1", "http://b.example.net/de/81", "http://example.net/de", "http://c.org?/es/", "http://c.org/es/#", "http://com", "http://.com/en/", "http://a.b.c.com/en/" + "p" * 5000]
    urls += urls[:8]
    pages = spark.createDataFrame([(i, u, "h", "k", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, keys string, path string")
    out = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, RULES).collect()}
    assert out == {i: by_hand(u) for i, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0), RULES).count() == 0 and {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_where_one_filter_is_not(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.where("substring(key, -1) = '7'")
    cascade = url_filter.build_cascade(listed, keys, bits_per_key=2, later_bits=2)
    assert len(cascade.levels) > 2
    assert keys.where(cascade.lists(F.col("key"))).select("key").exceptAll(listed).count() == 0
    assert keys.where(cascade.lists(F.col("key"))).count() == listed.count()
    with pytest.raises(ValueError):
        url_filter.build_level(keys, 0, 64, 1 << 10)


# 2 lines ----------------------------------------------------------------------------------------------------------


def test_line_dedup(spark):
    rng = random.Random(1)
    lines = [" Common ", "common", "\tCOMMON\x0b", "été", "", "  "] + [f"l{i}" for i in range(30)]
    rows = [(i, rng.choice([None, "", "x" * 20000, "\n".join(rng.choice(lines) for _ in range(rng.randrange(9)))])) for i in range(80)]
    rows += rows[:5] + [(None, "common\nalone"), (None, None)]
    out = line_dedup.drop_frequent_lines(table(spark, rows), frequent=5).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    key = lambda s: s.strip(" \t\n\x0b\f\r").translate(LOWER)
    count = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    expected = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if count[key(x)] < 5]
        expected.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert line_dedup.drop_frequent_lines(table(spark, [])).count() == 0


def test_line_runs_on_levels(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    seen = Counter()
    for k, batch in enumerate(([1, 2, 3, 3], [1, 2], [1, 5], [1, 2, 6], [7, 1, 3], [8] * 5)):
        runs.add(spark.createDataFrame([(x,) for x in batch], "hash long"))
        seen.update(batch)
        assert {r["hash"]: r["docs"] for r in runs.counts().collect()} == seen
        assert [len(level) for level in runs.levels] == [int(x) for x in reversed(f"{k + 1:b}")]  # a binary counter
        held = [r["hash"] for run in runs.runs for r in run.collect()]
        assert sorted(held) == sorted(seen)  # each key in one run only
    assert {r["hash"] for r in runs.unseen(spark.createDataFrame([(6,), (7,), (9,)], "hash long")).collect()} == {9}
    assert runs.compacted == 4
    with runs.in_order():  # runs are read as they lie, and merged as they are read
        for df in (runs.unseen(runs.runs[0]), runs.merged(runs.runs)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    for run in runs.runs:
        names = [f.rsplit("_", 1)[1].split(".")[0] for f in run.inputFiles()]  # the bucket of each file
        assert len(names) == len(set(names)) <= 3
    runs.close()


def test_line_runs_of_the_query_are_compacted(spark, monkeypatch):
    made, add = [], line_dedup.LineRuns.add

    def noted(self, hashes):
        add(self, hashes)
        made.append(([len(level) for level in self.levels], self.compacted))

    monkeypatch.setattr(line_dedup.LineRuns, "add", noted)
    rows = [(i, f"line {i % 7}\nown {i}") for i in range(100)]
    assert line_dedup.drop_frequent_lines(table(spark, rows)).where("n_dropped = 1").count() == 100
    assert made == [([1], 0), ([2], 0), ([3], 0), ([0, 1], 1), ([1, 1], 1)]


# 3 n-gram Jaccard -------------------------------------------------------------------------------------------------


def shingles(t, n=5):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups_by_hand(rows):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return [(i, len(s), least[root(k)] if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize("hot", [20000, 1])
def test_similar_groups(spark, hot):
    rng = random.Random(2)
    rows = [(None, "a b c d e f"), (900, "A b c d e f"), (901, None), (902, ""), (903, " \n"), (904, "one two"), (905, "One two"), (906, "long " * 20000)]
    for g in range(12):  # families of copies that differ a little more each
        base = words(rng, rng.randrange(30, 120), 500).split()
        for _ in range(rng.randrange(1, 14)):
            own = base[:]
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rows += rows[8:14]
    out = jaccard.similar_groups(table(spark, rows), hot=hot, bits=16).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, out), key=str) == sorted(groups_by_hand(rows), key=str)
    kept = [r["doc_id"] for r in jaccard.keep_one(table(spark, rows), bits=16).collect()]
    assert set(kept) - {None} == {c if s else i for i, s, c in groups_by_hand(rows)} - {None}
    assert jaccard.similar_groups(table(spark, []), bits=16).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7)]
    out = {r["node"]: r["part"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# 4 packing --------------------------------------------------------------------------------------------------------


def test_pieces_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    rng, plain = random.Random(3), Tokenizer.from_file(path)
    alphabet = [*"ab'sltrevmd  \n\t1２é日,.!_  ²Ⅷ\U0001f600\u0301\u00a0\u3000", "'ll", "'re", " '", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)]
    got = []
    for _, _, ids, at in tokens.encode_slices(pa.array([t or None for t in texts], pa.string()), path):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_packing(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, rng.choice([0, 3, 40, 200, 700]))) for i in range(120)] + [(500, None), (501, ""), (None, "x"), (0, "x")]
    rows.append((502, words(rng, 3000)))
    out = packing.pack(table(spark, rows), tokenizer_path("byte_bpe_50k.json"), capacity=256).collect()
    by_sequence, per_doc = {}, Counter()
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        per_doc[r["doc_id"]] += r["length"]
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert per_doc[500] == per_doc[501] == 1
    assert len(by_sequence) <= 1.05 * sum(r["length"] for r in out) / 256 + 1
    assert packing.pack(table(spark, []), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_plan_pairs_large_items_at_most():
    counts = {900: 3, 600: 4, 400: 5, 342: 2, 100: 7, 1: 30}
    rows = packing.plan(counts, 1024)
    assert Counter({s: 0 for s in counts}) + Counter({s: sum(r[2] for r in rows if r[0] == s) for s in counts}) == Counter(counts)
    large = Counter(b for s, _, n, first, _ in rows if 3 * s > 1024 for b in range(first, first + n))
    assert max(large.values()) <= 2


# 5 language model -------------------------------------------------------------------------------------------------


def test_language_model(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randrange(60), 30)) for i in range(150)] + [(700, None), (701, ""), (702, "Unheard of"), (None, "w1 w2"), (5, "w1")]
    out = {(r["doc_id"], r["n_tokens"], round(r["score"], 6), round(r["base_score"], 6), r["n_known"], r["held_out"]) for r in language_model.train_and_score(table(spark, rows)).collect()}
    toks = [[*WORD.findall((t or "").translate(LOWER)), "</>"] for _, t in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    train = [t for t, h in zip(toks, held, strict=True) if not h]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    triples = Counter(x for t in train for x in zip(["<>", "<>", *t], ["<>", *t], t, strict=False))
    pairs = Counter((v, w) for _, v, w in triples)
    kinds = Counter(w for _, w in pairs)
    d3, d2, d1 = ((0, *language_model._discounts([sum(x == j for x in level.values()) for j in (1, 2, 3, 4)])) for level in (triples, pairs, kinds))
    total, gamma = Counter(), Counter()
    for level, d in ((triples, d3), (pairs, d2)):
        for h, x in level.items():
            total[h[:-1]] += x
            gamma[h[:-1]] += d[min(x, 3)]
    left = sum(d1[min(x, 3)] for x in kinds.values()) / len(pairs)

    def p(u, v, w):
        low = (kinds[w] - d1[min(kinds[w], 3)]) / len(pairs) + left / (len(c) + 1)
        for level, d, h in ((pairs, d2, (v,)), (triples, d3, (u, v))):
            if h in total:
                low = max(level[*h, w] - d[min(level[*h, w], 3)], 0) / total[h] + gamma[h] / total[h] * low
        return low

    for h in (("w1", "w2"), ("<>", "<>"), ("new", "w1"), ("w3", "new")):
        assert abs(sum(p(*h, w) for w in [*c, "new"]) - 1) < 1e-9
    expected = {(i, len(t), round(sum(math.log10(p(*x)) for x in zip(["<>", "<>", *t], ["<>", *t], t, strict=False)), 6), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6), sum(c[w] > 0 for w in t), h) for (i, _), t, h in zip(rows, toks, held, strict=True)}
    assert out == expected
    # the same from many small chunks and shards, with a first word's pairs over several
    model = language_model.train(table(spark, [r for r, h in zip(rows, held, strict=True) if not h]), shard_bytes=1000, chunk=50, most=5)
    again = language_model.score(table(spark, rows), model, F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in again} == {x[:3] for x in expected}
    assert language_model.train_and_score(table(spark, [])).count() == 0


def test_language_model_of_often_repeated_words(spark):
    """Counts above a byte, contexts of many words."""
    rng = random.Random(6)
    rows = [(i, " ".join(["a b", *(f"x{rng.randrange(400)}" if rng.random() < 0.5 else "a b" for _ in range(60))])) for i in range(60)]
    model = language_model.train(table(spark, rows), shard_bytes=4000)
    toks = [[*t.split(), "</>"] for _, t in rows]
    triples = Counter(x for t in toks for x in zip(["<>", "<>", *t], ["<>", *t], t, strict=False))
    assert max(triples.values()) > 255 and len({w for u, v, w in triples if (u, v) == ("a", "b")}) > 255
    code = {w: text.text_hash(w) for t in toks for w in t} | {"</>": int(language_model.END)}
    ids = {w: int(model.dictionary.ids(np.array([h], np.uint64))[0]) for w, h in code.items()} | {"<>": model.dictionary.words}
    asked = [*triples, ("a", "b", "x399999"), ("x1", "x1", "x1")]
    context = np.array([ids.get(u, 0) * (model.dictionary.words + 1) + ids.get(v, 0) for u, v, _ in asked], np.uint64)
    n, sums = model.triple_counts(context, np.array([ids.get(w, -1) for *_, w in asked], np.int64))
    assert n.tolist() == [triples[x] for x in asked]
    follow = {}
    for (u, v, _), x in triples.items():
        follow.setdefault((u, v), []).append(x)
    for (u, v, _), own in zip(list(triples), sums.T.tolist(), strict=False):
        x = follow[u, v]
        assert own == [sum(x), x.count(1), x.count(2), sum(y > 2 for y in x)]
    pairs = Counter((v, w) for _, v, w in triples)
    first, second = (np.array([ids[q[j]] for q in pairs], np.int64) for j in (0, 1))
    assert model.pair_counts(first, second, model.dictionary.counts(first)).tolist() == list(pairs.values())


# 6 fingerprints ---------------------------------------------------------------------------------------------------


def test_fingerprints(spark):
    rng = random.Random(6)
    rows = [(i * 3, words(rng, rng.randrange(200))) for i in range(40)] + [(200, None), (201, ""), (202, "é" * 9), (203, "long " * 9000), (0, "again"), (None, "none")]
    rng.shuffle(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected = []
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        e = fingerprint.edited(t, after)
        a, b, c = (fingerprint.chunks(x.encode()) for x in (t, e, after))
        expected.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint.written(a), fingerprint.written(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    for parts in (1, 3, 60):
        assert sorted(map(tuple, fingerprint.with_edits(table(spark, rows), parts=parts).collect()), key=str) == sorted(expected, key=str)
    assert fingerprint.with_edits(table(spark, [])).count() == 0
    one = fingerprint.with_edits(table(spark, [(1, "only one")])).collect()[0]
    assert one["near_next"] == 1 and fingerprint.read(one["fingerprint"]) == fingerprint.chunks(b"only one")


def test_chunks_survive_a_shift():
    data = random.Random(7).randbytes(20000)
    cuts = [0, *fingerprint.cuts(data)]
    assert cuts[-1] == len(data) and all(b - a <= fingerprint.MOST for a, b in zip(cuts, cuts[1:], strict=False))
    assert fingerprint.likeness(fingerprint.chunks(data), fingerprint.chunks(b"shift" + data)) > 0.95


# 7 neighbours -----------------------------------------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(600, 16)).astype(np.float32)
    v[50:90] = v[50]
    rows = [(i, v[i].tolist()) for i in range(600)] + [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0]), (None, v[0].tolist()), (0, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x")).withColumn("id", F.lit("y"))
    out = neighbours.nearest(df, F.col("id") % 20 == 0, k=10, shard_size=250, block=20).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    exact = v.astype(np.float64)
    hit = 0
    for q in range(0, 600, 20):
        s = (exact * exact[q]).sum(axis=1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:10]
        hit += len({i for i, _ in by[q]} & set(best.tolist()))
        assert all(score == s[i] for i, score in by[q]) and len(by[q]) == 10
    assert sorted(by) == list(range(0, 600, 20)) and hit >= 0.95 * 300
    assert [i for i, _ in by[60]] == [i for i in range(50, 61) if i != 60]
    assert neighbours.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert len(neighbours.nearest(df.where("vec_id < 3"), F.col("id") % 20 == 0).collect()) == 2


# 8 segmentation ---------------------------------------------------------------------------------------------------

VOCABULARY = "piece_bpe_32k.model"


def test_segmentation_is_lossless_and_reproducible(spark):
    rows = [(1, "the  thing▁\n é  x\U0001f600\x00"), (2, None), (3, ""), (4, " "), (5, "x" * 30000), (6, "▁"), (None, "a b"), (1, "the  thing▁\n é  x\U0001f600\x00")]
    df, path = table(spark, rows), tokenizer_path(VOCABULARY)
    encoded = segmentation.encode(df, path)
    back = sorted((tuple(r) for r in segmentation.decode(encoded, path).collect()), key=str)
    assert back == sorted([(i, t or "") for i, t in rows], key=str)
    trip = segmentation.round_trip(df, path).collect()
    assert all(r["lossless"] for r in trip) and {(r["doc_id"], r["n_pieces"], r["ids_crc32"]) for r in trip} == {(r["doc_id"], r["n_pieces"], r["ids_crc32"]) for r in segmentation.round_trip(df.repartition(3), path).collect()}
    assert segmentation.encode(table(spark, []), path).count() == 0


def test_segmentations_are_drawn_by_weight():
    known = segmentation.Segmenter(tokenizer_path(VOCABULARY), 1.0)

    def ways(s):
        if not s:
            yield (), 1.0
        for k in range(1, len(s) + 1):
            if s[:k] in known.pieces:
                i, w = known.pieces[s[:k]]
                for rest, x in ways(s[k:]):
                    yield (i, *rest), w * x

    n = 30000
    for _, _, raw, offsets in text.slices(pa.array(["hello"] * n), limit=1 << 24):
        ids, at = known.sample(raw, offsets, text.mix(np.arange(n, dtype=np.uint64)))
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True))
    all_ways = dict(ways("hello"))
    total = sum(all_ways.values())
    assert set(seen) <= set(all_ways) and all(abs(seen[w] / n - p / total) < 0.01 for w, p in all_ways.items())


# 9 toxicity -------------------------------------------------------------------------------------------------------


def test_segments_are_maximal():
    rng = random.Random(9)
    for _ in range(200):
        scores = [rng.choice([-0.5, -0.5, -0.5, 2.0, 1.0, 0.4]) for _ in range(rng.randrange(1, 25))]
        places = [i for i, s in enumerate(scores) if s > 0]

        def by_hand(lo, hi):
            best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            _, _, _, a, b = best
            return by_hand(lo, a) + [(a, b - 1, round(best[0], 6))] + by_hand(b, hi)

        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(places, [scores[i] for i in places], 0.5)]
        assert got[-1:] == [] or sum(s for _, _, s in got) == pytest.approx(sum(s for _, _, s in by_hand(0, len(scores))))


def test_toxicity(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(400):
        t = words(rng, rng.randrange(5, 60)).split()
        if bad := i % 4 == 0:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(["Idiot,", "scum", "vilest"]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    rows += [(900, None), (901, ""), (902, "w1 " * 30000), (None, "idiot scum vilest"), (3, "w1")]
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (0, 1)], "doc_id long, toxic int")
    out = toxicity.train_and_score(table(spark, rows), marks).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert sum(by[i]["predicted"] == y for i, y in labels if by[i]["held_out"]) >= 0.97 * sum(by[i]["held_out"] for i, _ in labels)
    assert [by[i]["predicted"] for i in (900, 901, 902, None)] == [0, 0, 0, 1]
    passage = by[0]["passages"][0]
    assert rows[0][1].encode()[passage["first_byte"] : passage["end_byte"]].decode().lower().startswith(("idiot", "scum", "vilest"))
    assert {r["score"] for r in toxicity.train_and_score(table(spark, rows), marks.limit(0)).collect()} == {0.0}
    assert toxicity.keep_clean(table(spark, rows), None).count() == len(rows)


# 10 language ------------------------------------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(11)
    parts = {"aa": ["tion", "the", "ing"], "bb": ["schen", "über", "keit"], "cc": ["ción", "que", "los"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(parts))
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(rng.randrange(2, 40))), lang))
    extra = [(900, None, "aa"), (901, "", "aa"), (902, "12 !!", None), (903, "über " * 20000, None), (None, "los que", None), (3, "que", None)]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").withColumn("lettered", F.lit(1)).withColumn("held_out", F.lit(1))
    out = language.train_and_predict(df).collect()
    truth = {i: x for i, _, x in rows}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth and r["doc_id"] != 3]
    assert len(out) == len(rows + extra) and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    by = {r["doc_id"]: r for r in out}
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and by[903]["lang_pred"] == "bb"
    kept = language.keep_accepted(df, language.train(df))
    assert kept.columns == df.columns and kept.count() >= len(rows) and kept.where("doc_id in (900, 901, 902)").count() == 0
    assert {r["lang_pred"] for r in language.predict(df, None).collect()} == {"und"}
    assert language.train_and_predict(df.limit(0)).count() == 0


# pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    docs = [(i, words(rng, 60, 300) + "\nfooter line", "en", "s", 0) for i in range(60)]
    docs += [(100 + i, docs[i][1].replace("footer", "Footer"), "en", "s", 0) for i in range(5)] + [(200, None, "en", "s", 0), (201, "?!", "en", "s", 0)]
    docs += [(300 + i, words(rng, 40, 300) + " idiot scum vilest idiot", "en", "s", 0) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i >= 300)) for i, *_ in docs], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages, current = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        stages.append({r["doc_id"]: r["text"] for r in current.collect()})
    assert set(stages[0]) == {i for i, *_ in docs} - {200, 201}
    assert set(stages[1]) == {i for i in stages[0] if i < 300}
    assert set(stages[2]) == set(stages[1]) and not any("ooter" in t for t in stages[2].values())
    assert set(stages[3]) == set(range(60))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(range(60))
