"""Links of operator 3, those inside components too, against brute force."""

import random

import pytest

from holdfast.llm import jaccard

from test_llm import shingles, table, words


def links_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    own = [frozenset(s) for s in sets]
    least = {}
    for (i, _), s in zip(rows, own, strict=True):
        least[s] = min(least.get(s, i), i)
    pairs, others = set(), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(len(rows)):
            both = len(sets[a] & sets[b])
            if a != b and sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                others[a] += 1
                if own[a] != own[b]:
                    pairs.add(tuple(sorted((least[own[a]], least[own[b]]))))
    return pairs, {i: n for (i, _), n in zip(rows, others, strict=True)}


@pytest.mark.parametrize("block", [1024, 3])
def test_links_inside_components(spark, block):
    rng = random.Random(4)
    rows = [(1, None), (2, " "), (3, "one two"), (4, "One two"), (5, "apart")]
    for size, changes in ((60, 3), (25, 6), (2, 1), (12, 9)):  # cliques, and chains where most pairs don't link
        base = words(rng, 300, 2000).split()
        for _ in range(size):
            own = base[: len(base) - rng.randrange(15)]
            for _ in range(rng.randrange(changes)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) + 100, " ".join(own)))
    pairs, others = links_by_hand(rows)
    assert len(pairs) > 1000
    found = jaccard.links(table(spark, rows), bits=16, block=block).collect()
    assert sorted(map(tuple, found)) == sorted(pairs)
    assert {r["doc_id"]: r["n_links"] for r in jaccard.with_links(table(spark, rows), bits=16, block=block).collect()} == others


def test_rows_of_one_id_are_one_document(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a), (5, a), (5, b), (9, b), (9, None), (7, "alone"), (7, ""), (8, ""), (None, b)]
    out = jaccard.with_links(table(spark, rows), bits=16).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == sorted([(3, 2, 3), (5, 2, 3), (5, 2, 3), (9, 2, 3), (9, 0, 3), (7, 1, 7), (7, 0, 7), (8, 0, 8), (None, 2, 3)], key=str)
    assert len({r["class_id"] for r in out if r["n_shingles"]}) == 3
    assert sorted(r["n_links"] for r in out) == [0, 0, 0, 0, 1, 1, 2, 2, 2]
    assert jaccard.links(table(spark, rows), bits=16).collect() == []
    assert sorted(r["doc_id"] or 0 for r in jaccard.keep_one(table(spark, rows), bits=16).collect()) == [0, 3, 7, 7, 8]


def test_a_row_repeated_often_and_a_frequent_ngram(spark):
    rng = random.Random(6)
    text, common = words(rng, 200, 1000), " ".join("the same five words come again and again".split())
    rows = [(1, text)] * 300 + [(10 + i, common + " " + words(rng, 6, 10**6)) for i in range(300)] + [(None, text)] * 50
    out = {r["doc_id"]: r for r in jaccard.with_links(table(spark, rows), bits=12, hot=10, small_ids=3).collect()}
    assert out[1]["component_id"] == 1 and out[1]["n_links"] == out[None]["n_links"] == 50
    assert all(out[i]["component_id"] == i and out[i]["n_links"] == 0 for i in range(10, 310))
