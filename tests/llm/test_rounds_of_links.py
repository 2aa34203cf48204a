"""Operator 3 does no more rounds than there are links for: the driver keeps what each of them leaves behind."""

import random

from holdfast.llm import components, jaccard

from test_llm import groups_by_hand, table, words


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)


def test_links_added_to_settled_parts(spark):
    rng = random.Random(8)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    more = [(rng.randrange(70), rng.randrange(70)) for _ in range(15)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    found = lambda df: {r["node"]: r["part"] for r in df.collect() if r["node"] != r["part"]}
    parts = components.connected(frame(first))
    assert found(components.extended(parts, frame(more))) == found(components.connected(frame(first + more)))
    assert found(components.extended(parts, frame([(5, 5)]))) == found(parts)
    assert found(components.extended(components.connected(frame([])), frame(more))) == found(components.connected(frame(more)))


def test_rounds_without_a_link_are_few_jobs(spark):
    rng = random.Random(9)
    rows = []
    for i in range(30):  # pairs of near copies, all found at first
        text = words(rng, 60, 5000)
        rows += [(2 * i, text), (2 * i + 1, text + " more")]
    kept, jobs = jobs_of(spark, "few-rounds", lambda: sorted(r["doc_id"] for r in jaccard.keep_one(table(spark, rows)).collect()))
    assert kept == list(range(0, 60, 2))
    assert jobs <= 110


def test_pairs_beside_a_large_group_grow_no_faster_than_it(spark, monkeypatch):
    def compared(k):
        """A group of k near copies and k texts that share n-grams with each of them and don't link with it: pairs that are made."""
        rng = random.Random(10)
        base, rows, made = words(rng, 120, 10**6).split(), [], []
        for i in range(2 * k):
            own = base[:]
            for at in rng.sample(range(10, 60, 5), 1) if i < k else rng.sample(range(60, 111, 5), 2):
                own[at] = f"x{i}x{at}"
            rows.append((i, " ".join(own)))
        ends = jaccard._ends
        monkeypatch.setattr(jaccard, "_ends", lambda pairs: made.append(pairs.count()) or ends(pairs))
        found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(table(spark, rows), bits=16).collect()]
        monkeypatch.undo()
        assert sorted(found) == sorted(groups_by_hand(rows))
        return sum(made)

    assert compared(120) <= 3 * compared(60)
