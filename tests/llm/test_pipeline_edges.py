"""The stages over empty tables, nulls in any column, repeated rows and columns with names that operators use inside."""

import random

import corpus_pipeline

from test_llm import words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, node string, hashes string, label string"


def write(spark, at, docs, labels):
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(f"{at}/labels.parquet")


def test_stages_over_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0 and docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_over_nulls_and_repeats(spark, tmp_path):
    rng = random.Random(3)
    more = ("r", "k", "n", "h", "l")
    docs = [(i, words(rng, 50, 300), "en", "s", 1, *more) for i in range(40)]
    docs += docs[:3] + [(None, docs[5][1], None, None, None, *[None] * 5), (7, words(rng, 50, 300), "en", None, None, *more), (50, None, "en", "s", 1, *more), (51, "", None, None, None, *[None] * 5), (52, words(rng, 20000, 300), "en", "s", 1, *more)]
    labels = [(i, None, None, "t") for i in range(20)] + [(None, 1, 1, None), (3, 1, 0, None), (3, 1, 0, None)]  # no label of one class
    write(spark, tmp_path, docs, labels)
    current, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        kept.append(sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in current.collect()))
    texts = sorted([*range(40), 0, 1, 2, 7, -1, 52])
    assert kept[0] == texts  # null and empty texts have no language
    assert kept[1] == texts and kept[2] == texts  # without labels of both classes nothing is toxic
    assert kept[3] == texts  # equal rows are one document, and a row without an id stays
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {None, *range(40), 52}
