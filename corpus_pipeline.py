"""A training corpus from documents: five stages, each over all rows that the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import jaccard, language, line_dedup, packing, toxicity
from holdfast.llm.common import materialise, table
from holdfast.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told surely enough; null texts and texts without a letter go. Ids play no part; without a labelled row all go."""
    return language.keep_accepted(docs, language.train(docs))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic, learnt from the labels of documents at hand; without labels of both classes all stay. Rows without an id are judged like others."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them have; n_chars is that of the text left. Each row counts, whether its id is null or repeated."""
    out = line_dedup.drop_frequent_lines(docs)
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")), "n_chars": F.when(F.col("row.text").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one of least id, with all its rows. Rows without an id stay."""
    return jaccard.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, of rows with null or repeated ids too."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language id", known_language),
    ("toxicity", not_toxic),
    ("line dedup", without_common_lines),
    ("n-gram jaccard join", one_of_each_group),
    ("best-fit packing", packed),
]

#: Models and packing aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name.replace(' ', '-')}")
    return docs
