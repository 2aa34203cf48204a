"""The queries ``opN_<name>`` over the given tables, and the SQL that states some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, fingerprint, jaccard, language, language_model, line_dedup, neighbours, packing, segmentation, token_counts, toxicity, url_filter, whitening
from .common import table


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files lie, on the driver and the workers alike."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


Query = Callable[[SparkSession, str], DataFrame]


RULES = [
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.with_links(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.links(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.train_and_score(table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("n_passages", F.size("passages")).drop("passages")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.train_and_predict(table(spark, sf_dir, "documents")).drop("accepted")


def op11_vector_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compress(table(spark, sf_dir, "embeddings"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: Translates A-Z only, unlike lower().
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url FROM pages),
q AS (SELECT r, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM p),
s AS (SELECT r, page_id, coalesce({_LOWER.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM q),
rules(action, host, path) AS (VALUES {", ".join(f"('{x.action}', '{x.host}', '{x.path}')" for x in RULES)}),
fit AS (SELECT s.r, x.action, x.host || x.path AS rule, row_number() OVER (PARTITION BY s.r ORDER BY length(x.host) + length(x.path) DESC, length(x.host) DESC) AS k
        FROM s JOIN rules x ON (s.host = x.host OR ends_with(s.host, '.' || x.host)) AND starts_with(s.path, x.path))
SELECT s.page_id, s.host, s.path, fit.rule, coalesce(fit.action, 'allow') AS verdict FROM s LEFT JOIN fit ON s.r = fit.r AND fit.k = 1
"""

OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line, {_LOWER.format("trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
      FROM d, unnest(range(1, len(lines) + 1)) AS u(i)),
frequent AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN frequent f ON l.key = f.key GROUP BY r, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1_SQL, "op2_line_dedup": OP2_SQL}
