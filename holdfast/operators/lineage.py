"""Where records come from and what is wrong with them: issues, files, datasets and field definitions as entities and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import scalars as S
from holdfast.operators import graph

# What each code of an issue says
MESSAGES = {
    "missing_product_number": "no product number; no entity was made",
    "missing_item_number": "no item number; no entity was made",
    "malformed_item_number": "the item number doesn't have the shape of a source key; no entity was made",
}


def issues(entities: DataFrame, dataset: str) -> DataFrame:
    """(uri, source_uri, code, message, dataset, row_number) of the rows of a feed (see ``transform``) that made no entity: one issue for each record and code."""
    bad = entities.where("issue_code is not null")
    said = F.create_map(*[F.lit(x) for kv in MESSAGES.items() for x in kv])
    uri = F.concat(F.col("source_uri"), F.lit(":issue:"), F.replace("issue_code", F.lit("_"), F.lit("-")))
    return bad.select(uri.alias("uri"), "source_uri", F.col("issue_code").alias("code"), F.coalesce(said[F.col("issue_code")], F.col("issue_code")).alias("message"), F.lit(dataset).alias("dataset"), "row_number").dropDuplicates(["uri"])


def edges(records: DataFrame, fields: DataFrame, found: DataFrame) -> DataFrame:
    """(src, rel, dst): records in their files, files as extracts of datasets, datasets' fields, records' issues.

    ``records`` as of ``transform.source_records``, ``fields`` as of ``landed.field_definitions``, ``found`` as of ``issues``.
    """
    dataset = S.uri("dataset", F.col("dataset"))
    file = S.uri("file", F.col("dataset"), F.coalesce(F.col("snapshot_date").cast("string"), F.lit("undated")))
    files = records.select("dataset", "snapshot_date").distinct()
    return graph.edge_union(
        (records, F.col("uri"), "IN_FILE", file),
        (files, file, "EXTRACT_OF", dataset),
        (fields, dataset, "HAS_FIELD", S.uri("field", F.col("dataset"), F.col("field"))),
        (found, F.col("source_uri"), "HAS_ISSUE", F.col("uri")),
    )
