"""Edges, hierarchies, neighbourhoods and provenance over (src, rel, dst) tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators import skew, stages

# Logical relations, the stored relation and whether it is followed backwards
RELATIONS = {
    "has_unit": ("HAS_UNIT", False),
    "of_fund": ("HAS_UNIT", True),
    "managed_by": ("MANAGED_BY", False),
    "issued_by": ("ISSUED_BY", False),
    "tracks": ("TRACKS", False),
    "classified_as": ("CLASSIFIED_AS", False),
    "has_identifier": ("HAS_IDENTIFIER", False),
    "listed_as": ("LISTED_AS", False),
    "on_market": ("ON_MARKET", False),
    "has_offering": ("OFFERS", True),
    "has_observation": ("HAS_OBSERVATION", False),
    "instance_of": ("INSTANCE_OF", False),
    "subclass_of": ("SUBCLASS_OF", False),
    "described_by": ("DESCRIBES", True),
    "in_file": ("IN_FILE", False),
}
MOST_DEPTH = 4


def edge_union(*families: tuple[DataFrame, Column, str, Column]) -> DataFrame:
    """Distinct (src, rel, dst) of edge families (rows, source, relation, target); missing ends make no edge.

    Edges are dealt by their ends before they are made distinct, so the reading tasks gather none.
    """
    parts = [df.select(s.alias("src"), F.lit(rel).alias("rel"), d.alias("dst")).where("src is not null and dst is not null") for df, s, rel, d in families]
    return stages.spread(reduce(DataFrame.unionByName, parts), "src", "rel", "dst").distinct()


def attached(edges: DataFrame, sources: DataFrame, source: str, key: str) -> DataFrame:
    """Edges of a source that is there, with what the source row adds; others are not made."""
    return edges.join(sources, edges[source] == sources[key]).drop(sources[key]) if source != key else edges.join(sources, key)


def path_join(rows: DataFrame, *steps: tuple[DataFrame, str, str, bool]) -> DataFrame:
    """Rows with what each step's table adds: (table, column here, column there, whether the step must be there)."""
    for table, here, there, must in steps:
        rows = rows.join(table, rows[here] == table[there], "inner" if must else "left")
    return rows


def logical_edges(edges: DataFrame) -> DataFrame:
    """Edges under their logical relations, reversed where those are; a unit also reaches its fund's manager and benchmark."""
    parts = []
    for name, (stored, back) in RELATIONS.items():
        own = edges.where(F.col("rel") == stored)
        parts.append(own.select(F.col("dst" if back else "src").alias("src"), F.lit(name).alias("rel"), F.col("src" if back else "dst").alias("dst")))
    units = edges.where("rel = 'HAS_UNIT'").select(F.col("src").alias("fund"), F.col("dst").alias("unit"))
    for name in ("managed_by", "tracks"):
        own = edges.where(F.col("rel") == RELATIONS[name][0]).select(F.col("src").alias("fund"), "dst")
        parts.append(units.join(own, "fund").select(F.col("unit").alias("src"), F.lit(name).alias("rel"), "dst"))
    return stages.spread(reduce(DataFrame.unionByName, parts), "src", "rel", "dst").distinct()


def closure(child_parent: DataFrame, depth: int = MOST_DEPTH) -> DataFrame:
    """(node, ancestor, depth, path) for 1 to ``depth`` steps up (child, parent). Hierarchies are small; steps are unrolled."""
    step = child_parent.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth"), F.array("child", "parent").alias("path"))
    found, up = [step], child_parent.select(F.col("child").alias("ancestor"), F.col("parent").alias("next"))
    for i in range(2, depth + 1):
        step = step.join(up, "ancestor").where(~F.array_contains("path", F.col("next"))).select("node", F.col("next").alias("ancestor"), F.lit(i).alias("depth"), F.array_append("path", F.col("next")).alias("path"))
        found.append(step)
    return reduce(DataFrame.unionByName, found)


def instances(instance_of: DataFrame, closed: DataFrame, class_: str) -> DataFrame:
    """Entities (src) of a class or of any below it."""
    below = closed.where(F.col("ancestor") == class_).select(F.col("node").alias("dst")).unionByName(instance_of.sparkSession.createDataFrame([(class_,)], "dst string")).distinct()
    return instance_of.join(below, "dst", "left_semi").select("src").distinct()


def paths(roots: DataFrame, edges: DataFrame, relations: list[str], depth: int) -> DataFrame:
    """(root, node, depth, path): walks of 1 to ``depth`` steps along the relations, with no node twice.

    Relations are filtered first and walks grow one join at a time; their number is that of the results.
    """
    if not 1 <= depth <= MOST_DEPTH:
        raise ValueError(f"invalid_request: depth {depth}")
    own = edges.where(F.col("rel").isin(relations)).select(F.col("src").alias("node"), F.col("dst").alias("next"))
    step = roots.select(F.col("root"), F.col("root").alias("node"), F.array("root").alias("path"))
    found = []
    for i in range(1, depth + 1):
        step = step.join(own, "node").where(~F.array_contains("path", F.col("next"))).select("root", F.col("next").alias("node"), F.array_append("path", F.col("next")).alias("path"))
        found.append(step.withColumn("depth", F.lit(i)))
    return reduce(DataFrame.unionByName, found).select("root", "node", "depth", "path")


def neighbours(roots: DataFrame, edges: DataFrame, relations: list[str], depth: int, per: int = 1_000_000) -> DataFrame:
    """(root, node, depth): each node once, at its least distance.

    Round by round: only the nodes that a root first saw in the last round go on, and what a root has seen already is
    left out, so work is bounded by roots times edges and no walks are made. Each round is written. A node with more than
    ``per`` edges is split over salts.
    """
    if not 1 <= depth <= MOST_DEPTH:
        raise ValueError(f"invalid_request: depth {depth}")
    own = edges.where(F.col("rel").isin(relations)).select(F.col("src").alias("node"), F.col("dst").alias("next"))
    own = stages.written(stages.spread(own, "node", "next").distinct(), "neighbours-edges")
    many = stages.written(skew.hot(own.groupBy("node").agg(F.count("*").alias("n")), ["node"], per), "neighbours-hubs")
    own = skew.dealt(own, ["node"], many, F.col("next"))
    last = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct()
    seen = [last]
    for i in range(1, depth + 1):
        step = skew.copied(last.select("root", "node"), ["node"], many).join(own, ["node", "_salt"]).select("root", F.col("next").alias("node"), F.lit(i).alias("depth"))
        # one aggregation makes a round distinct and tells what is new in it
        met = reduce(DataFrame.unionByName, [step, *seen]).groupBy("root", "node").agg(F.min("depth").alias("depth"))
        last = stages.written(met.where(F.col("depth") == i), "neighbours-round")
        seen.append(last)
    return reduce(DataFrame.unionByName, seen[1:])


def provenance(roots: DataFrame, describes: DataFrame, in_file: DataFrame) -> DataFrame:
    """(root, record, file): the source records that describe a root, and their files."""
    d = describes.select(F.col("dst").alias("root"), F.col("src").alias("record"))
    return roots.join(d, "root").join(in_file.select(F.col("src").alias("record"), F.col("dst").alias("file")), "record").select("root", "record", "file").distinct()
