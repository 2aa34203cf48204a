"""Tables that streams add to batch by batch, so that any batch may come again.

A batch is one part of the table, a folder under the name of its run and number: writing it again overwrites it, and it
counts only once the manifest holds its entry, which is written last. The entry has the range of the part's keys, so a
batch is compared with the parts alone whose ranges meet its own; the others aren't opened. A merge of parts is a part whose
entry names those that it replaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.operators import fold

Sink = Callable[[DataFrame, int], None]


class BatchTable:
    """Rows of ``schema`` under ``place``; ``keys`` tell rows apart, and the first of them has ranges."""

    def __init__(self, spark: SparkSession, place: str, schema: str | StructType, keys: list[str]):
        self.spark, self.place, self.keys = spark, place.rstrip("/"), keys
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kind = self.schema[keys[0]].dataType.simpleString()
        self.entry = f"part string, n long, low {kind}, high {kind}, replaces array<string>"

    def manifest(self) -> list:
        """The entries, one for each part ever committed; a handful of values each."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.place}/manifest")
        if not at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
            return []
        return self.spark.read.schema(self.entry).option("recursiveFileLookup", True).parquet(f"{self.place}/manifest").collect()

    def parts(self, entries: list | None = None) -> list:
        """The entries that count: committed and not replaced."""
        entries = self.manifest() if entries is None else entries
        gone = {name for e in entries for name in e["replaces"] or []}
        return [e for e in entries if e["part"] not in gone]

    def read(self, parts: list | None = None) -> DataFrame:
        """All rows, or those of some parts; other folders aren't even listed."""
        names = [e["part"] for e in (self.parts() if parts is None else parts) if e["n"]]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.place}/data/{name}" for name in names])

    def put(self, rows: DataFrame, part: str, replaces: list[str] | None = None) -> None:
        """Write a part, over what an earlier try left, then its entry."""
        place, key = f"{self.place}/data/{part}", F.col(self.keys[0])
        rows.select(*self.schema.names).write.mode("overwrite").parquet(place)
        entry = self.spark.read.schema(self.schema).parquet(place).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        entry = entry.select(F.lit(part).alias("part"), "n", "low", "high", F.lit(replaces).cast("array<string>").alias("replaces"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.place}/manifest/{part}")

    def known(self, rows: DataFrame, entries: list) -> DataFrame | None:
        """The keys of committed rows within the range of ``rows``, from the parts that reach into it; None if there are none."""
        key = F.col(self.keys[0])
        low, high = rows.agg(F.min(key), F.max(key)).first()
        if low is None:
            return None
        met = [e for e in self.parts(entries) if e["n"] and e["low"] is not None and e["low"] <= high and e["high"] >= low]
        return self.read(met).where(key.between(low, high)).select(*self.keys) if met else None

    def append(self, rows: DataFrame, part: str) -> None:
        """Add the rows whose keys the table doesn't hold; a part that is committed stays as it is."""
        entries = self.manifest()
        if any(e["part"] == part for e in entries):
            return
        rows = rows.dropDuplicates(self.keys)
        known = self.known(rows, entries)
        if known is not None:
            rows = rows.join(known, self.keys, "left_anti")
        self.put(rows.sortWithinPartitions(self.keys[0]), part)

    def merge(self, name: str, by: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """One part in the place of all; ``by`` folds their rows."""
        parts = self.parts()
        if len(parts) > 1:
            rows = self.read(parts)
            self.put(by(rows) if by else rows, name, [e["part"] for e in parts])


def append_new(table: BatchTable, run: str) -> Sink:
    """A sink that adds new rows; ``run`` names the checkpoint, as batches are numbered within it."""
    return lambda batch, i: table.append(batch, f"{run}-{i}")


class FoldedTable:
    """Canonical properties of entities, folded over all batches under a rule for each property.

    A batch adds its own partial fold, which holds with each value the load order that it has. Partial folds go together in any
    order and any number of times, so late snapshots don't undo later ones, a batch may come again, and none deletes.
    """

    def __init__(self, spark: SparkSession, place: str, rows: StructType, keys: list[str], order: str, rules: dict[str, str]):
        self.keys, self.order, self.rules = keys, order, rules
        partial = fold.partial(spark.createDataFrame([], rows), keys, F.col(order), rules)
        self.table = BatchTable(spark, place, partial.schema, keys)

    def add(self, rows: DataFrame, part: str) -> None:
        self.table.put(fold.partial(rows, self.keys, F.col(self.order), self.rules), part)

    def sink(self, run: str) -> Sink:
        return lambda batch, i: self.add(batch, f"{run}-{i}")

    def merge(self, name: str) -> None:
        """Fold all parts into one, so that reading doesn't grow with the number of batches."""
        self.table.merge(name, lambda rows: fold.together(rows, self.keys, self.rules))

    def current(self) -> DataFrame:
        """(keys, properties) as of all committed batches."""
        return fold.finished(fold.together(self.table.read(), self.keys, self.rules), self.keys, self.rules)


def both(*sinks: Sink) -> Sink:
    """One sink of several, each of which may see a batch again."""

    def sink(batch: DataFrame, i: int) -> None:
        batch.persist()
        for s in sinks:
            s(batch, i)
        batch.unpersist()

    return sink
