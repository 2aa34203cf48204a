"""Operator 2: lines that many documents share, found through levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z lowered; its hash has 64 bits. ``LineRuns``
holds how many documents had each key, in sorted runs on levels; a key is in one run only. A batch is counted and
merge-anti-joined with each run: its new keys become a run of level 0. The counts of keys that runs have already are
kept beside it. When a level has ``fanout`` runs they are merged into one of the next level,
so that a key is rewritten a number of times that grows with the logarithm of the batches. Runs are Parquet tables in
buckets by hash, sorted within each, so that neither joining nor merging them takes a shuffle.

Everything is DataFrame functions. Defined cases: a null text is one empty line, as an empty text is; each row counts
as a document, also where ids repeat or are null; an empty table gives no rows. Ids may be of any type.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, remove, settings, shared_dir, size_of

_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lowered, all else as it is; ASCII texts take the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(F.split(lowered(text), "\n", -1), lambda line: F.btrim(line, F.lit(_SPACE)))


def line_hashes(text: Column, least_length: int = 1) -> Column:
    """The hashes of a text's lines, in order; null for keys of fewer code points."""
    return F.transform(line_keys(text), lambda key: F.when(F.length(key) >= least_length, F.xxhash64(key)))


def _keys(run: DataFrame) -> DataFrame:
    return run.select("hash").hint("merge")


class LineRuns:
    """Counts of documents by line hash, in sorted runs on levels. ``buckets``: of each run, one sorted file each."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]
        self.met: list[DataFrame] = []  # counts of keys that a run had when their batch came
        self.compacted = 0
        self._tables: list[tuple[str, str]] = []  # what was merged stays until the end, for what its batches met

    @property
    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def in_order(self):
        """Settings under which a shuffle deals keys as the buckets do, and a bucket of one file is read in its order."""
        return settings(self.spark, spark__sql__shuffle__partitions=str(self.buckets), spark__sql__legacy__bucketedTableScan__outputOrdering="true")

    def _sorted(self, counts: DataFrame, name: str) -> DataFrame:
        """A run of rows whose buckets lie in one task each, after a shuffle by hash or from other runs."""
        table, path = f"holdfast_{uuid.uuid4().hex}", shared_dir(self.spark, name)
        with self.in_order():
            counts.write.bucketBy(self.buckets, "hash").sortBy("hash").option("path", path).saveAsTable(table)
        self._tables.append((table, path))
        return self.spark.table(table)

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The rows of ``hashes`` whose hash no run holds."""
        return reduce(lambda left, run: left.join(_keys(run), "hash", "left_anti"), self.runs, hashes)

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """Several runs as one, bucket by bucket in order of hash; a key is in one of them only."""
        both = lambda a, b: a.hint("merge").join(b.withColumnRenamed("docs", "other"), "hash", "full").select("hash", F.coalesce("docs", "other").alias("docs"))
        return reduce(both, runs)

    def add(self, hashes: DataFrame) -> None:
        """Take in a batch: one row (hash) for each document and distinct key.

        Its counts go by the runs in one merge join, which leaves both sides of the anti-join: keys that no run holds are the
        new run, the others are kept beside the runs.
        """
        batch, marks = hashes.groupBy("hash").agg(F.count("*").alias("docs")), []
        for i, run in enumerate(self.runs):
            marks.append(F.col(f"in_{i}"))
            batch = batch.join(_keys(run).select("hash", F.lit(True).alias(f"in_{i}")).hint("merge"), "hash", "left")
        table = self._sorted(batch.select("hash", "docs", F.coalesce(*marks, F.lit(False)).alias("seen")), "line-run-0")
        if marks:
            self.met.append(table.where("seen").select("hash", "docs"))
        self.levels[0].append(table.where("not seen").select("hash", "docs"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._sorted(self.merged(runs), f"line-run-{level + 1}"))
            self.compacted += 1
            level += 1

    def counts(self) -> DataFrame:
        """(hash, docs) of all keys so far."""
        if not self.runs:
            return self.spark.createDataFrame([], "hash long, docs long")
        have = reduce(DataFrame.unionByName, self.runs)
        if not self.met:
            return have
        more = reduce(DataFrame.unionByName, self.met).groupBy("hash").agg(F.sum("docs").alias("more"))
        return have.join(more, "hash", "left").select("hash", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"))

    def close(self) -> None:
        """Delete all runs."""
        for table, path in self._tables:
            self.spark.sql(f"DROP TABLE {table}")
            remove(self.spark, path)
        self._tables, self.levels, self.met = [], [[]], []


#: Bytes of hashes that make a batch, and a bucket of a batch's run.
BATCH_BYTES, BUCKET_BYTES = 1 << 36, 1 << 25
#: Shares that documents are dealt to, by the partition that they are read in, before their bytes are known.
SHARES = 64


def drop_frequent_lines(docs: DataFrame, frequent: int = 10, least_length: int = 1, least_batches: int = 5, fanout: int = 4, text_col: str = "text", id_col: str = "doc_id", small: int = 1_000_000) -> DataFrame:
    """row (a struct of all columns of ``docs``), n_lines, n_dropped, kept (the text left).

    Lines whose key at least ``frequent`` documents have are dropped in all of them. At most ``small`` frequent hashes
    (8 MB) are broadcast; more are joined by a shuffle. Documents' hashes are written in SHARES shares, a task's in one of them, so
    each writes one file; batches take several shares, so that there are ``least_batches`` of them, or more (SHARES at most)
    where they would exceed BATCH_BYTES. Tables of fewer partitions leave some batches empty. Runs have a bucket for each
    BUCKET_BYTES of a batch, and one for each core at least.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    # ids that repeat do no harm: frequent lines of either row are dropped in both
    own = F.col("row")[id_col]
    rows = docs.select(F.struct("*").alias("row")).select("row", F.when(own.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(own)).alias("key"))
    hashed = rows.select("key", F.array_compact(F.array_distinct(line_hashes(text, least_length))).alias("hashes"))
    hashed = materialise(hashed.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(SHARES)).cast("int")), "line-hashes", "share")
    size = size_of(hashed)
    batches = min(SHARES, max(least_batches, -(-size // BATCH_BYTES)))
    runs = LineRuns(spark, fanout, max(spark.sparkContext.defaultParallelism, -(-size // (batches * BUCKET_BYTES))))
    for b in range(batches):
        runs.add(hashed.where(F.col("share").isin(list(range(b, SHARES, batches)))).select(F.explode("hashes").alias("hash")))
    known = materialise(runs.counts().where(F.col("docs") >= frequent).select("hash"), "line-frequent")
    runs.close()
    side = F.broadcast(known) if known.count() <= small else known
    hit = hashed.select("key", F.explode("hashes").alias("hash")).join(side, "hash").groupBy("key").agg(F.collect_set("hash").alias("drop"))
    return _kept(rows.join(hit, "key", "left"), text, least_length)


def _kept(rows: DataFrame, text: Column, least_length: int) -> DataFrame:
    """Only texts with a frequent line are taken apart."""
    newlines = lambda c: (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))).cast("long")
    lines = F.arrays_zip(F.split(text, "\n", -1).alias("line"), line_hashes(text, least_length).alias("hash"))
    left = F.transform(F.filter(lines, lambda x: ~F.coalesce(F.array_contains("drop", x["hash"]), F.lit(False))), lambda x: x["line"])
    rows = rows.withColumn("left", F.when(F.col("drop").isNotNull(), left)).withColumn("n_lines", newlines(text) + 1)
    kept = F.when(F.col("drop").isNull(), text).otherwise(F.array_join("left", "\n"))
    dropped = F.when(F.col("drop").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("left"))
    return rows.select("row", "n_lines", dropped.cast("long").alias("n_dropped"), kept.alias("kept"))
