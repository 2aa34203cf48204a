"""What the training-data operators share: session settings, shared tables, table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: list[str] = []
_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share.

    Only in a local session without the setting, as in tests, a temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN_DIR:
            _OWN_DIR.append(tempfile.mkdtemp(prefix="holdfast-"))
        base = f"file://{_OWN_DIR[0]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = shared_dir(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing still to be computed reads."""
    for df in tables:
        if (path := _PLACES.pop(df, None)) is not None:
            remove(df.sparkSession, path)


def size_of(df: DataFrame) -> int:
    """Bytes of a table of ``materialise``."""
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_PLACES[df])
    return at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).getContentSummary(at).getLength()


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


#: Rows that a Python task gets at once, where the session has Spark's default of 10,000: texts are long.
BATCH_ROWS = 1000


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (dots written as two underscores) while a table is planned and written; then what they were before."""
    before = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k.replace("__", "."), v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def importable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it, and get batches fit for long texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    home, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, home]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under internal names, so that other columns can't clash."""
    importable(df.sparkSession)
    return df.select(*[df[c].alias(k) for k, c in cols.items()])


def keep_rows(docs: DataFrame, text: Column, mask: Callable[[pa.RecordBatch], np.ndarray], **extra: Column) -> DataFrame:
    """The rows of ``docs``, all columns as they are, for which ``mask`` of a batch (text and ``extra``) holds."""
    importable(docs.sparkSession)
    whole = docs.select(F.struct("*").alias("row"), text.alias("text"), *[c.alias(k) for k, c in extra.items()])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row")], ["row"]).filter(pa.array(mask(batch), pa.bool_()))

    return whole.mapInArrow(run, f"row {whole.schema['row'].dataType.simpleString()}").select("row.*")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id has fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")
