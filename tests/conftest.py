import os
import sys
import tempfile
from pathlib import Path

import pytest

HOME = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, HOME)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.local.dir": work, "spark.sql.warehouse.dir": f"{work}/warehouse", "spark.driver.memory": "4g"}
    builder = SparkSession.builder.master("local[4]")
    for k, v in conf.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """The rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=str)
