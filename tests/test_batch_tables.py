"""Tables that streams add to: replays, crashes between steps, pruned parts, folds in any order of arrival."""

import random

import pytest

from pyspark.sql import functions as F

from holdfast.operators import fold
from holdfast.streaming import intake, tables


def numbers(spark, low, high):
    return spark.range(low, high).select("id", (F.col("id") * 2).alias("v"))


def table_at(spark, tmp_path):
    return tables.BatchTable(spark, str(tmp_path / "t"), "id long, v long", ["id"])


def test_replays_add_nothing(spark, tmp_path):
    numbers(spark, 0, 10).write.parquet(str(tmp_path / "in"))
    table = table_at(spark, tmp_path)
    for run in ("a", "a", "b"):  # again with its checkpoint, and after the checkpoint is lost
        intake.stream_intake(spark, str(tmp_path / "in"), "id long, v long", str(tmp_path / run), tables.append_new(table, run)).awaitTermination()
    assert sorted(r["id"] for r in table.read().collect()) == list(range(10))
    numbers(spark, 5, 12).write.mode("append").parquet(str(tmp_path / "in"))
    intake.stream_intake(spark, str(tmp_path / "in"), "id long, v long", str(tmp_path / "b"), tables.append_new(table, "b")).awaitTermination()
    assert sorted(r["id"] for r in table.read().collect()) == list(range(12))


def test_a_crash_before_the_entry_or_before_the_checkpoint(spark, tmp_path, monkeypatch):
    table = table_at(spark, tmp_path)
    table.append(numbers(spark, 0, 5), "r-0")
    # data written, no entry: the part doesn't count and is overwritten
    numbers(spark, 3, 99).write.parquet(f"{table.place}/data/r-1")
    assert table.read().count() == 5
    table.append(numbers(spark, 3, 8), "r-1")
    assert sorted(r["id"] for r in table.read().collect()) == list(range(8))
    # entry written, batch comes again
    table.append(numbers(spark, 3, 8), "r-1")
    assert table.read().count() == 8 and [e["n"] for e in table.parts()] == [5, 3] or [e["n"] for e in table.parts()] == [3, 5]


def test_only_parts_in_range_are_opened(spark, tmp_path):
    table = table_at(spark, tmp_path)
    for k in range(4):
        table.append(numbers(spark, 100 * k, 100 * k + 50), f"r-{k}")
    table.append(numbers(spark, 0, 0), "r-4")  # an empty batch
    known = table.known(numbers(spark, 240, 310), table.manifest())
    assert {f.split("/data/")[1].split("/")[0] for f in known.inputFiles()} == {"r-2", "r-3"}
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,240), LessThanOrEqual(id,309)]" in known._jdf.queryExecution().executedPlan().toString() or "GreaterThanOrEqual(id,240)" in known._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert table.known(numbers(spark, 60, 90), table.manifest()) is None
    table.append(numbers(spark, 240, 310), "r-5")
    assert table.read().count() == 4 * 50 + 60 - 10
    table.merge("all")
    assert [e["part"] for e in table.parts()] == ["all"] and table.read().count() == 250
    table.append(numbers(spark, 0, 3), "r-2")  # replaced, and committed all the same
    table.append(numbers(spark, 0, 3), "r-6")
    assert table.read().count() == 250


def test_rows_that_repeat_and_null_keys(spark, tmp_path):
    table = table_at(spark, tmp_path)
    table.append(spark.createDataFrame([(1, 1), (1, 1), (None, 5)], "id long, v long"), "r-0")
    table.append(spark.createDataFrame([(1, 1), (2, 1)], "id long, v long"), "r-1")
    assert sorted((r["id"] for r in table.read().collect()), key=str) == [1, 2, None]


RULES = {"name": "last_value", "since": "first_value", "state": "last_row"}


@pytest.mark.parametrize("seed", [1, 2])
def test_folds_in_any_order(spark, tmp_path, rows, seed):
    """Snapshots arrive late first, one twice, and are merged in between: the result is that of one fold of all."""
    rng = random.Random(seed)
    some = lambda v: v if rng.random() > 0.4 else None
    data = [(rng.randrange(6), at, some(f"n{at}"), some(at * 10), some(f"s{at}")) for at in range(40)]
    df = spark.createDataFrame(data, "k int, at int, name string, since int, state string")
    table = tables.FoldedTable(spark, str(tmp_path / "t"), df.schema, ["k"], "at", RULES)
    assert table.current().collect() == []
    for i, (low, high) in enumerate([(30, 40), (10, 20), (30, 40), (0, 10), (20, 30)]):
        table.add(df.where(F.col("at").between(low, high - 1)), f"run-{i}")
        if i == 2:
            table.merge("merged")
    assert rows(table.current()) == rows(fold.fold(df, ["k"], F.col("at"), RULES))
    with pytest.raises(ValueError):
        fold.partial(df, ["k"], F.col("at"), {"name": "other"})


def test_a_stream_that_folds_and_appends(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 2, "new", "u3"), (1, 1, "old", "u1"), (2, 1, "kept", "u2")], "k int, at int, name string, uri string")
    folded = tables.FoldedTable(spark, str(tmp_path / "f"), df.schema, ["k"], "at", {"name": "last_value"})
    seen = tables.BatchTable(spark, str(tmp_path / "o"), "uri string, k int", ["uri"])
    for i, at in enumerate((2, 1, 2)):  # the later snapshot lands first, and once more at the end
        df.where(F.col("at") == at).write.parquet(str(tmp_path / f"in{i}"))
        sink = tables.both(folded.sink(f"r{i}"), tables.append_new(seen, f"r{i}"))
        intake.stream_intake(spark, str(tmp_path / f"in{i}"), df.schema, str(tmp_path / f"c{i}"), sink).awaitTermination()
    assert rows(folded.current()) == [(1, "new"), (2, "kept")] and sorted(r["uri"] for r in seen.read().collect()) == ["u1", "u2", "u3"]
