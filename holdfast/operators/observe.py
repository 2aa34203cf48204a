"""Selection of observations in time, calendar grids and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.operators import skew, stages


def latest(obs: DataFrame, owner: str, as_of: str, uri: str) -> DataFrame:
    """One row an owner: of the greatest day, ties to the smallest uri; an undated one only if nothing is dated.

    Both steps combine before their shuffle, and the first is by owner and day, so an owner of many rows doesn't load one task.
    """
    days = obs.groupBy(F.col(owner).alias("_owner"), F.col(as_of).alias("_day")).agg(F.min_by(F.struct("*"), F.struct(uri)).alias("_row"))
    return days.groupBy("_owner").agg(F.max_by("_row", F.struct("_day")).alias("_row")).select("_row.*")


def at_or_before(obs: DataFrame, owner: str, as_of: str, uri: str, day: Column) -> DataFrame:
    """The latest one that isn't after the day."""
    return latest(obs.where(F.col(as_of) <= day), owner, as_of, uri)


def on_day(obs: DataFrame, as_of: str, day: Column) -> DataFrame:
    return obs.where(F.col(as_of) == day)


def between_days(obs: DataFrame, as_of: str, first: Column, last: Column) -> DataFrame:
    """Both ends included; undated ones aren't."""
    return obs.where(F.col(as_of).between(first, last))


def as_of(left: DataFrame, right: DataFrame, owner: tuple[str, str], at: tuple[str, str], tie: str, values: dict[str, str], step: str = "month", per: int = 1_000_000) -> DataFrame:
    """Rows of ``left``, each with ``values`` (column of ``right``, new name) of its owner's latest row of ``right`` at or before its own time.

    ``owner`` and ``at`` name the columns of both sides; rows of one owner and time go by the least ``tie``. Rows without an
    owner or a time, and those before everything, get nulls. Both sides lie on one timeline, which is cut into steps of the
    calendar: within a step the last value is carried on, and a step begins with the last value of the steps before it. Steps of more than
    ``per`` rows are dealt over salts, each of which has all of the step's values, so neither an owner nor a step of many rows loads one task.
    """
    value = F.struct(*[F.col(c).alias(n) for c, n in values.items()])
    own = right.select(F.col(owner[1]).alias("_k"), F.col(at[1]).alias("_at"), F.col(tie).alias("_tie"), value.alias("_v")).where("_k is not null and _at is not null")
    own = own.groupBy("_k", "_at").agg(F.min_by("_v", "_tie").alias("_v")).withColumn("_step", F.date_trunc(step, "_at"))
    asked = left.select(F.col(owner[0]).alias("_k"), F.col(at[0]).alias("_at"), F.date_trunc(step, at[0]).alias("_step"), F.struct("*").alias("_row"))
    placed = asked.where("_k is not null and _at is not null")
    # what each step begins with
    counts = placed.groupBy("_k", "_step").agg(F.count("*").alias("n"))
    ends = own.groupBy("_k", "_step").agg(F.max_by("_v", "_at").alias("_v"))
    steps = counts.join(ends, ["_k", "_step"], "full")
    before = F.last("_v", True).over(Window.partitionBy("_k").orderBy("_step").rowsBetween(Window.unboundedPreceding, -1))
    begins = steps.withColumn("_v", before).where("n is not null and _v is not null").select("_k", F.lit(None).cast(own.schema["_at"].dataType).alias("_at"), "_v", "_step")
    many = skew.hot(counts, ["_k", "_step"], per)
    known = skew.copied(own.select("_k", "_at", "_v", "_step").unionByName(begins), ["_k", "_step"], many)
    line = skew.dealt(placed, ["_k", "_step"], many, F.col("_row")).unionByName(known, allowMissingColumns=True)
    carried = Window.partitionBy("_k", "_step", "_salt").orderBy(F.col("_at").asc_nulls_first(), F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_v", F.last("_v", True).over(carried)).where("_row is not null").select("_row", "_v")
    rest = asked.where("_k is null or _at is null").select("_row", F.lit(None).cast(found.schema["_v"].dataType).alias("_v"))
    return found.unionByName(rest).select("_row.*", "_v.*")


def visible(rows: DataFrame, published: str, cutoff: Column) -> DataFrame:
    """Adds visible: evidence that was published after the cutoff stays in the table and out of answers; undated evidence too."""
    return rows.withColumn("visible", F.coalesce(F.col(published) <= cutoff, F.lit(False)))


def every(obs: DataFrame) -> DataFrame:
    """All of them, undated ones too."""
    return obs


def month_grid(spark: SparkSession, start: str, months: int) -> DataFrame:
    """(i, day): the start and the months after it. A day cut to a short month stays cut in the later ones."""
    grid = spark.range(months + 1).select(F.col("id").cast("int").alias("i"), F.add_months(F.trunc(F.lit(start).cast("date"), "month"), F.col("id").cast("int")).alias("month"))
    least = F.min(F.dayofmonth(F.last_day("month"))).over(Window.partitionBy(F.lit(0)).orderBy("i"))
    day = F.least(least, F.dayofmonth(F.lit(start).cast("date")))
    return grid.select("i", F.date_add("month", day - 1).alias("day"))


def grid(points: DataFrame, at: str) -> DataFrame:
    """(i, at): the distinct points of a calendar, numbered in order. Calendars are small, some ten thousand days at most."""
    return points.select(F.col(at).alias("at")).where("at is not null").distinct().select((F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at")) - 1).alias("i"), "at")


def day_grid(rows: DataFrame, day: str) -> DataFrame:
    """(i, at): every day from the first to the last of the rows."""
    return rows.agg(F.sequence(F.min(day), F.max(day)).alias("_days")).select(F.posexplode("_days").alias("i", "at"))


def gaps(targets: DataFrame, have: DataFrame, target: str, at: str, points: DataFrame) -> DataFrame:
    """(target, first, last, n, first_i, last_i): each target's runs of the calendar's points (i, at) that it doesn't have.

    Rows are each target's own points and one for its end, never targets times points; what it has off the calendar doesn't
    count. A target's points are no more than the calendar's, so none is large.
    """
    own = have.select(target, F.col(at).alias("at")).distinct().join(F.broadcast(points), "at").select(target, "i")
    ends = points.agg(F.max("i").alias("_last"))
    marks = targets.select(target).distinct().join(F.broadcast(ends)).select(target, (F.col("_last") + 1).alias("i")).unionByName(own.join(targets.select(target).distinct(), target, "left_semi"))
    before = F.coalesce(F.lag("i").over(Window.partitionBy(target).orderBy("i")), F.lit(-1))
    runs = marks.withColumn("_before", before).where(F.col("i") > F.col("_before") + 1).select(target, (F.col("_before") + 1).alias("first_i"), (F.col("i") - 1).alias("last_i"))
    named = lambda name: F.broadcast(points.select(F.col("i").alias(f"{name}_i"), F.col("at").alias(name)))
    out = runs.join(named("first"), "first_i").join(named("last"), "last_i")
    return out.select(target, "first", "last", (F.col("last_i") - F.col("first_i") + 1).cast("long").alias("n"), "first_i", "last_i")


def gap_days(found: DataFrame, target: str, points: DataFrame) -> DataFrame:
    """(target, at): the points of gaps one by one."""
    each = found.select(target, F.explode(F.sequence("first_i", "last_i")).alias("i"))
    return each.join(F.broadcast(points), "i").select(target, "at")


def shards(rows: DataFrame, group: list[str], order: list[str], size: int = 500, ranges: int | None = None) -> DataFrame:
    """Adds ``ordinal`` and ``shard``: runs of at most ``size`` rows of each group, in order, nulls first.

    Rows are dealt over ranges of the whole key (group and order, of any types, and a hash of the row where those repeat),
    whose bounds Spark samples, and written, so that they stay where they are. Rows are numbered within a group and a
    range; a group that goes on over several ranges adds the counts of those before. A range has one such group at most,
    so these counts are broadcast, and no group is sorted in one task.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_tie", F.xxhash64(*rows.columns)).repartitionByRange(ranges, *group, *order, "_tie").withColumn("_range", F.spark_partition_id())
    keyed = stages.written(keyed, "shards")
    counts = keyed.groupBy(*[F.col(g).alias(f"_{g}") for g in group], F.col("_range").alias("_at")).agg(F.count("*").alias("_n"))
    ahead = counts.withColumn("_ahead", F.sum("_n").over(Window.partitionBy(*[f"_{g}" for g in group]).orderBy("_at")) - F.col("_n")).where("_ahead > 0")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col("_range") == F.col("_at")]
    place = F.row_number().over(Window.partitionBy(*group, "_range").orderBy(*order, "_tie"))
    placed = keyed.withColumn("_k", place).join(F.broadcast(ahead), same, "left")
    out = placed.withColumn("ordinal", F.col("_k") + F.coalesce("_ahead", F.lit(0))).withColumn("shard", F.floor((F.col("ordinal") - 1) / size))
    return out.select(*rows.columns, "ordinal", "shard")


def in_window(rows: DataFrame, day: Column, first: Column, last: Column, published: Column, cutoff: Column) -> DataFrame:
    """Rows of days in the window that were published by the cutoff."""
    return rows.where((day >= first) & (day <= last) & (published <= cutoff))


def versions(docs: DataFrame, target: list[str], published: str, identity: str) -> DataFrame:
    """Adds ``version``: every version of a document is kept, numbered by its publication."""
    return docs.withColumn("version", F.row_number().over(Window.partitionBy(*target).orderBy(F.col(published).asc_nulls_last(), identity)))


def changes(positions: DataFrame, owner: str, item: str, snapshot: str) -> DataFrame:
    """(owner, item, snapshot, change): what entered with a snapshot, and what left with the one after its last."""
    snaps = positions.select(owner, snapshot).distinct()
    w = Window.partitionBy(owner).orderBy(snapshot)
    snaps = snaps.withColumn("_before", F.lag(snapshot).over(w)).withColumn("_after", F.lead(snapshot).over(w))
    held = positions.select(owner, item, snapshot).distinct().join(snaps, [owner, snapshot])
    wi = Window.partitionBy(owner, item).orderBy(snapshot)
    held = held.withColumn("_held_before", F.lag(snapshot).over(wi)).withColumn("_held_after", F.lead(snapshot).over(wi))
    entry = held.where("_before is not null and not (_held_before <=> _before)").select(owner, item, F.col(snapshot), F.lit("entry").alias("change"))
    leave = held.where("_after is not null and not (_held_after <=> _after)").select(owner, item, F.col("_after").alias(snapshot), F.lit("exit").alias("change"))
    return entry.unionByName(leave)
