"""Sequences in time: holes, runs, running totals, spines, axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from . import intervals


def holes(det: DataFrame, max_gap: str, by: list[str] | None = None, lo: Column | None = None, hi: Column | None = None, time: str = "acq_datetime") -> DataFrame:
    """Spans between successive times that are longer than max_gap: (by,) start, end.

    Two levels: gaps within a day from windows over days, and gaps across days from each day's first and last
    time, of which there are few.  lo and hi, where given, bound the whole: an empty table is one hole.
    """
    by = by or []
    times = det.select(*by, F.col(time).alias("t")).distinct()
    if lo is not None and hi is not None:
        times = times.filter((F.col("t") > lo) & (F.col("t") < hi))
    times = times.withColumn("d", F.to_date("t"))
    within = times.withColumn("p", F.lag("t").over(Window.partitionBy(*by, "d").orderBy("t"))).select(*by, F.col("p").alias("start"), F.col("t").alias("end"))
    days = times.groupBy(*by, "d").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    if lo is not None and hi is not None:
        ends = det.sparkSession.range(1).select(lo.alias("lo"), hi.alias("hi"))
        days = days.unionByName(ends.select(F.to_date("lo").alias("d"), F.col("lo").alias("first"), F.col("lo").alias("last"))).unionByName(ends.select(F.to_date("hi").alias("d"), F.col("hi").alias("first"), F.col("hi").alias("last")))
    w = Window.partitionBy(*by).orderBy("first", "last")
    across = days.withColumn("p", F.lag("last").over(w)).select(*by, F.col("p").alias("start"), F.col("first").alias("end"))
    return within.unionByName(across).filter(F.col("start").isNotNull() & (F.col("end") > F.col("start") + F.expr(f"interval {max_gap}")))


def days_touched(spans: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """The days of spans (start, end), clipped to [lo, hi]."""
    a, b = F.greatest(F.to_date("start"), lo), F.least(F.to_date("end"), hi)
    return spans.filter(a <= b).select(F.explode(F.sequence(a, b)).alias("day")).distinct()


def runs(days: DataFrame, cap: int = 5) -> DataFrame:
    """Runs of successive days, each cut to at most so many: start, n_days."""
    w = Window.orderBy("day")  # a row per day of the calendar
    island = days.select("day", F.date_sub("day", F.row_number().over(w)).alias("g"))
    pos = F.row_number().over(Window.partitionBy("g").orderBy("day")) - 1
    return island.select("day", "g", F.floor(pos / cap).alias("part")).groupBy("g", "part").agg(F.min("day").alias("start"), F.count("*").alias("n_days")).select("start", "n_days")


def spine(det: DataFrame, unit: str, lo: Column, hi: Column) -> DataFrame:
    """Every bucket of the calendar between two keys: idx, bucket."""
    one = det.sparkSession.range(1)
    return one.select(F.explode(F.sequence(keys.bucket_index(lo), keys.bucket_index(hi))).alias("idx")).select("idx", keys.bucket_key(F.col("idx"), unit).alias("bucket"))


def dense(cells: DataFrame, buckets: DataFrame) -> DataFrame:
    """Every cell with every bucket of the spine; what is absent counts 0. The spine is as long as the calendar, not the data."""
    grid = cells.select("cell").distinct().crossJoin(F.broadcast(buckets.select("bucket")))
    return grid.join(cells.select("cell", "bucket", "cnt"), ["cell", "bucket"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))


def running(cells: DataFrame) -> DataFrame:
    """Running totals along the buckets of each cell, as longs."""
    w = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.select("cell", "bucket", F.sum(F.coalesce("cnt", F.lit(0))).over(w).cast("long").alias("running"))


def range_sum(total: DataFrame, lo: str, hi: str) -> DataFrame:
    """Per cell the sum over [lo, hi] from running totals: the last at or before hi less the last before lo."""
    at = lambda cond: F.coalesce(F.max(F.when(cond, F.col("running"))), F.lit(0))  # noqa: E731  running totals never fall
    return total.filter(F.col("bucket") <= hi).groupBy("cell").agg((at(F.col("bucket") <= hi) - at(F.col("bucket") < lo)).alias("cnt"))


def running_blocks(cells: DataFrame, block: Column) -> DataFrame:
    """Running totals that begin anew in each block of buckets: cell, block, bucket, running. A changed bucket then changes one block, not all that follow."""
    w = Window.partitionBy("cell", "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn("block", block).select("cell", "block", "bucket", F.sum(F.coalesce("cnt", F.lit(0))).over(w).cast("long").alias("running"))


def block_totals(blocks: DataFrame) -> DataFrame:
    """What each block adds to a cell: cell, block, total."""
    return blocks.groupBy("cell", "block").agg(F.max("running").alias("total"))


def block_range_sum(blocks: DataFrame, totals: DataFrame, lo: str, hi: str, block_of) -> DataFrame:
    """Per cell the sum over [lo, hi]: the totals of the blocks between, and within the first and last block the running totals.

    block_of tells the block of a bucket, as a value; of the blocks only the first and the last one are read.
    """
    first, last = block_of(lo), block_of(hi)
    at = lambda cond: F.coalesce(F.max(F.when(cond, F.col("running"))), F.lit(0))
    ends = blocks.filter(F.col("block").isin(first, last)).groupBy("cell", "block").agg((at(F.col("bucket") <= hi) - at(F.col("bucket") < lo)).alias("cnt"))
    between = totals.filter((F.col("block") > first) & (F.col("block") < last)).select("cell", "block", F.col("total").alias("cnt"))
    return ends.unionByName(between).groupBy("cell").agg(F.sum("cnt").cast("long").alias("cnt"))


def gaps(axis: DataFrame, sources: DataFrame) -> DataFrame:
    """Of an axis (pos, bucket, unit): ranges of positions that no source (unit, min_key, max_key) of the unit covers."""
    at = lambda c: keys.bucket_index(F.col(c))
    held = intervals.holding(axis, at("bucket"), sources.select("unit", "min_key", "max_key").distinct(), at("min_key"), at("max_key"), ("unit",))
    bare = axis.join(held.select("pos").distinct(), "pos", "left_anti")
    island = bare.withColumn("g", F.col("pos") - F.row_number().over(Window.orderBy("pos")))  # a row per bucket of the axis
    return island.groupBy("g").agg(F.min("pos").alias("from_pos"), F.max("pos").alias("to_pos")).select("from_pos", "to_pos")


def union_axis(sources: DataFrame) -> DataFrame:
    """The finest unit of the sources, and the extent of those that have it: unit, min_key, max_key."""
    rank = F.when(F.col("unit") == "day", 0).otherwise(1)
    finest = F.min(rank).over(Window.partitionBy(F.lit(0)))
    return sources.withColumn("r", rank).withColumn("f", finest).filter("r = f").groupBy("unit").agg(F.min("min_key").alias("min_key"), F.max("max_key").alias("max_key"))


def downsample(series: DataFrame, size: int | Column, width: int) -> DataFrame:
    """A series (idx, value) of size buckets to at most width bars: bar, total, mean. Totals are conserved."""
    n = size if isinstance(size, Column) else F.lit(size)
    bar = F.when(n < width, F.col("idx")).otherwise(F.floor(((F.col("idx") + 1) * width - 1) / n))
    return series.groupBy(bar.cast("long").alias("bar")).agg(F.sum("value").alias("total"), F.avg("value").alias("mean"))


def overlaps(det: DataFrame) -> DataFrame:
    """Sensors whose ranges of two qualities meet: sensor, quality, until, next_quality, next_from."""
    each = det.groupBy("sensor", "quality").agg(F.min("acq_date").alias("lo"), F.max("acq_date").alias("hi"))
    w = Window.partitionBy("sensor").orderBy("lo", "quality")
    follow = each.withColumns({"next_quality": F.lead("quality").over(w), "next_from": F.lead("lo").over(w)})
    return follow.filter(F.col("next_from") <= F.col("hi")).select("sensor", "quality", F.col("hi").alias("until"), "next_quality", "next_from")


def declare_axis(cells: DataFrame) -> DataFrame:
    """One row: unit, key_format, min_key, max_key, buckets. No buckets, mixed or odd widths raise."""
    n = F.length("bucket")
    t = cells.agg(F.min("bucket").alias("min_key"), F.max("bucket").alias("max_key"), F.countDistinct("bucket").alias("buckets"), F.min(n).alias("a"), F.max(n).alias("b"))
    sound = F.assert_true(F.coalesce((F.col("a") == F.col("b")) & F.col("a").isin(6, 8), F.lit(False)), "buckets are absent, mixed, or neither months nor days")
    unit = F.when(F.col("a") == 6, "month").otherwise("day")
    return t.filter(sound.isNull()).select(unit.alias("unit"), F.when(F.col("a") == 6, "YYYYMM").otherwise("YYYYMMDD").alias("key_format"), "min_key", "max_key", "buckets")


def axis_of_columns(names: list[str]) -> dict[str, object]:
    """The same from the names of a wide table; counts of other things than time are passed over."""
    found = sorted(n[6:] for n in names if n.startswith("count_") and n[6:].isdigit())
    widths = {len(k) for k in found}
    if not found or len(widths) > 1 or widths - {6, 8}:
        raise ValueError(f"no axis in widths {sorted(widths)}")
    unit = "month" if widths == {6} else "day"
    return {"unit": unit, "key_format": "YYYYMM" if unit == "month" else "YYYYMMDD", "min": found[0], "max": found[-1], "buckets": len(found)}


def energy(det: DataFrame, by: list[str], cap_hours: float = 24.0) -> DataFrame:
    """Power integrated over time (trapezoids between successive overpasses; longer gaps than the cap are left out).

    Two levels, as holes: pieces within a day from windows over days, and pieces across days from each day's first and last overpass.
    """
    seen = det.filter(F.col("frp").isNotNull()).groupBy(*by, F.col("acq_datetime").cast("timestamp").alias("t")).agg(F.sum("frp").alias("f")).withColumn("d", F.to_date("t"))
    point = F.struct("t", "f")
    within = seen.select(*by, F.lag(point).over(Window.partitionBy(*by, "d").orderBy("t")).alias("a"), point.alias("b"))
    days = seen.groupBy(*by, "d").agg(F.min(point).alias("b"), F.max(point).alias("last"))
    across = days.select(*by, F.lag("last").over(Window.partitionBy(*by).orderBy("d")).alias("a"), "b")
    dt = (F.unix_micros("b.t") - F.unix_micros("a.t")) / 1e6
    part = F.when(dt <= cap_hours * 3600, (F.col("a.f") + F.col("b.f")) / 2 * dt)
    return within.unionByName(across).groupBy(*by).agg(F.sum(part).alias("energy"))


def climatology(cells: DataFrame) -> DataFrame:
    """Per cell, month of the year and year: count, and mean and deviation of the other years."""
    w = Window.partitionBy("cell", "moy")
    n, s, q = F.count("*").over(w) - 1, F.sum("cnt").over(w) - F.col("cnt"), F.sum(F.col("cnt") * F.col("cnt")).over(w) - F.col("cnt") * F.col("cnt")
    mean = F.when(n > 0, s / n)
    return cells.select("cell", "moy", "year", "cnt", mean.alias("mean_other"), F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), (q - s * s / n) / (n - 1)))).alias("sd_other"))


def persistent(cells: DataFrame, least: int) -> DataFrame:
    """Cells active in at least so many distinct buckets."""
    return cells.groupBy("cell").agg(F.countDistinct("bucket").alias("active")).filter(F.col("active") >= least)
