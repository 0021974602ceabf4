"""Keeping a year complete: tail replacement, day replacement, supersession."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows (sensor, day) that are broadcast at most: ten sensors for over two hundred years.
MOST_SENSOR_DAYS = 1_000_000


def merge_tail(archive: DataFrame, window: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Archive rows before the window's first time, and the whole window; with keys, per key, so that a feed that failed keeps its tail."""
    start = window.groupBy(*by).agg(F.min("acq_datetime").alias("__t0"))  # a row per key: of no bounded number, so Spark chooses the join
    if by:
        head = archive.join(start, list(by), "left").filter(F.col("__t0").isNull() | (F.col("acq_datetime") < F.col("__t0")))
    else:
        head = archive.crossJoin(F.broadcast(start)).filter(F.col("__t0").isNull() | (F.col("acq_datetime") < F.col("__t0")))
    return head.drop("__t0").unionByName(window, allowMissingColumns=True)


def merge_decision(archive: DataFrame, window: DataFrame, year: int, allow_gap: bool = False, seed_days: int = 10) -> DataFrame:
    """One row: action (merge, seed, noop, refuse) and reason, from the two tables' first and last times."""
    ends = lambda df, p: df.agg(F.min("acq_datetime").alias(f"{p}_lo"), F.max("acq_datetime").alias(f"{p}_hi"))
    one = ends(archive, "a").crossJoin(ends(window, "w"))  # one row each
    case = (
        F.when(F.col("w_lo").isNull(), "noop:no window")
        .when(F.col("a_lo").isNull() & ((F.year("w_lo") != year) | (F.dayofyear("w_lo") > seed_days)), "refuse:no archive and the window starts too late to seed one")
        .when(F.col("a_lo").isNull(), "seed:a new year")
        .when((F.col("w_lo") > F.col("a_hi")) & ~F.lit(allow_gap), "refuse:the window starts after the archive ends")
        .when(F.col("w_hi") <= F.col("a_hi"), "noop:the archive covers the window")
        .otherwise("merge:the window reaches past the archive")
    )
    return one.select(F.split(case, ":")[0].alias("action"), F.split(case, ":")[1].alias("reason"))


def merge(archive: DataFrame, window: DataFrame, year: int, allow_gap: bool = False, seed_days: int = 10) -> tuple[str, DataFrame]:
    """The action taken and the rows that result; a merge that does not reach the window's end raises."""
    action, reason = merge_decision(archive, window, year, allow_gap, seed_days).first()
    if action in ("noop", "refuse"):
        return f"{action}: {reason}", archive
    out = merge_tail(archive, window)
    reached, want = out.agg(F.max("acq_datetime")).first()[0], window.agg(F.max("acq_datetime")).first()[0]
    if reached != want:
        raise ValueError(f"the merge ends at {reached}, the window at {want}")
    return f"{action}: {reason}", out


def replace_days(archive: DataFrame, refetched: DataFrame, days: DataFrame) -> DataFrame:
    """Archive without the days, and the refetched rows of those days."""
    d = F.broadcast(days.select(F.col("day").alias("acq_date")))  # days of a calendar
    return archive.join(d, "acq_date", "left_anti").unionByName(refetched.join(d, "acq_date", "left_semi"), allowMissingColumns=True)


def repair(archive: DataFrame, refetched: DataFrame, days: DataFrame, still_open) -> tuple[str, DataFrame]:
    """replace_days, guarded: refused if nothing was refetched, rows do not add up, or still_open(rows) has holes."""
    d = F.broadcast(days.select(F.col("day").alias("acq_date"), F.lit(True).alias("__due")))
    out = replace_days(archive, refetched, days)
    # the three counts in one pass over each table
    count = lambda df, what: df.select("acq_date").join(d, "acq_date", "left").agg(F.count_if(F.col("__due").isNull()).alias("other"), F.count_if("__due").alias("due")).select(F.lit(what).alias("of"), "*")
    of = {r["of"]: r for r in count(archive, "archive").union(count(refetched, "refetched")).union(count(out, "out")).collect()}
    keep, fill = of["archive"]["other"], of["refetched"]["due"]
    if not fill:
        return "refused: nothing was refetched", archive
    if of["out"]["other"] + of["out"]["due"] != keep + fill:
        return "refused: rows do not add up", archive
    if still_open(out).take(1):
        return "refused: still uncovered", archive
    return f"replaced: {keep} kept, {fill} added", out


def supersede(det: DataFrame, most: int = MOST_SENSOR_DAYS) -> DataFrame:
    """Science-quality rows replace near-real-time ones of the same sensor and day.

    The sensors' days that have such rows are a calendar's worth; up to so many they are broadcast, so that the rows stay where they are.
    """
    due = det.filter(F.col("quality") == "sp").select(F.col("sensor").alias("__s"), F.col("acq_date").alias("__d"), F.lit(True).alias("__sp")).distinct()
    if due.limit(most + 1).count() <= most:
        due = F.broadcast(due)
    met = det.join(due, (F.col("sensor") == F.col("__s")) & (F.col("acq_date") == F.col("__d")), "left")
    return met.filter(F.col("__sp").isNull() | (F.col("quality") == "sp")).drop("__s", "__d", "__sp")


def replace_entries(entries: DataFrame, rebuilt: DataFrame, key: str = "id") -> DataFrame:
    """Entries not rebuilt stay; rebuilt ones replace theirs."""
    return entries.join(rebuilt.select(key), key, "left_anti").unionByName(rebuilt)
