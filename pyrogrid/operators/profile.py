"""Profiles of partitions and of the collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def partition_profile(det: DataFrame) -> DataFrame:
    """Per year: rows, bounds, first and last time, sensors."""
    return det.groupBy("year").agg(
        F.count("*").alias("n_rows"), F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"),
        F.min("acq_datetime").alias("first_time"), F.max("acq_datetime").alias("last_time"), F.sort_array(F.collect_set("sensor")).alias("sensors"),
    )


def live_only(archive: DataFrame, live: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Live rows after their year's archive ends (or its declared end where there is no archive); of other years, all."""
    end = archive.groupBy("year").agg(F.max("acq_datetime").alias("__end"))  # a row per year
    if declared is not None:
        end = end.join(declared.select("year", F.col("end_time").alias("__d")), "year", "full_outer").select("year", F.coalesce("__end", "__d").alias("__end"))
    return live.join(F.broadcast(end), "year", "left").filter(F.col("__end").isNull() | (F.col("acq_datetime") > F.col("__end"))).drop("__end")


def collection_profile(archive: DataFrame, live: DataFrame) -> DataFrame:
    """The whole: every row counted once, the bounds, times, years and sensors of both."""
    parts = partition_profile(archive).unionByName(partition_profile(live_only(archive, live)))
    return parts.agg(
        F.sum("n_rows").cast("long").alias("n_rows"), F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.countDistinct("year").alias("years"), F.size(F.array_distinct(F.flatten(F.collect_list("sensors")))).alias("sensors"),
    )


def missing_sensors(present: DataFrame, avail: DataFrame) -> DataFrame:
    """Sensors that should have flown in a year (avail: sensor, lo, hi years) and are not in present (year, sensor)."""
    flown = avail.select("sensor", F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int"))).alias("year")).distinct()
    due = present.select("year").distinct().join(flown, "year").select("year", "sensor")
    return due.join(present.select("year", "sensor").distinct(), ["year", "sensor"], "left_anti")


def fleet_effect(det: DataFrame) -> DataFrame:
    """Per year: rows, sensors flying, ratio to the year before."""
    t = det.groupBy("year").agg(F.count("*").alias("cnt"), F.countDistinct("sensor").alias("sensors"))
    before = F.lag("cnt").over(Window.orderBy("year"))  # a row a year
    return t.withColumn("ratio", F.round(F.col("cnt") / before, 6))
