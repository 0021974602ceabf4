"""Which table answers: owners of buckets, best cover, routing of time domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.grid import tile_xy
from . import intervals

#: What a point and a cell weigh in a tile, in bytes.
POINT_BYTES, CELL_BYTES = 12, 40


def owners(buckets: DataFrame, sources: DataFrame) -> DataFrame:
    """Per bucket (bucket, unit) the covering source that was rebuilt last; ties go to the narrower one, then to the smaller id."""
    s = sources.select("id", "unit", "min_key", "max_key", "rebuilt")
    met = intervals.holding(buckets, keys.bucket_index(F.col("bucket")), s, keys.bucket_index(F.col("min_key")), keys.bucket_index(F.col("max_key")), ("unit",))
    best = F.min(F.struct((-F.col("rebuilt")).alias("r"), keys.days_between(F.col("min_key"), F.col("max_key")).alias("span"), "id"))
    return met.groupBy("bucket", "unit").agg(best.alias("best")).select("bucket", "unit", F.col("best.id").alias("owner"))


def best_cover(selections: DataFrame, sources: DataFrame) -> DataFrame:
    """Per selection (sel, unit, lo, hi) the source of its unit that covers most buckets, then the freshest.

    Sources of one extent are one until the freshest is taken; selections of one extent are one throughout.
    """
    asked = selections.select("unit", "lo", "hi").distinct().withColumn("ask", F.xxhash64("unit", "lo", "hi"))
    extents = sources.groupBy("unit", "min_key", "max_key").agg(F.min(F.struct((-F.col("rebuilt")).alias("r"), "id")).alias("fresh")).withColumn("extent", F.xxhash64("unit", "min_key", "max_key"))
    at = lambda c: keys.bucket_index(F.col(c))
    met = intervals.meeting(asked, at("lo"), at("hi"), "ask", extents, at("min_key"), at("max_key"), "extent", ("unit",))
    met = met.join(asked, ["unit", "ask"]).join(extents, ["unit", "extent"])
    covered = keys.bucket_index(F.least("hi", "max_key")) - keys.bucket_index(F.greatest("lo", "min_key")) + 1
    best = met.groupBy("unit", "lo", "hi").agg(F.min(F.struct((-covered).alias("n"), F.col("fresh.r"), F.col("fresh.id"))).alias("best"))
    return selections.join(best, ["unit", "lo", "hi"]).select("sel", F.col("best.id").alias("source"), (-F.col("best.n")).alias("covered"))


def days_of(days: DataFrame, sources: DataFrame) -> DataFrame:
    """Of days (day_key and others): each with the sources (id, min_key, max_key) that hold it."""
    at = lambda c: keys.bucket_index(F.col(c))
    return intervals.holding(days, at("day_key"), sources.select("id", "min_key", "max_key"), at("min_key"), at("max_key"))


def route(domains: DataFrame, years: tuple[int, int], live_from: str) -> DataFrame:
    """Per domain (req, lo, hi as dates): live, a year's daily table, or the monthly one of all time.

    One year, or two adjacent ones, are answered by a year's table: of two, by that which holds more days of the
    domain, the later one in a tie.
    """
    y0, y1 = F.year("lo"), F.year("hi")
    new_year = F.make_date(y1, F.lit(1), F.lit(1))
    early, late = F.datediff(new_year, "lo"), F.datediff("hi", new_year) + 1
    chosen = F.when(y0 == y1, y0).when(y1 == y0 + 1, F.when(early > late, y0).otherwise(y1))
    return domains.select(
        "req", F.when(F.col("lo") >= F.lit(live_from).cast("date"), "live").when(chosen.between(*years), F.concat(F.lit("year-"), chosen.cast("string"))).otherwise("alltime").alias("target")
    )


def plan_mounts(domains: DataFrame, years: DataFrame, most: int = 2) -> DataFrame:
    """Per domain the years nearest to its middle: req, year, rank."""
    mid = F.year("lo") + (F.year("hi") - F.year("lo")) / 2
    each = domains.select("*", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))
    near = each.join(years.select("year").distinct(), "year").withColumn("far", F.abs(F.col("year") - mid))
    w = Window.partitionBy("req").orderBy("far", F.desc("year"))
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select("req", "year", "rank")


def tile_weights(det: DataFrame, zooms: list[int], cell: Column | None = None) -> DataFrame:
    """Points, cells (if a cell is given) and bytes per map tile at each zoom: z, x, y, points, cells, bytes.

    Rows are counted once, by the tiles of the deepest zoom; each other zoom adds up what came before.
    """
    deepest = max(zooms)
    at = tile_xy(F.col("lon"), F.col("lat"), deepest)
    fine = det.groupBy(at["x"].alias("x"), at["y"].alias("y"), (cell if cell is not None else F.lit(0)).alias("cell")).agg(F.count("*").alias("points"))
    ups = F.array(*[F.lit(z) for z in zooms])
    each = fine.select("cell", "points", "x", "y", F.explode(ups).alias("z"))
    up = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), deepest - F.col("z")))
    tiles = each.groupBy("z", up("x").alias("x"), up("y").alias("y"), "cell").agg(F.sum("points").alias("points"))
    seen = F.count("*") if cell is not None else F.lit(0).cast("long")
    out = tiles.groupBy("z", "x", "y").agg(F.sum("points").alias("points"), seen.alias("cells"))
    return out.withColumn("bytes", F.col("points") * POINT_BYTES + F.col("cells") * CELL_BYTES)


def handover(tiles: DataFrame, budget: int, weight: str = "bytes", plan: int | None = None) -> DataFrame:
    """The first zoom whose heaviest tile is within the budget; a plan, where given, counts instead."""
    if plan is not None:
        return tiles.limit(1).agg(F.lit(plan).alias("zoom"))
    return tiles.groupBy("z").agg(F.max(weight).alias("heaviest")).filter(F.col("heaviest") <= budget).agg(F.min("z").alias("zoom"))
