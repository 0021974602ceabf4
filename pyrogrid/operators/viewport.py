"""What a viewport shows: histograms from cells and from points, selections, regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import View, in_view


def histogram(cells: DataFrame, bounds: DataFrame, view: View) -> DataFrame:
    """Per bucket the sum over the cells in view, and how many they are; empty buckets are left out. Cells without bounds do not count."""
    seen = bounds.filter(in_view(F.col("w"), F.col("s"), F.col("e"), F.col("n"), view)).select("cell")
    return cells.join(seen, "cell").groupBy("bucket").agg(F.sum("cnt").alias("cnt"), F.countDistinct("cell").alias("cells")).filter("cnt > 0")


def point_histogram(det: DataFrame, view: View, bucket: Column) -> DataFrame:
    lon, lat = F.col("lon"), F.col("lat")
    return det.filter(in_view(lon, lat, lon, lat, view)).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("cnt"))


def selection_mode(cells: DataFrame, lo: str, hi: str, axis: tuple[str, str], running: bool = False) -> str:
    """How a selection of an axis (first and last key) is answered: whole, none (no bucket of it is there), running or sum."""
    if lo <= axis[0] and hi >= axis[1]:
        return "whole"
    if not cells.filter(F.col("bucket").between(lo, hi)).take(1):
        return "none"
    return "running" if running else "sum"


def selected(cells: DataFrame, lo: str | None, hi: str | None, axis: tuple[str, str] | None = None, running: DataFrame | None = None) -> DataFrame:
    """Per cell the total, or the sum over a range of buckets; 0 where nothing of a cell is in it.

    With an axis the cheapest way is taken: totals for the whole axis, zeros where no bucket is there, and running totals (running) where given.
    """
    mode = "whole" if lo is None or hi is None else selection_mode(cells, lo, hi, axis, running is not None) if axis else "sum"
    if mode == "none":
        return cells.select("cell").distinct().withColumn("cnt", F.lit(0).cast("long"))
    if mode == "running":
        at = lambda key: F.coalesce(F.max(F.when(key, F.col("running"))), F.lit(0))  # noqa: E731  running totals never fall
        return running.groupBy("cell").agg((at(F.col("bucket") <= hi) - at(F.col("bucket") < lo)).alias("cnt"))
    inside = F.lit(True) if mode == "whole" else F.col("bucket").between(lo, hi)
    return cells.groupBy("cell").agg(F.coalesce(F.sum(F.when(inside, F.col("cnt"))), F.lit(0)).alias("cnt"))


def _edges(ring: Column) -> Column:
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def inside_edges(lon: Column, lat: Column, edges: Column) -> Column:
    """Whether a point is inside what edges (array of struct a, b) enclose: an odd number of them lies to its right. Holes and several parts need no more."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > lat) != (b["y"] > lat)) & (lon < (b["x"] - a["x"]) * (lat - a["y"]) / F.when(b["y"] == a["y"], F.lit(None)).otherwise(b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(edges, crosses)) % 2 == 1


def inside(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point is inside a ring (array of struct x, y)."""
    return inside_edges(lon, lat, _edges(ring))


def region_cover(regions: DataFrame, step: int = 500) -> DataFrame:
    """Cells of step hundredths of a degree (a part of 360 degrees) that regions meet: region, __cell, turn, edges.

    Cells that an edge passes have the region's edges, for the exact test; cells inside have none and need no test; others are not there.  Regions have a ring, or
    rings (parts and holes alike); they may pass the antimeridian, their x then leaves [-180, 180], and turn tells by how many turns a cell lies off.
    """
    if 36_000 % step:
        raise ValueError("cells must divide the circle")
    n, size = 36_000 // step, step / 100.0
    rings = F.col("rings") if "rings" in regions.columns else F.array("ring")
    shapes = regions.select("region", F.flatten(F.transform(rings, _edges)).alias("edges")).withColumn("__r", F.xxhash64("region", "edges"))
    row = lambda v, low: F.floor((v + low) / size).cast("long")
    # cells that an edge passes: column by column, between its heights at the column's sides, a little widened
    edge = shapes.select("__r", F.explode("edges").alias("e")).select("__r", "e.a", "e.b")
    left, right = F.least("a.x", "b.x"), F.greatest("a.x", "b.x")
    column = edge.select("__r", "a", "b", left.alias("l"), right.alias("r"), F.explode(F.sequence(row(left - 1e-9, 180), row(right + 1e-9, 180))).alias("i"))
    at = lambda x: F.when(F.col("b.x") == F.col("a.x"), F.lit(None)).otherwise(F.col("a.y") + (F.col("b.y") - F.col("a.y")) * (x - F.col("a.x")) / (F.col("b.x") - F.col("a.x")))
    y0, y1 = at(F.greatest("l", F.col("i") * size - 180)), at(F.least("r", (F.col("i") + 1) * size - 180))
    low, high = F.coalesce(F.least(y0, y1), F.least("a.y", "b.y")), F.coalesce(F.greatest(y0, y1), F.greatest("a.y", "b.y"))
    rim = column.select("__r", "i", F.explode(F.sequence(row(low - 1e-9, 90), row(high + 1e-9, 90))).alias("j")).distinct()
    # of the others in its box those whose middle is inside
    x, y = F.transform("edges", lambda e: e["a"]["x"]), F.transform("edges", lambda e: e["a"]["y"])
    box = shapes.select("__r", "edges", F.explode(F.sequence(row(F.array_min(x), 180), row(F.array_max(x), 180))).alias("i"), F.array_min(y).alias("s"), F.array_max(y).alias("n"))
    box = box.select("__r", "edges", "i", F.explode(F.sequence(row(F.col("s"), 90), row(F.col("n"), 90))).alias("j"))
    middle = inside_edges((F.col("i") + 0.5) * size - 180, (F.col("j") + 0.5) * size - 90, F.col("edges"))
    within = box.join(rim, ["__r", "i", "j"], "left_anti").filter(middle).select("__r", "i", "j", F.lit(True).alias("whole"))
    cells = rim.withColumn("whole", F.lit(False)).unionByName(within).join(shapes, "__r")
    key = F.pmod(F.col("i"), F.lit(n)) * 100_000 + F.col("j")
    return cells.select("region", key.alias("__cell"), F.floor(F.col("i") / n).alias("turn"), F.when(~F.col("whole"), F.col("edges")).alias("edges"))


def join_regions(det: DataFrame, regions: DataFrame, step: int = 500) -> DataFrame:
    """Points (lon, lat) with the regions (region, ring or rings) that hold them: an equality join on cells; only points in cells at a region's rim are tested."""
    cover = region_cover(regions, step)
    keyed = det.withColumn("__cell", F.pmod(F.floor((F.col("lon") + 180) / (step / 100.0)).cast("long"), F.lit(36_000 // step)) * 100_000 + F.floor((F.col("lat") + 90) / (step / 100.0)).cast("long"))
    held = F.col("edges").isNull() | inside_edges(F.col("lon") + F.col("turn") * 360, F.col("lat"), F.col("edges"))
    return keyed.join(cover, "__cell").filter(held).drop("__cell", "turn", "edges")
