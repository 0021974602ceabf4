"""Class breaks, shares, and the level that a zoom shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the quantiles of the breaks, the classes of a share
QUANTILES = (0.50, 0.75, 0.90, 0.96, 0.99, 0.997)
SHARE_CLASSES = (20, 40, 60, 80)


def rising(values: Column) -> Column:
    """Rounded (whole from 10 up, else to a tenth) and each over the one before, the first over zero."""
    tidy = F.transform(values, lambda v: F.when(v >= 10, F.bround(v)).otherwise(F.bround(v, 1)))

    def step(acc: Column, v: Column) -> Column:
        prev = F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0))
        over = F.when(v <= prev, F.bround(prev + F.when(prev >= 10, 1.0).otherwise(0.1), 1)).otherwise(v)
        return F.concat(acc, F.array(over))

    return F.aggregate(tidy, F.array().cast("array<double>"), step)


def quantiles(values: DataFrame, by: list[str], wanted: tuple[float, ...]) -> DataFrame:
    """Per group (by) of rows with a positive value: array quantiles, exact, interpolated between neighbouring ranks.

    Equal values are counted before any shuffle.  Values then fall into bands of an eighth of a power of two; counts by band tell which bands
    hold the ranks asked for, and only those are ordered, each by itself.  So no task sees all values of a group.
    """
    counted = values.groupBy(*by, "value").agg(F.count("*").alias("n")).withColumn("band", F.floor(F.log2("value") * 8).cast("int"))
    bands = counted.groupBy(*by, "band").agg(F.sum("n").alias("in_band"))  # some hundreds of rows a group
    group = Window.partitionBy(*by)
    ranked = bands.withColumns({
        "below": F.coalesce(F.sum("in_band").over(group.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "of": F.sum("in_band").over(group),
    })
    ranks = F.flatten(F.array(*[F.array(F.floor((F.col("of") - 1) * q), F.ceil((F.col("of") - 1) * q)) for q in wanted]))
    asked = ranked.withColumn("ranks", F.filter(F.array_distinct(ranks), lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("in_band")))).filter(F.size("ranks") > 0)
    near = counted.join(asked.select(*by, "band", "below", "ranks", "of"), [*by, "band"])  # one row a group and rank at most
    upto = F.sum("n").over(Window.partitionBy(*by, "band").orderBy("value"))
    placed = near.withColumn("last", F.col("below") + upto)
    hit = placed.select(*by, "of", "value", F.explode(F.filter("ranks", lambda r: (r < F.col("last")) & (r >= F.col("last") - F.col("n")))).alias("rank"))
    found = hit.groupBy(*by).agg(F.max("of").alias("of"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def one(q: float) -> Column:
        r = (F.col("of") - 1) * F.lit(q)
        a, b = F.col("at")[F.floor(r)], F.col("at")[F.ceil(r)]
        return a + (b - a) * (r - F.floor(r))

    return found.select(*by, F.array(*[one(q) for q in wanted]).alias("quantiles"))


def breaks(cells: DataFrame, metrics: list[str], by: list[str], wanted: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Per group and metric: quantiles over positive cells, and the ladder made of them."""
    long = cells.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("x")).select(*by, "x.*")
    return quantiles(long.filter(F.col("value") > 0), [*by, "metric"], wanted).withColumn("breaks", rising(F.col("quantiles")))


def share(cells: DataFrame, parts: list[str], whole: str) -> Column:
    """Percent that columns parts have of a whole; what is absent is zero."""
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0))
    return 100 * total / F.greatest(F.lit(1), F.col(whole))


def share_class(percent: Column) -> Column:
    return F.size(F.filter(F.array(*[F.lit(x) for x in SHARE_CLASSES]), lambda b: b <= percent))


def level_for_zoom(zooms: DataFrame, bands: DataFrame, zoom: str = "zoom") -> DataFrame:
    """zooms with level: that of the band (level, min_zoom, max_zoom; null is open) that holds the whole part of the zoom, null without one.

    Bands are a handful; where two hold a zoom the one that begins first counts.
    """
    at = F.floor(F.col(zoom))
    # ordered bands in one row, so that a zoom meets them without a join of its own
    one = bands.agg(F.sort_array(F.collect_list(F.struct("min_zoom", "level", "max_zoom"))).alias("__bands"))
    holds = lambda x: (at >= x["min_zoom"]) & (x["max_zoom"].isNull() | (at <= x["max_zoom"]))
    return zooms.crossJoin(F.broadcast(one)).withColumn("level", F.get(F.filter("__bands", holds), F.lit(0))["level"]).drop("__bands")


def points_from(bands: DataFrame, layer: str = "features") -> DataFrame:
    """One row: the lowest zoom at which bands (layer, min_zoom) have points of their own, infinite if none has."""
    return bands.filter(F.col("layer") == layer).agg(F.coalesce(F.min("min_zoom").cast("double"), F.lit(float("inf"))).alias("zoom"))
