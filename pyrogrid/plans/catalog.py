"""The registered queries over the given tables and, side by side, their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields, keys
from ..functions.grid import bounds, cell, in_view, lon_overlaps, mercator_y, parent, plain_cell, plain_parent, tile_point, tile_xy, with_hilbert
from ..operators import cells, classify, maintain, profile, quality, route, timeseq, viewport
from ..sources import normalize, store, versions
from ..sources.adapters import EVENTS, ORDERS, detections, yearly
from ..sources.schema import SOURCES as FEEDS
from ..streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
Det = DataFrame

# plain grid cells in the SQL counterparts
CELL = "(CAST(FLOOR(CAST(lon_c + 18000 AS DOUBLE) / {s}) AS BIGINT) * 100000 + CAST(FLOOR(CAST(lat_c + 9000 AS DOUBLE) / {s}) AS BIGINT))"
MONEY = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"
VIEW = (150.0, -40.0, 220.0, 45.0)
IN_VIEW = "((lon BETWEEN 150 AND 220 OR lon + 360 BETWEEN 150 AND 220) AND lat BETWEEN -40 AND 45)"
SPLIT = "TIMESTAMP '2024-01-24 12:00:00'"
WINDOW = "TIMESTAMP '2024-01-23 00:00:00'"
HOLE = "acq_datetime >= TIMESTAMP '2024-01-10 05:46:00' AND acq_datetime < TIMESTAMP '2024-01-12 00:01:00'"
SOURCES = "(SELECT * FROM (VALUES ('latest','day','20240123','20240130',4), ('2024','day','20240101','20240125',3), ('january','day','20240103','20240120',3), ('alltime','month','199501','202401',2)) AS t(id, unit, min_key, max_key, rebuilt))"
AVAIL = "(SELECT * FROM (VALUES ('MODIS',1995,2001), ('VIIRS_SNPP',1996,2001), ('VIIRS_NOAA20',1999,2001), ('VIIRS_NOAA21',2000,2001)) AS t(sensor, lo, hi))"
DOMAINS = "(SELECT l_orderkey * 10 + l_linenumber AS req, CAST(l_shipdate AS DATE) AS lo, CAST(l_shipdate AS DATE) + CAST(l_quantity * 12 AS INT) AS hi FROM lineitem)"


def register(name: str, sql: str | None, base: str | None = None, raw: bool = False):
    """Register a query; base 'det' or 'ord' gives it the adapted table (raw: the session and the folder) and its SQL the table's definition."""

    def put(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        make = {"det": detections, "ord": yearly, None: lambda s, d: (s, d)}[base]
        QUERIES[name] = (lambda s, d: f(make(s, d))) if base and not raw else f
        if sql is not None:
            head = {"det": f"WITH det AS ({EVENTS})", "ord": f"WITH ord AS ({ORDERS})", None: ""}[base]
            more = sql.lstrip().startswith(("AS_CTE", "RECURSIVE_CTE"))
            if sql.lstrip().startswith("RECURSIVE_CTE"):
                head = head.replace("WITH ", "WITH RECURSIVE ", 1)
            ORACLE_SQL[name] = f"{head}{',' if base and more else ''} {sql.replace('RECURSIVE_CTE', '', 1).replace('AS_CTE', '', 1)}".strip()
        return f

    return put


def money(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def values(df: DataFrame, text: str) -> DataFrame:
    return df.sparkSession.sql(text[1:-1])


# ---- aggregates -------------------------------------------------------------------------------------------------


@register("a11_by_sensor", "SELECT sensor, COUNT(*) AS cnt, ROUND(AVG(frp), 1) AS avg_frp FROM det GROUP BY sensor ORDER BY cnt DESC", "det")
def _(det):
    return det.groupBy("sensor").agg(F.count("*").alias("cnt"), F.round(F.avg("frp"), 1).alias("avg_frp")).orderBy(F.desc("cnt"))


@register("a1_cell_aggregate", f"SELECT {CELL.format(s=250)} AS cell, COUNT(*) AS cnt, {MONEY.format(c='frp')} AS sum_frp, ROUND({MONEY.format(c='frp')} / COUNT(frp), 4) AS avg_frp, MAX(frp) AS max_frp FROM det GROUP BY 1", "det")
def _(det):
    c = cells.with_means(cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 250), F.lit("all"), ()))
    return c.select("cell", "cnt", F.col("sum_frp").cast("double").alias("sum_frp"), F.round("avg_frp", 4).alias("avg_frp"), "max_frp")


@register("a2_cell_day", f"SELECT {CELL.format(s=500)} AS cell, day_key AS bucket, COUNT(*) AS cnt FROM det GROUP BY 1, 2", "det")
def _(det):
    return cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.col("day_key"), ()).select("cell", "bucket", "cnt")


@register("a3_cell_category", f"SELECT {CELL.format(s=500)} AS cell, 'sensor' AS dim, sensor AS value, COUNT(*) AS cnt FROM det GROUP BY 1, 3 UNION ALL SELECT {CELL.format(s=500)}, 'daynight', daynight, COUNT(*) FROM det GROUP BY 1, 3", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.col("day_key"))
    one = lambda d: cells.again(base, "cell", F.col(d).alias("value")).select("cell", F.lit(d).alias("dim"), "value", "cnt")
    return one("sensor").unionByName(one("daynight"))


@register("a4_wide_cells", f"SELECT {CELL.format(s=1000)} AS cell, " + ", ".join(f"SUM(CASE WHEN sensor = '{s}' THEN 1 ELSE 0 END)::BIGINT AS count_{s}" for s in ("MODIS", "VIIRS_SNPP", "VIIRS_NOAA20", "VIIRS_NOAA21")) + " FROM det GROUP BY 1", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.col("day_key"))
    return cells.wide(base, "sensor", ["MODIS", "VIIRS_SNPP", "VIIRS_NOAA20", "VIIRS_NOAA21"], 8)


@register("a5_rollup", f"SELECT {CELL.format(s=1000)} AS cell, day_key AS bucket, COUNT(*) AS cnt, {MONEY.format(c='frp')} AS sum_frp, MAX(frp) AS max_frp FROM det GROUP BY 1, 2", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 250), F.col("day_key"), ())
    up = cells.rollup(base, plain_parent(F.col("cell"), 4), "bucket")
    return up.select("cell", "bucket", "cnt", F.col("sum_frp").cast("double").alias("sum_frp"), "max_frp")


@register("a6_combine_years", f"SELECT {CELL.format(s=500)} AS cell, COUNT(*) AS cnt, {MONEY.format(c='frp')} AS sum_frp, ROUND({MONEY.format(c='frp')} / COUNT(*), 4) AS mean_all, MAX(frp) AS max_frp, COUNT(DISTINCT month_key) AS months FROM ord GROUP BY 1", "ord")
def _(det):
    by_year = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.col("month_key"), ("year",))
    # a month is in one year, so the rows of a cell are its months
    total = cells.with_means(by_year.withColumn("months", F.lit(1)).groupBy("cell").agg(F.sum("cnt").alias("cnt"), F.sum("n_frp").alias("n_frp"), F.sum("sum_frp").alias("sum_frp"), F.max("max_frp").alias("max_frp"), F.count("months").alias("months")))
    return total.select("cell", "cnt", F.col("sum_frp").cast("double").alias("sum_frp"), F.round("mean_all", 4).alias("mean_all"), "max_frp", "months")


@register("a6_wide_years", f"AS_CTE c AS (SELECT {CELL.format(s=500)} AS cell, year, month_key, COUNT(*) AS cnt FROM ord GROUP BY 1, 2, 3) SELECT cell, " + ", ".join(f"CASE WHEN bool_or(year = {m[:4]}) THEN CAST(COALESCE(SUM(CASE WHEN month_key = '{m}' THEN cnt END), 0) AS BIGINT) END AS count_{m}" for m in ("199603", "199604", "199707", "200012")) + " FROM c GROUP BY cell", "ord")
def _(det):
    by_year = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.col("month_key"), ("year",))
    return cells.wide_years(by_year, ["199603", "199604", "199707", "200012"])


@register(
    "a7_breaks",
    f"AS_CTE c AS (SELECT year, {CELL.format(s=500)} AS cell, COUNT(*) AS cnt, MAX(frp) AS max_frp FROM ord GROUP BY 1, 2), l AS (SELECT year, 'cnt' AS metric, CAST(cnt AS DOUBLE) AS v FROM c UNION ALL SELECT year, 'max_frp', max_frp FROM c) SELECT year, metric, "
    + ", ".join(f"ROUND(QUANTILE_CONT(v, {q}), 4) AS q{i}" for i, q in enumerate(classify.QUANTILES)) + " FROM l WHERE v > 0 GROUP BY year, metric", "ord",
)
def _(det):
    c = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.lit("all"), ("year",))
    b = classify.breaks(c, ["cnt", "max_frp"], ["year"])
    return b.select("year", "metric", *[F.round(F.col("quantiles")[i], 4).alias(f"q{i}") for i in range(len(classify.QUANTILES))])


_LADDER = ", ".join(
    f"CASE WHEN (CASE WHEN q{i} >= 10 THEN round_even(q{i}, 0) ELSE round_even(q{i}, 1) END) <= {before} THEN round({before} + CASE WHEN {before} >= 10 THEN 1.0 ELSE 0.1 END, 1) ELSE (CASE WHEN q{i} >= 10 THEN round_even(q{i}, 0) ELSE round_even(q{i}, 1) END) END AS b{i}"
    for i, before in enumerate(["CAST(0 AS DOUBLE)"] + [f"b{i}" for i in range(len(classify.QUANTILES) - 1)])
)
LADDERS = (
    f"AS_CTE c AS (SELECT year, {CELL.format(s=500)} AS cell, COUNT(*) AS cnt, MAX(frp) AS max_frp FROM ord GROUP BY 1, 2), l AS (SELECT year, 'cnt' AS metric, CAST(cnt AS DOUBLE) AS v FROM c UNION ALL SELECT year, 'max_frp', max_frp FROM c), q AS (SELECT year, metric, "
    + ", ".join(f"QUANTILE_CONT(v, {q}) AS q{i}" for i, q in enumerate(classify.QUANTILES)) + f" FROM l WHERE v > 0 GROUP BY year, metric), b AS (SELECT year, metric, {_LADDER} FROM q)"
)


@register("a7_break_ladders", LADDERS + " " + " UNION ALL ".join(f"SELECT year, metric, {i} AS idx, ROUND(b{i}, 4) AS value FROM b" for i in range(len(classify.QUANTILES))), "ord")
def _(det):
    c = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.lit("all"), ("year",))
    return classify.breaks(c, ["cnt", "max_frp"], ["year"]).select("year", "metric", F.posexplode("breaks").alias("idx", "value")).withColumn("value", F.round("value", 4))


@register("a8_sensors_per_year", "SELECT year, string_agg(DISTINCT sensor, ',' ORDER BY sensor) AS sensors FROM ord GROUP BY year", "ord")
def _(det):
    return det.groupBy("year").agg(F.array_join(F.sort_array(F.collect_set("sensor")), ",").alias("sensors"))


@register("a9_partition_profile", "SELECT year, COUNT(*) AS n_rows, MIN(lon_c) AS w, MIN(lat_c) AS s, MAX(lon_c) AS e, MAX(lat_c) AS n, CAST(MIN(acq_date) AS VARCHAR) AS first_day, CAST(MAX(acq_date) AS VARCHAR) AS last_day, COUNT(DISTINCT sensor) AS sensors FROM ord GROUP BY year", "ord")
def _(det):
    p = profile.partition_profile(det.withColumns({"lon": F.col("lon_c"), "lat": F.col("lat_c")}))
    day = lambda c: F.to_date(c).cast("string")
    return p.select("year", "n_rows", "w", "s", "e", "n", day("first_time").alias("first_day"), day("last_time").alias("last_day"), F.size("sensors").cast("long").alias("sensors"))


@register("a10_collection_profile", "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(lon) AS w, MIN(lat) AS s, MAX(lon) AS e, MAX(lat) AS n, COUNT(DISTINCT year) AS years, COUNT(DISTINCT sensor) AS sensors FROM det", "det")
def _(det):
    p = profile.collection_profile(det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {WINDOW}"))
    return p.select("n_rows", "w", "s", "e", "n", "years", F.col("sensors").cast("long").alias("sensors"))


def day_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Counts by cell and day, and the cells' bounds: made once from the detections, read by every view."""
    c, source = plain_cell(F.col("lon_c"), F.col("lat_c"), 500), f"{sf_dir}/events.parquet"
    by_level = lambda df: df.withColumn("level", F.lit(500))
    counts = store.persisted(spark, source, "cells", lambda: by_level(cells.base_cells(detections(spark, sf_dir), c, F.col("day_key"), ()).select("cell", "bucket", "cnt")), ("level",))
    point = lambda det: det.select(c.alias("cell"), F.col("lon").alias("w"), F.col("lat").alias("s"), F.col("lon").alias("e"), F.col("lat").alias("n"))
    extent = store.persisted(spark, source, "bounds", lambda: by_level(cells.bounds_union(point(detections(spark, sf_dir)))), ("level",))
    return counts.filter("level = 500"), extent.filter("level = 500")


@register("a12_view_histogram", f"SELECT day_key AS bucket, COUNT(*) AS cnt, COUNT(DISTINCT {CELL.format(s=500)}) AS cells FROM det WHERE {CELL.format(s=500)} IN (SELECT {CELL.format(s=500)} FROM det GROUP BY 1 HAVING (MIN(lon) <= 220 AND MAX(lon) >= 150 OR MIN(lon) + 360 <= 220 AND MAX(lon) + 360 >= 150) AND MIN(lat) <= 45 AND MAX(lat) >= -40) GROUP BY 1", "det", raw=True)
def _(spark, sf_dir):
    counts, extent = day_cells(spark, sf_dir)
    return viewport.histogram(counts, extent, VIEW)


@register("a13_point_histogram", f"SELECT day_key AS bucket, COUNT(*) AS cnt FROM det WHERE {IN_VIEW} GROUP BY 1", "det")
def _(det):
    return viewport.point_histogram(det, VIEW, F.col("day_key"))


@register("a14_bounds", f"SELECT {CELL.format(s=1000)} AS cell, MIN(lon) AS w, MIN(lat) AS s, MAX(lon) AS e, MAX(lat) AS n FROM det GROUP BY 1", "det")
def _(det):
    return cells.bounds_union(det.select(plain_cell(F.col("lon_c"), F.col("lat_c"), 1000).alias("cell"), F.col("lon").alias("w"), F.col("lat").alias("s"), F.col("lon").alias("e"), F.col("lat").alias("n")))


@register("a15_axis", "SELECT 'month' AS unit, 'YYYYMM' AS key_format, MIN(month_key) AS min_key, MAX(month_key) AS max_key, COUNT(DISTINCT month_key) AS buckets FROM ord", "ord")
def _(det):
    return timeseq.declare_axis(det.select(F.col("month_key").alias("bucket")))


@register("a16_shares", f"SELECT {CELL.format(s=1000)} AS cell, ROUND(100.0 * SUM(CASE WHEN daynight = 'N' THEN 1 ELSE 0 END) / GREATEST(1, COUNT(*)), 4) AS night_share FROM det GROUP BY 1", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.lit("all"), ("daynight",))
    w = cells.wide(base, "daynight", ["D", "N"], 4).withColumn("cnt", F.col("count_D") + F.col("count_N"))
    return w.select("cell", F.round(classify.share(w, ["count_N"], "cnt"), 4).alias("night_share"))


@register("a17_share_breaks_by_year", f"AS_CTE c AS (SELECT year, {CELL.format(s=1000)} AS cell, 100.0 * SUM(CASE WHEN sensor = 'MODIS' THEN 0 ELSE 1 END) / COUNT(*) AS share FROM ord GROUP BY 1, 2) SELECT year, ROUND(QUANTILE_CONT(CAST(share AS DOUBLE), 0.5), 4) AS q50, ROUND(QUANTILE_CONT(CAST(share AS DOUBLE), 0.9), 4) AS q90 FROM c WHERE share > 0 GROUP BY year", "ord")
def _(det):
    base = det.groupBy("year", plain_cell(F.col("lon_c"), F.col("lat_c"), 1000).alias("cell")).agg(F.count("*").alias("cnt"), F.count_if(F.col("sensor") != "MODIS").alias("v"))
    b = classify.breaks(base.withColumn("share", classify.share(base, ["v"], "cnt")), ["share"], ["year"], (0.5, 0.9))
    return b.select("year", F.round(F.col("quantiles")[0], 4).alias("q50"), F.round(F.col("quantiles")[1], 4).alias("q90"))


@register("a18_fleet_effect", "SELECT year, COUNT(*) AS cnt, COUNT(DISTINCT sensor) AS sensors, ROUND(CAST(COUNT(*) AS DOUBLE) / LAG(COUNT(*)) OVER (ORDER BY year), 6) AS ratio FROM ord GROUP BY year", "ord")
def _(det):
    return profile.fleet_effect(det)


@register("a19_power_by_month", f"SELECT month_key AS bucket, sensor, {MONEY.format(c='frp')} AS sum_frp FROM ord GROUP BY 1, 2", "ord")
def _(det):
    return det.groupBy(F.col("month_key").alias("bucket"), "sensor").agg(money("frp").alias("sum_frp"))


@register("a20_convergence", f"AS_CTE e AS (SELECT DISTINCT year, {CELL.format(s=500)} AS cell FROM ord), f AS (SELECT cell, MIN(year) AS year FROM e GROUP BY cell) SELECT p.year, p.cells, COALESCE(n.new_cells, 0) AS new_cells, CAST(SUM(COALESCE(n.new_cells, 0)) OVER (ORDER BY p.year) AS BIGINT) AS union_cells FROM (SELECT year, COUNT(*) AS cells FROM e GROUP BY year) p LEFT JOIN (SELECT year, COUNT(*) AS new_cells FROM f GROUP BY year) n USING (year)", "ord")
def _(det):
    return cells.convergence(det.select("year", plain_cell(F.col("lon_c"), F.col("lat_c"), 500).alias("cell")))


@register("a21_density", " UNION ALL ".join(f"SELECT {s} AS level, COUNT(*) AS filled, COUNT(DISTINCT cell) AS cells, COUNT(DISTINCT bucket) AS buckets, ROUND(CAST(COUNT(*) AS DOUBLE) / (COUNT(DISTINCT cell) * COUNT(DISTINCT bucket)), 6) AS density FROM (SELECT DISTINCT {CELL.format(s=s)} AS cell, month_key AS bucket FROM ord)" for s in (500, 1000)), "ord")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.col("month_key"), ())
    up = cells.rollup(base, plain_parent(F.col("cell")), "bucket")
    return cells.density(base.withColumn("level", F.lit(500)).unionByName(up.withColumn("level", F.lit(1000)), allowMissingColumns=True))


@register("a21_over_budget", " UNION ALL ".join(f"SELECT * FROM (SELECT {level} AS level, COUNT(DISTINCT cell) * COUNT(DISTINCT bucket) * 400000.0 / 1e6 AS mb, CAST({25.0 * 4 ** max(0, level - 6)} AS DOUBLE) AS budget_mb FROM (SELECT {CELL.format(s=s)} AS cell, month_key AS bucket FROM ord)) WHERE mb > budget_mb" for level, s in ((9, 250), (8, 500), (6, 2000))), "ord")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 250), F.col("month_key"), ())
    levels = [base.withColumn("level", F.lit(9)), cells.rollup(base, plain_parent(F.col("cell"), 2), "bucket").withColumn("level", F.lit(8)), cells.rollup(base, plain_parent(F.col("cell"), 8), "bucket").withColumn("level", F.lit(6))]
    return cells.over_budget(cells.density(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)), 400_000.0)


@register("a22_day_night_by_band", "SELECT CAST(FLOOR(lat / 10) AS BIGINT) AS band, CAST(month(acq_date) AS INT) AS month, SUM(CASE WHEN daynight = 'D' THEN 1 ELSE 0 END)::BIGINT AS day, SUM(CASE WHEN daynight = 'N' THEN 1 ELSE 0 END)::BIGINT AS night FROM det GROUP BY 1, 2", "det")
def _(det):
    return det.groupBy(F.floor(F.col("lat") / 10).alias("band"), F.month("acq_date").alias("month")).agg(F.count_if(F.col("daynight") == "D").alias("day"), F.count_if(F.col("daynight") == "N").alias("night"))


@register("a23_type_mix", "SELECT sensor, COUNT(*) AS cnt, SUM(CASE WHEN type IS NULL THEN 1 ELSE 0 END)::BIGINT AS unattributed, SUM(CASE WHEN type = 1 THEN 1 ELSE 0 END)::BIGINT AS volcano, SUM(CASE WHEN type = 2 THEN 1 ELSE 0 END)::BIGINT AS static_source, SUM(CASE WHEN type = 3 THEN 1 ELSE 0 END)::BIGINT AS offshore FROM det GROUP BY 1", "det")
def _(det):
    t = F.col("type")
    return det.groupBy("sensor").agg(F.count("*").alias("cnt"), F.count_if(t.isNull()).alias("unattributed"), F.count_if(t == 1).alias("volcano"), F.count_if(t == 2).alias("static_source"), F.count_if(t == 3).alias("offshore"))


# ---- filters and projections ---------------------------------------------------------------------------------------


@register("p8_of_year", "SELECT det_id, sensor FROM ord WHERE year = 1998", "ord")
def _(det):
    return store.of_year(det, 1998).select("det_id", "sensor")


@register("p9_type_filter", "SELECT det_id, type FROM det WHERE type = 0 OR type IS NULL", "det")
def _(det):
    return det.filter(fields.usable_type(F.col("type"))).select("det_id", "type")


@register("p10_confidence_filter", "SELECT det_id, sensor, confidence FROM det WHERE CASE WHEN sensor = 'MODIS' THEN confidence_pct >= 30 ELSE confidence <> 'l' END", "det")
def _(det):
    return det.filter(fields.confident(F.col("sensor"), F.col("confidence_pct"), F.col("confidence"))).select("det_id", "sensor", "confidence")


@register("p11_fixed_sensor", "SELECT det_id, frp FROM det WHERE sensor = 'VIIRS_SNPP' AND quality = 'sp'", "det")
def _(det):
    return det.filter((F.col("sensor") == "VIIRS_SNPP") & (F.col("quality") == "sp")).select("det_id", "frp")


@register("p12_pivot_keys", "SELECT det_id, year, CAST(month(acq_date) AS INT) AS month, day_key AS day, CAST(year * 100 + month(acq_date) AS VARCHAR) AS month_key FROM det", "det")
def _(det):
    return det.select("det_id", "year", F.month("acq_date").alias("month"), keys.day_key(F.col("acq_date")).alias("day"), keys.month_key(F.col("acq_date")).alias("month_key"))


@register("p13_footprint", "SELECT sensor, ROUND(SUM(CASE WHEN instrument = 'VIIRS' THEN scan * track / 1e6 ELSE scan * track END), 3) AS km2 FROM det GROUP BY sensor", "det")
def _(det):
    return det.groupBy("sensor").agg(F.round(F.sum(fields.footprint_km2(F.col("instrument"), F.col("scan"), F.col("track"))), 3).alias("km2"))


@register("p14_day_sets", "SELECT det_id, acq_date IN (DATE '2024-01-10', DATE '2024-01-12') AS refetched FROM det", "det")
def _(det):
    days = det.sparkSession.sql("SELECT explode(array(DATE '2024-01-10', DATE '2024-01-12')) AS acq_date")
    return det.join(F.broadcast(days), "acq_date", "left_semi").select("det_id", F.lit(True).alias("refetched")).unionByName(det.join(F.broadcast(days), "acq_date", "left_anti").select("det_id", F.lit(False).alias("refetched")))


@register("p15_head", f"SELECT det_id FROM det WHERE acq_datetime < {SPLIT}", "det")
def _(det):
    return det.filter(f"acq_datetime < {SPLIT}").select("det_id")


@register("p16_in_view", f"SELECT det_id, lon, lat FROM det WHERE {IN_VIEW}", "det")
def _(det):
    lon, lat = F.col("lon"), F.col("lat")
    return det.filter(in_view(lon, lat, lon, lat, VIEW)).select("det_id", "lon", "lat")


@register("p17_positive", "SELECT det_id, frp FROM det WHERE frp IS NOT NULL AND frp > 0", "det")
def _(det):
    return det.filter(fields.positive(F.col("frp"))).select("det_id", "frp")


# ---- joins, routing -------------------------------------------------------------------------------------------------


@register("j1_pivots_joined", f"SELECT {CELL.format(s=1000)} AS cell, COUNT(*) AS cnt, SUM(CASE WHEN daynight = 'D' THEN 1 ELSE 0 END)::BIGINT AS count_D, SUM(CASE WHEN daynight = 'N' THEN 1 ELSE 0 END)::BIGINT AS count_N, SUM(CASE WHEN sensor = 'MODIS' THEN 1 ELSE 0 END)::BIGINT AS count_MODIS FROM det GROUP BY 1", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.lit("all"))
    parts = [cells.again(base, "cell").select("cell", "cnt"), cells.wide(base, "daynight", ["D", "N"], 4), cells.wide(base, "sensor", ["MODIS", "VIIRS_SNPP", "VIIRS_NOAA20", "VIIRS_NOAA21"], 8).select("cell", "count_MODIS")]
    return reduce(lambda a, b: a.join(b, "cell"), parts)


@register("j2_years_united", f"SELECT {CELL.format(s=1000)} AS cell, " + ", ".join(f"SUM(CASE WHEN year = {y} THEN 1 ELSE 0 END)::BIGINT AS count_{y}" for y in range(1995, 2002)) + " FROM ord WHERE year BETWEEN 1995 AND 2001 GROUP BY 1", "ord")
def _(det):
    base = cells.base_cells(det.filter(F.col("year").between(1995, 2001)), plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.col("month_key"), ("year",))
    return cells.wide(base.withColumn("year", F.col("year").cast("string")), "year", [str(y) for y in range(1995, 2002)], 366)


@register("j3_todo", "SELECT DISTINCT year, sensor FROM ord WHERE year > 1998", "ord")
def _(det):
    plan = det.select("year", "sensor").distinct()
    return store.todo(plan, plan.filter("year <= 1998"), ["year", "sensor"])


@register("j4_missing_sensors", f"SELECT y.year, a.sensor FROM (SELECT DISTINCT year FROM ord) y JOIN {AVAIL} a ON y.year BETWEEN a.lo AND a.hi EXCEPT SELECT year, sensor FROM ord", "ord")
def _(det):
    return profile.missing_sensors(det.select("year", "sensor"), values(det, AVAIL))


@register("j5_days_by_source", f"SELECT CAST(d.acq_date AS VARCHAR) AS day, s.id FROM (SELECT DISTINCT acq_date, day_key FROM det) d JOIN {SOURCES} s ON s.unit = 'day' AND d.day_key BETWEEN s.min_key AND s.max_key", "det")
def _(det):
    days = det.select("acq_date", "day_key").distinct()
    return route.days_of(days, values(det, SOURCES).filter("unit = 'day'")).select(F.col("acq_date").cast("string").alias("day"), "id")


@register("j6_live_only", f"SELECT det_id FROM det WHERE acq_datetime >= {WINDOW} AND acq_datetime > (SELECT MAX(acq_datetime) FROM det WHERE acq_datetime < {SPLIT})", "det")
def _(det):
    return profile.live_only(det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {WINDOW}")).select("det_id")


@register("j7_owners", f"SELECT bucket, owner FROM (SELECT d.day_key AS bucket, s.id AS owner, ROW_NUMBER() OVER (PARTITION BY d.day_key ORDER BY s.rebuilt DESC, CAST(s.max_key AS INT) - CAST(s.min_key AS INT), s.id) AS r FROM (SELECT DISTINCT day_key FROM det) d JOIN {SOURCES} s ON s.unit = 'day' AND d.day_key BETWEEN s.min_key AND s.max_key) WHERE r = 1", "det")
def _(det):
    buckets = det.select(F.col("day_key").alias("bucket"), F.lit("day").alias("unit")).distinct()
    return route.owners(buckets, values(det, SOURCES)).select("bucket", "owner")


@register("j8_best_cover", f"SELECT sel, source, covered FROM (SELECT q.sel, s.id AS source, CAST(LEAST(q.hi, CAST(s.max_key AS INT)) - GREATEST(q.lo, CAST(s.min_key AS INT)) + 1 AS BIGINT) AS covered, ROW_NUMBER() OVER (PARTITION BY q.sel ORDER BY LEAST(q.hi, CAST(s.max_key AS INT)) - GREATEST(q.lo, CAST(s.min_key AS INT)) DESC, s.rebuilt DESC, s.id) AS r FROM (SELECT det_id AS sel, CAST(day_key AS INT) AS lo, LEAST(20240131, CAST(day_key AS INT) + CAST(det_id % 5 AS INT)) AS hi FROM det) q JOIN {SOURCES} s ON s.unit = 'day' AND q.lo <= CAST(s.max_key AS INT) AND q.hi >= CAST(s.min_key AS INT)) WHERE r = 1", "det")
def _(det):
    hi = F.least(F.lit(20240131), F.col("day_key").cast("int") + (F.col("det_id") % 5).cast("int")).cast("string")
    sel = det.select(F.col("det_id").alias("sel"), F.lit("day").alias("unit"), F.col("day_key").alias("lo"), hi.alias("hi"))
    return route.best_cover(sel, values(det, SOURCES))


@register("j9_counts_with_bounds", f"AS_CTE b AS (SELECT {CELL.format(s=1000)} AS cell, MIN(lon) AS w FROM det WHERE quality = 'sp' GROUP BY 1) SELECT c.cell, c.cnt, b.w FROM (SELECT {CELL.format(s=1000)} AS cell, COUNT(*) AS cnt FROM det GROUP BY 1) c JOIN b USING (cell)", "det")
def _(det):
    c = plain_cell(F.col("lon_c"), F.col("lat_c"), 1000)
    return det.groupBy(c.alias("cell")).agg(F.count("*").alias("cnt")).join(det.filter("quality = 'sp'").groupBy(c.alias("cell")).agg(F.min("lon").alias("w")), "cell")


#: Regions as edges (region, ax, ay, bx, by): a square with a hole and, apart from it, a second part; and one across the antimeridian.
_RINGS = {
    "holed": [((-60.005, -40.005), (40.005, -40.005), (40.005, 50.005), (-60.005, 50.005)), ((-20.005, -10.005), (20.005, -15.005), (5.005, 30.005)), ((100.005, 10.005), (130.005, 20.005), (110.005, 60.005))],
    "crossing": [((160.005, -50.005), (205.005, -45.005), (190.005, 40.005), (170.005, 30.005)), ((178.005, -5.005), (184.005, -5.005), (184.005, 5.005), (178.005, 5.005))],
}
_EDGES = ", ".join(f"('{k}', {a[0]}, {a[1]}, {b[0]}, {b[1]})" for k, rings in _RINGS.items() for r in rings for a, b in zip(r, r[1:] + r[:1], strict=True))


@register("j10_holed_regions", f"AS_CTE e(region, ax, ay, bx, \"by\") AS (SELECT col0, CAST(col1 AS DOUBLE), CAST(col2 AS DOUBLE), CAST(col3 AS DOUBLE), CAST(col4 AS DOUBLE) FROM (VALUES {_EDGES})), p AS (SELECT det_id, lat, lon + k * 360 AS x FROM det, (VALUES (-1), (0), (1)) AS t(k)) SELECT det_id, region FROM p JOIN e ON (ay > lat) <> (\"by\" > lat) AND x < (bx - ax) * (lat - ay) / (\"by\" - ay) + ax GROUP BY det_id, region, x HAVING COUNT(*) % 2 = 1", "det")
def _(det):
    point = lambda p: f"named_struct('x', {p[0]}D, 'y', {p[1]}D)"
    rings = lambda some: "array(" + ", ".join("array(" + ", ".join(map(point, r)) + ")" for r in some) + ")"
    regions = det.sparkSession.sql(" UNION ALL ".join(f"SELECT '{k}' AS region, {rings(v)} AS rings" for k, v in _RINGS.items()))
    return viewport.join_regions(det, regions).select("det_id", "region")


@register("j10_regions", "SELECT det_id, 'east' AS region FROM det WHERE lon > 10.005 AND lon < 60.005 AND lat > -20.005 AND lat < 30.005 UNION ALL SELECT det_id, 'triangle' FROM det WHERE lon + lat < 0.005 AND lon > -120.005 AND lat > -60.005", "det")
def _(det):
    ring = lambda *p: "array(" + ", ".join(f"named_struct('x', {x}D, 'y', {y}D)" for x, y in p) + ")"
    regions = det.sparkSession.sql(f"SELECT 'east' AS region, {ring((10.005, -20.005), (60.005, -20.005), (60.005, 30.005), (10.005, 30.005))} AS ring UNION ALL SELECT 'triangle', {ring((-120.005, -60.005), (60.01, -60.005), (-120.005, 120.01))}")
    return viewport.join_regions(det, regions).select("det_id", "region")


@register("r1_route", f"SELECT req, CASE WHEN lo >= DATE '2000-06-01' THEN 'live' WHEN year(lo) = year(hi) AND year(lo) BETWEEN 1995 AND 2000 THEN 'year-' || CAST(year(lo) AS VARCHAR) WHEN year(hi) = year(lo) + 1 AND (CASE WHEN date_diff('day', lo, make_date(year(hi), 1, 1)) > date_diff('day', make_date(year(hi), 1, 1), hi) + 1 THEN year(lo) ELSE year(hi) END) BETWEEN 1995 AND 2000 THEN 'year-' || CAST(CASE WHEN date_diff('day', lo, make_date(year(hi), 1, 1)) > date_diff('day', make_date(year(hi), 1, 1), hi) + 1 THEN year(lo) ELSE year(hi) END AS VARCHAR) ELSE 'alltime' END AS target FROM {DOMAINS}")
def _(spark, sf_dir):
    return route.route(domains(spark, sf_dir), (1995, 2000), "2000-06-01")


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time domains asked for, one per line item."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lo = F.col("l_shipdate").cast("date")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("req"), lo.alias("lo"), F.date_add(lo, (F.col("l_quantity") * 12).cast("int")).alias("hi"))


@register("r2_selected", f"SELECT {CELL.format(s=1000)} AS cell, SUM(CASE WHEN month_key BETWEEN '199703' AND '199902' THEN 1 ELSE 0 END)::BIGINT AS cnt FROM ord GROUP BY 1", "ord")
def _(det):
    return viewport.selected(cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.col("month_key"), ()), "199703", "199902")


@register(
    "r2_modes",
    f"AS_CTE c AS (SELECT {CELL.format(s=1000)} AS cell, month_key, COUNT(*) AS cnt FROM ord GROUP BY 1, 2) "
    + " UNION ALL ".join(f"SELECT '{mode}' AS mode, cell, CAST(SUM(CASE WHEN month_key BETWEEN '{lo}' AND '{hi}' THEN cnt ELSE 0 END) AS BIGINT) AS cnt FROM c GROUP BY cell" for mode, lo, hi in (("whole", "199501", "200112"), ("sum", "199703", "199902"), ("running", "199703", "199902"), ("none", "201001", "201012"))),
    "ord", raw=True,
)
def _(spark, sf_dir):
    months, total, axis = month_cells(yearly(spark, sf_dir)), running_months(spark, sf_dir), ("199501", "200112")
    ways = {"whole": ("199501", "200112", None), "sum": ("199703", "199902", None), "running": ("199703", "199902", total), "none": ("201001", "201012", None)}
    assert all(viewport.selection_mode(months, lo, hi, axis, running is not None) == mode for mode, (lo, hi, running) in ways.items())
    return reduce(DataFrame.unionByName, [viewport.selected(months, lo, hi, axis, running).select(F.lit(mode).alias("mode"), "cell", F.col("cnt").cast("long").alias("cnt")) for mode, (lo, hi, running) in ways.items()])


@register("r3_mounts", f"SELECT req, year, rank FROM (SELECT req, year, CAST(ROW_NUMBER() OVER (PARTITION BY req ORDER BY ABS(year - (year(lo) + (year(hi) - year(lo)) / 2.0)), year DESC) AS INT) AS rank FROM {DOMAINS} d JOIN (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders) y ON y.year BETWEEN year(d.lo) AND year(d.hi)) WHERE rank <= 2")
def _(spark, sf_dir):
    return route.plan_mounts(domains(spark, sf_dir), yearly(spark, sf_dir).select("year").distinct())


def tiles_sql(zooms) -> str:
    """Tiles counted at each zoom from the points."""
    y = "least(greatest(0, floor((0.5 - ln(tan(pi() / 4 + radians(least(85.05112878, greatest(-85.05112878, lat))) / 2)) / (2 * pi())) * pow(2, z))), pow(2, z) - 1)"
    return f"""AS_CTE zs AS (SELECT unnest({list(zooms)}) AS z), p AS (SELECT z, CAST(least(floor((lon + 180) / 360 * pow(2, z)), pow(2, z) - 1) AS BIGINT) AS x, CAST({y} AS BIGINT) AS y, {CELL.format(s=500)} AS cell FROM det, zs),
      tiles AS (SELECT z, x, y, COUNT(*) AS points, COUNT(DISTINCT cell) AS cells, COUNT(*) * {route.POINT_BYTES} + COUNT(DISTINCT cell) * {route.CELL_BYTES} AS bytes FROM p GROUP BY 1, 2, 3)"""


@register("r4_tile_weights", tiles_sql((0, 2, 4, 6)) + " SELECT * FROM tiles", "det")
def _(det):
    return route.tile_weights(det, [0, 2, 4, 6], plain_cell(F.col("lon_c"), F.col("lat_c"), 500))


@register("r4_handover", tiles_sql(range(10)) + " SELECT MIN(z) AS zoom FROM (SELECT z, MAX(bytes) AS heaviest FROM tiles GROUP BY z) WHERE heaviest <= 3000", "det")
def _(det):
    return route.handover(route.tile_weights(det, list(range(10)), plain_cell(F.col("lon_c"), F.col("lat_c"), 500)), 3000)


# ---- sequences ----------------------------------------------------------------------------------------------------

LO, HI = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-31 00:00:00'"
HOLES = f"AS_CTE t AS (SELECT DISTINCT acq_datetime AS t FROM det WHERE NOT ({HOLE}) AND acq_datetime > {LO} AND acq_datetime < {HI} UNION SELECT {LO} UNION SELECT {HI}), g AS (SELECT LAG(t) OVER (ORDER BY t) AS p, t FROM t)"


def with_hole(det: DataFrame) -> DataFrame:
    return timeseq.holes(det.filter(f"not ({HOLE})"), "3 hours", lo=F.expr(f"cast({LO} as timestamp_ntz)"), hi=F.expr(f"cast({HI} as timestamp_ntz)"))


@register("w1_holes", HOLES + " SELECT CAST(p AS TIMESTAMP) AS hole_start, CAST(t AS TIMESTAMP) AS hole_end FROM g WHERE t > p + INTERVAL 3 HOUR", "det")
def _(det):
    return with_hole(det).select(F.col("start").alias("hole_start"), F.col("end").alias("hole_end"))


@register("w2_silences", "AS_CTE t AS (SELECT DISTINCT sensor, acq_datetime AS t FROM det WHERE event_hour < 14), g AS (SELECT sensor, LAG(t) OVER (PARTITION BY sensor ORDER BY t) AS p, t FROM t) SELECT sensor, CAST(p AS TIMESTAMP) AS quiet_from, CAST(t AS TIMESTAMP) AS quiet_to FROM g WHERE t > p + INTERVAL 9 HOUR".replace("event_hour < 14", "hour(acq_datetime) < 14"), "det")
def _(det):
    return timeseq.holes(det.filter(F.hour("acq_datetime") < 14), "9 hours", by=["sensor"]).select("sensor", F.col("start").alias("quiet_from"), F.col("end").alias("quiet_to"))


@register("w3_days_touched", HOLES + " SELECT DISTINCT CAST(unnest(generate_series(CAST(p AS DATE), CAST(t AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM g WHERE t > p + INTERVAL 3 HOUR", "det")
def _(det):
    return timeseq.days_touched(with_hole(det), F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"))


@register("w4_runs", f"AS_CTE d AS (SELECT DISTINCT acq_date AS day FROM det WHERE NOT ({HOLE})), i AS (SELECT day, day - CAST(ROW_NUMBER() OVER (ORDER BY day) AS INT) AS g FROM d), p AS (SELECT day, g, (ROW_NUMBER() OVER (PARTITION BY g ORDER BY day) - 1) // 5 AS part FROM i) SELECT CAST(MIN(day) AS VARCHAR) AS start, COUNT(*) AS n_days FROM p GROUP BY g, part", "det")
def _(det):
    seen = det.filter(f"not ({HOLE})").select(F.col("acq_date").alias("day")).distinct()
    return timeseq.runs(seen).select(F.col("start").cast("string").alias("start"), "n_days")


MONTH_CELLS = f"c AS (SELECT {CELL.format(s=1000)} AS cell, month_key AS bucket, COUNT(*) AS cnt FROM ord GROUP BY 1, 2)"


def month_cells(det: DataFrame) -> DataFrame:
    return cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.col("month_key"), ())


@register("w5_running", f"AS_CTE {MONTH_CELLS} SELECT cell, bucket, CAST(SUM(cnt) OVER (PARTITION BY cell ORDER BY bucket) AS BIGINT) AS running FROM c", "ord")
def _(det):
    return timeseq.running(month_cells(det))


@register("w6_dense", f"AS_CTE {MONTH_CELLS}, s AS (SELECT strftime(m, '%Y%m') AS bucket FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m)) SELECT k.cell, s.bucket, COALESCE(c.cnt, 0) AS cnt FROM (SELECT DISTINCT cell FROM c) k CROSS JOIN s LEFT JOIN c ON c.cell = k.cell AND c.bucket = s.bucket", "ord")
def _(det):
    return timeseq.dense(month_cells(det), timeseq.spine(det, "month", F.lit("199501"), F.lit("200112"))).select("cell", "bucket", "cnt")


def running_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals by cell and month, made once from the detections."""
    return store.persisted(spark, f"{sf_dir}/orders.parquet", "running", lambda: timeseq.running(month_cells(yearly(spark, sf_dir))))


@register("w7_range_sum", f"AS_CTE {MONTH_CELLS} SELECT cell, SUM(CASE WHEN bucket BETWEEN '199705' AND '199808' THEN cnt ELSE 0 END)::BIGINT AS cnt FROM c WHERE bucket <= '199808' GROUP BY cell", "ord", raw=True)
def _(spark, sf_dir):
    return timeseq.range_sum(running_months(spark, sf_dir), "199705", "199808")


@register("w8_gaps", f"AS_CTE a AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY day_key) - 1 AS BIGINT) AS pos, day_key FROM (SELECT DISTINCT day_key FROM det)), b AS (SELECT pos FROM a WHERE NOT EXISTS (SELECT 1 FROM {SOURCES} s WHERE s.unit = 'day' AND s.id <> '2024' AND a.day_key BETWEEN s.min_key AND s.max_key)), i AS (SELECT pos, pos - ROW_NUMBER() OVER (ORDER BY pos) AS g FROM b) SELECT MIN(pos) AS from_pos, MAX(pos) AS to_pos FROM i GROUP BY g", "det")
def _(det):
    first = det.agg(F.min(keys.bucket_index(F.col("day_key"))).alias("first"))  # every day of the span has rows
    axis = det.select(F.col("day_key").alias("bucket"), F.lit("day").alias("unit")).distinct().crossJoin(F.broadcast(first))
    axis = axis.withColumn("pos", keys.bucket_index(F.col("bucket")) - F.col("first"))
    return timeseq.gaps(axis, values(det, SOURCES).filter("id <> '2024'"))


@register("w9_union_axis", "AS_CTE d AS (SELECT sensor AS id, 'day' AS unit, MIN(day_key) AS min_key, MAX(day_key) AS max_key FROM det WHERE quality = 'sp' GROUP BY sensor), m AS (SELECT sensor, 'month', MIN(substr(day_key, 1, 6)), MAX(substr(day_key, 1, 6)) FROM det GROUP BY sensor) SELECT 'day' AS unit, MIN(min_key) AS min_key, MAX(max_key) AS max_key FROM (SELECT * FROM d UNION ALL SELECT * FROM m) WHERE unit = 'day'", "det")
def _(det):
    extent = lambda key, unit, df: df.groupBy(F.col("sensor").alias("id")).agg(F.lit(unit).alias("unit"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
    return timeseq.union_axis(extent(F.col("day_key"), "day", det.filter("quality = 'sp'")).unionByName(extent(F.substring("day_key", 1, 6), "month", det)))


@register("w10_downsample", "AS_CTE s AS (SELECT ROW_NUMBER() OVER (ORDER BY month_key) - 1 AS idx, cnt, (SELECT COUNT(DISTINCT month_key) FROM ord) AS n FROM (SELECT month_key, COUNT(*) AS cnt FROM ord GROUP BY 1)) SELECT CAST(((idx + 1) * 20 - 1) // n AS BIGINT) AS bar, CAST(SUM(cnt) AS BIGINT) AS total, ROUND(AVG(cnt), 4) AS mean FROM s GROUP BY 1", "ord")
def _(det):
    months = det.groupBy("month_key").agg(F.count("*").alias("value"), F.min(keys.bucket_index(F.col("month_key"))).alias("i"))
    span = months.agg(F.min("i").alias("lo"), (F.max("i") - F.min("i") + 1).alias("size"))  # one row
    series = months.crossJoin(F.broadcast(span)).select((F.col("i") - F.col("lo")).alias("idx"), "value", "size")
    return timeseq.downsample(series, F.col("size"), 20).select("bar", "total", F.round("mean", 4).alias("mean"))


@register("w12_overlaps", "AS_CTE e AS (SELECT sensor, quality, MIN(acq_date) AS lo, MAX(acq_date) AS hi FROM (SELECT sensor, quality, acq_date FROM det UNION ALL SELECT sensor, 'nrt', acq_date FROM det WHERE sensor = 'MODIS') GROUP BY 1, 2), f AS (SELECT *, LEAD(quality) OVER (PARTITION BY sensor ORDER BY lo, quality) AS next_quality, LEAD(lo) OVER (PARTITION BY sensor ORDER BY lo, quality) AS next_from FROM e) SELECT sensor, quality, CAST(hi AS VARCHAR) AS until, next_quality, CAST(next_from AS VARCHAR) AS next_from FROM f WHERE next_from <= hi", "det")
def _(det):
    d = det.select("sensor", "quality", "acq_date")
    both = d.unionByName(d.filter("sensor = 'MODIS'").withColumn("quality", F.lit("nrt")))
    return timeseq.overlaps(both).select("sensor", "quality", F.col("until").cast("string").alias("until"), "next_quality", F.col("next_from").cast("string").alias("next_from"))


YEAR_CELLS = f"c AS (SELECT {CELL.format(s=2000)} AS cell, CAST(month(acq_date) AS INT) AS moy, year, COUNT(*) AS cnt FROM ord GROUP BY 1, 2, 3)"


@register("w13_climatology", f"AS_CTE {YEAR_CELLS}, x AS (SELECT *, COUNT(*) OVER w - 1 AS n, SUM(cnt) OVER w - cnt AS s, SUM(cnt * cnt) OVER w - cnt * cnt AS q FROM c WINDOW w AS (PARTITION BY cell, moy)) SELECT cell, moy, year, cnt, CASE WHEN n > 0 THEN ROUND(CAST(s AS DOUBLE) / n, 4) END AS mean_other, CASE WHEN n > 1 THEN ROUND(SQRT(GREATEST(0.0, (CAST(q AS DOUBLE) - CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n) / (n - 1))), 4) END AS sd_other FROM x", "ord")
def _(det):
    c = det.groupBy(plain_cell(F.col("lon_c"), F.col("lat_c"), 2000).alias("cell"), F.month("acq_date").alias("moy"), "year").agg(F.count("*").alias("cnt"))
    return timeseq.climatology(c).select("cell", "moy", "year", "cnt", F.round("mean_other", 4).alias("mean_other"), F.round("sd_other", 4).alias("sd_other"))


@register("w14_persistent", f"SELECT {CELL.format(s=500)} AS cell, COUNT(DISTINCT month_key) AS active FROM ord GROUP BY 1 HAVING COUNT(DISTINCT month_key) >= 5", "ord")
def _(det):
    return timeseq.persistent(det.select(plain_cell(F.col("lon_c"), F.col("lat_c"), 500).alias("cell"), F.col("month_key").alias("bucket")), 5)


@register("w15_energy", f"AS_CTE t AS (SELECT {CELL.format(s=2000)} AS cell, sensor, acq_datetime AS t, SUM(frp) AS f FROM det WHERE frp IS NOT NULL GROUP BY 1, 2, 3), g AS (SELECT cell, sensor, f, LAG(f) OVER w AS f0, CAST(epoch_us(t) - epoch_us(LAG(t) OVER w) AS DOUBLE) / 1e6 AS dt FROM t WINDOW w AS (PARTITION BY cell, sensor ORDER BY t)) SELECT cell, sensor, ROUND(SUM(CASE WHEN dt <= 86400 THEN (f + f0) / 2 * dt END) / 1e6, 3) AS energy_tj FROM g GROUP BY cell, sensor", "det")
def _(det):
    by_cell = det.withColumn("cell", plain_cell(F.col("lon_c"), F.col("lat_c"), 2000))
    return timeseq.energy(by_cell, ["cell", "sensor"]).select("cell", "sensor", F.round(F.col("energy") / 1e6, 3).alias("energy_tj"))


@register("w15_energy_by_sensor", "AS_CTE t AS (SELECT sensor, acq_datetime AS t, SUM(frp) AS f FROM det WHERE frp IS NOT NULL GROUP BY 1, 2), g AS (SELECT sensor, f, LAG(f) OVER w AS f0, CAST(epoch_us(t) - epoch_us(LAG(t) OVER w) AS DOUBLE) / 1e6 AS dt FROM t WINDOW w AS (PARTITION BY sensor ORDER BY t)) SELECT sensor, ROUND(SUM(CASE WHEN dt <= 86400 THEN (f + f0) / 2 * dt END) / 1e6, 3) AS energy_tj FROM g GROUP BY sensor", "det")
def _(det):
    return timeseq.energy(det, ["sensor"]).select("sensor", F.round(F.col("energy") / 1e6, 3).alias("energy_tj"))


# ---- order, sets, maintenance -----------------------------------------------------------------------------------


@register("t2_top_cells", f"SELECT {CELL.format(s=500)} AS cell, COUNT(*) AS cnt FROM ord GROUP BY 1 ORDER BY cnt DESC, cell LIMIT 10", "ord")
def _(det):
    return det.groupBy(plain_cell(F.col("lon_c"), F.col("lat_c"), 500).alias("cell")).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "cell").limit(10)


@register("t3_years", "SELECT DISTINCT year FROM ord ORDER BY year", "ord")
def _(det):
    return det.select("year").distinct().orderBy("year")


_TURN = """(SELECT k - 1 AS k, det_id, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN low - py ELSE py END ELSE px END AS x, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN low - px ELSE px END ELSE py END AS y, d * 4 + xor(3 * rx, ry) AS d
  FROM (SELECT k, det_id, d, (x >> k) & 1 AS rx, (y >> k) & 1 AS ry, x & ((1 << k) - 1) AS px, y & ((1 << k) - 1) AS py, (1 << k) - 1 AS low FROM h WHERE k >= 0))"""


@register("t1_hilbert", f"RECURSIVE_CTE h AS (SELECT 15 AS k, det_id, CAST(least(floor((lon + 180) / 360 * 65536), 65535) AS BIGINT) AS x, CAST(least(floor((lat + 90) / 180 * 65536), 65535) AS BIGINT) AS y, CAST(0 AS BIGINT) AS d FROM det UNION ALL {_TURN}) SELECT det_id, d AS place FROM h WHERE k = -1", "det")
def _(det):
    return with_hilbert(det, F.col("lon"), F.col("lat"), "place").select("det_id", "place")


@register("m1_merge_tail", "SELECT det_id, acq_datetime FROM det", "det")
def _(det):
    return maintain.merge_tail(det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {WINDOW}")).select("det_id", "acq_datetime")


#: Archive, window, whether a gap is allowed, and the year asked for; each leads to a decision of its own.
MERGES = {
    "overlap": ("acq_datetime < TIMESTAMP '2024-01-24 12:00:00'", "acq_datetime >= TIMESTAMP '2024-01-23 00:00:00'", False, 2024),
    "covered": ("TRUE", "acq_datetime BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'", False, 2024),
    "disjoint": ("acq_datetime < TIMESTAMP '2024-01-10 00:00:00'", "acq_datetime >= TIMESTAMP '2024-01-20 00:00:00'", False, 2024),
    "allowed": ("acq_datetime < TIMESTAMP '2024-01-10 00:00:00'", "acq_datetime >= TIMESTAMP '2024-01-20 00:00:00'", True, 2024),
    "empty": ("TRUE", "FALSE", False, 2024),
    "new": ("FALSE", "acq_datetime < TIMESTAMP '2024-01-20 00:00:00'", False, 2024),
    "late": ("FALSE", "acq_datetime >= TIMESTAMP '2024-01-20 00:00:00'", False, 2024),
    "other": ("FALSE", "acq_datetime < TIMESTAMP '2024-01-20 00:00:00'", False, 2025),
}


def decision_sql(name: str, archive: str, window: str, allow: bool, year: int) -> str:
    return f"""SELECT '{name}' AS scenario, CASE WHEN w0 IS NULL THEN 'noop' WHEN a1 IS NULL THEN CASE WHEN year(w0) = {year} AND dayofyear(w0) <= 10 THEN 'seed' ELSE 'refuse' END
      WHEN w0 > a1 AND NOT {allow} THEN 'refuse' WHEN w1 <= a1 THEN 'noop' ELSE 'merge' END AS action
      FROM (SELECT MAX(CASE WHEN {archive} THEN acq_datetime END) AS a1, MIN(CASE WHEN {window} THEN acq_datetime END) AS w0, MAX(CASE WHEN {window} THEN acq_datetime END) AS w1 FROM det)"""


@register("m2_merge_decision", " UNION ALL ".join(decision_sql(k, *v) for k, v in MERGES.items()), "det")
def _(det):
    said = [maintain.merge_decision(det.filter(a), det.filter(w), year, allow).select(F.lit(k).alias("scenario"), "action") for k, (a, w, allow, year) in MERGES.items()]
    return reduce(DataFrame.unionByName, said)


@register("m3_seed", "SELECT 'seed' AS action, det_id FROM det WHERE acq_datetime < TIMESTAMP '2024-01-06 00:00:00' AND (SELECT dayofyear(MIN(acq_datetime)) FROM det) <= 10", "det")
def _(det):
    said, rows = maintain.merge(det.limit(0), det.filter("acq_datetime < TIMESTAMP '2024-01-06 00:00:00'"), 2024)
    return rows.select(F.lit(said.split(":")[0]).alias("action"), "det_id")


@register("m4_replace_days", f"SELECT det_id, sensor FROM det WHERE NOT ({HOLE}) AND acq_date NOT IN (DATE '2024-01-10', DATE '2024-01-11', DATE '2024-01-12') UNION ALL SELECT det_id, sensor FROM det WHERE acq_date IN (DATE '2024-01-10', DATE '2024-01-11', DATE '2024-01-12')", "det")
def _(det):
    days = det.sparkSession.sql("SELECT explode(sequence(DATE '2024-01-10', DATE '2024-01-12')) AS day")
    return maintain.replace_days(det.filter(f"not ({HOLE})"), det, days).select("det_id", "sensor")


@register("m5_supersede", "SELECT det_id, quality FROM det d WHERE quality = 'sp' OR NOT EXISTS (SELECT 1 FROM det s WHERE s.sensor = d.sensor AND s.acq_date = d.acq_date AND s.quality = 'sp')", "det")
def _(det):
    return maintain.supersede(det).select("det_id", "quality")


@register("m8_entries", "SELECT year AS id, CASE WHEN year >= 2000 THEN COUNT(*) ELSE SUM(CASE WHEN sensor = 'MODIS' THEN 1 ELSE 0 END) END::BIGINT AS n_rows FROM ord GROUP BY year", "ord")
def _(det):
    entries = lambda df: df.groupBy(F.col("year").alias("id")).agg(F.count("*").alias("n_rows"))
    return maintain.replace_entries(entries(det.filter("sensor = 'MODIS'")), entries(det.filter("year >= 2000")))


@register("m6_unions", f"SELECT {CELL.format(s=1000)} AS cell FROM det WHERE sensor = 'VIIRS_SNPP' UNION SELECT {CELL.format(s=1000)} FROM det WHERE sensor = 'VIIRS_NOAA20' AND daynight = 'N'", "det")
def _(det):
    """Neither set holds the other, and they share cells."""
    c = plain_cell(F.col("lon_c"), F.col("lat_c"), 1000).alias("cell")
    return det.filter("sensor = 'VIIRS_SNPP'").select(c).union(det.filter("sensor = 'VIIRS_NOAA20' and daynight = 'N'").select(c)).distinct()


@register("m7_except", "SELECT sensor FROM ord WHERE year = 2001 EXCEPT SELECT sensor FROM ord WHERE year = 1997", "ord")
def _(det):
    return det.filter("year = 2001").select("sensor").distinct().exceptAll(det.filter("year = 1997").select("sensor").distinct())


@register("s9_eras", "AS_CTE c AS (SELECT month_key AS bucket, CASE WHEN year BETWEEN 1999 AND 2001 THEN '1999-2001' WHEN year BETWEEN 1995 AND 1998 THEN '1995-1998' END AS era FROM ord) SELECT era, MIN(bucket) AS min_bucket, MAX(bucket) AS max_bucket, COUNT(DISTINCT bucket) AS buckets FROM c GROUP BY era", "ord")
def _(det):
    return store.era_manifest(store.split_by_era(det.select("year", F.col("month_key").alias("bucket")), eras=((1999, 2001), (1995, 1998))))


@register("s12_windows", "AS_CTE a AS (SELECT sensor AS source_id, MIN(acq_date) AS lo, MAX(acq_date) AS hi FROM det GROUP BY 1), w AS (SELECT source_id, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 5 DAY)) AS DATE) AS start FROM a) SELECT source_id, CAST(start AS VARCHAR) AS start, CAST(LEAST(5, date_diff('day', start, hi) + 1) AS INT) AS n_days FROM w", "det")
def _(det):
    avail = det.groupBy(F.col("sensor").alias("source_id")).agg(F.min("acq_date").alias("lo"), F.max("acq_date").alias("hi"))
    return store.plan_windows(avail).select("source_id", F.col("start").cast("string").alias("start"), "n_days")


@register("s13_slices", "AS_CTE a AS (SELECT sensor AS source_id, MIN(year) AS lo, MAX(year) AS hi FROM ord GROUP BY 1) SELECT source_id, CAST(unnest(generate_series(lo, hi)) AS INT) AS year FROM a", "ord")
def _(det):
    return store.plan_slices(det.groupBy(F.col("sensor").alias("source_id")).agg(F.min("acq_date").alias("lo"), F.max("acq_date").alias("hi")))


# ---- scalar functions ---------------------------------------------------------------------------------------------


@register("f1_bucket_index", "SELECT DISTINCT month_key, CAST(CAST(substr(month_key, 1, 4) AS INT) * 12 + CAST(substr(month_key, 5, 2) AS INT) - 1 AS BIGINT) AS idx, month_key AS back FROM ord", "ord")
def _(det):
    idx = keys.bucket_index(F.col("month_key"))
    return det.select("month_key").distinct().select("month_key", idx.alias("idx"), keys.bucket_key(idx, "month").alias("back"))


@register("f2_key_days", "SELECT DISTINCT month_key, CAST(last_day(strptime(month_key || '01', '%Y%m%d')::DATE) AS VARCHAR) AS last, date_diff('day', strptime(month_key || '01', '%Y%m%d')::DATE, last_day(strptime(month_key || '01', '%Y%m%d')::DATE)) + 1 AS days FROM ord", "ord")
def _(det):
    k = F.col("month_key")
    return det.select(k).distinct().select("month_key", keys.last_day(k).cast("string").alias("last"), keys.days_between(k, k).cast("long").alias("days"))


@register("f3_labels", "SELECT DISTINCT day_key, substr(day_key, 1, 4) || '-' || substr(day_key, 5, 2) || '-' || substr(day_key, 7, 2) AS label FROM det", "det")
def _(det):
    return det.select("day_key").distinct().select("day_key", keys.label(F.col("day_key")).alias("label"))


@register("f4_axis_position", "SELECT det_id, CASE WHEN acq_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' THEN CAST(date_diff('day', DATE '2024-01-05', acq_date) AS BIGINT) ELSE -1 END AS pos FROM det", "det")
def _(det):
    return det.select("det_id", keys.axis_position(F.col("day_key"), F.lit("20240105"), F.lit(20)).alias("pos"))


@register("f5_lon_overlaps", "SELECT det_id, (lon - 1 <= 200 AND lon + 1 >= 170) OR (lon + 359 <= 200 AND lon + 361 >= 170) AS meets FROM det", "det")
def _(det):
    return det.select("det_id", lon_overlaps(F.col("lon") - 1, F.col("lon") + 1, 170, 200).alias("meets"))


@register("f6_mercator", "SELECT det_id, ROUND(0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi()), 6) AS y FROM det WHERE lat BETWEEN -80 AND 80", "det")
def _(det):
    return det.filter(F.col("lat").between(-80, 80)).select("det_id", F.round(mercator_y(F.col("lat")), 6).alias("y"))


@register("f6_tiles", f"SELECT det_id, CAST(least(floor((lon + 180) / 360 * 256), 255) AS BIGINT) AS x, CAST(least(greatest(0, floor((0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * 256)), 255) AS BIGINT) AS y, ROUND(least(floor((lon + 180) / 360 * 256), 255) / 256 * 360 - 180, 6) AS w FROM det WHERE lat BETWEEN -85 AND 85", "det")
def _(det):
    t = tile_xy(F.col("lon"), F.col("lat"), 8)
    return det.filter(F.col("lat").between(-85, 85)).select("det_id", t["x"].alias("x"), t["y"].alias("y"), F.round(tile_point(t["x"], t["y"], 8)["lon"], 6).alias("w"))


@register("f6_tile_corners", "SELECT DISTINCT lat, ROUND(degrees(2 * atan(exp(pi() * (1 - 2 * (0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())))))) - 90, 6) AS back FROM det WHERE lat BETWEEN -80 AND 80", "det")
def _(det):
    return det.filter(F.col("lat").between(-80, 80)).select("lat", F.round(tile_point(F.lit(0.0), mercator_y(F.col("lat")) * 1024, 10)["lat"], 6).alias("back")).distinct()


@register("f7_classes", "SELECT det_id, CASE WHEN frp >= 1000 THEN 5 WHEN frp >= 500 THEN 4 WHEN frp >= 200 THEN 3 WHEN frp >= 50 THEN 2 WHEN frp >= 10 THEN 1 END AS class FROM det", "det")
def _(det):
    return det.select("det_id", fields.class_of(F.col("frp"), F.array(*[F.lit(x) for x in fields.POWER_LADDER])).alias("class"))


BANDS = "(SELECT * FROM (VALUES (5, 1, 4), (8, 5, 9), (10, 11, NULL)) AS t(level, min_zoom, max_zoom))"


@register("f8_level_for_zoom", f"SELECT det_id, (SELECT MIN(level) FROM {BANDS} b WHERE floor((det_id % 140) / 10.0) >= min_zoom AND (max_zoom IS NULL OR floor((det_id % 140) / 10.0) <= max_zoom)) AS level, CAST(11 AS DOUBLE) AS points_from FROM det", "det")
def _(det):
    bands = values(det, BANDS)
    zooms = classify.level_for_zoom(det.select("det_id", ((F.col("det_id") % 140) / 10).alias("zoom")), bands)
    raw = classify.points_from(bands.withColumn("layer", F.when(F.col("max_zoom").isNull(), "features").otherwise("cells"))).select(F.col("zoom").alias("points_from"))
    return zooms.crossJoin(F.broadcast(raw)).select("det_id", "level", "points_from")


_AXIS = "least(floor({u} * {n}), {n} - 1)"
_U, _V = "(lon + 180) / 360", "(sin(radians(lat)) + 1) / 2"
_ID = "(CAST({x} AS BIGINT) * 268435456 + CAST({y} AS BIGINT))"


@register("f9_cells", f"AS_CTE c AS (SELECT {_AXIS.format(u=_U, n=1024)} AS x, {_AXIS.format(u=_V, n=512)} AS y FROM det) SELECT {_ID.format(x='x', y='y')} AS cell, {_ID.format(x='floor(x / 8)', y='floor(y / 8)')} AS up, COUNT(*) AS cnt, ROUND(x * 360 / 1024 - 180, 6) AS w, ROUND((x + 1) * 360 / 1024 - 180, 6) AS e, ROUND(degrees(asin(y * 2 / 512 - 1)), 6) AS s, ROUND(degrees(asin((y + 1) * 2 / 512 - 1)), 6) AS n FROM c GROUP BY x, y", "det")
def _(det):
    fine = det.groupBy(cell(F.col("lon"), F.col("lat"), 9).alias("cell")).agg(F.count("*").alias("cnt"))
    boxed = store.with_bbox(fine.withColumn("bounds", bounds(F.col("cell"), 9)))
    return boxed.select("cell", parent(F.col("cell"), 3).alias("up"), "cnt", *[F.round(f"bbox.{c}", 6).alias(c) for c in "wsen"])


@register("f10_tolerant_json", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_id END AS a, CASE WHEN event_id % 4 = 0 THEN event_type END AS b, event_id % 4 = 0 AS is_object FROM events""")
def _(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i, kind = F.col("event_id"), F.col("event_type")
    text = F.when(i % 4 == 0, F.to_json(F.struct(i.alias("a"), kind.alias("b")))).when(i % 4 == 1, F.concat(F.lit("{broken "), kind)).when(i % 4 == 2, F.to_json(F.array(i)))
    return e.select("event_id", fields.tolerant_json(text, "a long, b string").alias("j")).select("event_id", "j.a", "j.b", F.col("j").isNotNull().alias("is_object"))


@register("f11_iso_z", "SELECT det_id, strftime(acq_datetime, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM det", "det")
def _(det):
    return det.select("det_id", fields.iso_z(F.col("acq_datetime")).alias("iso"))


# ---- gates ----------------------------------------------------------------------------------------------------------


@register("q1_totals", f"AS_CTE c AS (SELECT {CELL.format(s=250)} AS cell, COUNT(*) AS cnt FROM det GROUP BY 1) SELECT * FROM (SELECT 1 AS level, CAST(SUM(cnt) AS BIGINT) AS got, (SELECT COUNT(*) FROM det) AS want FROM c WHERE cell >= 7200000) WHERE got <> want", "det")
def _(det):
    base = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 250), F.lit("all"), ())
    # level 1 lost its western half, levels 0 and 2 are sound
    lost = base.filter("cell >= 7200000").select(F.lit(1).alias("level"), "cnt")
    levels = base.select(F.lit(0).alias("level"), "cnt").unionByName(lost).unionByName(cells.rollup(base, plain_parent(F.col("cell"))).select(F.lit(2).alias("level"), "cnt"))
    return quality.totals_differ(det, levels)


@register("q2_rows_differ", f"SELECT * FROM (SELECT COUNT(*) AS got, SUM(CASE WHEN {HOLE} THEN 0 ELSE 1 END)::BIGINT AS kept, SUM(CASE WHEN acq_date IN (DATE '2024-01-10', DATE '2024-01-11') THEN 1 ELSE 0 END)::BIGINT AS added FROM det) WHERE got <> kept + added", "det")
def _(det):
    return quality.rows_differ(det, det.filter(f"not ({HOLE})"), det.filter("acq_date in (DATE '2024-01-10', DATE '2024-01-11')"))


@register("q5_axis_differs", "SELECT day_key AS bucket, 'undeclared' AS problem FROM det WHERE day_key NOT BETWEEN '20240104' AND '20240201' GROUP BY 1 UNION ALL SELECT '20240201', 'absent'", "det")
def _(det):
    declared = det.agg(F.lit("20240104").alias("min_key"), F.lit("20240201").alias("max_key"))
    return quality.axis_differs(declared, det.select(F.col("day_key").alias("bucket")))


#: Of the events: what the fixed schema has and they lack, and two types that differ.
@register("q8_schema", "SELECT name, want, have, CASE name WHEN 'acq_datetime' THEN (SELECT COUNT(acq_datetime) FROM det) WHEN 'scan' THEN (SELECT COUNT(scan) FROM det WHERE quality = 'sp') END AS filled FROM (VALUES ('acq_datetime', 'timestamp', 'timestamp_ntz'), ('bright_t31', 'double', NULL), ('bright_ti4', 'double', NULL), ('bright_ti5', 'double', NULL), ('brightness', 'double', NULL), ('version', 'string', NULL), ('scan', 'double', 'string')) AS t(name, want, have)", "det")
def _(det):
    known = [c for c in det.columns if c not in ("det_id", "year", "lon_c", "lat_c", "day_key")]
    return quality.values_at_risk(det.select(*known).withColumn("scan", F.when(F.col("quality") == "sp", F.col("scan").cast("string"))))


#: Rows spoiled by their number, so that each rule is broken by some.
_SPOILED = {"lon": ("13", "200.0"), "lat": ("17", "NULL"), "frp": ("19", "-1.0"), "daynight": ("23", "'X'"), "acq_date": ("29", "DATE '2020-01-01'"), "type": ("11", "0"), "confidence_pct": ("7", "5")}
_BROKEN = {
    "rows": "TRUE", "type": "(quality = 'nrt') <> (type IS NULL)", "confidence_pct": "confidence_pct IS NOT NULL AND instrument <> 'MODIS'", "lon": "lon IS NULL OR lon NOT BETWEEN -180 AND 180",
    "lat": "lat IS NULL OR lat NOT BETWEEN -90 AND 90", "acq_date": "CAST(acq_datetime AS DATE) IS DISTINCT FROM acq_date", "frp": "frp < 0", "daynight": "daynight NOT IN ('D', 'N')",
}
_SPOIL = ", ".join(f"CASE WHEN det_id % {n} = 0 THEN {v} ELSE {c} END AS {c}" for c, (n, v) in _SPOILED.items())
_COUNTED = " UNION ALL ".join(f"SELECT sensor, quality, '{k}' AS rule, CAST(SUM(CASE WHEN {v} THEN 1 ELSE 0 END) AS BIGINT) AS cnt FROM s GROUP BY 1, 2" for k, v in _BROKEN.items())


@register("q11_row_gates", f"AS_CTE s AS (SELECT sensor, quality, instrument, acq_datetime, {_SPOIL} FROM det) SELECT * FROM ({_COUNTED}) WHERE cnt > 0", "det")
def _(det):
    """Every gate on single rows, in one scan."""
    spoiled = det.withColumns({c: F.expr(f"case when det_id % {n} = 0 then {v} else {c} end") for c, (n, v) in _SPOILED.items()})
    return quality.row_gates(spoiled.drop("scan", "track"))


@register("q9_nothing_found", "SELECT s.sensor, y.year FROM (SELECT DISTINCT sensor FROM ord) s, (SELECT DISTINCT year FROM ord) y WHERE NOT EXISTS (SELECT 1 FROM ord o WHERE o.sensor = s.sensor AND o.year = y.year)", "ord")
def _(det):
    due = det.select("sensor").distinct().crossJoin(F.broadcast(det.select("year").distinct()))  # sensors and years: tens of rows
    loads = due.join(det.groupBy("sensor", "year").agg(F.count("*").alias("n_rows")), ["sensor", "year"], "left").withColumn("expected", F.lit(True))
    return quality.nothing_found(loads).select("sensor", "year")


@register("q10_counted_twice", f"SELECT * FROM (SELECT SUM(CASE WHEN acq_datetime < {SPLIT} THEN 1 ELSE 0 END)::BIGINT + SUM(CASE WHEN acq_datetime >= {WINDOW} THEN 1 ELSE 0 END)::BIGINT AS n_rows, COUNT(*) AS want FROM det) WHERE n_rows <> want", "det")
def _(det):
    archive, live = det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {WINDOW}")
    naive = archive.unionByName(live).agg(F.count("*").alias("n_rows"))  # the overlap counts twice; the collection's own profile passes
    sound = profile.collection_profile(archive, live)
    return quality.counted_twice(naive, archive, live, ("det_id",)).unionByName(quality.counted_twice(sound, archive, live, ("det_id",)))


@register("q3_duplicates", "SELECT user_id, event_type, CAST(ts AS DATE) AS day, COUNT(*) AS copies FROM events GROUP BY 1, 2, 3 HAVING COUNT(*) > 1")
def _(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.to_date("ts"))
    return quality.duplicates(e, ("user_id", "event_type", "day"))


@register("q4_uncovered", HOLES.replace(f"WHERE NOT ({HOLE}) AND", "WHERE") + " SELECT CAST(p AS TIMESTAMP) AS start, CAST(t AS TIMESTAMP) AS \"end\" FROM g WHERE t > p + INTERVAL 30 MINUTE", "det")
def _(det):
    return quality.uncovered(det, F.expr(f"cast({LO} as timestamp_ntz)"), F.expr(f"cast({HI} as timestamp_ntz)"), "30 minutes")


@register("q6_running_ends", f"AS_CTE {MONTH_CELLS} SELECT cell, CAST(SUM(cnt) - 1 AS BIGINT) AS got, CAST(SUM(cnt) AS BIGINT) AS want FROM c WHERE cell % 5 = 0 GROUP BY cell", "ord")
def _(det):
    c = month_cells(det)
    spoiled = timeseq.running(c).withColumn("running", F.col("running") - F.when(F.col("cell") % 5 == 0, 1).otherwise(0))
    return quality.running_differs(spoiled, c)


@register("q7_breaks_rise", LADDERS + ", l2 AS (" + " UNION ALL ".join(f"SELECT year, metric, {i} AS i, CASE WHEN year = 1996 THEN -b{i} ELSE b{i} END AS b FROM b" for i in range(len(classify.QUANTILES))) + "), w AS (SELECT *, LAG(b) OVER (PARTITION BY year, metric ORDER BY i) AS p FROM l2) SELECT year, metric, i, ROUND(b, 4) AS b, ROUND(p, 4) AS p FROM w WHERE b <= p", "ord")
def _(det):
    c = cells.base_cells(det, plain_cell(F.col("lon_c"), F.col("lat_c"), 500), F.lit("all"), ("year",))
    ladders = classify.breaks(c, ["cnt", "max_frp"], ["year"])
    spoiled = ladders.withColumn("breaks", F.when(F.col("year") == 1996, F.transform("breaks", lambda b: -b)).otherwise(F.col("breaks")))
    return quality.breaks_fall(spoiled, ["year"]).select("year", "metric", "i", F.round("b", 4).alias("b"), F.round("p", 4).alias("p"))


@register("q11_null_pattern", "SELECT sensor, quality, COUNT(*) AS cnt, SUM(CASE WHEN type IS NULL THEN 1 ELSE 0 END)::BIGINT AS type_null, SUM(CASE WHEN confidence_pct IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS pct_set FROM det GROUP BY 1, 2", "det")
def _(det):
    return quality.null_pattern(det)


@register("q11_null_violations", "AS_CTE v AS (SELECT sensor, quality, 'type' AS rule, (quality = 'nrt') <> (type IS NULL) AS bad FROM (SELECT *, CASE WHEN det_id % 11 = 0 THEN 0 ELSE type END AS t2 FROM det) UNION ALL SELECT sensor, quality, 'type', (quality = 'nrt') <> (t2 IS NULL) FROM (SELECT *, CASE WHEN det_id % 11 = 0 THEN 0 ELSE type END AS t2 FROM det) UNION ALL SELECT sensor, quality, 'confidence_pct', confidence_pct IS NOT NULL AND instrument <> 'MODIS' FROM det) SELECT sensor, quality, rule, COUNT(*) AS cnt FROM v WHERE bad GROUP BY 1, 2, 3", "det")
def _(det):
    spoiled = det.withColumn("type", F.when(F.col("det_id") % 11 == 0, 0).otherwise(F.col("type")))
    both = quality.null_violations(det).unionByName(quality.null_violations(spoiled))
    return both.filter("rule <> 'confidence_pct'").groupBy("sensor", "quality", "rule").agg(F.sum("cnt").alias("cnt"))


# ---- feeds ----------------------------------------------------------------------------------------------------------

#: Events as a feed publishes them: all text, odd spaces and cases, missing coordinates, words or numbers of confidence.
RAW = """SELECT CAST(event_id AS STRING) AS row_id, CASE WHEN event_id % 50 = 7 THEN '' ELSE CAST(lat AS STRING) END AS latitude, CASE WHEN event_id % 60 = 9 THEN NULL ELSE CAST(lon AS STRING) END AS longitude,
  CAST(acq_date AS STRING) AS acq_date, CAST(hour(acq_datetime) * 100 + minute(acq_datetime) AS STRING) AS acq_time,
  CASE event_id % 8 WHEN 0 THEN ' n20' WHEN 1 THEN 'N' WHEN 2 THEN '2' WHEN 3 THEN 'terra ' WHEN 4 THEN 'A' WHEN 5 THEN ' Foo ' WHEN 6 THEN 'NPP' ELSE '1' END AS satellite,
  CASE event_id % 6 WHEN 0 THEN ' Nominal' WHEN 1 THEN 'low' WHEN 2 THEN 'HIGH' WHEN 3 THEN '85.5' WHEN 4 THEN ' 40 ' ELSE '' END AS confidence,
  CASE WHEN event_id % 9 = 0 THEN ' ' ELSE CAST(frp AS STRING) END AS frp, daynight FROM (SELECT *, det_id AS event_id FROM {det})"""


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW.replace("FROM {det}", "FROM {src}"), src=detections(spark, sf_dir))


RAW_SQL = RAW.replace("FROM {det}", "FROM det")
_PLATFORM = "CASE upper(trim(satellite)) WHEN 'T' THEN 'Terra' WHEN 'TERRA' THEN 'Terra' WHEN 'A' THEN 'Aqua' WHEN 'AQUA' THEN 'Aqua' WHEN 'N' THEN 'Suomi-NPP' WHEN 'N20' THEN 'NOAA-20' WHEN '1' THEN 'NOAA-20' WHEN 'N21' THEN 'NOAA-21' WHEN '2' THEN 'NOAA-21' ELSE trim(satellite) END"
_CONFIDENCE = "CASE lower(trim(confidence)) WHEN 'low' THEN 'l' WHEN 'nominal' THEN 'n' WHEN 'high' THEN 'h' ELSE trim(confidence) END"
_PLACED = "latitude <> '' AND longitude IS NOT NULL"


def feed(name: str, sql: str):
    return register(name, f"AS_CTE raw AS ({RAW_SQL}) {sql}", "det", raw=True)


@feed("p1_observed_at", "SELECT row_id, strftime(CAST(acq_date AS DATE) + INTERVAL (CAST(acq_time AS INT) // 100) HOUR + INTERVAL (CAST(acq_time AS INT) % 100) MINUTE, '%Y-%m-%d %H:%M') AS t FROM raw")
def _(spark, sf_dir):
    return raw_feed(spark, sf_dir).select("row_id", F.date_format(fields.observed_at(F.col("acq_date"), F.col("acq_time")), "yyyy-MM-dd HH:mm").alias("t"))


@feed("p2_platform", f"SELECT row_id, {_PLATFORM} AS platform FROM raw")
def _(spark, sf_dir):
    return raw_feed(spark, sf_dir).select("row_id", fields.platform(F.col("satellite")).alias("platform"))


@feed("p3_confidence", f"SELECT row_id, {_CONFIDENCE} AS confidence FROM raw")
def _(spark, sf_dir):
    return raw_feed(spark, sf_dir).select("row_id", fields.confidence(F.col("confidence")).alias("confidence"))


@feed("p4_confidence_pct", "SELECT row_id, CAST(round(TRY_CAST(trim(confidence) AS DOUBLE)) AS INT) AS pct FROM raw")
def _(spark, sf_dir):
    return raw_feed(spark, sf_dir).select("row_id", fields.confidence_pct(F.col("confidence")).alias("pct"))


@feed("p5_typed", "SELECT row_id, CAST(nullif(trim(frp), '') AS DOUBLE) AS frp FROM raw")
def _(spark, sf_dir):
    return raw_feed(spark, sf_dir).select("row_id", fields.typed(F.col("frp"), "double").alias("frp"))


@feed("p7_coordinates", f"SELECT row_id FROM raw WHERE {_PLACED}")
def _(spark, sf_dir):
    raw = raw_feed(spark, sf_dir)
    placed = normalize.normalize(raw.withColumn("version", F.col("row_id")), "VIIRS_SNPP_SP")
    return placed.select(F.col("version").alias("row_id"))


@feed("s1_normalize", f"SELECT CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon, {_PLATFORM} AS satellite, nullif({_CONFIDENCE}, '') AS confidence, 'MODIS' AS sensor, 'sp' AS quality, 'MODIS' AS instrument, CAST(nullif(trim(frp), '') AS DOUBLE) AS frp, CAST(NULL AS DOUBLE) AS bright_ti4, CAST(NULL AS INT) AS type FROM raw WHERE {_PLACED}")
def _(spark, sf_dir):
    return normalize.normalize(raw_feed(spark, sf_dir), "MODIS_SP").select("lat", "lon", "satellite", "confidence", "sensor", "quality", "instrument", "frp", "bright_ti4", "type")


#: What the publishers' feeds hold, written down apart from the library's own table of them.
_FEEDS = "('MODIS_SP', 'MODIS', 'sp', 'MODIS'), ('MODIS_NRT', 'MODIS', 'nrt', 'MODIS'), ('VIIRS_SNPP_SP', 'VIIRS_SNPP', 'sp', 'VIIRS'), ('VIIRS_SNPP_NRT', 'VIIRS_SNPP', 'nrt', 'VIIRS'), ('VIIRS_NOAA20_SP', 'VIIRS_NOAA20', 'sp', 'VIIRS'), ('VIIRS_NOAA20_NRT', 'VIIRS_NOAA20', 'nrt', 'VIIRS'), ('VIIRS_NOAA21_NRT', 'VIIRS_NOAA21', 'nrt', 'VIIRS')"


@register("p6_source_map", f"SELECT id, sensor, quality, instrument, (SELECT COUNT(*) FROM det d WHERE d.sensor = t.sensor AND d.quality = t.quality AND d.instrument = t.instrument) AS cnt FROM (VALUES {_FEEDS}) AS t(id, sensor, quality, instrument)", "det")
def _(det):
    per = det.groupBy("sensor", "quality", "instrument").agg(F.count("*").alias("cnt"))
    feeds = det.sparkSession.createDataFrame([(k, *v) for k, v in FEEDS.items()], "id string, sensor string, quality string, instrument string")
    return feeds.join(per, ["sensor", "quality", "instrument"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))


@feed("s2_bulk_feed", "SELECT instrument, quality, COUNT(*) AS cnt, COUNT(type) AS typed FROM (SELECT 'VIIRS' AS instrument, 'nrt' AS quality, CAST(NULL AS INT) AS type FROM raw WHERE " + _PLACED + ") GROUP BY 1, 2")
def _(spark, sf_dir):
    return normalize.normalize(raw_feed(spark, sf_dir), "VIIRS_NOAA21_NRT").groupBy("instrument", "quality").agg(F.count("*").alias("cnt"), F.count("type").alias("typed"))


# ---- the store ------------------------------------------------------------------------------------------------------


def chunk_folder(spark: SparkSession, sf_dir: str) -> str:
    """The detections as dated chunks by month, with columns that differ and a stray year."""
    root = store.scratch(spark)
    det = yearly(spark, sf_dir).select("det_id", "acq_datetime", "acq_date", "sensor", "lon_c", "lat_c", "frp", "year")
    det.filter("year < 1998").drop("year", "frp").write.parquet(f"{root}/early")
    det.filter("year >= 1998").write.parquet(f"{root}/late")
    return root


@register("s3_read_parts", "SELECT det_id, sensor, CASE WHEN year >= 1998 THEN frp END AS frp FROM ord", "ord", raw=True)
def _(spark, sf_dir):
    root = chunk_folder(spark, sf_dir)
    parts = store.read_parts(spark, [f"{root}/early", f"{root}/late"])
    assert "year" not in parts.columns
    return parts.select("det_id", "sensor", "frp")


@register("s4_read_chunks", "SELECT det_id, sensor FROM ord WHERE year = 1998", "ord", raw=True)
def _(spark, sf_dir):
    return store.read_chunks(spark, chunk_folder(spark, sf_dir), 1998).select("det_id", "sensor")


@register("s4_candidates", "AS_CTE n AS (SELECT DISTINCT month_key, CASE WHEN CAST(month_key AS INT) % 5 = 0 THEN 'bulk_' || month_key || '.parquet' ELSE substr(month_key, 1, 4) || '-' || substr(month_key, 5, 2) || '-01.parquet' END AS name FROM ord) SELECT name FROM n WHERE name LIKE 'bulk%' OR name LIKE '1998-%' OR name LIKE '1997-12-%'", "ord")
def _(det):
    m = F.col("month_key")
    name = F.when(m.cast("int") % 5 == 0, F.concat(F.lit("bulk_"), m, F.lit(".parquet"))).otherwise(F.concat(F.substring(m, 1, 4), F.lit("-"), F.substring(m, 5, 2), F.lit("-01.parquet")))
    return store.candidates(det.select(m).distinct().select(name.alias("name")), 1998)


def stored(spark: SparkSession, sf_dir: str) -> str:
    """A store with an archive and, beside it, a live window of the same rows."""
    root = store.scratch(spark)
    det = yearly(spark, sf_dir).withColumns({"lon": F.col("lon_c") / 100, "lat": F.col("lat_c") / 100}).drop("year")
    store.write_detections(det, f"{root}/detections")
    store.write_detections(det.filter("acq_date >= DATE '2001-01-01'"), f"{root}/detections_live")
    return root


@register("s5_named_part", "SELECT det_id, sensor FROM ord WHERE year IN (1996, 2001)", "ord", raw=True)
def _(spark, sf_dir):
    return store.read_part(spark, stored(spark, sf_dir), "detections", [1996, 2001]).select("det_id", "sensor")


@register("s6_written", "SELECT year, COUNT(*) AS cnt, ROUND(SUM(CAST(frp AS DECIMAL(18,2))), 2)::DOUBLE AS frp FROM ord GROUP BY year", "ord", raw=True)
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{stored(spark, sf_dir)}/detections")
    return rows.groupBy("year").agg(F.count("*").alias("cnt"), money("frp").alias("frp"))


@register("s8_staged_swap", "SELECT year, COUNT(*) AS cnt FROM ord WHERE year <> 1999 OR sensor <> 'MODIS' GROUP BY year", "ord", raw=True)
def _(spark, sf_dir):
    path = f"{store.scratch(spark)}/detections"
    det = yearly(spark, sf_dir).withColumns({"lon": F.col("lon_c") / 100, "lat": F.col("lat_c") / 100})
    gates = [lambda df: quality.duplicates(df, ("det_id",))]
    store.staged_swap(det, path, det.count(), gates)
    fresh = versions.read(spark, path, ["1999"]).filter("sensor <> 'MODIS'")
    store.staged_swap(fresh, path, fresh.count(), gates)
    return versions.read(spark, path).groupBy("year").agg(F.count("*").alias("cnt"))


@register("p16_by_place", f"SELECT det_id, day_key FROM det WHERE {IN_VIEW}", "det", raw=True)
def _(spark, sf_dir):
    """The view of a13, read from the store by ranges of the curve."""
    path = f"{store.scratch(spark)}/detections"
    store.write_detections(detections(spark, sf_dir), path)
    return store.by_place(spark.read.parquet(path), VIEW).select("det_id", "day_key")


@register("s9_sidecar", f"AS_CTE c AS (SELECT month_key AS bucket, CASE WHEN year BETWEEN 1999 AND 2001 THEN '1999-2001' WHEN year BETWEEN 1995 AND 1998 THEN '1995-1998' END AS era FROM ord) SELECT era, MIN(bucket) AS min_bucket, MAX(bucket) AS max_bucket, COUNT(DISTINCT bucket) AS buckets, (SELECT COUNT(*) FROM (SELECT DISTINCT {_AXIS.format(u='(lon_c / 100.0 + 180) / 360', n=128)}, {_AXIS.format(u='(sin(radians(lat_c / 100.0)) + 1) / 2', n=64)} FROM ord)) AS bounds FROM c WHERE era IS NOT NULL GROUP BY era", "ord", raw=True)
def _(spark, sf_dir):
    root = store.scratch(spark)
    det = yearly(spark, sf_dir)
    long = cells.base_cells(det, cell(F.col("lon_c") / 100, F.col("lat_c") / 100, 6), F.col("month_key"), ())
    manifest = store.write_sidecar(long.select("cell", "bucket", "cnt"), root, 6, ((1999, 2001), (1995, 1998)))
    n = spark.read.parquet(f"{root}/bounds").agg(F.count("*").alias("bounds"))
    return manifest.crossJoin(F.broadcast(n))


@register("s9_sidecar_levels", " UNION ALL ".join(f"SELECT {k} AS level, '2022-2026' AS era, MIN(day_key) AS min_bucket, MAX(day_key) AS max_bucket, COUNT(DISTINCT day_key) AS buckets, (SELECT COUNT(*) FROM (SELECT DISTINCT {_AXIS.format(u='(lon + 180) / 360', n=2 << k)}, {_AXIS.format(u='(sin(radians(lat)) + 1) / 2', n=1 << k)} FROM det)) AS bounds, COUNT(*) AS cnt FROM det" for k in (3, 5, 7)), "det", raw=True)
def _(spark, sf_dir):
    """Daily cells at three levels."""
    root, det = store.scratch(spark), detections(spark, sf_dir)
    day = cells.base_cells(det, cell(F.col("lon"), F.col("lat"), 7), F.col("day_key"), ())
    manifest = store.write_sidecars(day.select("cell", "bucket", "cnt"), root, 7, (3, 5, 7))
    of = lambda name, what: reduce(DataFrame.union, [spark.read.parquet(f"{root}/level-{k}/{name}").agg(what).select(F.lit(k).alias("level"), "*") for k in (3, 5, 7)])
    return manifest.join(of("bounds", F.count("*").alias("bounds")), "level").join(of("counts", F.sum("cnt").alias("cnt")), "level")


@register("s10_drop_matching", "SELECT det_id, sensor, frp FROM det", "det")
def _(det):
    return store.drop_matching(det.select("det_id", "sensor", "frp", "lon_c", "lat_c", F.lit(1).alias("count_c202401")), "_c$|^count_c")


# ---- streams read as a whole -----------------------------------------------------------------------------------------


def as_stream(spark: SparkSession, batches: list[DataFrame], run: Callable[[DataFrame], None]) -> None:
    """Let a stream run once for each batch of arriving rows, from where the run before ended."""
    path = f"{store.scratch(spark)}/in"
    for rows in batches:
        rows.withColumn("acq_datetime", F.col("acq_datetime").cast("timestamp")).write.mode("append").parquet(path)
        run(jobs.table_stream(spark, path))


def with_late(det: DataFrame) -> list[DataFrame]:
    """Rows up to the middle of the 24th; then the others, and the first days once more, too late to count."""
    return [det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {SPLIT} or acq_datetime < TIMESTAMP '2024-01-06 00:00:00'")]


@feed("x1_ingest", f"SELECT CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon, {_PLATFORM} AS satellite, nullif({_CONFIDENCE}, '') AS confidence, 'VIIRS_NOAA21' AS sensor, 'nrt' AS quality, CAST(nullif(trim(frp), '') AS DOUBLE) AS frp, strftime(CAST(acq_date AS DATE) + INTERVAL (CAST(acq_time AS INT) // 100) HOUR + INTERVAL (CAST(acq_time AS INT) % 100) MINUTE, '%Y-%m-%d %H:%M') AS t FROM raw WHERE {_PLACED}")
def _(spark, sf_dir):
    """Two deliveries of a CSV feed."""
    root, raw = store.scratch(spark), raw_feed(spark, sf_dir)
    for late in (False, True):
        raw.filter((F.col("acq_date") >= "2024-01-24") == late).write.mode("append").option("header", True).csv(f"{root}/in")
        jobs.append_to(jobs.ingest(spark, f"{root}/in", "VIIRS_NOAA21_NRT", raw.schema), f"{root}/out", f"{root}/checkpoint")
    rows = spark.read.parquet(f"{root}/out")
    return rows.select("lat", "lon", "satellite", "confidence", "sensor", "quality", "frp", F.date_format("acq_datetime", "yyyy-MM-dd HH:mm").alias("t"))


@register("x2_rolling_windows", "SELECT CAST(w AS TIMESTAMP) AS start, COUNT(*) AS cnt FROM (SELECT unnest(generate_series(CAST(acq_date AS TIMESTAMP) - INTERVAL 6 DAY, CAST(acq_date AS TIMESTAMP), INTERVAL 1 DAY)) AS w FROM det) GROUP BY 1", "det", raw=True)
def _(spark, sf_dir):
    root = store.scratch(spark)
    each = jobs.keep_latest(f"{root}/kept", ("start", "end"), F.date_format("start", "yyyyMMdd"))
    as_stream(spark, with_late(detections(spark, sf_dir)), lambda s: jobs.fold_into(jobs.rolling(s), each, f"{root}/checkpoint", "update"))
    return versions.read(spark, f"{root}/kept").select(F.col("start").cast("timestamp_ntz").alias("start"), "cnt")


@register("x3_daily_counts", "SELECT CAST(CAST(acq_date AS TIMESTAMP) AS TIMESTAMP) AS day, sensor, COUNT(*) AS cnt FROM det GROUP BY 1, 2", "det", raw=True)
def _(spark, sf_dir):
    root = store.scratch(spark)
    each = jobs.keep_latest(f"{root}/kept", ("day", "sensor"), F.date_format("day", "yyyyMMdd"))
    as_stream(spark, with_late(detections(spark, sf_dir)), lambda s: jobs.fold_into(jobs.live_counts(s), each, f"{root}/checkpoint", "update"))
    return versions.read(spark, f"{root}/kept").select(F.col("day").cast("timestamp_ntz").alias("day"), "sensor", "cnt")


@feed("x1_hourly_refresh", f"SELECT strftime(CAST(acq_date AS DATE), '%Y%m%d') AS bucket, COUNT(*) AS cnt, COUNT(DISTINCT {_AXIS.format(u='(CAST(longitude AS DOUBLE) + 180) / 360', n=128)} * 1000 + {_AXIS.format(u='(sin(radians(CAST(latitude AS DOUBLE))) + 1) / 2', n=64)}) AS cells FROM raw WHERE {_PLACED} GROUP BY 1")
def _(spark, sf_dir):
    """Three deliveries of a CSV feed, each with some of the days before once more, from text to cells."""
    root, raw = store.scratch(spark), raw_feed(spark, sf_dir)
    for first, last in (("2024-01-01", "2024-01-15"), ("2024-01-12", "2024-01-24"), ("2024-01-20", "2024-02-01")):
        raw.filter(F.col("acq_date").between(first, last)).write.mode("append").option("header", True).csv(f"{root}/in")
        arrived = jobs.ingest(spark, f"{root}/in", "VIIRS_NOAA21_NRT", raw.schema)
        jobs.refresh(arrived, root, cell(F.col("lon"), F.col("lat"), 6), 2024, f"{root}/checkpoint")
    return versions.read(spark, f"{root}/cells_day").groupBy("bucket").agg(F.sum("cnt").cast("long").alias("cnt"), F.countDistinct("cell").alias("cells"))


def folded(spark: SparkSession, batches: list[DataFrame]) -> str:
    """The root of a store whose detections, kept by day, have taken in the batches as a stream."""
    root = store.scratch(spark)
    each = jobs.apply_window(f"{root}/detections", 2024)
    as_stream(spark, batches, lambda s: jobs.fold_into(s, each, f"{root}/checkpoint"))
    return root


@register("x4_late_science", "SELECT det_id, quality FROM det d WHERE quality = 'sp' OR NOT EXISTS (SELECT 1 FROM det s WHERE s.sensor = d.sensor AND s.acq_date = d.acq_date AND s.quality = 'sp')", "det", raw=True)
def _(spark, sf_dir):
    """Near-real-time rows first; then their tail again, and the science rows of all days."""
    det = detections(spark, sf_dir)
    nrt = det.filter("quality = 'nrt'")
    root = folded(spark, [nrt.filter("acq_date < DATE '2024-01-28'"), nrt.filter("acq_date >= DATE '2024-01-25'").unionByName(det.filter("quality = 'sp'"))])
    return versions.read(spark, f"{root}/detections").select("det_id", "quality")


#: An archive up to the 26th, and a window from the 20th on that lacks two days.
FOLDS = ("acq_date < DATE '2024-01-27'", "acq_date >= DATE '2024-01-20' AND acq_date NOT IN (DATE '2024-01-22', DATE '2024-01-23')")


def two_folds(spark: SparkSession, sf_dir: str) -> str:
    det = detections(spark, sf_dir).withColumn("quality", F.lit("nrt"))
    return folded(spark, [det.filter(f) for f in FOLDS])


@register("x5_fold", "SELECT det_id, acq_date FROM det WHERE acq_date NOT IN (DATE '2024-01-22', DATE '2024-01-23')", "det", raw=True)
def _(spark, sf_dir):
    return versions.read(spark, f"{two_folds(spark, sf_dir)}/detections").select("det_id", "acq_date")


def kept_up(spark: SparkSession, sf_dir: str) -> str:
    """Cells kept up to date over three folds: after the archive, after a window that lacks two days, and after one that brings them back."""
    root = store.scratch(spark)
    each = jobs.apply_window(f"{root}/detections", 2024)
    det, c = detections(spark, sf_dir).withColumn("quality", F.lit("nrt")), plain_cell(F.col("lon_c"), F.col("lat_c"), 500)

    def run(s: DataFrame) -> None:
        jobs.fold_into(s, each, f"{root}/checkpoint")
        store.kept_cells(spark, root, c)

    as_stream(spark, [det.filter("acq_date < DATE '2024-01-24'"), det.filter(f"{FOLDS[1]} AND acq_date < DATE '2024-01-28'"), det.filter("acq_date >= DATE '2024-01-21'")], run)
    return root


@register("a2_kept_cells", f"SELECT {CELL.format(s=500)} AS cell, day_key AS bucket, COUNT(*) AS cnt FROM det GROUP BY 1, 2", "det", raw=True)
def _(spark, sf_dir):
    return versions.read(spark, f"{kept_up(spark, sf_dir)}/cells_day").select("cell", "bucket", "cnt")


@register("a5_kept_months", f"SELECT {CELL.format(s=500)} AS cell, substr(day_key, 1, 6) AS bucket, COUNT(*) AS cnt, {MONEY.format(c='frp')} AS sum_frp FROM det GROUP BY 1, 2", "det", raw=True)
def _(spark, sf_dir):
    return versions.read(spark, f"{kept_up(spark, sf_dir)}/cells_month").select("cell", "bucket", "cnt", F.col("sum_frp").cast("double").alias("sum_frp"))


@register("w7_block_range_sum", f"SELECT {CELL.format(s=1000)} AS cell, COUNT(*) AS cnt FROM ord WHERE acq_date BETWEEN DATE '1997-05-12' AND DATE '1998-08-09' GROUP BY 1", "ord", raw=True)
def _(spark, sf_dir):
    """Days of seven years in blocks of months."""
    day = cells.base_cells(yearly(spark, sf_dir), plain_cell(F.col("lon_c"), F.col("lat_c"), 1000), F.date_format("acq_date", "yyyyMMdd"), ())
    root = store.scratch(spark)
    timeseq.running_blocks(day, F.substring("bucket", 1, 6)).write.partitionBy("block").parquet(f"{root}/running")
    blocks = spark.read.schema("cell long, bucket string, running long, block string").parquet(f"{root}/running")
    return timeseq.block_range_sum(blocks, timeseq.block_totals(blocks), "19970512", "19980809", lambda k: k[:6]).filter("cnt > 0")


@register("x6_stall", f"AS_CTE t AS (SELECT DISTINCT acq_datetime AS t FROM det WHERE acq_datetime < {SPLIT} AND acq_datetime > {LO}), e AS (SELECT MAX(t) AS start, TIMESTAMP '2024-01-26 18:00:00' AS \"end\" FROM t) SELECT * FROM e UNION ALL SELECT p, t FROM (SELECT LAG(t) OVER (ORDER BY t) AS p, t FROM (SELECT t FROM t UNION SELECT {LO})) WHERE t > p + INTERVAL 3 HOUR", "det")
def _(det):
    ntz = lambda text: F.expr(f"cast({text} as timestamp_ntz)")
    return jobs.stall_alarm(det.filter(f"acq_datetime < {SPLIT}"), ntz(LO), ntz("TIMESTAMP '2024-01-27 00:00:00'"))


@register("x7_without_repeats", "SELECT sensor, acq_datetime, lon, lat FROM det GROUP BY 1, 2, 3, 4", "det", raw=True)
def _(spark, sf_dir):
    """The second delivery brings the last day and a half of the first one again, within the watermark."""
    root, det = store.scratch(spark), detections(spark, sf_dir)
    again = [det.filter(f"acq_datetime < {SPLIT}"), det.filter(f"acq_datetime >= {WINDOW}")]
    as_stream(spark, again, lambda s: jobs.append_to(jobs.without_repeats(s, "2 days"), f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").select("sensor", F.col("acq_datetime").cast("timestamp_ntz").alias("acq_datetime"), "lon", "lat")


@register("x8_alerts", "SELECT det_id, 'east' AS region FROM det WHERE lon > 10.005 AND lon < 60.005 AND lat > -20.005 AND lat < 30.005 AND frp >= 100", "det")
def _(det):
    ring = "array(" + ", ".join(f"named_struct('x', {x}D, 'y', {y}D)" for x, y in ((10.005, -20.005), (60.005, -20.005), (60.005, 30.005), (10.005, 30.005))) + ")"
    regions = det.sparkSession.sql(f"SELECT 'east' AS region, {ring} AS ring")
    return jobs.alerts(det, regions, 100.0).select("det_id", "region")
