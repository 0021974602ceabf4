"""Gates: each returns the violations; an empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.schema import DETECTIONS, NATURAL_KEY
from .timeseq import holes


def totals_differ(det: DataFrame, levels: DataFrame) -> DataFrame:
    """Levels of cells (level, cnt) whose counts do not add up to the detections."""
    n = det.agg(F.count("*").alias("want"))
    return levels.groupBy("level").agg(F.sum("cnt").cast("long").alias("got")).crossJoin(F.broadcast(n)).filter("got <> want")


def rows_differ(rebuilt: DataFrame, kept: DataFrame, added: DataFrame) -> DataFrame:
    """The three counts, in one job, where they do not add up."""
    parts = [df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("of"), "n") for df, name in ((rebuilt, "got"), (kept, "kept"), (added, "added"))]
    n = lambda name: F.max(F.when(F.col("of") == name, F.col("n"))).alias(name)
    return parts[0].union(parts[1]).union(parts[2]).agg(n("got"), n("kept"), n("added")).filter("got <> kept + added")


def duplicates(det: DataFrame, key: tuple[str, ...] = NATURAL_KEY) -> DataFrame:
    return det.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def uncovered(det: DataFrame, lo, hi, max_gap: str = "3 hours") -> DataFrame:
    return holes(det, max_gap, lo=lo, hi=hi)


def axis_differs(declared: DataFrame, cells: DataFrame) -> DataFrame:
    """Buckets present outside the declared (min_key, max_key) extent, and ends that are declared and absent."""
    have = cells.select("bucket").distinct()
    ends = declared.select(F.explode(F.array("min_key", "max_key")).alias("bucket")).distinct()
    d = F.broadcast(declared.select("min_key", "max_key"))
    outside = have.join(d, ~F.col("bucket").between(F.col("min_key"), F.col("max_key"))).select("bucket", F.lit("undeclared").alias("problem"))
    return outside.unionByName(ends.join(have, "bucket", "left_anti").select("bucket", F.lit("absent").alias("problem")))


def running_differs(running: DataFrame, cells: DataFrame) -> DataFrame:
    last = running.groupBy("cell").agg(F.max_by("running", "bucket").alias("got"))
    return last.join(cells.groupBy("cell").agg(F.sum("cnt").alias("want")), "cell", "full_outer").filter("not (got <=> want)")


def breaks_fall(breaks: DataFrame, by: list[str]) -> DataFrame:
    each = breaks.select(*by, "metric", F.posexplode("breaks").alias("i", "b"))
    w = Window.partitionBy(*by, "metric").orderBy("i")
    return each.withColumn("p", F.lag("b").over(w)).filter("b <= p")


def schema_differs(det: DataFrame, want: StructType = DETECTIONS) -> DataFrame:
    """Columns that are absent, of another type, or not in the schema: name, want, have. Nothing is read for it."""
    wanted, have = ({f.name: f.dataType.simpleString() for f in s} for s in (want, det.schema))
    rows = sorted((k, wanted.get(k), have.get(k)) for k in wanted.keys() | have.keys() if wanted.get(k) != have.get(k))
    return det.sparkSession.createDataFrame(rows, "name string, want string, have string")


def values_at_risk(det: DataFrame, want: StructType = DETECTIONS) -> DataFrame:
    """schema_differs(), with how many rows have a value in the columns that differ: what a cast or a drop would touch, from one scan of these columns."""
    differs = schema_differs(det, want)
    names = [r["name"] for r in differs.select("name").collect() if r["name"] in det.columns]  # columns of a schema
    filled = det.agg(F.array(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("filled")) for c in names]).alias("x")).select(F.inline("x")) if names else differs.select("name", F.lit(0).cast("long").alias("filled")).limit(0)
    return differs.join(filled, "name", "left")


def nothing_written(written: int, expected: bool) -> None:
    """Raises if rows were expected and none were written; written is what write_detections() counted on the way."""
    if expected and not written:
        raise ValueError("rows were expected and none were written")


def nothing_found(loads: DataFrame) -> DataFrame:
    """Of loads (expected, n_rows): those that expected rows and brought none."""
    return loads.filter(F.col("expected") & (F.coalesce("n_rows", F.lit(0)) == 0))


def counted_twice(profile: DataFrame, archive: DataFrame, live: DataFrame, key: tuple[str, ...]) -> DataFrame:
    want = archive.select(*key).unionByName(live.select(*key)).distinct().agg(F.count("*").alias("want"))
    return profile.select("n_rows").crossJoin(want).filter("n_rows <> want")


def null_pattern(det: DataFrame) -> DataFrame:
    """Per sensor and quality: rows, rows without a type, rows with a numeric confidence."""
    return det.groupBy("sensor", "quality").agg(F.count("*").alias("cnt"), F.count_if(F.col("type").isNull()).alias("type_null"), F.count_if(F.col("confidence_pct").isNotNull()).alias("pct_set"))


#: Which columns only one family of instruments has.
ONLY_OF = {"MODIS": ("brightness", "bright_t31", "confidence_pct"), "VIIRS": ("bright_ti4", "bright_ti5")}


def rules_of(columns: list[str]) -> dict[str, Column]:
    """What no row may be, by rule: each is true where a row breaks it. Rules on columns that are not there are left out."""
    rules = {"type": (F.col("quality") == "nrt") != F.col("type").isNull()}
    for family, names in ONLY_OF.items():
        rules |= {c: F.col(c).isNotNull() & (F.col("instrument") != family) for c in names}
    rules |= {
        "lon": F.col("lon").isNull() | ~F.col("lon").between(-180, 180), "lat": F.col("lat").isNull() | ~F.col("lat").between(-90, 90),
        "acq_date": ~F.to_date("acq_datetime").eqNullSafe(F.col("acq_date")), "frp": F.col("frp") < 0, "daynight": ~F.coalesce(F.col("daynight").isin("D", "N"), F.lit(True)),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items() if k in columns}


def row_gates(det: DataFrame, by: tuple[str, ...] = ("sensor", "quality")) -> DataFrame:
    """All gates that look at rows one by one, in one scan: by the given columns and rule, how many rows break it; the rule 'rows' counts all."""
    rules = rules_of(det.columns)
    counted = det.groupBy(*by).agg(F.count("*").alias("__rows"), *[F.count_if(v).alias(f"__{k}") for k, v in rules.items()])
    each = F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"__{k}").alias("cnt")) for k in ("rows", *rules)])
    return counted.select(*by, F.explode(each).alias("x")).select(*by, "x.*").filter("cnt > 0")


def observed(det: DataFrame) -> tuple[DataFrame, Observation]:
    """det, and what row_gates() counts over all its rows, counted while they are written or read for another reason: no scan of its own."""
    seen = Observation()
    return det.observe(seen, F.count("*").alias("rows"), *[F.count_if(v).alias(k) for k, v in rules_of(det.columns).items()]), seen


def null_violations(det: DataFrame) -> DataFrame:
    """Per sensor, quality and rule how many rows break it: near-real-time rows have no type, others have one; columns of one family are null in the other."""
    return row_gates(det.drop("lon", "lat", "acq_date", "frp", "daynight")).filter("rule <> 'rows'")
