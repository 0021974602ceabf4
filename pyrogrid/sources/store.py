"""The store: one Parquet partition a year, in spatial order; chunks, load plans, staged replacement."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import View, bounds, hilbert_cover, in_view, parent, with_hilbert
from ..operators.cells import again, base_cells
from ..operators.timeseq import block_totals, running_blocks
from . import versions

ROWS_PER_GROUP = 100_000
#: Rows of one file of the store, roughly: some 100 MB.
ROWS_PER_FILE = 5_000_000
ERAS = ((2022, 2026), (2015, 2021), (2008, 2014), (2000, 2007))
#: The place on the curve, kept in the store for reads by place.
PLACE = "place"
#: The tables of a store, side by side; none is read by a pattern over the others.
PARTS = ("detections", "detections_live", "cells", "running", "profiles")


def one_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a local folder is a shared one."""
    return spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place that spark.checkpoint.dir names, a local one only where it is unset and the session is one process; it goes with the session's JVM."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not one_process(spark):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.mkdtemp(prefix="pyrogrid-")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared}/store-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def removed(spark: SparkSession, path: str) -> None:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def read_parts(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Chunks of differing schemas, united by name; a stray year column is dropped."""
    frames = [spark.read.option("recursiveFileLookup", True).parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.drop("year") for f in frames])


def may_hold(name: Column, year: int) -> Column:
    """Whether a chunk of a name may hold rows of a year: dated in it, in the December before, or undated."""
    found, month = F.regexp_extract(name, r"(\d{4})-(\d{2})-\d{2}", 1), F.regexp_extract(name, r"(\d{4})-(\d{2})-\d{2}", 2)
    return (found == "") | (found == str(year)) | ((found == str(year - 1)) & (month == "12"))


def candidates(chunks: DataFrame, year: int) -> DataFrame:
    """Of chunk names (name), those that may hold rows of a year."""
    return chunks.filter(may_hold(F.col("name"), year))


def of_year(det: DataFrame, year: int) -> DataFrame:
    """The year is decided by the data, not by a file's name."""
    return det.filter((F.col("acq_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (F.col("acq_date") < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))


def read_chunks(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Rows of a year from a folder of chunks: files are passed over by name before they are opened, rows are chosen by date."""
    chunks = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path)
    return of_year(chunks.filter(may_hold(F.col("_metadata.file_name"), year)), year).drop("year")


def read_part(spark: SparkSession, root: str, part: str, years: Iterable[int] | None = None) -> DataFrame:
    """One named table of a store, of some years; other names, patterns among them, raise."""
    if part not in PARTS:
        raise ValueError(f"{part!r} is none of {PARTS}")
    rows = spark.read.parquet(f"{root}/{part}")
    return rows if years is None else rows.filter(F.col("year").isin(*years))


def in_order(det: DataFrame, files: int) -> DataFrame:
    """Ranges of (year, month, place on the curve), sorted within; the place is kept, and row-group statistics prune by time and place."""
    keyed = with_hilbert(det.withColumn("year", F.year("acq_date")), F.col("lon"), F.col("lat"), PLACE)
    order = ("year", F.month("acq_date"), PLACE)
    return keyed.repartitionByRange(files, *order).sortWithinPartitions(*order)


def by_place(det: DataFrame, view: View, most: int = 32) -> DataFrame:
    """Rows of a store in a view.  The view becomes a few ranges of the curve, which reach the scan and skip row groups; the exact test follows."""
    near = reduce(Column.__or__, [F.col(PLACE).between(lo, hi) for lo, hi in hilbert_cover(view, most)], F.lit(False))
    lon, lat = F.col("lon"), F.col("lat")
    return det.filter(near).filter(in_view(lon, lat, lon, lat, view))


def _writer(df: DataFrame, level: int, rows_per_group: int):
    return (
        df.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)
        .option("parquet.block.row.count.limit", rows_per_group).option("partitionOverwriteMode", "dynamic").partitionBy("year")
    )


def write_detections(det: DataFrame, path: str, level: int = 9, rows_per_group: int = ROWS_PER_GROUP, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write by year in spatial order, in as many files as the rows need; how many rows were written, counted on the way."""
    files = max(1, -(-det.count() // rows_per_file))
    seen = Observation()
    _writer(in_order(det, files).observe(seen, F.count("*").alias("rows")), level, rows_per_group).parquet(path)
    return seen.get["rows"]


def staged_swap(
    det: DataFrame, path: str, expected: int, gates: Iterable[Callable[[DataFrame], DataFrame]] = (), level: int = 9, rows_per_group: int = ROWS_PER_GROUP, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Write beside, check what was written, then replace the years that the rows have in one step; raises before anything is touched.

    Rows are written once, in spatial order and as many files as they need; gates read these files. A refused run leaves nothing behind.
    """
    spark, base = det.sparkSession, versions.manifest(det.sparkSession, path)
    keyed = with_hilbert(det, F.col("lon"), F.col("lat"), PLACE)
    staged = versions.stage(
        keyed, path, F.year("acq_date"), (F.month("acq_date"), PLACE), max(1, -(-expected // rows_per_file)), compression="zstd",
        **{"parquet.compression.codec.zstd.level": level, "parquet.block.row.count.limit": rows_per_group},
    )
    try:
        if staged.rows != expected or not staged.rows:
            raise ValueError(f"{staged.rows} rows staged, {expected} expected")
        done = versions.staged_rows(spark, path, staged)
        for gate in gates:
            if bad := gate(done).take(1):
                raise ValueError(f"refused by {getattr(gate, '__name__', 'a gate')}: {bad[0]}")
        versions.commit(spark, path, base, staged, note=f"swapped: {', '.join(sorted(staged.parts))}")
    except BaseException:
        versions.discard(spark, path, staged)
        raise
    return staged.rows


def plan_windows(avail: DataFrame, days: int = 5) -> DataFrame:
    """Of sources (source_id, lo, hi): windows of at most so many days, the last one truncated: start, n_days."""
    starts = avail.select("source_id", "hi", F.explode(F.expr(f"sequence(lo, hi, interval {int(days)} days)")).alias("start"))
    return starts.select("source_id", F.col("start").cast("date").alias("start"), F.least(F.lit(days), F.datediff("hi", "start") + 1).alias("n_days"))


def plan_slices(avail: DataFrame) -> DataFrame:
    """One load slice per source and year that the source covers."""
    return avail.select("source_id", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))


def todo(plan: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """What is planned and not logged; a load without rows is logged too."""
    return plan.join(log, keys, "left_anti")


def split_by_era(cells: DataFrame, year_col: str = "year", eras: tuple[tuple[int, int], ...] = ERAS) -> DataFrame:
    era = F.lit(None).cast("string")
    for lo, hi in eras:
        era = F.when(F.col(year_col).between(lo, hi), f"{lo}-{hi}").otherwise(era)
    return cells.withColumn("era", era)


def era_manifest(cells: DataFrame) -> DataFrame:
    return cells.groupBy("era").agg(F.min("bucket").alias("min_bucket"), F.max("bucket").alias("max_bucket"), F.countDistinct("bucket").alias("buckets"))


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Without the columns that match; nothing else may go."""
    kept = [c for c in df.columns if not re.search(pattern, c)]
    out = df.select(*kept)
    assert [c for c in out.columns if re.search(pattern, c)] == [] and set(df.columns) - set(kept) == {c for c in df.columns if re.search(pattern, c)}
    return out


def with_bbox(cells: DataFrame, bounds: str = "bounds") -> DataFrame:
    return cells.withColumn("bbox", F.struct(*[F.col(f"{bounds}.{c}") for c in ("w", "s", "e", "n")]))


def write_sidecar(cells: DataFrame, path: str, level: int, eras: tuple[tuple[int, int], ...] = ERAS, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """A folder of what a map needs of cells (cell, bucket, cnt): bounds alone, and counts split by era; returns the manifest of the eras.

    Both are written in ranges of cells, the counts in ranges of era and cell, in as many files as the rows need, so that one task holds neither a table nor an era.
    """
    spark = cells.sparkSession
    rows, alone = cells.agg(F.count("*"), F.approx_count_distinct("cell")).first()
    files = lambda n: max(1, -(-n // rows_per_file))
    with_bounds = with_bbox(cells.select("cell").distinct().withColumn("bounds", bounds(F.col("cell"), level))).drop("bounds")
    with_bounds.repartitionByRange(files(alone), "cell").sortWithinPartitions("cell").write.mode("overwrite").parquet(f"{path}/bounds")
    split = split_by_era(cells.withColumn("year", F.substring("bucket", 1, 4).cast("int")), eras=eras).filter(F.col("era").isNotNull()).drop("year")
    split.repartitionByRange(files(rows), "era", "cell").sortWithinPartitions("era", "cell", "bucket").write.mode("overwrite").partitionBy("era").parquet(f"{path}/counts")
    return era_manifest(spark.read.parquet(f"{path}/counts"))


def write_sidecars(cells: DataFrame, path: str, level: int, levels: Iterable[int], eras: tuple[tuple[int, int], ...] = ERAS, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """A sidecar for each of the levels, the coarser ones summed from the finer; one manifest: level, era, min_bucket, max_bucket, buckets.

    cells (cell, bucket, cnt) are at the given level; buckets may be months or days.
    """
    manifests, have = [], level
    for at in sorted(set(levels), reverse=True):
        if at < have:
            cells = cells.groupBy(parent(F.col("cell"), have - at).alias("cell"), "bucket").agg(F.sum("cnt").alias("cnt"))
        have = at
        manifests.append(write_sidecar(cells, f"{path}/level-{at}", at, eras, rows_per_file).select(F.lit(at).alias("level"), "*"))
        # the next level is summed from what was written, without eras
        cells = cells.sparkSession.read.parquet(f"{path}/level-{at}/counts").select("cell", "bucket", "cnt")
    return reduce(DataFrame.unionByName, manifests)


def kept_cells(spark: SparkSession, root: str, cell: Column, dims: tuple[str, ...] = ()) -> dict[str, set[str]]:
    """Bring what is derived from a table of detections kept by day (root/detections) up to date: cells by day and by month, running totals in blocks of months.

    Only days whose part has changed are counted again, then the months that hold them; which parts were made again is returned.
    """
    day, month = F.date_format("acq_date", "yyyyMMdd"), F.substring("bucket", 1, 6)
    days = versions.refresh(spark, f"{root}/detections", f"{root}/cells_day", lambda det: base_cells(det, cell, day, dims), F.col("bucket"))
    of_month = lambda k: k[:6]
    months = versions.refresh(spark, f"{root}/cells_day", f"{root}/cells_month", lambda c: again(c.withColumn("bucket", month), "cell", "bucket", *dims), F.col("bucket"), of_month)
    per_day = lambda c: running_blocks(c.groupBy("cell", "bucket").agg(F.sum("cnt").alias("cnt")), month)
    blocks = versions.refresh(spark, f"{root}/cells_day", f"{root}/running", per_day, F.col("block"), of_month)
    versions.refresh(spark, f"{root}/running", f"{root}/totals", block_totals, F.col("block"))
    return {"days": days, "months": months, "blocks": blocks}


def persisted(spark: SparkSession, source: str, name: str, make: Callable[[], DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    """A table derived from the file or folder source, made once for each state of it and session, and read from then on."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    state = (spark.sparkContext.applicationId, source, name, fs.getFileStatus(jvm_path).getModificationTime(), fs.getContentSummary(jvm_path).getLength())
    if state not in _PERSISTED:
        path = f"{scratch(spark)}/{name}"
        made = make()
        made.write.partitionBy(*by).parquet(path)
        _PERSISTED[state] = path
    return spark.read.parquet(_PERSISTED[state])


_PERSISTED: dict[tuple, str] = {}
