"""Structured Streaming: ingestion, live counts, folding windows into the store, alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import maintain, timeseq
from ..operators.viewport import join_regions
from ..sources import store, versions
from ..sources.normalize import normalize
from ..sources.schema import NATURAL_KEY


def ingest(spark: SparkSession, path: str, source: str, raw: StructType) -> DataFrame:
    """Arriving CSV chunks, normalised as in batch."""
    return normalize(spark.readStream.schema(raw).option("header", True).csv(path), source)


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files as a stream, its times made fit for watermarks."""
    batch = spark.read.parquet(path)
    return spark.readStream.schema(batch.schema).parquet(path)


def live_counts(stream: DataFrame, late: str = "1 day", by: tuple[str, ...] = ("sensor",)) -> DataFrame:
    """Daily counts (tumbling windows)."""
    return stream.withWatermark("acq_datetime", late).groupBy(F.window("acq_datetime", "1 day"), *by).agg(F.count("*").alias("cnt")).select(F.col("window.start").alias("day"), *by, "cnt")


def rolling(stream: DataFrame, size: str = "7 days", slide: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts of the last so many days, republished at each slide (sliding windows)."""
    return stream.withWatermark("acq_datetime", late).groupBy(F.window("acq_datetime", size, slide)).agg(F.count("*").alias("cnt")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "cnt")


def without_repeats(stream: DataFrame, late: str = "8 days", key: tuple[str, ...] = NATURAL_KEY) -> DataFrame:
    return stream.withWatermark("acq_datetime", late).dropDuplicatesWithinWatermark(list(key))


def apply_window(table: str, year: int, allow_gap: bool = False):
    """A foreachBatch function that folds each window into a year's table, kept by day in versions, once per batch id.

    A batch is one version of the table: tail replacement and, after it, science-quality rows that replace near-real-time ones of their sensors and days,
    however old.  Days that the tail replacement leaves without rows vanish with the same step, other days keep their folders.  A refused or idle batch
    is a version without changes.  A batch that was cut off left the table as it was and is folded again; one that is in a version is not.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = versions.manifest(spark, table)
        if base.batch is not None and base.batch >= batch_id:
            return
        of = lambda c: F.date_format(c, "yyyyMMdd")
        science = batch.filter(F.col("quality") == "sp") if "quality" in batch.columns else None
        window = batch.filter(~F.col("quality").eqNullSafe(F.lit("sp"))) if science is not None else batch
        # the ends of the archive stand in its first and last day
        ends = [k for k in (min(base.parts, default=None), max(base.parts, default=None)) if k]
        action = maintain.merge_decision(versions.read(spark, table, ends, base, batch), window, year, allow_gap).first()
        said, due = f"{action['action']}: {action['reason']}", set()
        merges = action["action"] in ("merge", "seed")
        if merges:
            first = window.agg(of(F.min("acq_datetime"))).first()[0]
            due = {k for k in base.parts if k >= first}
        days = {r[0] for r in science.select(of("acq_date")).distinct().collect()} if science is not None else set()  # of a calendar
        if not merges and not days:
            versions.commit(spark, table, base, note=said, batch=batch_id)
            return
        rows = versions.read(spark, table, sorted(due | days), base, batch)
        if merges:
            tail = maintain.merge_tail(rows.filter(of("acq_date") >= first), window)
            rows = rows.filter(of("acq_date") < first).unionByName(tail, allowMissingColumns=True)
        if days:
            late = of("acq_date").isin(*days)
            again = science.select("sensor", "acq_date").distinct().withColumn("quality", F.lit("sp"))
            kept = rows.filter(late).join(again, ["sensor", "acq_date", "quality"], "left_anti").unionByName(science, allowMissingColumns=True)  # sp rows delivered again replace themselves
            rows = rows.filter(~late).unionByName(maintain.supersede(kept))
            said += f"; superseded {len(days)} days"
        staged = versions.stage(rows, table, of("acq_date"), ("acq_datetime",))
        versions.commit(spark, table, base, staged, due | days, said, batch_id)

    return fold


def refresh(stream: DataFrame, root: str, cell: Column, year: int, checkpoint: str, allow_gap: bool = False) -> None:
    """The hourly run: fold what has arrived into the detections kept by day below root, then bring the cells and totals made of them up to date.

    Either part that is cut off is made up for by the next run: the fold by its batch number, the cells by what they were last derived from.
    """
    fold_into(stream, apply_window(f"{root}/detections", year, allow_gap), checkpoint)
    store.kept_cells(stream.sparkSession, root, cell)


def stall_alarm(batch: DataFrame, lo: Column, now: Column, latency: str = "6 hours", max_gap: str = "3 hours") -> DataFrame:
    """Holes up to now less the feed's latency; a stalled feed is a hole at the end."""
    return timeseq.holes(batch, max_gap, lo=lo, hi=now - F.expr(f"interval {latency}"))


def alerts(stream: DataFrame, regions: DataFrame, least_frp: float) -> DataFrame:
    """New detections in regions of interest above a power: a stream-static join."""
    return join_regions(stream.filter(F.col("frp") >= least_frp), regions)


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that is there now, as a table of the session: for looks and tests, since the driver holds it."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def keep_latest(table: str, keys: tuple[str, ...], part: Column):
    """A foreachBatch function for streams in update mode: a row replaces the one of its keys, once per batch id; part names the part it lies in.

    Only parts that a batch touches are written again, all in one step.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = versions.manifest(spark, table)
        if base.batch is not None and base.batch >= batch_id:
            return
        batch = batch.persist()  # what a stateful batch gives is worked out once
        try:
            due = [r[0] for r in batch.select(part.cast("string")).distinct().collect()]  # buckets of time that are still open
            before = versions.read(spark, table, due, base, batch)
            rows = before.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)
            versions.commit(spark, table, base, versions.stage(rows, table, part) if due else None, due, f"{len(due)} parts", batch_id)
        finally:
            batch.unpersist()

    return put


def fold_into(stream: DataFrame, each, checkpoint: str, mode: str = "append") -> None:
    """Hand all that is there now to a foreachBatch function and end; the checkpoint tells the next call where to go on."""
    stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write all that is there now as Parquet files, each row once, and end."""
    stream.writeStream.format("parquet").option("path", path).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
