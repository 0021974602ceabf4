"""Raw rows of any feed to the fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from .schema import DETECTIONS, SOURCES

NUMBERS = ("brightness", "bright_t31", "bright_ti4", "bright_ti5", "scan", "track", "frp")


def normalize(raw: DataFrame, source: str) -> DataFrame:
    """All-text rows with whatever columns the feed has; missing ones become typed nulls, rows without coordinates go."""
    sensor, quality, instrument = SOURCES[source]
    have = {c.lower(): c for c in raw.columns}

    def text(name: str) -> Column:
        return F.col(have[name]).cast("string") if name in have else F.lit(None).cast("string")

    own = {
        "lon": fields.typed(text("longitude"), "double"), "lat": fields.typed(text("latitude"), "double"),
        "acq_datetime": fields.observed_at(text("acq_date"), text("acq_time")), "acq_date": fields.typed(text("acq_date"), "date"),
        "sensor": F.lit(sensor), "satellite": fields.platform(text("satellite")),
        "instrument": F.coalesce(F.nullif(F.trim(text("instrument")), F.lit("")), F.lit(instrument)), "quality": F.lit(quality),
        "version": F.nullif(F.trim(text("version")), F.lit("")), "daynight": F.nullif(F.trim(text("daynight")), F.lit("")),
        "confidence": fields.confidence(F.nullif(F.trim(text("confidence")), F.lit(""))), "confidence_pct": fields.confidence_pct(text("confidence")),
        "type": fields.typed(text("type"), "int"), **{c: fields.typed(text(c), "double") for c in NUMBERS},
    }
    return raw.select(*[own[f.name].cast(f.dataType).alias(f.name) for f in DETECTIONS]).dropna(subset=["lon", "lat"])


def read_detections_csv(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Header-driven: nothing is inferred, every column is read as text."""
    return normalize(spark.read.option("header", True).csv(path), source)
