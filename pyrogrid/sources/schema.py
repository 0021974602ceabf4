"""The schema of detections and what is known of the feeds."""

from __future__ import annotations

from pyspark.sql import types as T

DETECTIONS = T.StructType([
    T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()),
    T.StructField("acq_datetime", T.TimestampType()), T.StructField("acq_date", T.DateType()),
    T.StructField("sensor", T.StringType()), T.StructField("satellite", T.StringType()), T.StructField("instrument", T.StringType()),
    T.StructField("quality", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("brightness", T.DoubleType()), T.StructField("bright_t31", T.DoubleType()), T.StructField("bright_ti4", T.DoubleType()), T.StructField("bright_ti5", T.DoubleType()),
    T.StructField("scan", T.DoubleType()), T.StructField("track", T.DoubleType()), T.StructField("frp", T.DoubleType()),
    T.StructField("daynight", T.StringType()), T.StructField("confidence", T.StringType()), T.StructField("confidence_pct", T.IntegerType()), T.StructField("type", T.IntegerType()),
])

# fixed values: feed -> sensor, quality, instrument
SOURCES = {
    "MODIS_SP": ("MODIS", "sp", "MODIS"),
    "MODIS_NRT": ("MODIS", "nrt", "MODIS"),
    "VIIRS_SNPP_SP": ("VIIRS_SNPP", "sp", "VIIRS"),
    "VIIRS_SNPP_NRT": ("VIIRS_SNPP", "nrt", "VIIRS"),
    "VIIRS_NOAA20_SP": ("VIIRS_NOAA20", "sp", "VIIRS"),
    "VIIRS_NOAA20_NRT": ("VIIRS_NOAA20", "nrt", "VIIRS"),
    "VIIRS_NOAA21_NRT": ("VIIRS_NOAA21", "nrt", "VIIRS"),
}
NATURAL_KEY = ("sensor", "acq_datetime", "lon", "lat")
