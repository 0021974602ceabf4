"""The given star-schema tables seen as detections; the same text runs in Spark and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = """SELECT event_id AS det_id, ts AS acq_datetime, CAST(ts AS DATE) AS acq_date, CAST(year(ts) AS INT) AS year,
  CASE event_type WHEN 'view' THEN 'MODIS' WHEN 'error' THEN 'MODIS'
       WHEN 'click' THEN 'VIIRS_SNPP' WHEN 'purchase' THEN 'VIIRS_NOAA20' ELSE 'VIIRS_NOAA21' END AS sensor,
  CASE event_type WHEN 'view' THEN 'Terra' WHEN 'error' THEN 'Aqua'
       WHEN 'click' THEN 'Suomi-NPP' WHEN 'purchase' THEN 'NOAA-20' ELSE 'NOAA-21' END AS satellite,
  CASE WHEN event_type IN ('view','error') THEN 'MODIS' ELSE 'VIIRS' END AS instrument,
  CASE WHEN event_type = 'signup' OR CAST(ts AS DATE) >= DATE '2024-01-25' THEN 'nrt' ELSE 'sp' END AS quality,
  (user_id * 7919) % 35980 - 18000 + event_id % 10 AS lon_c,
  (user_id * 6007) % 16980 - 8500 + event_id % 10 AS lat_c,
  CAST((user_id * 7919) % 35980 - 18000 + event_id % 10 AS DOUBLE) / 100 AS lon,
  CAST((user_id * 6007) % 16980 - 8500 + event_id % 10 AS DOUBLE) / 100 AS lat,
  value AS frp,
  CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'D' ELSE 'N' END AS daynight,
  CASE WHEN event_type IN ('view','error') THEN CAST(event_id % 101 AS STRING)
       WHEN event_id % 3 = 0 THEN 'l' WHEN event_id % 3 = 1 THEN 'n' ELSE 'h' END AS confidence,
  CASE WHEN event_type IN ('view','error') THEN CAST(event_id % 101 AS INT) END AS confidence_pct,
  CASE WHEN event_type = 'signup' OR CAST(ts AS DATE) >= DATE '2024-01-25' THEN NULL
       ELSE CAST(event_id % 4 AS INT) END AS type,
  CAST(CASE WHEN event_type IN ('view','error') THEN 1.0 ELSE 375.0 END AS DOUBLE) AS scan,
  CAST(CASE WHEN event_type IN ('view','error') THEN 1.0 ELSE 375.0 END AS DOUBLE) AS track,
  CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) AS day_key
FROM events"""

ORDERS = """SELECT o_orderkey AS det_id, o_orderdate AS acq_datetime, CAST(o_orderdate AS DATE) AS acq_date,
  CAST(year(o_orderdate) AS INT) AS year,
  CASE o_orderkey % (CASE WHEN year(o_orderdate) <= 1996 THEN 1 WHEN year(o_orderdate) <= 1998 THEN 2
                          WHEN year(o_orderdate) <= 2000 THEN 3 ELSE 4 END)
    WHEN 0 THEN 'MODIS' WHEN 1 THEN 'VIIRS_SNPP' WHEN 2 THEN 'VIIRS_NOAA20' ELSE 'VIIRS_NOAA21' END AS sensor,
  (o_custkey * 7919) % 36000 - 18000 AS lon_c,
  (o_custkey * 6007) % 17000 - 8500 AS lat_c,
  o_totalprice AS frp,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS month_key
FROM orders"""


def _adapted(spark: SparkSession, sf_dir: str, table: str, text: str) -> DataFrame:
    head, _ = text.rsplit("\nFROM ", 1)
    return spark.sql(f"{head}\nFROM {{src}}", src=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 days of detections from events."""
    return _adapted(spark, sf_dir, "events", EVENTS)


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven years of detections from orders, by a growing fleet."""
    return _adapted(spark, sf_dir, "orders", ORDERS)
