"""Column expressions on detections: cleaning, filters, classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: platforms by code, confidence words, the ladder of powers
PLATFORMS = {"t": "Terra", "terra": "Terra", "a": "Aqua", "aqua": "Aqua", "n": "Suomi-NPP", "1": "NOAA-20", "n20": "NOAA-20", "2": "NOAA-21", "n21": "NOAA-21"}
CONFIDENCE = {"low": "l", "nominal": "n", "high": "h"}
POWER_LADDER = (10, 50, 200, 500, 1000)


def typed(c: Column, kind: str) -> Column:
    """Text to a type; empty text is null, junk raises."""
    return F.nullif(F.trim(c), F.lit("")).cast(kind)


def observed_at(date: Column, hhmm: Column) -> Column:
    """UTC time from a date and an integer hhmm such as 7 for 00:07."""
    text = F.lpad(F.trim(hhmm).cast("int").cast("string"), 4, "0")
    return F.to_timestamp(F.concat_ws(" ", date.cast("string"), text), "yyyy-MM-dd HHmm")


def _mapped(c: Column, names: dict[str, str]) -> Column:
    """What names has for a text, whatever its case; any other text trimmed."""
    out = F.trim(c)
    key = F.lower(out)
    for k, v in names.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def platform(c: Column) -> Column:
    return _mapped(c, PLATFORMS)


def confidence(c: Column) -> Column:
    return _mapped(c, CONFIDENCE)


def confidence_pct(c: Column) -> Column:
    return F.round(F.trim(c).try_cast("double")).try_cast("int")


def usable_type(kind: Column, strict: bool = False) -> Column:
    """Vegetation fires; rows without a type (near real time) count unless strict."""
    return F.coalesce(kind == 0, F.lit(False)) if strict else (kind == 0) | kind.isNull()


def confident(sensor: Column, pct: Column, letter: Column, least: int = 30) -> Column:
    """Both scales: a number for one sensor family, letters for the other."""
    return F.when(sensor == "MODIS", pct >= least).otherwise(letter != "l")


def footprint_km2(instrument: Column, scan: Column, track: Column) -> Column:
    return F.when(instrument == "VIIRS", scan * track / 1e6).otherwise(scan * track)


def positive(c: Column) -> Column:
    return c.isNotNull() & (c > 0)


def class_of(value: Column, breaks: Column) -> Column:
    """How many breaks a value reaches; null under the first one."""
    n = F.size(F.filter(breaks, lambda b: b <= value))
    return F.when(n > 0, n)


def scaled_breaks(breaks: Column, share: Column) -> Column:
    """Breaks for a part of the buckets: each at least 1 and over the one before."""
    step = lambda acc, b: F.concat(acc, F.array(F.greatest(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long")) + 1, F.greatest(F.lit(1).cast("long"), F.ceil(b * share)))))
    return F.aggregate(breaks, F.array().cast("array<bigint>"), step)


def iso_z(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def tolerant_json(text: Column, schema: str) -> Column:
    """The fields asked for of a text that holds a JSON object; null for anything else, malformed or not."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.when(kind.startswith("OBJECT"), F.from_json(text, schema, {"mode": "PERMISSIVE"}))
