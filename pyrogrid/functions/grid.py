"""Cells of an equal-area quadtree, the Hilbert key, map tiles and longitude arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_BITS = 28
#: West, south, east, north; east may pass 180.
View = tuple[float, float, float, float]


def _axis(x: Column, n: int) -> Column:
    return F.least(F.floor(x * n), F.lit(n - 1)).cast("long")


def cell(lon: Column, lat: Column, level: int) -> Column:
    """Cell id at a level: 2^(level+1) columns by 2^level rows of equal area."""
    u, v = (lon + 180) / 360, (F.sin(F.radians(lat)) + 1) / 2
    return F.shiftleft(_axis(u, 1 << (level + 1)), ROW_BITS).bitwiseOR(_axis(v, 1 << level))


def parent(c: Column, up: int) -> Column:
    """The cell so many levels coarser that holds cell c."""
    return F.shiftleft(F.shiftright(c, ROW_BITS + up), ROW_BITS).bitwiseOR(F.shiftright(c.bitwiseAND(F.lit((1 << ROW_BITS) - 1)), up))


def bounds(c: Column, level: int) -> Column:
    """struct(w, s, e, n) in degrees."""
    ix, iy = F.shiftright(c, ROW_BITS), c.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    lon = lambda i: i * (360.0 / (1 << (level + 1))) - 180
    lat = lambda i: F.degrees(F.asin(i * (2.0 / (1 << level)) - 1))
    return F.struct(lon(ix).alias("w"), lat(iy).alias("s"), lon(ix + 1).alias("e"), lat(iy + 1).alias("n"))


def plain_cell(lon_c: Column, lat_c: Column, step: int) -> Column:
    """Cell of a plain grid over centidegrees; steps that double nest."""
    x = F.floor((lon_c + 18000).cast("double") / step).cast("long")
    return x * 100000 + F.floor((lat_c + 9000).cast("double") / step).cast("long")


def plain_parent(c: Column, times: int = 2) -> Column:
    return F.floor(F.floor(c / 100000) / times).cast("long") * 100000 + F.floor((c % 100000) / times).cast("long")


def with_hilbert(df: DataFrame, lon: Column, lat: Column, name: str, bits: int = 16) -> DataFrame:
    """df with a column: the place on the Hilbert curve over a 2^bits square.

    Each bit is a projection of its own over plain long arithmetic.  Spark compiles them together and works each out once; as one
    expression the terms would double with each bit, and as a fold they would be interpreted.
    """
    x, y, d = (f"__{name}_{c}" for c in "xyd")
    out = df.withColumns({x: _axis((lon + 180) / 360, 1 << bits), y: _axis((lat + 90) / 180, 1 << bits), d: F.lit(0).cast("long")})
    for k in reversed(range(bits)):
        low = (1 << k) - 1
        rx, ry = F.shiftright(x, k).bitwiseAND(F.lit(1)), F.shiftright(y, k).bitwiseAND(F.lit(1))
        px, py = F.col(x).bitwiseAND(F.lit(low)), F.col(y).bitwiseAND(F.lit(low))
        # within a quadrant the curve is turned: mirror in the right one of the lower half, swap in the lower half
        mx, my = F.when(rx == 1, low - px).otherwise(px), F.when(rx == 1, low - py).otherwise(py)
        out = out.withColumns({
            x: F.when(ry == 0, my).otherwise(px), y: F.when(ry == 0, mx).otherwise(py), d: F.shiftleft(F.col(d), 2) + (rx * 3).bitwiseXOR(ry),
        })
    return out.withColumn(name, F.col(d)).drop(x, y, d)


def hilbert_place(x: int, y: int, bits: int) -> int:
    """The place of one square on the curve of with_hilbert; its upper bits are the place of the square of fewer bits that holds it."""
    d = 0
    for k in reversed(range(bits)):
        low = (1 << k) - 1
        rx, ry, x, y = x >> k & 1, y >> k & 1, x & low, y & low
        d = (d << 2) + (3 * rx ^ ry)
        if not ry:
            x, y = (low - y, low - x) if rx else (y, x)
    return d


def hilbert_cover(view: View, most: int = 32, bits: int = 16) -> list[tuple[int, int]]:
    """Ranges of the curve, at most so many, that hold all places in a view; they hold others only at its rim.

    Squares at the view's rim are quartered as long as the ranges stay few; then the smallest gaps are closed.
    """
    n = 1 << bits
    w, s, e, north = view
    row = lambda lat: min(n - 1, max(0, int((lat + 90) / 180 * n // 1)))
    column = lambda lon: min(n - 1, max(0, int((lon + 180) / 360 * n // 1)))
    turns = [(-180.0, 180.0)] if e - w >= 360 else [(max(-180.0, w + k), min(180.0, e + k)) for k in range(-1080, 1081, 360) if w + k <= 180 and e + k >= -180]
    boxes = [(column(a), row(s), column(b), row(north)) for a, b in turns] if s <= 90 and north >= -90 and s <= north and w <= e else []
    if not boxes:
        return []
    inside: list[tuple[int, int]] = []
    rim, level = [(0, 0)], 0
    while True:
        below, size = [], n >> level
        for x, y in rim:
            lo_x, lo_y, hi_x, hi_y = x * size, y * size, (x + 1) * size - 1, (y + 1) * size - 1
            if any(a <= lo_x and hi_x <= c and b <= lo_y and hi_y <= d for a, b, c, d in boxes):
                first = hilbert_place(x, y, level) * size * size
                inside.append((first, first + size * size - 1))
            elif any(a <= hi_x and lo_x <= c and b <= hi_y and lo_y <= d for a, b, c, d in boxes):
                below.append((x, y))
        if level == bits or len(below) * 4 > 8 * most:
            ends = [(hilbert_place(x, y, level) * size * size, size * size) for x, y in below]
            ranges = sorted(inside + [(first, first + k - 1) for first, k in ends])
            break
        rim, level = [(2 * x + i, 2 * y + j) for x, y in below for i in (0, 1) for j in (0, 1)], level + 1
    gaps = sorted((b[0] - a[1], i) for i, (a, b) in enumerate(zip(ranges, ranges[1:], strict=False)))
    close = {i for k, (gap, i) in enumerate(gaps) if gap <= 1 or k < len(gaps) - most + 1}
    out = [ranges[0]]
    for i, r in enumerate(ranges[1:]):
        out[-1:] = [(out[-1][0], r[1])] if i in close else [out[-1], r]
    return out


def lon_overlaps(w: Column, e: Column, view_w: Column | float, view_e: Column | float) -> Column:
    """Whether [w, e] meets the view on the circle: the view may cross the antimeridian or be a world copy."""
    vw, ve = (x if isinstance(x, Column) else F.lit(float(x)) for x in (view_w, view_e))
    shift = F.floor((vw - w) / 360) * 360
    meets = lambda k: (w + shift + k <= ve) & (e + shift + k >= vw)
    return (ve - vw >= 360) | meets(0) | meets(360)


def in_view(w: Column, s: Column, e: Column, n: Column, view: tuple[float, float, float, float]) -> Column:
    return lon_overlaps(w, e, view[0], view[2]) & (s <= view[3]) & (n >= view[1])


def mercator_y(lat: Column) -> Column:
    """0 at the north end of the map, 1 at the south end."""
    s = F.radians(F.greatest(F.lit(-85.05112878), F.least(F.lit(85.05112878), lat)))
    return 0.5 - F.log(F.tan(F.lit(3.141592653589793 / 4) + s / 2)) / (2 * 3.141592653589793)


def tile_xy(lon: Column, lat: Column, z: int) -> Column:
    """struct(x, y) of the map tile at zoom z."""
    n = 1 << z
    return F.struct(F.greatest(F.lit(0), _axis((lon + 180) / 360, n)).alias("x"), F.greatest(F.lit(0), _axis(mercator_y(lat), n)).alias("y"))


def tile_point(x: Column, y: Column, z: int) -> Column:
    """struct(lon, lat) of a place in tile units at zoom z."""
    n = float(1 << z)
    return F.struct((x / n * 360 - 180).alias("lon"), F.degrees(2 * F.atan(F.exp(3.141592653589793 * (1 - 2 * y / n))) - 3.141592653589793 / 2).alias("lat"))
