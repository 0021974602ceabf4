"""Joins on ranges of whole numbers as equality joins, for any number of ranges of any lengths.

A range is cut into blocks of a dyadic tree: of each length 1, 2, 4, ... at most two, none of which lies in another.  A point lies in one block of each length, so
point and range meet in exactly one block, or in none.  Two ranges meet if a block of the one is, or lies in, a block of the other.
Long ranges need few blocks more than short ones, so neither length nor number makes a key hot, and no side has to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_N, _K = "__block", "__size"


def _floor(x: Column, k: Column) -> Column:
    """x divided by 2 ** k, rounded down."""
    return F.call_function("shiftright", x, k)


def blocks(lo: Column, hi: Column, sizes: int) -> Column:
    """array of struct(size, block): the blocks of [lo, hi], of lengths below 2 ** sizes; empty for an empty range."""
    lo, end = lo.cast("long"), hi.cast("long") + 1

    def of(k: Column) -> Column:
        # whole blocks of this length, a to b, less those in whole blocks of the next one; the greatest length takes all that is left
        a, b = -_floor(-lo, k), _floor(end, k)
        a2, b2 = 2 * -_floor(-lo, k + 1), 2 * _floor(end, k + 1)
        some = (k < sizes - 1) & (a2 < b2)
        numbers = F.when(a >= b, F.array().cast("array<bigint>")).when(~some, F.sequence(a, b - 1)).otherwise(
            F.concat(F.when(a < a2, F.array(a)).otherwise(F.array().cast("array<bigint>")), F.when(b2 < b, F.array(b2)).otherwise(F.array().cast("array<bigint>")))
        )
        return F.transform(numbers, lambda n: F.struct(k.alias(_K), n.alias(_N)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(sizes - 1)), of))


def above(x: Column, size: Column | int, sizes: int) -> Column:
    """array of struct(size, block): the block x of a size, and all that hold it."""
    first = size if isinstance(size, Column) else F.lit(size)
    return F.transform(F.sequence(first, F.lit(sizes - 1)), lambda k: F.struct(k.alias(_K), _floor(x.cast("long"), k - first).alias(_N)))


def _sizes(ranges: DataFrame, lo: Column, hi: Column) -> int:
    """How many lengths of blocks the longest range needs."""
    longest = ranges.agg(F.max(hi.cast("long") - lo.cast("long"))).first()[0]
    return max(1, (1 if longest is None else int(longest) + 1).bit_length())


def holding(points: DataFrame, at: Column, ranges: DataFrame, lo: Column, hi: Column, on: tuple[str, ...] = ()) -> DataFrame:
    """Rows of points with each row of ranges that holds their place, the columns on alike: place and ends are whole numbers, null meets nothing."""
    n = _sizes(ranges, lo, hi)
    cut = ranges.filter(lo <= hi).withColumn("__b", F.explode(blocks(lo, hi, n)))
    placed = points.withColumn("__b", F.explode(above(at, 0, n)))
    return _opened(placed).join(_opened(cut), [*on, _K, _N]).drop(_K, _N)


def meeting(a: DataFrame, a_lo: Column, a_hi: Column, a_id: str, b: DataFrame, b_lo: Column, b_hi: Column, b_id: str, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (on, a_id, b_id) of ranges that overlap, each once."""
    n = max(_sizes(a, a_lo, a_hi), _sizes(b, b_lo, b_hi))

    def both(df: DataFrame, lo: Column, hi: Column, name: str) -> tuple[DataFrame, DataFrame]:
        own = _opened(df.filter(lo <= hi).select(*on, name, F.explode(blocks(lo, hi, n)).alias("__b")))
        more = own.select(*on, name, F.explode(F.slice(above(F.col(_N), F.col(_K), n), F.lit(2), F.lit(n))).alias("__b"))
        return own, _opened(more).distinct()

    (a_own, a_up), (b_own, b_up) = both(a, a_lo, a_hi, a_id), both(b, b_lo, b_hi, b_id)
    keys = [*on, _K, _N]
    found = a_own.join(b_own.unionByName(b_up), keys).unionByName(a_up.join(b_own, keys))
    return found.select(*on, a_id, b_id).distinct()


def _opened(df: DataFrame) -> DataFrame:
    return df.withColumns({_K: F.col(f"__b.{_K}"), _N: F.col(f"__b.{_N}")}).drop("__b")
