"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its share of tokens to the power alpha, normalised.  The exponent is sought, by cutting an interval again
and again, to the largest one (closest to the natural shares) that meets the target: an entropy of the weights of at least
``min_entropy`` times its maximum, or else to the least one with which no source is repeated over ``max_repeats`` times within the budget.
A cut needs three sums over the sources for each of its exponents, so sources stay a distributed table, however many there are.

The budget is then dealt in whole documents: each source is cut into blocks by a hash of its rows, its
blocks are put in a hashed order, and within a block rows are in a hashed order.  A row's place is the number of tokens before it in this
permutation of its source; a source is repeated as often as its budget holds it whole, and the rest is taken from the front of
the permutation until it is used up.  Sums run over blocks first and over rows within a block second, so a source with a third of
all rows is spread over its blocks.  Only DataFrame operations are used.

A copy's turn is where it stands in the mixture, from 0 to 1: tokens of its source dealt before it over the source's budget.  In
the order of turns, any beginning of the mixture holds the sources by their weights.

Defined results: a null source is a source of its own; null and empty texts have no tokens and share
the fate of the place they fall on; very long texts count by their tokens like others; equal ids are ordered by their texts' hash and repeated rows count each,
and are taken or left together; an empty table gives an empty result; a source without any tokens keeps its rows once;
columns of docs named like the results are replaced, all others pass through whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import looked_up, unused, written

BLOCKS = 1024
#: Exponents tried in one pass, and passes: the last interval is (CUTS - 1) ** -ROUNDS wide.
CUTS, ROUNDS = 48, 7


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def hashed(*parts: Column) -> Column:
    """60 bits of an MD5, which other engines have too."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def exponent(shares: DataFrame, min_entropy: float | None, max_repeats: float | None, budget_ratio: float | None) -> tuple[float, float]:
    """alpha and the sum of the shares (p > 0) to its power, which normalises the weights."""
    p = F.col("p")

    def sums(alphas: list[float]) -> list[tuple[float, float]]:
        row = shares.agg(*[f for a in alphas for f in (F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))]).first()
        return list(zip(row[::2], row[1::2], strict=True))

    n, least, most = shares.agg(F.count("*"), F.min("p"), F.max("p")).first()

    def fits(a: float, z: float, weighted_log: float) -> bool:
        if min_entropy is not None:
            # H = - sum w ln w with w = p ** a / z
            return math.log(z) - a * weighted_log / z >= min_entropy * math.log(n)
        if budget_ratio is not None:
            return least ** (a - 1) / z * budget_ratio <= max_repeats
        return (least / most) ** (a - 1) <= max_repeats  # the source that is cut most is kept whole

    if not n or (min_entropy is None and max_repeats is None):
        return 1.0, 1.0
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / (CUTS - 1) for i in range(CUTS)]
        good = [fits(a, *s) for a, s in zip(grid, sums(grid), strict=True)]
        if min_entropy is not None:  # met from 0 up to some exponent
            if good[-1]:
                lo = hi = grid[-1]
                break
            i = good.index(False)
            lo, hi = grid[max(0, i - 1)], grid[i]
        else:  # met from some exponent up to 1
            if good[0]:
                lo = hi = grid[0]
                break
            i = len(good) - 1 - good[::-1].index(False)
            lo, hi = grid[i], grid[min(len(grid) - 1, i + 1)]
    alpha = lo if min_entropy is not None else hi
    return alpha, sums([alpha])[0][0]


def weights(tokens: DataFrame, min_entropy: float | None = None, max_repeats: float | None = None, budget_ratio: float | None = 1.0) -> DataFrame:
    """Per source of tokens (src, tokens): src, tokens, weight, budget (tokens to deal), alpha.

    budget_ratio: the budget over all tokens; None: as much as leaves the most reduced source whole once.
    """
    total = tokens.agg(F.sum("tokens")).first()[0] or 0
    shares = tokens.withColumn("p", F.col("tokens") / F.lit(float(max(1, total))))
    alpha, z = exponent(shares.filter("p > 0"), min_entropy, max_repeats, budget_ratio)
    w = F.when(F.col("p") > 0, F.pow("p", F.lit(alpha)) / F.lit(z)).otherwise(F.lit(0.0))
    weighted = shares.withColumn("weight", w)
    ratio = budget_ratio
    if ratio is None:
        ratio = weighted.agg(F.max(F.when(F.col("weight") > 0, F.col("p") / F.col("weight")))).first()[0] or 0.0
    return weighted.select("src", "tokens", "weight", F.floor(F.col("weight") * F.lit(float(total) * ratio) + F.lit(0.5)).alias("budget"), F.lit(alpha).alias("alpha"))


def mix(
    docs: DataFrame, min_entropy: float | None = None, max_repeats: float | None = None, budget_ratio: float | None = 1.0, seed: int = 17,
    blocks: int = BLOCKS, places: bool = True, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """All rows and columns of docs, with __tokens, __weight, __alpha, __budget (of the source), __all (its tokens), __repeats, and, if asked for, __place.

    __repeats is how often the mixture takes the row: 0 where the budget of its source ends before it.  Copy c, from 0, has the turn
    (c * __all + __place) / __budget.
    """
    u = unused(docs)
    src, tok, h, block, start, size, rest, whole, last = (f"{u}{x}" for x in ("src", "tok", "h", "block", "start", "size", "rest", "whole", "last"))
    source = F.when(F.col(source_col).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    key = hashed(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.withColumns({src: source, tok: token_count(F.col(text_col)), h: key})
    rows = rows.withColumn(block, F.pmod(F.shiftright(h, 20), F.lit(blocks)).cast("int"))
    dealt_in = written(rows.groupBy(src, block).agg(F.sum(tok).alias(size)))
    dealt = weights(dealt_in.groupBy(F.col(src).alias("src")).agg(F.sum(size).alias("tokens")), min_entropy, max_repeats, budget_ratio)
    order = hashed(F.lit(seed), F.col(src), F.col(block))
    before = Window.partitionBy(src).orderBy(order, block).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt_in.select(src, block, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start), size)
    some = F.col("tokens") > 0
    placed = written(starts.join(dealt, F.col(src) == F.col("src")).select(
        src, block, start, size, F.when(some, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)).alias(rest), F.when(some, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).alias(whole),
        *[F.col(c).alias(u + c) for c in ("tokens", "weight", "alpha", "budget")],
    ))
    # only the block in which the budget ends needs the order of its rows to tell who is in; the others are in or out as wholes
    ends = placed.filter((F.col(start) < F.col(rest)) & (F.col(start) + F.col(size) > F.col(rest)))  # one block a source at most
    inner = Window.partitionBy(src, block).orderBy(h).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cutting = rows.select(src, block, h, tok).join(ends.select(src, block, start, rest), [src, block])
    reach = F.col(start) + F.sum(tok).over(inner)
    limit = cutting.withColumn(tok, reach).filter(F.col(tok) <= F.col(rest)).groupBy(src, block).agg(F.max(h).alias(last))
    cell = f"{u}cell"
    full = placed.join(limit, [src, block], "left").withColumn(cell, F.concat_ws("/", block, src)).drop(src, block)
    inside = F.when(F.col(start) + F.col(size) <= F.col(rest), True).otherwise(F.coalesce(F.col(h) <= F.col(last), F.lit(False)))
    out = looked_up(rows.withColumn(cell, F.concat_ws("/", block, src)), full, cell)
    made = {
        "__tokens": F.col(tok), "__weight": F.col(f"{u}weight"), "__alpha": F.col(f"{u}alpha"), "__budget": F.col(f"{u}budget"), "__all": F.col(f"{u}tokens"),
        "__repeats": (F.col(whole) + inside.cast("long")).cast("int"),
    }
    if places:
        earlier = Window.partitionBy(cell).orderBy(h).rowsBetween(Window.unboundedPreceding, -1)
        made["__place"] = F.col(start) + F.coalesce(F.sum(tok).over(earlier), F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])


def turns(mixed: DataFrame) -> DataFrame:
    """A row for each copy that the mixture takes, with __copy (from 0) and __turn: its place in the mixture, from 0 to 1.

    A source without tokens has no place among the others: its rows get turn 0.
    """
    copies = mixed.filter("__repeats > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__repeats") - 1)))
    turn = (F.col("__copy") * F.col("__all") + F.col("__place")) / F.col("__budget")
    return copies.withColumn("__turn", F.when(F.col("__budget") > 0, turn).otherwise(F.lit(0.0)))
