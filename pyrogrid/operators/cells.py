"""Cell aggregates: one finest-grain long table, from which all else is summed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What each long table has beside its keys.
MEASURES = ("cnt", "n_frp", "sum_frp", "max_frp")


def base_cells(det: DataFrame, cell: Column, bucket: Column, dims: tuple[str, ...] = ("sensor", "daynight")) -> DataFrame:
    """The finest grain: cell, bucket, the dimensions, and their measures, in one scan and one shuffle."""
    return det.groupBy(cell.alias("cell"), bucket.alias("bucket"), *dims).agg(
        F.count("*").alias("cnt"), F.count("frp").alias("n_frp"), F.sum(F.col("frp").cast("decimal(18,2)")).alias("sum_frp"), F.max("frp").alias("max_frp")
    )


def again(cells: DataFrame, *keys: str | Column) -> DataFrame:
    """Sum a long table to coarser keys: counts and sums add, the maximum is that of the maxima."""
    return cells.groupBy(*keys).agg(F.sum("cnt").alias("cnt"), F.sum("n_frp").alias("n_frp"), F.sum("sum_frp").alias("sum_frp"), F.max("max_frp").alias("max_frp"))


def rollup(cells: DataFrame, parent: Column, *keys: str) -> DataFrame:
    return again(cells.withColumn("cell", parent), "cell", *keys)


def with_means(cells: DataFrame) -> DataFrame:
    """avg_frp over the rows that have a power, and mean_all over all rows."""
    total = F.col("sum_frp").cast("double")
    return cells.withColumns({"avg_frp": F.when(F.col("n_frp") > 0, total / F.col("n_frp")), "mean_all": total / F.col("cnt")})


def wide(cells: DataFrame, dim: str, values: list[str], limit: int, key: str = "cell") -> DataFrame:
    """count_<value> columns. The values are given; more distinct ones than the limit, or others, raise rather than go missing."""
    if len(values) > limit:
        raise ValueError(f"{len(values)} values of {dim}; the limit is {limit}")
    known = F.col(dim).isin(*values)
    checked = cells.filter(F.assert_true(known, F.concat(F.lit(f"unlisted value of {dim}: "), F.coalesce(F.col(dim).cast("string"), F.lit("null")))).isNull())
    out = checked.groupBy(key).pivot(dim, values).agg(F.sum("cnt"))
    return out.select(key, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"count_{v}") for v in values])


def wide_years(by_year: DataFrame, months: list[str], key: str = "cell") -> DataFrame:
    """count_<month> columns of cells by year (cell, year, bucket, cnt): 0 in a year that has the cell, null in one that lacks it."""
    years = sorted({m[:4] for m in months})
    per_year = [F.max((F.col("year") == int(y)).cast("int")).alias(f"__{y}") for y in years]
    per_month = [F.sum(F.when(F.col("bucket") == m, F.col("cnt"))).alias(f"__{m}") for m in months]
    one = by_year.groupBy(key).agg(*per_year, *per_month)
    return one.select(key, *[F.when(F.col(f"__{m[:4]}") == 1, F.coalesce(F.col(f"__{m}"), F.lit(0))).alias(f"count_{m}") for m in months])


def bounds_union(pieces: DataFrame, key: str = "cell") -> DataFrame:
    """The bounds of a cell's pieces, joined."""
    return pieces.groupBy(key).agg(F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))


def convergence(cells: DataFrame) -> DataFrame:
    """Per year: cells, cells not seen in any year before, and how many were seen so far."""
    each = cells.select("year", "cell").distinct()
    first = each.groupBy("cell").agg(F.min("year").alias("year")).groupBy("year").agg(F.count("*").alias("new_cells"))
    per = each.groupBy("year").agg(F.count("*").alias("cells"))
    joined = per.join(first, "year", "left").withColumn("new_cells", F.coalesce("new_cells", F.lit(0)))
    return joined.withColumn("union_cells", F.sum("new_cells").over(Window.orderBy("year")))  # a row a year


def density(cells: DataFrame) -> DataFrame:
    """Of each level: rows, cells, buckets, and the filled part of the matrix."""
    t = cells.groupBy("level").agg(F.count("*").alias("filled"), F.countDistinct("cell").alias("cells"), F.countDistinct("bucket").alias("buckets"))
    return t.withColumn("density", F.round(F.col("filled") / (F.col("cells") * F.col("buckets")), 6))


def over_budget(densities: DataFrame, bytes_per_value: float = 4.0) -> DataFrame:
    """Of densities (level, cells, buckets): the levels whose matrix would pass its budget, with its size and the budget in MB."""
    size = F.col("cells") * F.col("buckets") * bytes_per_value / 1e6
    budget = F.lit(25.0) * F.pow(F.lit(4.0), F.greatest(F.lit(0), F.col("level") - 6))
    return densities.select("level", size.alias("mb"), budget.alias("budget_mb")).filter("mb > budget_mb")
