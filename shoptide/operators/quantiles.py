"""Exact quantiles without gathering the values anywhere.

Spark's exact percentile keeps every distinct value of the table in the memory of one task. Here the
values are counted first, cut into about equal slices of distinct values, and ranked slice by slice:
the only things that travel whole are a fixed number of slice totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 200


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of numeric columns occurs: column_name, value, n. Nulls and NaN are one
    value, null."""
    names = list(columns)
    long = df.select(*(F.col(c).cast("double").alias(c) for c in names)).unpivot(
        [], names, "column_name", "value"
    )
    value = F.when(~F.isnan("value"), F.col("value")).alias("value")
    return long.groupBy("column_name", value).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], slices: int = SLICES
) -> DataFrame:
    """Interpolated quantiles of numeric columns, nulls and NaN left out.

    One row per column that has values: ``column_name`` and ``q`` (one double per point).
    """
    return quantiles_of(value_frequencies(df, columns), points, slices)


def quantiles_of(
    frequencies: DataFrame, points: Sequence[float], slices: int = SLICES
) -> DataFrame:
    """``exact_quantiles`` from ``value_frequencies``."""
    freq = frequencies.where(F.col("value").isNotNull())
    # One row per column name, each with at most `slices` marks: a size fixed by the caller.
    steps = [i / slices for i in range(1, slices)]
    marks = freq.groupBy("column_name").agg(
        F.percentile_approx("value", steps, 10 * slices).alias("marks")
    )
    sliced = freq.join(F.broadcast(marks), "column_name").select(
        "column_name",
        "value",
        "n",
        F.size(F.filter("marks", lambda m: m < F.col("value"))).alias("slice"),
    )
    # At most `slices` rows per column: rows below each slice, and all rows of the column.
    totals = sliced.groupBy("column_name", "slice").agg(F.sum("n").alias("slice_rows"))
    by_column = Window.partitionBy("column_name")
    before = by_column.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "column_name",
        "slice",
        F.coalesce(F.sum("slice_rows").over(before), F.lit(0)).alias("below"),
        F.sum("slice_rows").over(by_column).alias("all_rows"),
    )
    within = (
        Window.partitionBy("column_name", "slice")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = sliced.join(F.broadcast(offsets), ["column_name", "slice"]).select(
        "column_name",
        "value",
        "all_rows",
        (F.col("below") + F.sum("n").over(within)).alias("up_to"),
    )
    # The value at rank r (from 0) is the smallest one with more than r rows up to it.
    ends = []
    for i, point in enumerate(points):
        place = (F.col("all_rows") - 1) * F.lit(float(point))
        ends.append(F.min(F.when(F.col("up_to") > F.floor(place), F.col("value"))).alias(f"lo_{i}"))
        ends.append(F.min(F.when(F.col("up_to") > F.ceil(place), F.col("value"))).alias(f"hi_{i}"))
    found = ranked.groupBy("column_name").agg(F.max("all_rows").alias("all_rows"), *ends)
    values = []
    for i, point in enumerate(points):
        place = (F.col("all_rows") - 1) * F.lit(float(point))
        low, high = F.col(f"lo_{i}"), F.col(f"hi_{i}")
        values.append(low + (high - low) * (place - F.floor(place)))
    return found.select("column_name", F.array(*values).alias("q"))
