"""Single-pass profiles of any layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import fixed_values as fixed
from shoptide.operators.quantiles import SLICES, quantiles_of, value_frequencies


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null rows and their percent per column. NaN is a value, not a null."""
    names = list(columns) if columns is not None else df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in names)
    )
    long = counts.unpivot(["_rows"], names, "column_name", "null_rows")
    share = F.coalesce(F.try_divide(F.col("null_rows"), F.col("_rows")) * 100.0, F.lit(0.0))
    return long.select("column_name", "null_rows", share.alias("pct_null"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows whose key, with the time cut to the second, occurs more than once; all members count."""
    key = [c for c in fixed.EVENT_KEY if c != "event_time"]
    groups = df.groupBy(*key, F.date_trunc("second", "event_time").alias("second")).agg(
        F.count(F.lit(1)).alias("n")
    )
    members = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return groups.agg(
        members.alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_rows"),
    ).select(
        "duplicate_rows",
        "duplicate_groups",
        "all_rows",
        F.coalesce(
            F.try_divide(F.col("duplicate_rows"), F.col("all_rows")) * 100.0, F.lit(0.0)
        ).alias("pct_duplicates"),
    )


def distinct_values(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Distinct values per column in one row; a null counts as one value."""
    counts = [
        (
            F.count_distinct(column)
            + F.coalesce(F.max(F.col(column).isNull().cast("bigint")), F.lit(0))
        ).alias(alias)
        for alias, column in names.items()
    ]
    return df.agg(*counts)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, slices: int = SLICES
) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max of each numeric column.

    All of it comes from one table of values and how often they occur, built in one scan. ``slices``
    tasks at most rank the distinct values of a column.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    freq = value_frequencies(df, names)
    value, n = F.col("value"), F.col("n")
    rows = F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0))
    sums = freq.groupBy("column_name").agg(
        rows.alias("n"),
        F.try_divide(F.sum(value * n), rows).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    # Deviations are taken from the mean before they are squared; one mean per column name.
    means = F.broadcast(sums.select("column_name", "mean"))
    spread = freq.join(means, "column_name").groupBy("column_name").agg(
        F.sum(F.pow(value - F.col("mean"), F.lit(2)) * n).alias("squares")
    )
    std = F.sqrt(F.try_divide(F.col("squares"), F.col("n") - 1)).alias("std")
    moments = sums.join(spread, "column_name").select("column_name", "n", "mean", std, "min", "max")
    quartiles = quantiles_of(freq, (0.25, 0.5, 0.75), slices)
    # Both sides have one row per column name.
    return moments.join(quartiles, "column_name", "left").select(
        "column_name",
        "n",
        "mean",
        "std",
        "min",
        F.get("q", F.lit(0)).alias("p25"),
        F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p75"),
        "max",
    )


def price_stats(df: DataFrame, slices: int = SLICES) -> DataFrame:
    """Price: count, min, max, mean, sample deviation and exact median."""
    stats = describe_numeric(df, ["price"], slices)
    return stats.select(
        F.col("n").alias("prices"),
        F.col("min").alias("min_price"),
        F.col("max").alias("max_price"),
        F.col("mean").alias("avg_price"),
        F.col("std").alias("std_price"),
        F.col("p50").alias("median_price"),
    )
