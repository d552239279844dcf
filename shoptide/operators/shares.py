"""Counts per value and shares of a grand total.

The total is a scalar subquery over the counted frame. Spark runs it on the same shuffle as the
counts (ReusedExchange), so the events are read once, nothing passes through Python, and no window
without a partition moves all rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of(part: Column, total: Column) -> Column:
    """``part / total * 100``; 0 when the total is 0."""
    share = F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0)
    return F.when(total != 0, share).otherwise(F.lit(0.0))


def value_counts(df: DataFrame, columns: str | Sequence[str], count: str = "n") -> DataFrame:
    """Rows per distinct value; a null is a value of its own."""
    names = [columns] if isinstance(columns, str) else list(columns)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def with_share(counts: DataFrame, measure: str, share: str, total: DataFrame | None = None) -> DataFrame:
    """Adds ``share``: percent of the grand total of ``measure`` (or of a one-value ``total``)."""
    whole = counts.agg(F.sum(measure)) if total is None else total
    return counts.withColumn(share, share_of(F.col(measure), whole.scalar()))


def value_shares(
    df: DataFrame, columns: str | Sequence[str], count: str = "n", share: str = "pct"
) -> DataFrame:
    """Rows per value and their percent of all rows, most frequent first."""
    names = [columns] if isinstance(columns, str) else list(columns)
    counts = with_share(value_counts(df, names, count), count, share)
    return counts.orderBy(F.col(count).desc(), *names)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows of an order: each task keeps k rows, no full sort."""
    return df.orderBy(*order).limit(k)


def arg_max(measure: str, picked: str, tie: str) -> Column:
    """Aggregate: ``picked`` from the row with the highest ``measure``; lowest ``tie`` among equals."""
    return F.min_by(F.col(picked), F.struct(-F.col(measure), F.col(tie)))
