"""From raw events to valid, unique events. Every step is lazy and fits ``DataFrame.transform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import has_valid_price, known_or_unknown


def keep_valid_prices(df: DataFrame) -> DataFrame:
    """Rows with a price above zero; null and NaN prices fall out."""
    return df.where(has_valid_price())


def fill_unknown(df: DataFrame) -> DataFrame:
    """Missing brands and category codes become "Unknown"."""
    targets = [c for c in ("brand", "category_code") if c in df.columns]
    return df.withColumns({c: known_or_unknown(c) for c in targets})


def _nulls_last(df: DataFrame, name: str) -> list[Column]:
    value = F.col(name).alias(name)
    nullable = df.schema[name].nullable
    return [F.col(name).isNull().alias(f"{name}_missing"), value] if nullable else [value]


def dedup_events(df: DataFrame, key: tuple[str, ...] = fixed.EVENT_KEY) -> DataFrame:
    """One row per event key, and the same one on every run.

    The survivor is the lowest row by ``TIE_ORDER`` (nulls last), then by any further column. It is
    an aggregate, not a window: copies collapse inside each map task, so a key that holds a large
    part of all rows sends one row per task to the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    order = [c for c in fixed.TIE_ORDER if c in rest]
    order += [c for c in rest if c not in order]
    if not order:
        return df.dropDuplicates(list(key))
    parts = [part for c in order for part in _nulls_last(df, c)]
    best = df.groupBy(*key).agg(F.min(F.struct(*parts)).alias("_best"))
    return best.select(*(F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns))


def clean(df: DataFrame) -> DataFrame:
    """Valid prices, known brands and categories, one row per event."""
    return df.transform(keep_valid_prices).transform(fill_unknown).transform(dedup_events)


def clean_needed(df: DataFrame, *needed: str) -> DataFrame:
    """``clean``, carrying only what ``needed`` columns take.

    The survivor is the lowest row in dictionary order, so its leading tie columns do not depend on
    the trailing ones: everything after the last needed tie column is left out of the shuffle.
    """
    ties = [c for c in fixed.TIE_ORDER if c in df.columns]
    last = max((ties.index(c) for c in needed if c in ties), default=-1)
    # The price decides which rows are valid, and is part of the order from its place on.
    keep = set(fixed.EVENT_KEY) | set(ties[: max(last, ties.index("price")) + 1]) | set(needed)
    return clean(df.select(*(c for c in df.columns if c in keep)))


def clean_audit(df: DataFrame) -> DataFrame:
    """What ``clean`` removes and why, in one pass and without running it."""
    valid = has_valid_price()
    counts = df.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(valid).alias("valid_rows"),
        # A struct keeps keys with a null part apart from rows outside the filter.
        F.count_distinct(F.when(valid, F.struct(*fixed.EVENT_KEY))).alias("final_rows"),
    )
    removed = F.col("initial_rows") - F.col("final_rows")
    return counts.select(
        "initial_rows",
        (F.col("initial_rows") - F.col("valid_rows")).alias("removed_by_price"),
        (F.col("valid_rows") - F.col("final_rows")).alias("removed_as_duplicates"),
        "final_rows",
        removed.alias("removed_rows"),
        F.coalesce(F.try_divide(removed, F.col("initial_rows")) * 100.0, F.lit(0.0)).alias(
            "pct_removed"
        ),
    )
