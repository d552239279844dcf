"""The fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import (
    calendar_date,
    hour_band,
    on_weekend,
    money_total,
)
from shoptide.operators.metrics import DISTINCTS, MEASURES, RATIOS, fact
from shoptide.operators.shares import share_of
from shoptide.schemas import GOLD_CATEGORY, GOLD_DAILY, GOLD_HOURLY


def _measured(names: list[str]) -> list[str]:
    return [n for n in names if n in MEASURES or n in DISTINCTS or n in RATIOS]


def _with_day_columns(df: DataFrame) -> DataFrame:
    date = calendar_date()
    day_of_week = F.dayofweek(date)
    return df.withColumns(
        {"date": date, "day_of_week": day_of_week, "is_weekend": on_weekend(day_of_week)}
    )


def gold_daily(silver: DataFrame, exact: bool = True, ordered: bool = True) -> DataFrame:
    """One row per day, in date order. Reports that aggregate further need no order."""
    days = fact(silver, ["year", "month", "day"], _measured(GOLD_DAILY.names), exact)
    table = days.transform(_with_day_columns).select(*GOLD_DAILY.names)
    return table.orderBy("date") if ordered else table


def gold_hourly(silver: DataFrame, exact: bool = True, ordered: bool = True) -> DataFrame:
    """One row per day and hour, in time order."""
    keys = ["year", "month", "day", F.hour("event_time").alias("hour")]
    hours = fact(silver, keys, _measured(GOLD_HOURLY.names), exact)
    table = (
        hours.transform(_with_day_columns)
        .withColumn("time_of_day", hour_band(F.col("hour")))
        .select(*GOLD_HOURLY.names)
    )
    return table.orderBy("date", "hour") if ordered else table


def with_category(
    silver: DataFrame, exclude: tuple[str, ...] = fixed.EXCLUDED_CATEGORIES
) -> DataFrame:
    """Rows with a category; the comparison is case-sensitive, so "Unknown" stays."""
    category = F.col("category_l1")
    return silver.where(category.isNotNull() & ~category.isin(*exclude))


def gold_category(
    silver: DataFrame,
    exact: bool = True,
    ordered: bool = True,
    exclude: tuple[str, ...] = fixed.EXCLUDED_CATEGORIES,
) -> DataFrame:
    """One row per first-level category, highest revenue first."""
    rows = with_category(silver, exclude)
    categories = fact(rows, ["category_l1"], _measured(GOLD_CATEGORY.names), exact)
    # Summed over the categories, not over the events: money is exact.
    totals = categories.agg(
        F.struct(
            money_total(F.col("total_revenue")).alias("revenue"),
            F.sum("total_purchases").alias("purchases"),
        )
    ).scalar()
    shares = {
        "pct_revenue": share_of(F.col("total_revenue"), totals.getField("revenue")),
        "pct_purchases": share_of(F.col("total_purchases"), totals.getField("purchases")),
    }
    table = categories.withColumns(shares).select(*GOLD_CATEGORY.names)
    return table.orderBy(F.col("total_revenue").desc(), "category_l1") if ordered else table


PERIOD_FACT = [
    n for n in GOLD_DAILY.names if n in MEASURES or n in DISTINCTS or n in RATIOS
]


def gold_period(silver: DataFrame, unit: str, exact: bool = True) -> DataFrame:
    """The daily measures per ``week`` (Monday first) or ``month``.

    Counted from events: distinct users of a week are not the sum of its days.
    """
    start = F.date_trunc(unit, F.col("event_time")).cast("date").alias(f"{unit}_start")
    return fact(silver, [start], PERIOD_FACT, exact).orderBy(f"{unit}_start")
