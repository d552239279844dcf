"""Business reports over the hourly fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import hour_band_rank, money_total
from shoptide.operators.shares import arg_max, share_of, top_k, with_share


def _pattern(hourly: DataFrame, key: str) -> DataFrame:
    return hourly.groupBy(key).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("total_views").alias("total_views"),
        F.sum("total_purchases").alias("total_purchases"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )


def hourly_pattern(hourly: DataFrame) -> DataFrame:
    """Traffic, purchases, revenue and mean conversion per hour of the day."""
    return _pattern(hourly, "hour").orderBy("hour")


def peak_hours(hourly: DataFrame) -> DataFrame:
    """The hour with the most traffic, the best mean conversion and the most revenue."""
    return _pattern(hourly, "hour").agg(
        arg_max("total_events", "hour", tie="hour").alias("traffic_hour"),
        F.max("total_events").alias("traffic_events"),
        arg_max("avg_conversion_rate", "hour", tie="hour").alias("conversion_hour"),
        F.max("avg_conversion_rate").alias("conversion_rate"),
        arg_max("total_revenue", "hour", tie="hour").alias("revenue_hour"),
        F.max("total_revenue").alias("revenue"),
    )


def _band_shares(hourly: DataFrame) -> DataFrame:
    bands = _pattern(hourly, "time_of_day")
    totals = hourly.agg(
        F.struct(F.sum("total_events").alias("events"), F.sum("total_purchases").alias("purchases"))
    ).scalar()
    return bands.withColumns(
        {
            "band_rank": hour_band_rank(F.col("time_of_day")),
            "pct_events": share_of(F.col("total_events"), totals.getField("events")),
            "pct_purchases": share_of(F.col("total_purchases"), totals.getField("purchases")),
        }
    )


def time_of_day_share(hourly: DataFrame) -> DataFrame:
    """Each band's part of traffic and purchases, in the order of the day."""
    return (
        _band_shares(hourly)
        .select(
            "time_of_day", "band_rank", "total_events", "pct_events", "total_purchases",
            "pct_purchases", "avg_conversion_rate", "total_revenue",
        )
        .orderBy("band_rank")
    )


def time_of_day_winners(hourly: DataFrame) -> DataFrame:
    """The band people browse in, buy in and convert best in; the earliest wins a tie."""

    def winner(measure: str) -> Column:
        return arg_max(measure, "time_of_day", tie="band_rank")

    return (
        _band_shares(hourly)
        .agg(
            winner("pct_events").alias("traffic_band"),
            F.max("pct_events").alias("traffic_pct"),
            winner("pct_purchases").alias("purchase_band"),
            F.max("pct_purchases").alias("purchase_pct"),
            winner("avg_conversion_rate").alias("conversion_band"),
            F.max("avg_conversion_rate").alias("conversion_rate"),
        )
        .withColumn("browse_and_buy_differ", F.col("traffic_band") != F.col("purchase_band"))
    )


def best_hours(hourly: DataFrame, weekend: bool, k: int = 5) -> DataFrame:
    """Hours of the best mean conversion on weekends or on weekdays."""
    hours = (
        hourly.where(F.col("is_weekend") == weekend)
        .groupBy("hour")
        .agg(
            F.avg("conversion_rate").alias("avg_conversion_rate"),
            F.sum("total_purchases").alias("total_purchases"),
        )
    )
    return top_k(hours, k, F.col("avg_conversion_rate").desc(), "hour")


def hourly_overall(hourly: DataFrame) -> DataFrame:
    return hourly.agg(
        F.count(F.lit(1)).alias("total_hours"),
        F.min("hour").alias("min_hour"),
        F.max("hour").alias("max_hour"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
        F.sum("total_events").alias("total_events"),
        F.sum("total_purchases").alias("total_purchases"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
    )


def _hour_shares(hourly: DataFrame, golden: Sequence[int]) -> DataFrame:
    hours = hourly.groupBy("hour").agg(
        F.sum("total_events").alias("total_events"),
        F.sum("total_purchases").alias("total_purchases"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )
    total = hourly.agg(F.sum("total_purchases"))
    return with_share(hours, "total_purchases", "pct_purchases", total).withColumn(
        "is_golden", F.col("hour").isin(*golden)
    )


def hourly_purchase_share(
    hourly: DataFrame, golden: Sequence[int] = fixed.GOLDEN_HOURS
) -> DataFrame:
    """Each hour's part of all purchases, the golden hours marked."""
    return _hour_shares(hourly, golden).orderBy("hour")


def golden_hours(hourly: DataFrame, golden: Sequence[int] = fixed.GOLDEN_HOURS) -> DataFrame:
    """What the golden hours add up to, next to the mean hour."""
    inside = F.col("is_golden")
    return _hour_shares(hourly, golden).agg(
        F.sum(F.when(inside, F.col("pct_purchases"))).alias("golden_pct_purchases"),
        F.avg(F.when(inside, F.col("avg_conversion_rate"))).alias("golden_avg_conversion_rate"),
        F.avg("pct_purchases").alias("mean_pct_purchases"),
        F.avg("avg_conversion_rate").alias("mean_conversion_rate"),
    )
