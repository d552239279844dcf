"""Business reports over the daily fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import change_pct, money_total
from shoptide.operators.shares import share_of, top_k
from shoptide.plans.periods import NOVEMBER, OCTOBER, Period, period_label


def _sides(before: Period, after: Period) -> list[tuple[str, Column]]:
    return [("before", before.contains()), ("after", after.contains())]


def _within(inside: Column, name: str) -> Column:
    return F.when(inside, F.col(name))


def period_compare(
    daily: DataFrame, before: Period = OCTOBER, after: Period = NOVEMBER
) -> DataFrame:
    """Both periods side by side in one row, with the change of traffic and conversion."""
    figures = []
    for side, inside in _sides(before, after):
        for name in ("total_events", "total_views", "total_purchases"):
            figures.append(F.sum(_within(inside, name)).alias(f"{side}_{name}"))
        figures += [
            money_total(_within(inside, "total_revenue")).alias(f"{side}_total_revenue"),
            F.avg(_within(inside, "conversion_rate")).alias(f"{side}_avg_conversion_rate"),
            # A sum of daily distinct users, not distinct users of the period.
            F.sum(_within(inside, "unique_users")).alias(f"{side}_sum_daily_unique_users"),
            F.avg(_within(inside, "events_per_user")).alias(f"{side}_avg_events_per_user"),
        ]
    traffic = change_pct(F.col("before_total_events"), F.col("after_total_events"))
    points = F.col("after_avg_conversion_rate") - F.col("before_avg_conversion_rate")
    return daily.agg(*figures).withColumns(
        {"traffic_change_pct": traffic, "conversion_change_points": points}
    )


def traffic_quality_flag(
    daily: DataFrame, before: Period = OCTOBER, after: Period = NOVEMBER
) -> DataFrame:
    """True where users did more events each while conversion fell."""
    both = period_compare(daily, before, after)
    busier = F.col("after_avg_events_per_user") > F.col("before_avg_events_per_user")
    fewer = F.col("after_avg_conversion_rate") < F.col("before_avg_conversion_rate")
    return both.select(
        busier.alias("events_per_user_rose"),
        fewer.alias("conversion_fell"),
        (busier & fewer).alias("low_quality_traffic"),
    )


def spike_days(
    daily: DataFrame, period: Period = NOVEMBER, days: Sequence[int] = fixed.SPIKE_DAYS
) -> DataFrame:
    return (
        daily.where(period.contains() & F.col("day").isin(*days))
        .select(
            "date", "total_events", "unique_users", "total_purchases", "conversion_rate",
            "total_revenue", "events_per_user",
        )
        .orderBy("date")
    )


def spike_impact(
    daily: DataFrame, period: Period = NOVEMBER, days: Sequence[int] = fixed.SPIKE_DAYS
) -> DataFrame:
    """What the spike days weigh in their period, and how far they rise above its daily mean."""
    spike = F.col("day").isin(*days)
    sums = daily.where(period.contains()).agg(
        F.sum(_within(spike, "total_events")).alias("spike_events"),
        F.sum(_within(spike, "total_purchases")).alias("spike_purchases"),
        money_total(_within(spike, "total_revenue")).alias("spike_revenue"),
        F.sum("total_events").alias("period_events"),
        F.count(F.lit(1)).alias("period_days"),
    )
    mean = F.try_divide(F.col("period_events"), F.col("period_days"))
    spike_mean = F.col("spike_events") / F.lit(len(days))
    return sums.select(
        "spike_events",
        "spike_purchases",
        "spike_revenue",
        "period_events",
        share_of(F.col("spike_events"), F.col("period_events")).alias("pct_of_period"),
        mean.alias("period_daily_events"),
        spike_mean.alias("spike_daily_events"),
        ((F.try_divide(spike_mean, mean) - 1) * 100.0).alias("uplift_pct"),
    )


def event_day(daily: DataFrame, period: Period = NOVEMBER, day: int = fixed.EVENT_DAY) -> DataFrame:
    return daily.where(period.contains() & (F.col("day") == day)).select(
        "date", "total_events", "total_purchases", "total_revenue", "conversion_rate"
    )


def top_days_traffic(daily: DataFrame, k: int = 10) -> DataFrame:
    shown = daily.select(
        "date", "total_events", "total_purchases", "conversion_rate", "total_revenue"
    )
    return top_k(shown, k, F.col("total_events").desc(), "date")


def top_days_revenue(daily: DataFrame, k: int = 10) -> DataFrame:
    shown = daily.select(
        "date", "total_revenue", "total_purchases", "conversion_rate", "total_events"
    )
    return top_k(shown, k, F.col("total_revenue").desc(), "date")


def daily_overall(daily: DataFrame) -> DataFrame:
    """Range of days, means of the daily rates, total revenue."""
    return daily.agg(
        F.count(F.lit(1)).alias("total_days"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
        F.avg("events_per_user").alias("avg_events_per_user"),
        F.avg("purchases_per_user").alias("avg_purchases_per_user"),
        F.avg("avg_order_value").alias("avg_order_value"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
    )


def weekend_vs_weekday(daily: DataFrame) -> DataFrame:
    return daily.groupBy("is_weekend").agg(
        F.avg("conversion_rate").alias("avg_conversion_rate"),
        F.avg("events_per_user").alias("avg_events_per_user"),
    )


def fact_totals(fact: DataFrame) -> DataFrame:
    """Totals of a fact table that holds the additive measures."""
    return fact.agg(
        F.sum("total_events").alias("total_events"),
        F.sum("total_purchases").alias("total_purchases"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )


def monthly_rollup(
    daily: DataFrame, before: Period = OCTOBER, after: Period = NOVEMBER
) -> DataFrame:
    """Each period's sums and mean conversion, and their relative change from the first period."""
    periods = (
        daily.withColumn("period", period_label(before, after))
        .where(F.col("period").isNotNull())
        .groupBy("period")
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("total_purchases").alias("total_purchases"),
            money_total(F.col("total_revenue")).alias("total_revenue"),
            F.avg("conversion_rate").alias("avg_conversion_rate"),
        )
    )
    base = (
        periods.where(F.col("period") == before.label)
        .select(
            F.struct(
                F.col("total_events").alias("events"), F.col("avg_conversion_rate").alias("rate")
            )
        )
        .scalar()
    )
    traffic = F.try_divide(F.col("total_events"), base.getField("events"))
    conversion = F.try_divide(F.col("avg_conversion_rate"), base.getField("rate"))
    return periods.withColumns(
        {
            "traffic_change_pct": (traffic - 1) * 100.0,
            "conversion_change_pct": (conversion - 1) * 100.0,
        }
    )


def revenue_series(
    daily: DataFrame,
    period: Period = NOVEMBER,
    days: Sequence[int] = fixed.SPIKE_DAYS,
    day: int = fixed.EVENT_DAY,
) -> DataFrame:
    """Daily revenue of a period with its spike days, event day and best day marked."""
    rows = daily.where(period.contains())
    best = top_k(rows, 1, F.col("total_revenue").desc(), "date").select("date").scalar()
    return rows.select(
        "date",
        "day",
        "total_revenue",
        F.col("day").isin(*days).alias("is_spike_day"),
        (F.col("day") == day).alias("is_event_day"),
        (F.col("date") == best).alias("is_best_day"),
    ).orderBy("date")


def revenue_peaks(
    daily: DataFrame,
    period: Period = NOVEMBER,
    days: Sequence[int] = fixed.SPIKE_DAYS,
    day: int = fixed.EVENT_DAY,
) -> DataFrame:
    """Best day, spike and event day of a period in one row."""
    spike = F.col("day").isin(*days)
    return (
        daily.where(period.contains())
        .agg(
            F.min_by("date", F.struct(-F.col("total_revenue"), F.col("date"))).alias("best_date"),
            F.max("total_revenue").alias("best_revenue"),
            money_total(_within(spike, "total_revenue")).alias("spike_revenue"),
            money_total(_within(F.col("day") == day, "total_revenue")).alias("event_day_revenue"),
            money_total(F.col("total_revenue")).alias("period_revenue"),
        )
        .withColumn(
            "spike_pct_of_period", share_of(F.col("spike_revenue"), F.col("period_revenue"))
        )
    )
