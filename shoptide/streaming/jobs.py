"""Streaming forms of the transforms and facts. Each takes and returns a streaming frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import hour_band, stage_label, stage_rank
from shoptide.operators.cleaning import fill_unknown, keep_valid_prices
from shoptide.operators.enrichment import add_calendar_parts, enrich_temporal, parse_categories
from shoptide.operators.metrics import fact

WINDOW_MEASURES = (
    "total_events", "unique_users", "unique_sessions", "total_views", "total_carts",
    "total_purchases", "total_revenue", "avg_price", "avg_order_value", "conversion_rate",
    "cart_abandonment_rate", "events_per_user",
)


def silver_rows(stream: DataFrame) -> DataFrame:
    """What Silver knows about a row by itself: valid prices, labels, calendar, categories.

    No state. Without the funnel stage, which later events revise (see ``running_stage``).
    """
    return (
        stream.transform(keep_valid_prices)
        .transform(fill_unknown)
        .transform(enrich_temporal)
        .transform(parse_categories)
        .transform(add_calendar_parts)
    )


def dedup(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per event key. A copy is recognised while it arrives within ``delay``."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        list(fixed.EVENT_KEY)
    )


def _windowed(stream: DataFrame, window: Column, delay: str | None) -> DataFrame:
    timed = stream if delay is None else stream.withWatermark("event_time", delay)
    # Streams cannot count distincts exactly: users and sessions per window are approximate.
    measured = fact(timed, [window.alias("window")], WINDOW_MEASURES, exact=False)
    return measured.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *WINDOW_MEASURES,
    )


def hourly_windows(stream: DataFrame, delay: str | None = "10 minutes") -> DataFrame:
    """The hourly measures per clock hour, with the band of the day.

    ``delay=None`` keeps a watermark set before, as by ``dedup``.
    """
    hours = _windowed(stream, F.window("event_time", "1 hour"), delay)
    return hours.withColumn("time_of_day", hour_band(F.hour("window_start")))


def sliding_traffic(
    stream: DataFrame,
    length: str = "1 hour",
    step: str = "15 minutes",
    delay: str | None = "10 minutes",
) -> DataFrame:
    """The same measures over overlapping windows, to see a spike while it builds."""
    return _windowed(stream, F.window("event_time", length, step), delay)


def user_sessions(
    stream: DataFrame, gap: str = "30 minutes", delay: str | None = "10 minutes"
) -> DataFrame:
    """Visits: runs of events of a user without a pause longer than ``gap``."""
    timed = stream if delay is None else stream.withWatermark("event_time", delay)
    visits = timed.groupBy("user_id", F.session_window("event_time", gap).alias("visit")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == fixed.PURCHASE).alias("total_purchases"),
    )
    return visits.select(
        "user_id",
        F.col("visit.start").alias("visit_start"),
        F.col("visit.end").alias("visit_end"),
        "total_events",
        "total_purchases",
    )


def running_stage(stream: DataFrame) -> DataFrame:
    """Furthest stage so far per (user, product); for update or complete output.

    Keeps one small value per pair for good. ``funnel_state.expiring_stage`` forgets idle pairs.
    """
    ranks = stream.groupBy("user_id", "product_id").agg(F.max(stage_rank()).alias("rank"))
    return ranks.select("user_id", "product_id", stage_label(F.col("rank")).alias("conversion_stage"))
