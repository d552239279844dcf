"""Calendar features, category levels and the funnel stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.functions import (
    category_level,
    day_part,
    is_cart,
    is_purchase,
    on_weekend,
    stage_label,
    stage_rank,
)


def enrich_temporal(df: DataFrame) -> DataFrame:
    """Adds hour, day_of_week (1 = Sunday), is_weekend and time_of_day."""
    hour, day_of_week = F.hour("event_time"), F.dayofweek("event_time")
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": day_of_week,
            "is_weekend": on_weekend(day_of_week),
            "time_of_day": day_part(hour),
        }
    )


def parse_categories(df: DataFrame) -> DataFrame:
    """Adds category_l1, category_l2 and category_l3; deeper levels are left in the code."""
    code = F.col("category_code")
    return df.withColumns({f"category_l{n}": category_level(code, n) for n in (1, 2, 3)})


def add_calendar_parts(df: DataFrame) -> DataFrame:
    """Adds the partition columns year, month and day."""
    time = F.col("event_time")
    return df.withColumns({"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)})


def funnel_pairs(df: DataFrame) -> DataFrame:
    """(user, product) pairs that reached the cart or a purchase, with the furthest stage.

    Pairs that were only viewed, nearly all of them, are not in the result. The aggregate combines
    inside each map task, so a busy pair costs one row per task.
    """
    reached = df.where(is_cart() | is_purchase())
    return reached.groupBy(
        F.col("user_id").alias("pair_user"), F.col("product_id").alias("pair_product")
    ).agg(F.max(stage_rank()).alias("pair_rank"))


def conversion_stage(df: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Stamps every row with the furthest stage its (user, product) pair reached.

    ``evidence`` holds the events that decide the stage (``df`` itself by default). Passing a frame
    from before deduplication gives the same stages, since copies of an event change no stage, and
    keeps the deduplication out of the second branch of the plan.

    This is an outer join to the few pairs that got beyond viewing, not a window over all pairs: a
    window puts a whole pair into one task, while AQE splits the events of a skewed pair over many
    join tasks. The null-safe keys make rows without a user or product one pair, as a grouping does,
    and give both sides a shuffle of their own, which AQE needs to split one.
    """
    pairs = funnel_pairs(df if evidence is None else evidence)
    same_pair = F.col("user_id").eqNullSafe(F.col("pair_user")) & F.col("product_id").eqNullSafe(
        F.col("pair_product")
    )
    stamped = df.join(pairs, same_pair, "left")
    return stamped.select(
        *(F.col(c) for c in df.columns), stage_label(F.col("pair_rank")).alias("conversion_stage")
    )
