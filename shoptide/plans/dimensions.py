"""Sessions, dimensions and retention: announced for the tables, built from Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import (
    category_level,
    is_purchase,
    money_total,
    stage_label,
    stage_rank,
    total_money,
)


def session_duration(silver: DataFrame) -> DataFrame:
    """First and last event, whole seconds between them and events per session."""
    sessions = silver.where(F.col("user_session").isNotNull()).groupBy("user_session").agg(
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("ended_at"),
        F.count(F.lit(1)).alias("total_events"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return sessions.withColumn("duration_seconds", seconds)


def conversion_paths(silver: DataFrame) -> DataFrame:
    """Sessions per order in which event types first occur, such as ``view>cart>purchase``.

    A session is reduced to the first time of each type, so a session of any length takes a fixed
    number of values and combines inside the map tasks.
    """
    types = (fixed.VIEW, fixed.CART, fixed.PURCHASE)
    firsts = silver.where(F.col("user_session").isNotNull()).groupBy("user_session").agg(
        *(F.min(F.when(F.col("event_type") == t, F.col("event_time"))).alias(f"{t}_at") for t in types)
    )
    steps = F.array(
        *(
            F.struct(F.col(f"{t}_at").alias("at"), F.lit(i).alias("rank"), F.lit(t).alias("type"))
            for i, t in enumerate(types)
        )
    )
    taken = F.sort_array(F.filter(steps, lambda s: s["at"].isNotNull()))
    path = F.array_join(F.transform(taken, lambda s: s["type"]), ">")
    return firsts.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("sessions"))


def session_paths(silver: DataFrame) -> DataFrame:
    """Sessions per ordered list of all their events, such as ``view>cart>view>purchase``.

    Events at one time go by their order in the funnel, then by name; a missing type is ``Unknown``.
    Equal steps are counted in the map tasks, and a session is put together from its hours, so that the
    events of a long session spread over many tasks and only its path is in one.
    """
    types = F.array(*(F.lit(t) for t in (fixed.VIEW, fixed.CART, fixed.PURCHASE)))
    step = F.coalesce("event_type", F.lit(fixed.UNKNOWN)).alias("step")
    steps = silver.where(F.col("user_session").isNotNull()).groupBy("user_session", "event_time", step).agg(
        F.count(F.lit(1)).cast("int").alias("n")
    )
    known = F.array_position(types, F.col("step"))
    rank = F.when(known > 0, known).otherwise(F.size(types) + 1).alias("rank")
    hour = F.date_trunc("hour", "event_time").alias("hour")
    hours = steps.groupBy("user_session", hour).agg(
        F.sort_array(F.collect_list(F.struct("event_time", rank, "step", "n"))).alias("steps")
    )
    said = F.transform("steps", lambda s: F.repeat(F.concat(F.lit(">"), s["step"]), s["n"]))
    parts = hours.select("user_session", F.struct("hour", F.array_join(said, "").alias("part")).alias("part"))
    sessions = parts.groupBy("user_session").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    path = F.substr(F.array_join(F.col("parts.part"), ""), F.lit(2)).alias("path")
    return sessions.groupBy(path).agg(F.count(F.lit(1)).alias("sessions"))


def anomaly_sessions(silver: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Sessions whose number of events lies more than ``threshold`` deviations above the mean."""
    sessions = silver.where(F.col("user_session").isNotNull()).groupBy("user_session").agg(
        F.count(F.lit(1)).alias("total_events")
    )
    spread = sessions.agg(
        F.struct(
            F.avg("total_events").alias("mean"), F.stddev_samp("total_events").alias("std")
        )
    ).scalar()
    z = F.try_divide(F.col("total_events") - spread.getField("mean"), spread.getField("std"))
    return sessions.withColumn("z_score", z).where(F.col("z_score") > threshold)


def group_anomaly_sessions(silver: DataFrame, threshold: float = 3.5) -> DataFrame:
    """Sessions with unusually many events for their group: the hour of day they begin in and the
    furthest stage they reach.

    The robust z-score is ``0.6745 * (events - median) / mad`` with the group's median and the median of
    the distances from it, both exact and interpolated; where half of a group is equal, so that this is
    zero, the mean distance times 1.2533 / 0.6745 stands for it. Groups without any spread have no
    anomaly. Medians come from how often each number of events occurs, never from gathered sessions.
    """
    rank = F.max(stage_rank())
    sessions = silver.where(F.col("user_session").isNotNull()).groupBy("user_session").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.hour(F.min("event_time")).alias("start_hour"),
        stage_label(rank).alias("stage"),
    )
    group = ["start_hour", "stage"]
    counts = sessions.groupBy(*group, "total_events").agg(F.count(F.lit(1)).alias("n"))
    middle = _grouped_median(counts, group, "total_events", "median")
    apart = F.abs(F.col("total_events") - F.col("median"))
    distances = counts.join(middle, group).groupBy(*group, apart.alias("distance")).agg(F.sum("n").alias("n"))
    spread = _grouped_median(distances, group, "distance", "mad").join(
        distances.groupBy(*group).agg(
            (F.sum(F.col("distance") * F.col("n")) / F.sum("n")).alias("mean_distance")
        ),
        group,
    )
    scale = F.when(F.col("mad") > 0, F.col("mad") / 0.6745).otherwise(F.col("mean_distance") * 1.2533)
    scored = sessions.join(middle, group).join(spread, group).withColumn(
        "z_score", F.try_divide(F.col("total_events") - F.col("median"), scale)
    )
    return scored.where(F.col("z_score") > threshold).select(
        "user_session", *group, "total_events", "median", "mad", "z_score"
    )


def _grouped_median(counts: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """Median of each group from its values and how often they occur (``n``)."""
    # A window partition has one row per distinct value of a group.
    upward = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumns(
        {"_upto": F.sum("n").over(upward), "_all": F.sum("n").over(Window.partitionBy(*group))}
    )
    low = F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), F.col(value)))
    high = F.min(F.when(F.col("_upto") * 2 > F.col("_all"), F.col(value)))
    return placed.groupBy(*group).agg(((low + high) / 2).alias(name))


def negative_prices(raw: DataFrame) -> DataFrame:
    """Raw rows with a price below zero, by event type."""
    return raw.groupBy("event_type").agg(F.count_if(F.col("price") < 0).alias("negative_rows"))


def normalized_brands(silver: DataFrame) -> DataFrame:
    """Rows and spellings per brand, ignoring case and outer blanks."""
    spellings = silver.groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    return spellings.groupBy(F.lower(F.trim("brand")).alias("brand_key")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("spellings")
    )


def dim_product(silver: DataFrame) -> DataFrame:
    """Each product with the attributes of its latest event."""
    latest = F.max(F.struct("event_time", "category_code", "brand", "category_id"))
    products = silver.groupBy("product_id").agg(
        latest.alias("latest"), F.count(F.lit(1)).alias("total_events")
    )
    code = F.col("latest.category_code")
    return products.select(
        "product_id",
        F.col("latest.category_id").alias("category_id"),
        code.alias("category_code"),
        category_level(code, 1).alias("category_l1"),
        F.col("latest.brand").alias("brand"),
        "total_events",
    )


def dim_user(silver: DataFrame) -> DataFrame:
    return silver.groupBy("user_id").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(is_purchase()).alias("total_purchases"),
        total_money(F.col("price"), where=is_purchase()).alias("total_revenue"),
    )


def dim_category(silver: DataFrame) -> DataFrame:
    codes = silver.groupBy("category_code").agg(F.count(F.lit(1)).alias("total_events"))
    code = F.col("category_code")
    return codes.select(
        "category_code",
        *(category_level(code, n).alias(f"category_l{n}") for n in (1, 2, 3)),
        "total_events",
    )


def star_revenue(silver: DataFrame) -> DataFrame:
    """Revenue per category and brand of the product dimension.

    Purchases are summed per product before the join, so the join sees one row per product on both
    sides and a best-selling product is no hot key.
    """
    sales = silver.where(is_purchase()).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("purchases"), total_money(F.col("price")).alias("revenue")
    )
    products = dim_product(silver).select("product_id", "category_l1", "brand")
    return (
        sales.join(products, "product_id")
        .groupBy("category_l1", "brand")
        .agg(
            F.sum("purchases").alias("total_purchases"),
            money_total(F.col("revenue")).alias("total_revenue"),
        )
    )


def weekly_retention(silver: DataFrame) -> DataFrame:
    """Users of each first-active week that are active n weeks later."""
    week = F.date_trunc("week", F.col("event_time")).cast("date")
    active = silver.select("user_id", week.alias("week")).distinct()
    # A user has one row per week here: a window partition is at most the weeks of the data.
    cohort = F.min("week").over(Window.partitionBy("user_id"))
    weeks_later = (F.date_diff("week", "cohort_week") / 7).cast("int")
    return (
        active.withColumn("cohort_week", cohort)
        .groupBy("cohort_week", weeks_later.alias("weeks_later"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
