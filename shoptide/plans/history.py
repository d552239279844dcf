"""Dimensions that remember: versions of a product's attributes, and facts joined to the version of
their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions import category_level, is_purchase, money_total, total_money

ATTRIBUTES = ("category_code", "brand", "category_id")


def with_price_level(silver: DataFrame, step: float = 100.0) -> DataFrame:
    """Adds ``price_level``: whole steps in the price, an attribute that changes from day to day."""
    return silver.withColumn("price_level", F.floor(F.col("price") / step).cast("bigint"))


def dim_product_history(silver: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Each product's versions: product_id, version (from 1), valid_from, valid_to (the day the next
    one begins; null for the current), is_current and the attributes.

    A day has the attributes of its last event (the greatest values among events of one time); days that
    change nothing start no version, and a null is a value like others. Events are reduced to one row
    per product and day in the map tasks before a product's days are put in order, so a window partition
    has one row per day however often a product is seen. Rows without a product or a time are left out.
    """
    day = F.to_date("event_time").alias("valid_from")
    latest = F.max(F.struct("event_time", *attributes)).alias("latest")
    seen = silver.where(F.col("product_id").isNotNull() & F.col("event_time").isNotNull())
    days = seen.groupBy("product_id", day).agg(latest).select(
        "product_id", "valid_from", F.struct(*(F.col(f"latest.{a}") for a in attributes)).alias("state")
    )
    in_order = Window.partitionBy("product_id").orderBy("valid_from")
    before = F.lag("state").over(in_order)
    changed = days.withColumn("_new", ~before.eqNullSafe(F.col("state"))).where("_new")
    following = F.lead("valid_from").over(in_order)
    return changed.select(
        "product_id",
        F.row_number().over(in_order).alias("version"),
        "valid_from",
        following.alias("valid_to"),
        following.isNull().alias("is_current"),
        *(F.col(f"state.{a}").alias(a) for a in attributes),
    )


def as_of(facts: DataFrame, history: DataFrame, key: str = "product_id", day: str = "date") -> DataFrame:
    """The facts with the columns of the version that is valid on their day; null for days before the
    first version. ``facts`` should hold few rows per key and day.

    Versions and facts of a key are put in the order of time, and each fact takes the last version seen:
    one shuffle on the key, no join by ranges. Keep the facts summed per key and day, so that a
    partition grows with days and not with events.
    """
    taken = [c for c in history.columns if c not in (key, "valid_from")]
    versions = history.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_day"), F.lit(0).alias("_kind"),
        F.struct(*taken).alias("_version"),
    )
    rows = facts.select(
        F.col(key).alias("_key"), F.col(day).alias("_day"), F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"),
    )
    until_now = Window.partitionBy("_key").orderBy("_day", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    both = versions.unionByName(rows, allowMissingColumns=True)
    known = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(until_now))
    return known.where("_kind = 1").select("_fact.*", *(F.col(f"_seen.{c}").alias(c) for c in taken))


def star_revenue_as_of(silver: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Purchases and revenue per first category level and further attributes of the product version that
    was valid on the day of the sale."""
    sales = silver.where(is_purchase()).groupBy("product_id", F.to_date("event_time").alias("date")).agg(
        F.count(F.lit(1)).alias("purchases"), total_money(F.col("price")).alias("revenue")
    )
    sold = as_of(sales, dim_product_history(silver, attributes))
    others = [a for a in attributes if a not in ("category_code", "category_id")]
    level = category_level(F.col("category_code"), 1).alias("category_l1")
    return sold.groupBy(level, *others).agg(
        F.sum("purchases").alias("total_purchases"), money_total(F.col("revenue")).alias("total_revenue")
    )
