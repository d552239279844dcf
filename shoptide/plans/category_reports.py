"""Business reports over the category fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions import money_total
from shoptide.operators.shares import arg_max, share_of, top_k

CATEGORY = "category_l1"


def category_overview(category: DataFrame) -> DataFrame:
    return category.select(
        CATEGORY, "total_purchases", "total_revenue", "conversion_rate", "avg_order_value",
        "cart_abandonment_rate",
    )


def _ranked(category: DataFrame, k: int, order: Column, *shown: str) -> DataFrame:
    return top_k(category.select(CATEGORY, *shown), k, order, CATEGORY)


def top_conversion(category: DataFrame, k: int = 10) -> DataFrame:
    return _ranked(
        category, k, F.col("conversion_rate").desc(),
        "conversion_rate", "total_views", "total_purchases", "total_revenue", "avg_order_value",
    )


def top_revenue(category: DataFrame, k: int = 10) -> DataFrame:
    return _ranked(
        category, k, F.col("total_revenue").desc(),
        "total_revenue", "pct_revenue", "total_purchases", "avg_order_value", "conversion_rate",
    )


def by_abandonment(category: DataFrame, highest: bool, k: int = 10) -> DataFrame:
    rate = F.col("cart_abandonment_rate")
    return _ranked(
        category, k, rate.desc() if highest else rate.asc(),
        "cart_abandonment_rate", "total_carts", "total_purchases", "conversion_rate",
    )


def top_order_value(category: DataFrame, k: int = 10) -> DataFrame:
    return _ranked(
        category, k, F.col("avg_order_value").desc(),
        "avg_order_value", "total_purchases", "total_revenue", "conversion_rate",
    )


def category_top3(category: DataFrame, k: int = 3) -> DataFrame:
    """Numbered best categories by conversion and by revenue."""
    shown = [
        CATEGORY, "conversion_rate", "total_views", "total_purchases", "total_revenue",
        "pct_revenue", "avg_order_value",
    ]

    def best(measure: str, label: str) -> DataFrame:
        few = top_k(category.select(*shown), k, F.col(measure).desc(), CATEGORY)
        # Numbers the k rows already picked.
        place = Window.partitionBy("ranking").orderBy(F.col(measure).desc(), CATEGORY)
        return few.withColumn("ranking", F.lit(label)).withColumn(
            "place", F.row_number().over(place)
        )

    return best("conversion_rate", "conversion").unionByName(best("total_revenue", "revenue"))


def best_overall(category: DataFrame) -> DataFrame:
    """The category with the highest product of conversion and revenue."""
    shown = category.select(
        CATEGORY, "conversion_rate", "total_revenue", "avg_order_value", "cart_abandonment_rate"
    )
    return top_k(shown, 1, (F.col("conversion_rate") * F.col("total_revenue")).desc(), CATEGORY)


def category_overall(category: DataFrame) -> DataFrame:
    return category.agg(
        F.count(F.lit(1)).alias("total_categories"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
        F.avg("cart_abandonment_rate").alias("avg_cart_abandonment_rate"),
        F.avg("avg_order_value").alias("avg_order_value"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
        F.sum("total_purchases").alias("total_purchases"),
    )


def category_totals(category: DataFrame) -> DataFrame:
    return category.agg(
        F.sum("total_purchases").alias("total_purchases"),
        money_total(F.col("total_revenue")).alias("total_revenue"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )


def category_winners(category: DataFrame) -> DataFrame:
    """Best category by conversion, by revenue and by order value, in one row."""
    return category.agg(
        arg_max("conversion_rate", CATEGORY, tie=CATEGORY).alias("conversion_category"),
        F.max("conversion_rate").alias("conversion_rate"),
        arg_max("total_revenue", CATEGORY, tie=CATEGORY).alias("revenue_category"),
        F.max("total_revenue").alias("total_revenue"),
        arg_max("avg_order_value", CATEGORY, tie=CATEGORY).alias("order_value_category"),
        F.max("avg_order_value").alias("avg_order_value"),
    )


def top_category_share(category: DataFrame, k: int = 5) -> DataFrame:
    """The best k by revenue, with their part of the k's revenue next to that of all revenue."""
    few = top_revenue(category, k)
    total = few.agg(money_total(F.col("total_revenue"))).scalar()
    return few.select(
        CATEGORY,
        F.initcap(CATEGORY).alias("label"),
        "total_revenue",
        "conversion_rate",
        share_of(F.col("total_revenue"), total).alias("pct_of_top"),
        "pct_revenue",
    ).orderBy(F.col("total_revenue").desc(), CATEGORY)
