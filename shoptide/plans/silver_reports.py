"""Quality and distribution reports over Silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import calendar_date, change_pct, date_text, is_purchase
from shoptide.operators.cleaning import clean_audit
from shoptide.operators.profiles import distinct_values
from shoptide.operators.shares import share_of, top_k, value_counts, value_shares, with_share
from shoptide.plans.periods import NOVEMBER, OCTOBER, Period, period_label


def records_by_month(silver: DataFrame) -> DataFrame:
    return value_counts(silver, ["year", "month"], "records").orderBy("year", "month")


def records_by_day(silver: DataFrame) -> DataFrame:
    return value_counts(silver, ["year", "month", "day"], "records").orderBy("year", "month", "day")


def busiest_days(silver: DataFrame, k: int = 10) -> DataFrame:
    days = value_counts(silver, ["year", "month", "day"], "records")
    shown = days.select(date_text(calendar_date()).alias("date"), "records")
    return top_k(shown, k, F.col("records").desc(), "date")


def event_type_dist(silver: DataFrame) -> DataFrame:
    return value_shares(silver, "event_type")


def stage_dist(silver: DataFrame) -> DataFrame:
    return value_shares(silver, "conversion_stage")


def time_of_day_dist(silver: DataFrame) -> DataFrame:
    return value_shares(silver, "time_of_day")


def weekend_share(silver: DataFrame) -> DataFrame:
    return value_shares(silver, "is_weekend")


def top_categories(silver: DataFrame, k: int = 10) -> DataFrame:
    counts = with_share(value_counts(silver, "category_l1"), "n", "pct")
    return top_k(counts, k, F.col("n").desc(), "category_l1")


def valid_category_share(silver: DataFrame) -> DataFrame:
    """Rows the category fact keeps."""
    category = F.col("category_l1")
    kept = F.coalesce(category.isNotNull() & ~category.isin(*fixed.EXCLUDED_CATEGORIES), F.lit(False))
    return silver.agg(
        F.count(F.lit(1)).alias("all_rows"), F.count_if(kept).alias("valid_rows")
    ).withColumn("pct_valid", share_of(F.col("valid_rows"), F.col("all_rows")))


def distinct_entities(silver: DataFrame) -> DataFrame:
    return distinct_values(
        silver,
        {"unique_users": "user_id", "unique_products": "product_id", "unique_brands": "brand"},
    )


def critical_nulls(silver: DataFrame, lists: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Nulls per critical column, for each of the column lists; one pass over the data."""
    if lists is None:
        lists = {
            "silver": fixed.CRITICAL_SILVER,
            "silver_short": fixed.CRITICAL_SILVER_SHORT,
            "pipeline": fixed.CRITICAL_PIPELINE,
        }
    columns = sorted({c for cols in lists.values() for c in cols})
    counts = silver.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = [
        F.struct(
            F.lit(label).alias("list_name"), F.lit(c).alias("column_name"), F.col(c).alias("null_rows")
        )
        for label, cols in lists.items()
        for c in cols
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn("is_clean", F.col("null_rows") == 0)


def month_traffic_change(
    silver: DataFrame, before: Period = OCTOBER, after: Period = NOVEMBER
) -> DataFrame:
    """Rows per period and the change in percent."""
    counts = silver.where(before.contains() | after.contains()).agg(
        F.count_if(before.contains()).alias("before_rows"),
        F.count_if(after.contains()).alias("after_rows"),
    )
    return counts.withColumns(
        {
            "direction": F.when(F.col("after_rows") > F.col("before_rows"), "more").otherwise("less"),
            "change_pct": F.abs(change_pct(F.col("before_rows"), F.col("after_rows"))),
        }
    )


def month_purchase_share(
    silver: DataFrame, before: Period = OCTOBER, after: Period = NOVEMBER
) -> DataFrame:
    """Purchases in percent of all events per period: not the fact's conversion rate."""
    return (
        silver.where(before.contains() | after.contains())
        .groupBy(period_label(before, after).alias("period"))
        .agg(F.count_if(is_purchase()).alias("purchases"), F.count(F.lit(1)).alias("all_rows"))
        .withColumn("purchase_share", share_of(F.col("purchases"), F.col("all_rows")))
    )


def partition_coverage(silver: DataFrame, expected: int = fixed.EXPECTED_DAYS) -> DataFrame:
    days = silver.select("year", "month", "day").distinct()
    return days.agg(F.count(F.lit(1)).alias("days_present")).select(
        "days_present",
        F.lit(expected).cast("bigint").alias("days_expected"),
        (F.lit(expected) - F.col("days_present")).alias("days_missing"),
        (F.col("days_present") == expected).alias("is_complete"),
    )


def missing_days(silver: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Dates from ``first`` to ``last`` without a row."""
    spark = silver.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date")
    )
    present = silver.select(calendar_date().alias("date")).distinct()
    return wanted.join(present, "date", "left_anti").orderBy("date")


def temporal_ranges(silver: DataFrame) -> DataFrame:
    return silver.agg(
        *(
            edge(c).alias(f"{name}_{c}")
            for c in ("hour", "day_of_week")
            for name, edge in (("min", F.min), ("max", F.max))
        )
    )


def category_depth(silver: DataFrame) -> DataFrame:
    """Rows by number of category levels; distinct values (null is one) and nulls per level."""
    l1, l2, l3 = (F.col(f"category_l{n}") for n in (1, 2, 3))
    unknown = l1 == fixed.UNKNOWN
    distinct = [
        (
            F.count_distinct(f"category_l{n}")
            + F.coalesce(F.max(F.col(f"category_l{n}").isNull().cast("bigint")), F.lit(0))
        ).alias(f"distinct_l{n}")
        for n in (1, 2, 3)
    ]
    # Counting rows per combination first leaves few rows for the distinct counts.
    combinations = silver.groupBy("category_l1", "category_l2", "category_l3").agg(
        F.count(F.lit(1)).alias("n")
    )

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0))

    return combinations.agg(
        rows(unknown).alias("unknown_rows"),
        rows(l2.isNull() & ~unknown).alias("one_level_rows"),
        rows(l2.isNotNull() & l3.isNull()).alias("two_level_rows"),
        rows(l3.isNotNull()).alias("three_level_rows"),
        *distinct,
        rows(l2.isNull()).alias("null_l2_rows"),
        rows(l3.isNull()).alias("null_l3_rows"),
    )


def category_paths(silver: DataFrame) -> DataFrame:
    return silver.select("category_code", "category_l1", "category_l2", "category_l3").distinct()


def event_by_stage(silver: DataFrame) -> DataFrame:
    keys = ["event_type", "conversion_stage"]
    return value_counts(silver, keys).orderBy(*keys)


def users_by_stage(silver: DataFrame) -> DataFrame:
    return silver.groupBy("conversion_stage").agg(F.count_distinct("user_id").alias("unique_users"))


def stage_consistency(silver: DataFrame) -> DataFrame:
    """Pairs with a purchase whose rows are not all marked as purchased: none, if all is well."""
    pairs = silver.groupBy("user_id", "product_id").agg(
        F.max(is_purchase()).alias("bought"),
        F.count_if(F.col("conversion_stage") != fixed.PURCHASED).alias("other_rows"),
    )
    broken = F.col("bought") & (F.col("other_rows") > 0)
    return pairs.agg(
        F.count_if(F.col("bought")).alias("buying_pairs"),
        F.count_if(broken).alias("violating_pairs"),
        F.coalesce(F.sum(F.when(broken, F.col("other_rows"))), F.lit(0)).alias("violating_rows"),
    )


def stage_examples(silver: DataFrame, k: int = 5) -> DataFrame:
    """The first k distinct rows of each stage.

    The number is limited inside each task before the shuffle, so a stage that holds most rows sends
    k rows per task.
    """
    shown = ["user_id", "product_id", "event_type", "conversion_stage"]
    place = Window.partitionBy("conversion_stage").orderBy("user_id", "product_id", "event_type")
    return (
        silver.select(*shown)
        .distinct()
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= k)
    )


def buyer_trail(silver: DataFrame) -> DataFrame:
    """All events of the first (user, product) pair with a purchase, in time order."""
    pair = top_k(
        silver.where(is_purchase()).select(
            F.col("user_id").alias("buyer"), F.col("product_id").alias("bought")
        ),
        1,
        "buyer",
        "bought",
    )
    same = F.col("user_id").eqNullSafe(F.col("buyer")) & F.col("product_id").eqNullSafe(F.col("bought"))
    # One row is broadcast.
    return (
        silver.join(F.broadcast(pair), same)
        .select("user_id", "product_id", "event_time", "event_type", "conversion_stage")
        .orderBy("event_time", "event_type")
    )


def column_growth(raw: DataFrame, silver_columns: Sequence[str]) -> DataFrame:
    """Rows and columns in and out of the Silver step; counts the result without building it."""
    before, after = len(raw.columns), len(silver_columns)
    return clean_audit(raw).select(
        F.col("initial_rows").alias("rows_in"),
        F.col("final_rows").alias("rows_out"),
        F.col("removed_rows").alias("rows_removed"),
        "pct_removed",
        F.lit(before).alias("columns_in"),
        F.lit(after).alias("columns_out"),
        F.lit(after - before).alias("columns_added"),
    )


def layer_summary(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("layer"), "total_rows")
        for name, df in layers.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result

