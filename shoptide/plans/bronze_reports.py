"""Profiles of the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import category_root
from shoptide.operators.profiles import null_profile
from shoptide.operators.shares import share_of, top_k, value_counts, with_share


def event_dist(raw: DataFrame) -> DataFrame:
    """Rows per event type, nulls left out, in percent of all rows."""
    counts = with_share(value_counts(raw, "event_type"), "n", "pct")
    counts = counts.where(F.col("event_type").isNotNull())
    return counts.orderBy(F.col("n").desc(), "event_type")


def time_range(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("event_time").alias("min_time"), F.max("event_time").alias("max_time"))


def top_values(raw: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Most frequent values, nulls left out."""
    known = raw.where(F.col(column).isNotNull())
    return top_k(value_counts(known, column), k, F.col("n").desc(), column)


def value_examples(raw: DataFrame, column: str, k: int = 10) -> DataFrame:
    """First k distinct values in order, nulls left out."""
    return top_k(raw.where(F.col(column).isNotNull()).select(column).distinct(), k, column)


def nulls_found(raw: DataFrame, digits: int = 2) -> DataFrame:
    """Columns that have nulls, percent rounded."""
    found = null_profile(raw).where(F.col("null_rows") > 0)
    return found.withColumn("pct_null", F.round("pct_null", digits))


def invalid_prices(raw: DataFrame) -> DataFrame:
    price = F.col("price")
    counts = raw.agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(price == 0).alias("zero_rows"),
        F.count_if(price < 0).alias("negative_rows"),
        F.count_if((price > 0) & ~F.isnan(price)).alias("valid_rows"),
    )
    return counts.withColumns(
        {
            f"pct_{kind}": share_of(F.col(f"{kind}_rows"), F.col("all_rows"))
            for kind in ("zero", "negative", "valid")
        }
    )


def zero_price_examples(raw: DataFrame, k: int = 5) -> DataFrame:
    """The first k rows with a price of zero, by event key."""
    zero = raw.where(F.col("price") == 0)
    few = top_k(zero, k, "user_id", "product_id", "event_type", "event_time", "brand")
    return few.select("event_time", "event_type", "product_id", "brand", "price")


def duplicate_examples(raw: DataFrame, k: int = 10) -> DataFrame:
    """The first k members of duplicate groups, by event key.

    Each group has two members at least, so k rows come from the first k groups: those few are
    broadcast to the rows.
    """
    key = [c for c in fixed.EVENT_KEY if c != "event_time"]
    second = F.date_trunc("second", "event_time")
    groups = raw.groupBy(*(F.col(c).alias(f"group_{c}") for c in key), second.alias("group_second"))
    repeated = groups.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    order = [f"group_{c}" for c in key] + ["group_second"]
    few = F.broadcast(top_k(repeated, k, *order))
    same = second.eqNullSafe(F.col("group_second"))
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"group_{c}"))
    members = raw.join(few, same).select("event_time", "event_type", "product_id", "user_id", "price")
    return top_k(members, k, "user_id", "product_id", "event_type", "event_time", "price")


def _root_counts(raw: DataFrame) -> DataFrame:
    return value_counts(raw.select(category_root(F.col("category_code")).alias("category_l1")), "category_l1")


def category_root_dist(raw: DataFrame, k: int = 15) -> DataFrame:
    """Most frequent first-level categories, a missing code counting as Unknown."""
    counts = with_share(_root_counts(raw), "n", "pct")
    return top_k(counts, k, F.col("n").desc(), "category_l1")


def rarest_category_roots(raw: DataFrame, k: int = 10) -> DataFrame:
    return top_k(_root_counts(raw), k, "n", "category_l1")


def quality_verdicts(raw: DataFrame) -> DataFrame:
    """Graded duplicates, bad prices and number of categories: one row per check, all from one scan.

    Rows are grouped once by the key that makes duplicates; bad prices add up over the groups, and the
    first category levels of a group (one, as a rule) are merged over all groups: few values, whatever
    the number of rows.
    """
    key = [c for c in fixed.EVENT_KEY if c != "event_time"]
    price, n = F.col("price"), F.col("n")
    groups = raw.groupBy(*key, F.date_trunc("second", "event_time").alias("second")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(price == 0).alias("zero"),
        F.count_if(price < 0).alias("negative"),
        F.collect_set(category_root(F.col("category_code"))).alias("roots"),
    )
    found = groups.groupBy("roots").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("repeated"),
        F.sum("zero").alias("zero"),
        F.sum("negative").alias("negative"),
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum("zero"), F.lit(0)).alias("zero"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative"),
        F.size(F.array_distinct(F.flatten(F.collect_set("roots")))).alias("roots"),
    )
    duplicates = F.coalesce(F.try_divide(F.col("repeated"), n) * 100.0, F.lit(0.0))
    bad = share_of(F.col("zero"), n) + share_of(F.col("negative"), n)
    roots = F.col("roots")

    def verdict(check: str, value: Column, grade: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"), value.cast("double").alias("value"), grade.alias("verdict")
        )

    checks = [
        verdict(
            "duplicates_pct",
            duplicates,
            F.when(duplicates < fixed.DUPLICATES_FEW, "few")
            .when(duplicates < fixed.DUPLICATES_MODERATE, "moderate")
            .otherwise("significant"),
        ),
        verdict("bad_prices_pct", bad, F.when(bad < fixed.BAD_PRICES_FEW, "few").otherwise("filter")),
        verdict(
            "category_roots",
            roots,
            F.when(roots < fixed.CATEGORIES_CLEAN, "clean").otherwise("review"),
        ),
    ]
    return found.select(F.inline(F.array(*checks)))
