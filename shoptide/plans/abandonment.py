"""Carts that no purchase follows in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.functions import is_cart, is_purchase

CONVERTED, ABANDONED, OPEN = "converted", "abandoned", "open"


def cart_outcomes(silver: DataFrame, hours: int = 24) -> DataFrame:
    """Every cart event with ``outcome``: converted if its user buys the product at that time or up to
    ``hours`` later, abandoned if not, open if the data ends before the time is up.

    Time is cut into buckets of the waiting time, so a purchase in time lies in the cart's own bucket,
    not before it, or in the next one, not too late. The last purchase of the own and the first of the
    next bucket decide: two values per (user, product, bucket), combined in the map tasks, joined by
    equal keys. A pair with very many events is spread over its buckets; within one, AQE splits the
    carts, as purchases are a single row. Rows without a user, a product or a time are not compared
    with others: such a cart is never converted.
    """
    width = hours * 3600
    moment = F.unix_micros(F.col("event_time").cast("timestamp"))
    bucket = F.floor(moment / F.lit(width * 1_000_000)).cast("bigint")
    keys = ["user_id", "product_id", "bucket"]
    bought = silver.where(is_purchase()).select("user_id", "product_id", bucket.alias("bucket"), moment.alias("bought"))
    # Once for the carts of its own bucket, once for those of the bucket before.
    sides = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.col("bought").alias("own"), F.lit(None).cast("bigint").alias("next")),
        F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(None).cast("bigint").alias("own"), F.col("bought").alias("next")),
    )
    decisive = bought.select("user_id", "product_id", F.inline(sides)).groupBy(*keys).agg(
        F.max("own").alias("last_own"), F.min("next").alias("first_next")
    )
    carts = silver.where(is_cart()).withColumns({"bucket": bucket, "moment": moment})
    in_time = F.coalesce(F.col("last_own") >= F.col("moment"), F.lit(False)) | F.coalesce(
        F.col("first_next") <= F.col("moment") + width * 1_000_000, F.lit(False)
    )
    end = silver.agg(F.max(moment)).scalar()
    outcome = (
        F.when(in_time, CONVERTED)
        .when(F.col("moment") + width * 1_000_000 > end, OPEN)
        .otherwise(ABANDONED)
    )
    return carts.join(decisive, keys, "left").withColumn("outcome", outcome).select(*silver.columns, "outcome")


def abandoned_carts(silver: DataFrame, hours: int = 24) -> DataFrame:
    """Per day: cart events that were converted, abandoned and are still open, and the share of the
    decided ones that was abandoned (null where none is decided)."""
    counted = cart_outcomes(silver, hours).groupBy(F.to_date("event_time").alias("date")).agg(
        F.count(F.lit(1)).alias("total_carts"),
        *(F.count_if(F.col("outcome") == o).alias(f"{o}_carts") for o in (CONVERTED, ABANDONED, OPEN)),
    )
    decided = F.col("converted_carts") + F.col("abandoned_carts")
    return counted.withColumn("abandonment_pct", F.try_divide(F.col("abandoned_carts") * 100, decided))
