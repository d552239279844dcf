"""Abandoned carts while they happen: two topics joined within a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def abandoned_cart_stream(
    carts: DataFrame, purchases: DataFrame, hours: int = 24, delay: str | None = "10 minutes"
) -> DataFrame:
    """Cart events that no purchase of their user and product follows within ``hours``: user_id,
    product_id, cart_time. For append output; both streams carry ``event_time``.

    An outer join with a time bound: a cart waits in the state until the watermark of both streams has
    passed its time, and is given out once if nothing came, never if something did. A purchase is kept
    only while a cart could still reach it. Events later than ``delay`` behind their stream are dropped,
    as everywhere with watermarks. Carts whose time is not up stay in the state: they are open.

    ``delay=None`` keeps watermarks set before, as by ``jobs.dedup``.
    """
    if delay is not None:
        carts, purchases = (s.withWatermark("event_time", delay) for s in (carts, purchases))
    waiting = carts.select("user_id", "product_id", F.col("event_time").alias("cart_time"))
    bought = purchases.select(
        F.col("user_id").alias("buyer"), F.col("product_id").alias("bought"),
        F.col("event_time").alias("purchase_time"),
    )
    in_time = (
        (F.col("user_id") == F.col("buyer"))
        & (F.col("product_id") == F.col("bought"))
        & (F.col("purchase_time") >= F.col("cart_time"))
        & (F.col("purchase_time") <= F.col("cart_time") + F.expr(f"interval {int(hours)} hours"))
    )
    joined = waiting.join(bought, in_time, "leftOuter")
    return joined.where(F.col("purchase_time").isNull()).select("user_id", "product_id", "cart_time")
