"""One list of base measures and ratios; every fact table is a choice from it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions import (
    average_money,
    is_cart,
    is_purchase,
    is_view,
    safe_ratio,
    total_money,
)

# Base measures over events. Built when asked for: expressions need a live session.
MEASURES: dict[str, Callable[[], Column]] = {
    "total_events": lambda: F.count(F.lit(1)),
    "total_views": lambda: F.count_if(is_view()),
    "total_carts": lambda: F.count_if(is_cart()),
    "total_purchases": lambda: F.count_if(is_purchase()),
    "total_revenue": lambda: total_money(F.col("price"), where=is_purchase()),
    "avg_price": lambda: average_money(F.col("price")),
}

# Distinct counts over events: measure name to counted column.
DISTINCTS = {
    "unique_users": "user_id",
    "unique_sessions": "user_session",
    "unique_products": "product_id",
}


@dataclass(frozen=True)
class Ratio:
    """``numerator / denominator * scale`` over finished measures, 0 without a denominator."""

    numerator: str
    denominator: str
    scale: float = 1.0

    def column(self) -> Column:
        return safe_ratio(F.expr(self.numerator), F.col(self.denominator), self.scale)


RATIOS = {
    "avg_order_value": Ratio("total_revenue", "total_purchases"),
    "revenue_per_user": Ratio("total_revenue", "unique_users"),
    "events_per_user": Ratio("total_events", "unique_users"),
    "purchases_per_user": Ratio("total_purchases", "unique_users"),
    "conversion_rate": Ratio("total_purchases", "total_views", 100),
    "add_to_cart_rate": Ratio("total_carts", "total_views", 100),
    "cart_to_purchase_rate": Ratio("total_purchases", "total_carts", 100),
    # Not clamped: more purchases than carts make it negative.
    "cart_abandonment_rate": Ratio("total_carts - total_purchases", "total_carts", 100),
}


def _distinct(column: str, exact: bool) -> Column:
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def fact(
    events: DataFrame, keys: Sequence[str | Column], names: Sequence[str], exact: bool = True
) -> DataFrame:
    """Group ``events`` by ``keys`` and compute the named measures and ratios.

    Exact distinct counts shuffle (keys, value) tuples already combined per map task, so one huge
    day or category spreads over all tasks. ``exact=False`` counts distincts by HyperLogLog: one
    pass, no extra rows, and allowed on streams.
    """
    ratios = [n for n in names if n in RATIOS]
    base = [n for n in names if n not in RATIOS]
    aggregates = [
        (_distinct(DISTINCTS[n], exact) if n in DISTINCTS else MEASURES[n]()).alias(n) for n in base
    ]
    grouped = events.groupBy(*keys).agg(*aggregates)
    return grouped.withColumns({n: RATIOS[n].column() for n in ratios}) if ratios else grouped
