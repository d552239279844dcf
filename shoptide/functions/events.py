"""Expressions over one event row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed


def is_view() -> Column:
    return F.col("event_type") == fixed.VIEW


def is_cart() -> Column:
    return F.col("event_type") == fixed.CART


def is_purchase() -> Column:
    return F.col("event_type") == fixed.PURCHASE


def has_valid_price() -> Column:
    """A finite price above zero. NaN and infinity sort above every number in Spark."""
    price = F.col("price")
    return (price > 0) & (price < float("inf"))


def known_or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(fixed.UNKNOWN))


def category_level(code: Column, level: int) -> Column:
    """Level 1, 2, 3 ... of a dotted category code; null where the code is shorter."""
    return F.get(F.split(code, r"\."), level - 1)


def category_root(code: Column) -> Column:
    """First level of a raw category code, a missing code counting as Unknown."""
    return F.coalesce(F.substring_index(code, ".", 1), F.lit(fixed.UNKNOWN))


def stage_rank() -> Column:
    """How far one event takes its (user, product) pair: 2 purchase, 1 cart, 0 anything else."""
    return F.when(is_purchase(), 2).when(is_cart(), 1).otherwise(0)


def stage_label(rank: Column) -> Column:
    return (
        F.when(rank == 2, F.lit(fixed.PURCHASED))
        .when(rank == 1, F.lit(fixed.ADDED_TO_CART))
        .otherwise(F.lit(fixed.VIEWED_ONLY))
    )
