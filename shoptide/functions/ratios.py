"""Ratios that never divide by zero: ANSI mode raises on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale``, and 0 where the denominator is not above zero."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if scale != 1.0:
        ratio = ratio * F.lit(float(scale))
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def change_pct(before: Column, after: Column) -> Column:
    """Change from ``before`` to ``after`` in percent of ``before``; null without a ``before``."""
    return F.try_divide((after - before).cast("double"), before.cast("double")) * F.lit(100.0)
