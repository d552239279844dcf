"""Money is summed in whole units of a fixed scale: the same total whatever the order of the rows.

A sum of doubles depends on the order in which tasks finish. Totals count whole cents, means count
millionths, so that prices below a cent are not rounded away; both are bigints and need no decimal
object per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


CENTS, MILLIONTHS = 100, 1_000_000


def _units(price: Column, scale: int) -> Column:
    """Whole units of a price; NaN and infinite prices count as missing."""
    return F.when(F.abs(price) < float("inf"), F.rint(price * scale).cast("bigint"))


def total_money(price: Column, where: Column | None = None) -> Column:
    """Exact sum of prices in dollars; rows outside ``where`` add nothing."""
    cents = _units(price, CENTS)
    return F.sum(cents if where is None else F.when(where, cents).otherwise(0)) / F.lit(100.0)


def average_money(price: Column) -> Column:
    """Mean of the prices that are there, in dollars."""
    units = _units(price, MILLIONTHS)
    return F.try_divide(F.sum(units) / F.lit(float(MILLIONTHS)), F.count(units))


def money_total(total: Column) -> Column:
    """Exact sum over a fact's money column, whose values are whole cents already."""
    return F.sum(total.cast("decimal(28,2)")).cast("double")
