"""Named date ranges that reports compare."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import calendar_date


@dataclass(frozen=True)
class Period:
    """Days from ``first`` to ``last``, both included."""

    label: str
    first: dt.date
    last: dt.date

    def contains(self) -> Column:
        """Filter on year, month, day: a partition filter on Bronze and Silver."""
        return calendar_date().between(F.lit(self.first), F.lit(self.last))


OCTOBER = Period(fixed.MONTH_NAMES[10], dt.date(2019, 10, 1), dt.date(2019, 10, 31))
NOVEMBER = Period(fixed.MONTH_NAMES[11], dt.date(2019, 11, 1), dt.date(2019, 11, 30))


def period_label(*periods: Period) -> Column:
    """Label of the first period a row falls into, null outside all of them."""
    return F.coalesce(*(F.when(p.contains(), F.lit(p.label)) for p in periods))
