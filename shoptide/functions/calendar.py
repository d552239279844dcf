"""Calendar expressions. The session zone is UTC (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed


def on_weekend(day_of_week: Column) -> Column:
    """True on Saturday and Sunday, for 1 = Sunday ... 7 = Saturday."""
    return day_of_week.isin(*fixed.WEEKEND_DAYS)


def day_part(hour: Column) -> Column:
    """morning / afternoon / evening / night, as the cleaned events carry it."""
    return F.coalesce(
        *(
            F.when(hour.between(first, after - 1), F.lit(label))
            for label, first, after in fixed.DAY_PARTS
        ),
        F.lit(fixed.DAY_PART_REST),
    )


def hour_band(hour: Column) -> Column:
    """The four equal bands of the hourly fact."""
    bands = F.array(*(F.lit(name) for name in fixed.HOUR_BANDS))
    return F.get(bands, (hour / fixed.HOURS_PER_BAND).cast("int"))


def hour_band_rank(band: Column) -> Column:
    """1..4 in the order of the day."""
    return F.array_position(F.array(*(F.lit(name) for name in fixed.HOUR_BANDS)), band).cast("int")


def calendar_date() -> Column:
    """DATE from the year, month and day columns: prunes partitions when used in a filter."""
    return F.make_date(F.col("year"), F.col("month"), F.col("day"))


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")

