"""Facts of several grains: from one scan of the events, or from stored daily facts by sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.operators.metrics import DISTINCTS, MEASURES, RATIOS, fact
from shoptide.plans.gold import PERIOD_FACT
from shoptide.functions import money_total

#: Sketches of 2^12 registers: one standard error is 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
#: Estimates stay within three standard errors, or one, whichever is more.
ERROR_BOUND = 3 * STANDARD_ERROR
GRAINS = ("day", "week", "month")


def gold_grains(silver: DataFrame) -> DataFrame:
    """The daily measures per day, week (Monday first), month and over all, from one scan: grain,
    period_start (null over all) and the measures.

    ``GROUPING SETS`` groups each event once per grain; partial sums are combined in the map tasks, and
    exact distinct counts are spread by the counted value as in the single facts.
    """
    starts = {g: F.date_trunc(g, F.col("event_time")).cast("date") for g in GRAINS}
    rows = silver.withColumns({f"{g}_start": c for g, c in starts.items()})
    keys = [f"{g}_start" for g in GRAINS]
    base = [n for n in PERIOD_FACT if n not in RATIOS]
    measures = [(F.count_distinct(DISTINCTS[n]) if n in DISTINCTS else MEASURES[n]()).alias(n) for n in base]
    grouped = rows.groupingSets([[F.col(k)] for k in keys] + [[]], *keys).agg(
        F.grouping_id(*keys).alias("_grouping"), *measures
    )
    # A bit per key, set where the key is not grouped by; the first key is the highest bit.
    every = 2 ** len(keys) - 1
    names = {every - (1 << (len(keys) - 1 - i)): g for i, g in enumerate(GRAINS)}
    grain = F.lit("all")
    for number, name in names.items():
        grain = F.when(F.col("_grouping") == number, name).otherwise(grain)
    finished = grouped.withColumns({n: RATIOS[n].column() for n in PERIOD_FACT if n in RATIOS})
    return finished.select(grain.alias("grain"), F.coalesce(*keys).alias("period_start"), *PERIOD_FACT)


def daily_sketches(silver: DataFrame) -> DataFrame:
    """A daily fact that adds up: date, counts, money in cents and millionths, and per distinct count a
    sketch of what was seen."""
    price = F.when(F.abs("price") < float("inf"), F.rint(F.col("price") * 1_000_000).cast("bigint"))
    counts = [n for n in MEASURES if n not in ("avg_price",)]
    return silver.groupBy(F.to_date("event_time").alias("date")).agg(
        *(MEASURES[n]().alias(n) for n in counts),
        F.sum(price).alias("price_millionths"),
        F.count(price).alias("prices"),
        *(F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{n}_sketch") for n, c in DISTINCTS.items()),
    )


def roll_up_sketched(daily: DataFrame, unit: str) -> DataFrame:
    """The measures of ``gold_period`` per ``week`` or ``month`` from stored daily sketches, without the
    events: sums and money are exact, distinct counts and ratios to them are within ``ERROR_BOUND``."""
    start = F.date_trunc(unit, F.col("date")).cast("date").alias(f"{unit}_start")
    sums = [n for n in MEASURES if n not in ("avg_price", "total_revenue")]
    rolled = daily.groupBy(start).agg(
        *(F.sum(n).alias(n) for n in sums),
        money_total(F.col("total_revenue")).alias("total_revenue"),
        F.try_divide(F.sum("price_millionths") / F.lit(1_000_000.0), F.sum("prices")).alias("avg_price"),
        *(F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch")).alias(n) for n in DISTINCTS),
    )
    ratios = {n: RATIOS[n].column() for n in PERIOD_FACT if n in RATIOS}
    return rolled.withColumns(ratios).select(f"{unit}_start", *PERIOD_FACT)


def distinct_errors(estimated: DataFrame, silver: DataFrame, unit: str) -> DataFrame:
    """Estimated against exact distinct counts: per period and count the relative error."""
    names = list(DISTINCTS)
    start = F.date_trunc(unit, F.col("event_time")).cast("date").alias(f"{unit}_start")
    exact = fact(silver, [start], names).withColumnsRenamed({n: f"exact_{n}" for n in names})
    both = estimated.join(exact, f"{unit}_start")
    errors = {
        f"{n}_error": F.abs(F.col(n) - F.col(f"exact_{n}")) / F.greatest(F.col(f"exact_{n}"), F.lit(1))
        for n in names
    }
    return both.withColumns(errors).drop(*(f"exact_{n}" for n in names))
