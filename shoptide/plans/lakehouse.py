"""The three table layers, written step by step."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.functions import calendar_date
from shoptide.operators.cleaning import keep_valid_prices
from shoptide.operators.enrichment import add_calendar_parts, conversion_stage
from shoptide.plans.gold import gold_category, gold_daily, gold_hourly
from shoptide.plans.silver import silver_events
from shoptide.sources.raw_csv import read_raw_csv
from shoptide.sources.tables import (
    DAY_PARTITIONS,
    SOURCE_PARTITION,
    between_days,
    read_events,
    write_events,
    write_fact,
)


@dataclass(frozen=True)
class WriteStats:
    """Rows written, and how fast."""

    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def _timed_write(
    df: DataFrame, path: str, mode: str, partitions: Sequence[str] = DAY_PARTITIONS
) -> WriteStats:
    start = time.monotonic()
    rows = write_events(df, path, mode, partitions)
    return WriteStats(rows=rows, seconds=time.monotonic() - start)


def ingest_csv(
    spark: SparkSession, csv_paths: str | list[str], bronze: str, mode: str = "overwrite"
) -> WriteStats:
    """CSV files to Bronze, in one job.

    A file's rows of a day are what is replaced: files that share a day keep beside each other, over
    one call or several, and a file that comes again neither doubles nor drops anything.
    """
    key = F.concat(F.lit("f"), F.hex(F.xxhash64(F.input_file_name()))).alias(SOURCE_PARTITION)
    events = add_calendar_parts(read_raw_csv(spark, csv_paths).select("*", key))
    return _timed_write(events, bronze, mode, (*DAY_PARTITIONS, SOURCE_PARTITION))


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> WriteStats:
    """Bronze to Silver: all days, or ``first`` to ``last``.

    The funnel stage always looks at the carts and purchases of all of Bronze. A run over some days
    replaces those days, and the other days that hold a pair whose stage is no longer the one written:
    Silver built day by day, as days come, is Silver built at once.
    """
    # Listed once, however many files there are.
    everything = read_events(spark, bronze)
    chosen = rows = between_days(everything, first, last)
    if stale := _stale_days(spark, everything, silver, first, last):
        rows = everything.where(_in_range(first, last) | calendar_date().isin(stale))
    stats = _timed_write(silver_events(rows, evidence=everything), silver, "overwrite")
    _empty_days(spark, keep_valid_prices(chosen), silver, first, last)
    return stats


def _in_range(first: dt.date | None, last: dt.date | None) -> Column:
    low = F.lit(True) if first is None else calendar_date() >= F.lit(first)
    return low if last is None else low & (calendar_date() <= F.lit(last))


def _stale_days(
    spark: SparkSession, everything: DataFrame, silver: str, first: dt.date | None, last: dt.date | None
) -> list[dt.date]:
    """Written days outside the range with rows whose stage differs from what Bronze says now."""
    if first is None and last is None:
        return []
    try:
        written = read_events(spark, silver)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    others = written.where(~_in_range(first, last)).select(
        "user_id", "product_id", F.col("conversion_stage").alias("written_stage"), *DAY_PARTITIONS
    )
    staged = conversion_stage(others, evidence=keep_valid_prices(everything))
    changed = staged.where(~F.col("conversion_stage").eqNullSafe(F.col("written_stage")))
    return [r["date"] for r in changed.select(calendar_date().alias("date")).distinct().collect()]  # days


def _empty_days(
    spark: SparkSession, rows: DataFrame, path: str, first: dt.date | None, last: dt.date | None
) -> None:
    """Days of the range that the table holds although no row belongs there any more become empty."""
    written = between_days(spark.read.parquet(path), first, last).select(*DAY_PARTITIONS).distinct()
    stale = written.join(rows.select(*DAY_PARTITIONS).distinct(), list(DAY_PARTITIONS), "left_anti")
    nothing = spark.read.parquet(path).drop(*DAY_PARTITIONS).limit(0)
    for day in stale.collect():  # days, not events
        folder = "/".join(f"{name}={day[name]}" for name in DAY_PARTITIONS)
        options = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
        options.parquet(f"{path.rstrip('/')}/{folder}")


def build_gold(
    spark: SparkSession, silver: str, gold: str, exact: bool = True
) -> dict[str, int]:
    """The three facts from Silver; rows per fact, read back. Without ``exact``, distinct counts are
    HyperLogLog estimates, which need a single pass."""
    events = read_events(spark, silver)
    root = gold.rstrip("/")
    return {
        "fact_daily_metrics": write_fact(gold_daily(events, exact), f"{root}/fact_daily_metrics", 1),
        "fact_hourly_metrics": write_fact(gold_hourly(events, exact), f"{root}/fact_hourly_metrics"),
        "fact_category_metrics": write_fact(
            gold_category(events, exact), f"{root}/fact_category_metrics", 1
        ),
    }
