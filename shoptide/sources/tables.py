"""Parquet tables: events partitioned by day, and small fact tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.functions import calendar_date
from shoptide.schemas import CALENDAR_PARTS

DAY_PARTITIONS = tuple(CALENDAR_PARTS.names)
#: Below the day, Bronze is split by the file its rows came from.
SOURCE_PARTITION = "source_key"


def read_events(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Bronze or Silver events of all days, or of ``first`` to ``last``.

    The day filter holds only partition columns: the tree is listed once, files outside the range are
    not read, and days without a folder are simply not there. The folder level that tells source files
    apart is not a column of the table.
    """
    events = spark.read.parquet(path).drop(SOURCE_PARTITION)
    return between_days(_microseconds(events), first, last)


def between_days(df: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, by the partition columns; None leaves a side open."""
    if first is not None:
        df = df.where(calendar_date() >= F.lit(first))
    if last is not None:
        df = df.where(calendar_date() <= F.lit(last))
    return df


def read_days(
    spark: SparkSession, path: str, days: Sequence[tuple[int, int, int]]
) -> DataFrame:
    """Events of the given (year, month, day) folders; the rest of the table is not even listed."""
    folders = [f"{path.rstrip('/')}/year={y}/month={m}/day={d}" for y, m, d in days]
    return _microseconds(spark.read.option("basePath", path).parquet(*folders))


def _microseconds(df: DataFrame) -> DataFrame:
    """Nanosecond times, which Spark loads as numbers, become timestamps."""
    if isinstance(df.schema["event_time"].dataType, T.LongType):
        return df.withColumn("event_time", F.timestamp_micros(F.expr("event_time div 1000")))
    return df


def write_events(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partitions: Sequence[str] = DAY_PARTITIONS,
    max_records_per_file: int = 20_000_000,
    compression: str = "zstd",
) -> int:
    """Events to Parquet, one folder per day; returns the rows written.

    Overwriting replaces the days the frame holds and leaves the others, so a run can be repeated
    without doubling rows. The rebalance hint gathers each day into files of a good size: AQE joins
    small days and cuts a huge one over many tasks, where a plain repartition would hand a whole day
    to one.
    """
    gathered = df.hint("rebalance", *partitions)
    # Counted in the writing tasks, after the shuffle: Spark counts a result task once however often
    # lost executors make it run, and no second job is needed.
    written = Observation()
    (
        gathered.observe(written, F.count(F.lit(1)).alias("total_rows"))
        .write.partitionBy(*partitions)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", compression)
        .parquet(path)
    )
    return written.get["total_rows"]


def write_fact(df: DataFrame, path: str, files: int | None = None) -> int:
    """A fact table to Parquet, replacing the old one; returns its rows, read back.

    ``files`` joins the finished rows into that many files. It suits facts with a row per day or
    category; without it AQE sizes the files.
    """
    rows = df if files is None else df.coalesce(files)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.parquet(path).count()
