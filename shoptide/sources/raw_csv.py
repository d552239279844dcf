"""Raw event files: CSV with a header line."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from shoptide.schemas import RAW


def read_raw_csv(
    spark: SparkSession, paths: str | list[str], mode: str = "FAILFAST", **options: str
) -> DataFrame:
    """Raw events from one or more CSV paths or globs, split over tasks, with the fixed schema.

    The header must name the columns of the schema. A row that does not fit ends the read;
    ``mode="DROPMALFORMED"`` or ``"PERMISSIVE"`` choose another policy. A path that does not exist
    raises.
    """
    reader = spark.read.schema(RAW).option("header", True).option("enforceSchema", False)
    return reader.option("mode", mode).options(**options).csv(paths)


def read_raw_folder(
    spark: SparkSession, folder: str, pattern: str = "*.csv", **options: str
) -> DataFrame | None:
    """All files of a folder that match ``pattern`` in one read; a warning and None without any."""
    events = read_raw_csv(spark, folder, pathGlobFilter=pattern, **options)
    if not events.inputFiles():
        warnings.warn(f"no file matches {pattern} in {folder}", stacklevel=2)
        return None
    return events


def read_csv_head(spark: SparkSession, path: str, n: int = 5, **options: str) -> DataFrame:
    """The first ``n`` rows of one CSV file in the order of the file; fewer where it has fewer.

    Only the beginning of the file is read: Spark takes rows from its first split, and goes on to the
    next only if they do not suffice. The n rows pass through the driver.
    """
    return spark.createDataFrame(read_raw_csv(spark, path, **options).head(n), RAW)
