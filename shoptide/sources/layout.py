"""What lies in storage: files, rows per file, partitions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed


def _file(field: str) -> Column:
    return F.col(f"_metadata.{field}")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per source file of a frame read from files; reads no data column."""
    # Files of several partitions written by one task share their name.
    files = df.groupBy(_file("file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("total_rows"))
    return files.select(F.substring_index("file_path", "/", -1).alias("file_name"), "total_rows")


def storage_layout(df: DataFrame) -> DataFrame:
    """One row per file: name, bytes, rows, and the partition folders it lies in."""
    files = df.groupBy(
        _file("file_path").alias("file_path"), _file("file_size").alias("file_bytes")
    ).agg(F.count(F.lit(1)).alias("total_rows"))
    folders = F.filter(F.split("file_path", "/"), lambda part: part.contains("="))
    return files.select(
        F.substring_index("file_path", "/", -1).alias("file_name"),
        F.array_join(folders, "/").alias("partition_path"),
        "file_bytes",
        "total_rows",
    ).orderBy("partition_path", "file_name")


def storage_summary(df: DataFrame) -> DataFrame:
    """Number of files, bytes, rows and partitions of a table in one row."""
    return storage_layout(df).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_bytes").alias("total_bytes"),
        F.sum("total_rows").alias("total_rows"),
        F.count_distinct("partition_path").alias("partitions"),
        F.min("partition_path").alias("first_partition"),
        F.max("partition_path").alias("last_partition"),
    )


def file_sample(df: DataFrame, files: int = fixed.SAMPLE_FILES) -> DataFrame:
    """The rows of the first ``files`` files in path order."""
    # The listing writes file:///x, the metadata column file:/x. The filter prunes files.
    paths = [re.sub("^file:/+", "file:/", path) for path in sorted(df.inputFiles())[:files]]
    return df.where(_file("file_path").isin(*paths)) if paths else df.limit(0)


def row_estimate(df: DataFrame, files: int = fixed.SAMPLE_FILES) -> DataFrame:
    """Rows of a table from the mean of a file sample times the number of files.

    Reads the sampled files only; the number of files comes from the file listing.
    """
    total = len(df.inputFiles())
    sampled = rows_per_file(file_sample(df, files)).agg(
        F.count(F.lit(1)).alias("sampled_files"), F.avg("total_rows").alias("avg_rows_per_file")
    )
    return sampled.select(
        F.lit(total).cast("bigint").alias("files"),
        "sampled_files",
        "avg_rows_per_file",
        F.round(F.col("avg_rows_per_file") * total).cast("bigint").alias("estimated_rows"),
    )
