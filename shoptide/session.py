"""Session settings the library relies on. It never creates a session itself."""

from __future__ import annotations

import math
import uuid
from typing import TypeVar

from pyspark.ml.util import JavaMLWritable
from pyspark.sql import SparkSession

Model = TypeVar("Model", bound=JavaMLWritable)

MB, GB = 2**20, 2**30
PARTITION_BYTES = 128 * MB
FINE_PARTITIONS = 20_000
LARGEST_PARTITION_BYTES = 2 * GB


def shuffle_partitions(
    input_bytes: int,
    partition_bytes: int = PARTITION_BYTES,
    fine_partitions: int = FINE_PARTITIONS,
    largest_bytes: int = LARGEST_PARTITION_BYTES,
) -> int:
    """Partitions to start a shuffle of ``input_bytes`` with.

    About 128 MB each, up to 20,000 partitions; beyond that partitions grow instead, to 2 GB at most,
    since the blocks of a shuffle are map tasks times partitions. Sorts and aggregates spill.
    """
    fine = math.ceil(input_bytes / partition_bytes)
    return max(1, min(fine, fine_partitions), math.ceil(input_bytes / largest_bytes))


def configure(
    spark: SparkSession,
    input_bytes: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
    fine_partitions: int = FINE_PARTITIONS,
    largest_bytes: int = LARGEST_PARTITION_BYTES,
) -> SparkSession:
    """Pin calendar functions to UTC and make table writes replace only the partitions they touch.

    With ``input_bytes``, the size of what will be shuffled, the number of partitions AQE starts from
    is set; AQE then merges small ones up to 128 MB and splits skewed ones. Without it the caller's
    values stay.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    # Files written by pandas hold nanoseconds: let them load as numbers (see sources.tables).
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if input_bytes is not None:
        wanted = max(
            shuffle_partitions(input_bytes, partition_bytes, fine_partitions, largest_bytes),
            int(spark.conf.get("spark.sql.shuffle.partitions")),
        )
        coalesce = "spark.sql.adaptive.coalescePartitions"
        spark.conf.set(f"{coalesce}.initialPartitionNum", str(wanted))
        spark.conf.set(f"{coalesce}.parallelismFirst", "false")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder below the one the cluster names in ``spark.checkpoint.dir``, or, where it names none,
    below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{name}"


def reloaded(spark: SparkSession, model: Model) -> Model:
    """The fitted model, written to the shared folder and read back.

    What ``fit`` returns holds its training summary and thereby the session, which Spark cannot send to
    tasks any more once a frame of that session was observed. The written model holds neither.
    """
    path = shared_folder(spark, f"model-{uuid.uuid4().hex}")
    model.write().save(path)
    return type(model).load(path)
