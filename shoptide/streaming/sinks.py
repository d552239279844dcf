"""Sinks that can repeat a batch without doubling it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoptide.operators.cleaning import dedup_events
from shoptide.plans.gold import gold_daily
from shoptide.session import shared_folder
from shoptide.sources.tables import DAY_PARTITIONS, read_days, write_events


def upsert_daily(silver: str, gold: str) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: rows to Silver, then the daily fact of the touched days.

    Each batch owns a ``batch`` folder inside its days and replaces it when repeated, so a batch that
    runs again after a failure adds nothing. Copies of an event in different batches are removed when
    the days are read back. The fact is counted from all rows of a day, because distinct users do not
    add up, and only the folders of the touched days are listed, read and replaced.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        batch = rows.withColumn("batch", F.lit(batch_id).cast("bigint"))
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_events(batch, silver, partitions=(*DAY_PARTITIONS, "batch"))
            # One small row per day of the batch.
            days = batch.select(*DAY_PARTITIONS).distinct().collect()
        finally:
            batch.unpersist()
        if days:
            touched = read_days(rows.sparkSession, silver, [tuple(d) for d in days])
            write_events(gold_daily(dedup_events(touched.drop("batch"))), gold)

    return apply


def start_daily_upsert(
    stream: DataFrame, silver: str, gold: str, name: str = "daily_upsert", **trigger
) -> StreamingQuery:
    """Run the upsert on a stream of Silver rows, its progress kept in the cluster's shared folder."""
    checkpoint = shared_folder(stream.sparkSession, name)
    writer = stream.writeStream.foreachBatch(upsert_daily(silver, gold))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_events_sink(stream: DataFrame, path: str, name: str, **trigger) -> StreamingQuery:
    """Append a stream of events to Parquet folders per day, exactly once."""
    checkpoint = shared_folder(stream.sparkSession, name)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*DAY_PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_available(stream: DataFrame, path: str, checkpoint: str, complete: bool = False) -> DataFrame:
    """Process what has arrived since the last run, stop, and return the table at ``path``.

    Suits scheduled runs. Rows are appended exactly once; with ``complete`` the table holds the whole
    state of an aggregate and each batch replaces it.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if complete:

        def replace(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

        writer = writer.outputMode("complete").foreachBatch(replace)
    else:
        writer = writer.outputMode("append").format("parquet").option("path", path)
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
