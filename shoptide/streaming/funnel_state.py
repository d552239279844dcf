"""Running funnel stage with expiry: the one job that needs state of its own."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shoptide.functions import stage_label, stage_rank


#: Groups that pairs are dealt to by hash. State is read and written once per group of a micro-batch, which
#: for single pairs took a millisecond or more each. Of n pairs a group holds n / BUCKETS; the number is
#: fixed for the life of a checkpoint.
BUCKETS = 1 << 14
#: Side by side, an entry per pair of the bucket; ``seen`` is the time of the micro-batch it was last in.
PAIRS = (
    "user_id ARRAY<BIGINT>, product_id ARRAY<BIGINT>, missing ARRAY<INT>, rank ARRAY<INT>, seen ARRAY<BIGINT>"
)


class _FurthestStages(StatefulProcessor):
    """Keeps the highest rank of each pair of a bucket and tells which rise."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # A bucket is written whenever one of its pairs is seen, so it expires with the last of them.
        self.pairs = handle.getValueState("pairs", PAIRS, ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        came: dict[tuple[int, int, int], int] = {}
        # Batches of rows come one after the other: a busy pair is never held as a whole.
        for batch in rows:
            columns = (batch[c].tolist() for c in ("user_id", "product_id", "missing", "rank"))
            for user, product, missing, rank in zip(*columns):
                pair = (user, product, missing)
                if rank > came.get(pair, -1):
                    came[pair] = rank
        known = {
            (user, product, missing): (rank, seen)
            for user, product, missing, rank, seen in zip(*(self.pairs.get() or ()))
            if seen + self.keep_ms > now
        }
        risen = [(*p, rank) for p, rank in came.items() if p not in known or rank > known[p][0]]
        known |= {p: (max(rank, known[p][0]) if p in known else rank, now) for p, rank in came.items()}
        entries = [(*p, rank, seen) for p, (rank, seen) in known.items()]
        self.pairs.update(tuple(list(column) for column in zip(*entries)))
        if risen:
            yield pd.DataFrame(risen, columns=["user_id", "product_id", "missing", "rank"])

    def close(self) -> None:
        pass


def expiring_stage(stream: DataFrame, keep_hours: float = 24 * 30) -> DataFrame:
    """Pairs whose stage rose, each with its new stage; a pair idle for ``keep_hours`` is forgotten.

    State lives in the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    # Pandas would turn a column with a null into floats: nulls travel beside the numbers.
    absent = lambda c, flag: F.when(F.col(c).isNull(), flag).otherwise(0)
    ranked = stream.select(
        F.pmod(F.xxhash64("user_id", "product_id"), F.lit(BUCKETS)).alias("bucket"),
        *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("user_id", "product_id")),
        (absent("user_id", 1) + absent("product_id", 2)).alias("missing"),
        stage_rank().alias("rank"),
    )
    changes = ranked.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_FurthestStages(int(keep_hours * 3_600_000)),
        outputStructType="user_id BIGINT, product_id BIGINT, missing INT, rank INT",
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    present = lambda c, flag: F.when(F.col("missing").bitwiseAND(F.lit(flag)) == 0, F.col(c)).alias(c)
    return changes.select(
        present("user_id", 1), present("product_id", 2), stage_label(F.col("rank")).alias("conversion_stage")
    )
