"""The category fact kept up to date by what each batch changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import is_cart, is_purchase, is_view, money_total
from shoptide.operators.cleaning import dedup_events
from shoptide.operators.metrics import RATIOS
from shoptide.operators.shares import share_of
from shoptide.plans.gold import with_category
from shoptide.plans.rollups import SKETCH_BITS
from shoptide.schemas import GOLD_CATEGORY
from shoptide.sources.tables import DAY_PARTITIONS, read_days, write_events, write_fact

#: Counted values whose sketches are kept; what was once seen stays in a sketch.
SKETCHED = {"unique_users": "user_id", "unique_products": "product_id"}
SUMS = (
    "total_events", "total_views", "total_carts", "total_purchases", "revenue_cents",
    "price_millionths", "prices",
)


def _units(price: Column, scale: int) -> Column:
    return F.when(F.abs(price) < float("inf"), F.rint(price * scale).cast("bigint"))


def signed_sums(rows: DataFrame) -> DataFrame:
    """Sums per category over Silver rows that carry ``sign``: 1 for a row that comes, -1 for one that
    goes."""
    sign, price = F.col("sign"), F.col("price")
    counted = lambda flag: F.sum(F.when(flag, sign).otherwise(0))
    units = _units(price, 1_000_000)
    return with_category(rows).groupBy("category_l1").agg(
        F.sum(sign).alias("total_events"),
        counted(is_view()).alias("total_views"),
        counted(is_cart()).alias("total_carts"),
        counted(is_purchase()).alias("total_purchases"),
        F.coalesce(F.sum(F.when(is_purchase(), sign * _units(price, 100))), F.lit(0)).alias("revenue_cents"),
        F.coalesce(F.sum(sign * units), F.lit(0)).alias("price_millionths"),
        counted(units.isNotNull()).alias("prices"),
        *(
            F.hll_sketch_agg(F.when(sign > 0, F.col(c)), SKETCH_BITS).alias(f"{n}_sketch")
            for n, c in SKETCHED.items()
        ),
    )


def category_fact(deltas: DataFrame) -> DataFrame:
    """``gold_category`` from the deltas of all batches: a row per category and batch is all it reads.

    Sums, money and ratios between them are exact; distinct counts and revenue per user are within the
    error of the sketches. Shares are taken over the finished rows.
    """
    merged = deltas.groupBy("category_l1").agg(
        *(F.sum(n).alias(n) for n in SUMS),
        *(F.hll_sketch_estimate(F.hll_union_agg(f"{n}_sketch")).alias(n) for n in SKETCHED),
    )
    merged = merged.where("total_events > 0").withColumns(
        {
            "total_revenue": F.col("revenue_cents") / F.lit(100.0),
            "avg_price": F.try_divide(F.col("price_millionths") / F.lit(1_000_000.0), F.col("prices")),
        }
    )
    totals = merged.agg(
        F.struct(
            money_total(F.col("total_revenue")).alias("revenue"), F.sum("total_purchases").alias("purchases")
        )
    ).scalar()
    ratios = {n: RATIOS[n].column() for n in GOLD_CATEGORY.names if n in RATIOS}
    shares = {
        "pct_revenue": share_of(F.col("total_revenue"), totals.getField("revenue")),
        "pct_purchases": share_of(F.col("total_purchases"), totals.getField("purchases")),
    }
    return merged.withColumns(ratios).withColumns(shares).select(*GOLD_CATEGORY.names)


def batch_delta(spark: SparkSession, silver: str, batch_id: int, days: list[tuple[int, int, int]]) -> DataFrame:
    """What a batch, already in its folders of ``silver``, changes in the sums.

    Of the touched days only rows with an event key of the batch take part: the survivor among the
    earlier batches goes, the survivor with this batch comes. A copy that changes nothing cancels out.
    Earlier means a smaller number, so the change of a batch is the same whenever it is computed.
    """
    key = list(fixed.EVENT_KEY)
    touched = read_days(spark, silver, days).where(F.col("batch") <= batch_id)
    keys = touched.where(F.col("batch") == batch_id).select(*key).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    named = keys.select(*(F.col(c).alias(f"_{c}") for c in key))
    # A row per event of the batch: shuffled, as a broadcast of it would pass through the driver.
    rows = touched.join(named.hint("merge"), same, "left_semi")
    kept = [c for c in rows.columns if c not in ("batch",)]
    now = dedup_events(rows.select(*kept)).withColumn("sign", F.lit(1))
    before = dedup_events(rows.where(F.col("batch") < batch_id).select(*kept)).withColumn("sign", F.lit(-1))
    return signed_sums(now.unionByName(before))


def upsert_category(silver: str, deltas: str, gold: str) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: rows to Silver, the batch's change to the deltas, then the
    category fact from all deltas.

    A batch owns a folder in Silver and one in the deltas and replaces both when it runs again. Events
    may come in any order of time, and copies in any batch. The fact is never counted from events again.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        batch = rows.withColumn("batch", F.lit(batch_id).cast("bigint"))
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_events(batch, silver, partitions=(*DAY_PARTITIONS, "batch"))
            # One small row per day of the batch.
            days = [tuple(d) for d in batch.select(*DAY_PARTITIONS).distinct().collect()]
        finally:
            batch.unpersist()
        if not days:
            return
        change = batch_delta(spark, silver, batch_id, days).withColumn("batch", F.lit(batch_id).cast("bigint"))
        # A row per category: one file.
        change.coalesce(1).write.partitionBy("batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(deltas)
        write_fact(category_fact(spark.read.parquet(deltas)), gold, files=1)

    return apply
