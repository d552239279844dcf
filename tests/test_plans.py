"""What Spark makes of the queries: pruning, push-down, skew handling, nothing gathered."""

from __future__ import annotations

import re
from contextlib import contextmanager

from frames import edge_frame
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shoptide import configure
from shoptide.functions import stage_rank
from shoptide.operators import cleaning, enrichment
from shoptide.operators.shares import value_shares
from shoptide.plans import daily_reports, gold, silver_reports
from shoptide.plans.silver import silver_events
from shoptide.schemas import RAW
from shoptide.session import shuffle_partitions
from shoptide.sources.driver_tables import as_shop_events, read_table, shop_events
from shoptide.sources.tables import read_events, write_events

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@contextmanager
def settings(spark, **values):
    old = {}
    for name, value in values.items():
        name = name.replace("__", ".")
        old[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_scan_reads_only_what_a_report_needs(spark, sf001):
    text = plan(QUERIES["bronze_event_dist"](spark, sf001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("value" not in s and "user_id" not in s for s in schemas)


def test_price_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_events(enrichment.add_calendar_parts(edge_frame(spark)), path)
    text = plan(cleaning.clean(read_events(spark, path)))
    assert "GreaterThan(price,0.0)" in text


def test_top_k_is_not_a_full_sort(spark):
    daily = gold.gold_daily(silver_events(edge_frame(spark)), ordered=False)
    assert "TakeOrderedAndProject" in plan(daily_reports.top_days_traffic(daily))


def test_stage_examples_are_limited_before_the_shuffle(spark, sf001):
    text = plan(QUERIES["stage_examples"](spark, sf001))
    assert len(re.findall("WindowGroupLimit", text)) == 2


def test_total_of_shares_reads_the_events_once(spark, sf001):
    df = value_shares(shop_events(spark, sf001), "event_type")
    assert "ReusedExchange" in final_plan(df)


def test_quantiles_share_one_count_of_the_values(spark, sf001):
    text = final_plan(QUERIES["bronze_price_stats"](spark, sf001))
    assert text.count("ReusedExchange") >= 2


def test_copies_collapse_before_the_shuffle(spark):
    text = plan(cleaning.dedup_events(edge_frame(spark)))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_min" in below


def hot_events(spark, rows=60_000):
    """A third of the events belong to one user and product; a few of them are purchases."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, rows, 1, 8).select(
        F.timestamp_seconds(F.lit(1_570_000_000) + n).alias("event_time"),
        F.when(n % 1000 == 0, "purchase").when(n % 100 == 0, "cart").otherwise("view").alias("event_type"),
        F.when(hot, 7).otherwise(n % 5000).cast("bigint").alias("product_id"),
        F.lit(1).cast("bigint").alias("category_id"),
        F.sha2(n.cast("string"), 256).alias("category_code"),
        F.lit("b").alias("brand"),
        F.lit(1.0).alias("price"),
        F.when(hot, 1).otherwise(n % 9973).cast("bigint").alias("user_id"),
        F.sha2((n + 1).cast("string"), 256).alias("user_session"),
    ).select(*RAW.names)


def test_hot_pair_is_split_over_tasks(spark):
    raw = hot_events(spark)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        # As the sink does: rows leave the join as they are.
        staged = silver_events(raw)
        text = final_plan(staged)
        assert "skew=true" in text
        counts = {r[0]: r[1] for r in staged.groupBy("conversion_stage").count().collect()}
    window = raw.groupBy("user_id", "product_id").agg(
        F.max(stage_rank()).alias("r"),
        F.count(F.lit(1)).alias("n"),
    )
    want = {r.r: r.n for r in window.groupBy("r").agg(F.sum("n").alias("n")).collect()}
    assert counts == {"purchased": want[2], "added_to_cart": want[1], "viewed_only": want[0]}


def test_hot_product_of_the_test_tables_is_split_over_tasks(spark, sf001):
    events = read_table(spark, sf001, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit('{"k": 7}')).otherwise(F.col("props"))
    raw = as_shop_events(
        events.withColumn("props", hot).repartition(8), read_table(spark, sf001, "part")
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        assert "skew=true" in final_plan(raw)


def test_hot_day_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day = hot_events(spark).withColumn("event_time", F.expr("timestamp'2019-10-01 00:00:00'"))
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="300KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    ):
        write_events(enrichment.add_calendar_parts(day), path)
    assert len(read_events(spark, path).inputFiles()) > 4


def test_configure_sizes_the_shuffle(spark):
    assert [shuffle_partitions(n) for n in (1, 2**30, 10 * 2**40, 100 * 2**40)] == [1, 8, 20_000, 51_200]
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with settings(
        spark,
        spark__sql__adaptive__coalescePartitions__initialPartitionNum="8",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="true",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB",
    ):
        configure(spark, input_bytes=100 * 2**40)
        assert int(spark.conf.get(key)) == 51_200
        configure(spark, input_bytes=1)
        assert int(spark.conf.get(key)) == 8


def test_stage_consistency_finds_a_broken_row(spark):
    silver = silver_events(edge_frame(spark))
    broken = silver.withColumn(
        "conversion_stage",
        F.when(F.col("event_type") == "cart", "viewed_only").otherwise(F.col("conversion_stage")),
    )
    row = silver_reports.stage_consistency(broken).first()
    assert (row.buying_pairs, row.violating_pairs, row.violating_rows) == (3, 1, 1)
