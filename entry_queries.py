"""Every registered query: name -> function of (session, folder of the test tables).

All of them start from the raw shop events that ``shop_events`` derives from the whole ``events`` and
``part`` tables. Means and deviations of doubles depend on the order of the rows in the last digit,
so they are rounded to six decimals here, on both sides of the comparison; the library does not
round.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide import configure
from shoptide import fixed_values as fixed
from shoptide import schemas
from shoptide.operators import cleaning, enrichment, profiles
from shoptide.operators.metrics import DISTINCTS, fact
from shoptide.operators.shares import top_k
from shoptide.plans import abandonment
from shoptide.plans import bronze_reports as bronze
from shoptide.plans import category_reports as by_category
from shoptide.plans import daily_reports as by_day
from shoptide.plans import churn, dimensions
from shoptide.plans import gold, history, lakehouse
from shoptide.plans import hourly_reports as by_hour
from shoptide.plans import recommend, rollups
from shoptide.plans import silver as silver_plan
from shoptide.plans import silver_reports as quality
from shoptide.plans.periods import Period
from shoptide.session import shared_folder
from shoptide.sources import layout, tables
from shoptide.sources.driver_tables import read_table, shop_event_stream, shop_events
from shoptide.streaming import category_deltas, funnel_state, jobs, sinks
from shoptide.streaming.abandonment import abandoned_cart_stream

Query = Callable[[SparkSession, str], DataFrame]

# The test tables cover 2024-01-01 to 2024-01-30: two halves stand for the two months.
FIRST_HALF = Period("first_half", dt.date(2024, 1, 1), dt.date(2024, 1, 15))
SECOND_HALF = Period("second_half", dt.date(2024, 1, 16), dt.date(2024, 1, 30))
SPIKE_HALF = Period("january", dt.date(2024, 1, 1), dt.date(2024, 1, 30))
FIRST_WEEK = Period("first_week", dt.date(2024, 1, 1), dt.date(2024, 1, 7))
CALENDAR = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
EXPECTED_DAYS = 31
# Models learn from the days before it and are judged by the days after.
CUT_OFF = dt.date(2024, 1, 24)
ABANDONED_AFTER_HOURS = 72


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return shop_events(configure(spark), folder)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver_plan.silver_rows(_raw(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver_plan.silver_events(_raw(spark, folder))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    events = silver_plan.silver_needed(_raw(spark, folder), "user_session", "price")
    return gold.gold_daily(events, ordered=False)


def _hourly(spark: SparkSession, folder: str) -> DataFrame:
    events = silver_plan.silver_needed(_raw(spark, folder), "user_session", "price")
    return gold.gold_hourly(events, ordered=False)


def _category(spark: SparkSession, folder: str) -> DataFrame:
    events = silver_plan.silver_needed(_raw(spark, folder), "category_code", "price")
    return gold.gold_category(events, ordered=False)


def _over(source: Query, report: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: report(source(spark, folder), *args, **kwargs)


def _rounded(query: Query, *columns: str, digits: int = 6) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        return df.withColumns({c: F.round(c, digits) for c in columns})

    return run


def _bronze_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.add_calendar_parts(_raw(spark, folder))


def _scan_range(spark: SparkSession, folder: str) -> DataFrame:
    return _bronze_partitions(spark, folder).where(FIRST_WEEK.contains())


def _head_sample(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.col(c).asc_nulls_last() for c in (*fixed.EVENT_KEY, *fixed.TIE_ORDER)]
    return top_k(_raw(spark, folder), 1000, *columns)


def _source_tables(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(configure(spark), folder, "events")


def _rows_per_source_file(spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    events = layout.rows_per_file(read_table(spark, folder, "events"))
    return events.unionByName(layout.rows_per_file(read_table(spark, folder, "part")))


def _layer_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the written layers: counted from the files, nothing is computed again."""
    bronze, silver = _written_silver(spark, folder)
    lakehouse.build_gold(spark, silver, f"{silver}-gold")
    facts = {f"gold_{n}": f"{silver}-gold/fact_{n}_metrics" for n in ("daily", "hourly", "category")}
    paths = {"bronze": bronze, "silver": silver} | facts
    return quality.layer_summary({name: spark.read.parquet(path) for name, path in paths.items()})


def _column_growth(spark: SparkSession, folder: str) -> DataFrame:
    """Columns as the Silver step makes them from the columns of the step checks."""
    raw = _raw(spark, folder).select(*fixed.STEP_COLUMNS)
    made = silver_plan.silver_events(raw).columns
    return quality.column_growth(raw, [c for c in made if c not in schemas.CALENDAR_PARTS.names])


def _fill_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.fill_unknown(_raw(spark, folder))


def _temporal(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.enrich_temporal(cleaning.clean(_raw(spark, folder)))


def _categories(spark: SparkSession, folder: str) -> DataFrame:
    return enrichment.parse_categories(cleaning.clean(_raw(spark, folder)))


def _stages(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    return enrichment.conversion_stage(
        cleaning.clean(raw), evidence=cleaning.keep_valid_prices(raw)
    )


def _events(*needed: str) -> Query:
    """Clean events with calendar parts, carrying only the columns a report reads."""
    return lambda spark, folder: silver_plan.silver_needed(_raw(spark, folder), *needed)


# What a version of a product holds.
PRODUCT_STATE = ("category_code", "brand", "price_level")


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events with the level of their price, which changes from day to day."""
    return history.with_price_level(_events("brand", "category_code", "price")(spark, folder))


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    """Event keys with their funnel stage."""
    raw = _raw(spark, folder)
    events = cleaning.clean_needed(raw).select(*fixed.EVENT_KEY)
    return enrichment.conversion_stage(events, evidence=cleaning.keep_valid_prices(raw))


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    """Event keys with their calendar features."""
    return enrichment.enrich_temporal(
        cleaning.clean_needed(_raw(spark, folder)).select(*fixed.EVENT_KEY)
    )


def _run_folder(spark: SparkSession) -> str:
    """A fresh folder for one streaming run, in the folder that all executors share."""
    return shared_folder(spark, f"run-{uuid.uuid4().hex}")


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All events through CSV files into Bronze. The files share their days and come in two calls,
    one of them twice."""
    root, raw = _run_folder(spark), _raw(spark, folder)
    text = raw.withColumn("event_time", F.concat(F.col("event_time").cast("string"), F.lit(" UTC")))
    for part in (0, 1):
        rows = text.where(F.pmod(F.xxhash64("user_session"), F.lit(2)) == part)
        rows.select(*schemas.RAW.names).write.option("header", True).csv(f"{root}/csv/{part}")
    for part in (0, 1, 0):
        lakehouse.ingest_csv(spark, f"{root}/csv/{part}", f"{root}/bronze")
    found = tables.read_events(spark, f"{root}/bronze")
    return found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def _written_silver(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Bronze and Silver tables of all events: their folders."""
    root = _run_folder(spark)
    tables.write_events(_bronze_partitions(spark, folder), f"{root}/bronze")
    lakehouse.build_silver(spark, f"{root}/bronze", f"{root}/silver")
    return f"{root}/bronze", f"{root}/silver"


def _written_layer(layer: int) -> Query:
    return lambda spark, folder: tables.read_events(spark, _written_silver(spark, folder)[layer])


def _silver_by_week(spark: SparkSession, folder: str) -> DataFrame:
    """Silver built week by week, each when its events have come."""
    root, rows = _run_folder(spark), _bronze_partitions(spark, folder)
    for week in range(5):
        first = CALENDAR[0] + dt.timedelta(days=7 * week)
        last = first + dt.timedelta(days=6)
        tables.write_events(tables.between_days(rows, first, last), f"{root}/bronze")
        lakehouse.build_silver(spark, f"{root}/bronze", f"{root}/silver", first, last)
    return tables.read_events(spark, f"{root}/silver")


def _written_fact(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        silver = _written_silver(spark, folder)[1]
        lakehouse.build_gold(spark, silver, f"{silver}-gold")
        return spark.read.parquet(f"{silver}-gold/{name}")

    return run


def _streamed(
    job: Callable[[DataFrame], DataFrame], columns: list[str], complete: bool = False
) -> Query:
    """Run a streaming job over the file of events until all of it is processed.

    Times come back without a zone. Approximate counts are left out of what is compared.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = job(shop_event_stream(configure(spark), folder))
        root = _run_folder(spark)
        table = sinks.run_available(result, f"{root}/table", f"{root}/checkpoint", complete)
        times = [f.name for f in table.schema.fields if f.dataType.typeName() == "timestamp"]
        return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}).select(*columns)

    return run


def _daily_upsert(spark: SparkSession, folder: str) -> DataFrame:
    stream = jobs.silver_rows(shop_event_stream(configure(spark), folder))
    root = _run_folder(spark)
    batch = sinks.upsert_daily(f"{root}/silver", f"{root}/gold")
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/gold").select(*schemas.GOLD_DAILY.names)


def _category_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All events as batches of a stream: every week is a file, so batches come one after another."""
    root = _run_folder(spark)
    weeks = F.floor(F.dayofmonth("event_time") / 7).cast("int")
    raw = shop_events(configure(spark), folder)
    zoned = raw.withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn("week", weeks)
    # Written once: events meet their products in one join, not in one per week.
    zoned.write.partitionBy("week").parquet(f"{root}/weeks")
    written = spark.read.schema(zoned.schema).parquet(f"{root}/weeks")
    for week in range(5):  # the later weeks first
        rows = written.where(F.col("week") == 4 - week).drop("week")
        rows.coalesce(1).write.mode("append").parquet(f"{root}/raw")
    stream = spark.readStream.schema(schemas.RAW).option("maxFilesPerTrigger", 1).parquet(f"{root}/raw")
    batch = category_deltas.upsert_category(f"{root}/silver", f"{root}/deltas", f"{root}/gold")
    writer = jobs.silver_rows(stream).writeStream.foreachBatch(batch)
    writer = writer.option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    fact_rows = spark.read.parquet(f"{root}/gold")
    exact = gold.gold_category(_events("category_code", "price")(spark, folder), ordered=False)
    names = list(category_deltas.SKETCHED)
    beside = exact.select("category_l1", *(F.col(n).alias(f"exact_{n}") for n in names))
    close = {f"{n}_close": _close(F.col(n), F.col(f"exact_{n}")) for n in names}
    return fact_rows.join(beside, "category_l1", "left").withColumns(close).drop(
        *names, *(f"exact_{n}" for n in names), "revenue_per_user"
    )


def _close(estimate: Column, exact: Column) -> Column:
    """Whether an estimated distinct count is within the stated error of the exact one."""
    return F.coalesce(
        F.abs(estimate - exact) <= F.greatest(exact * rollups.ERROR_BOUND, F.lit(1.0)), F.lit(False)
    )


def _cart_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    found = abandonment.cart_outcomes(_events()(spark, folder), ABANDONED_AFTER_HOURS)
    return found.select("user_id", "product_id", "event_time", "outcome")


def _weekly_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Weeks from written daily sketches. The distinct counts are compared with exact ones."""
    path = f"{_run_folder(spark)}/daily"
    events = _events("user_session", "price")(spark, folder)
    tables.write_fact(rollups.daily_sketches(events), path)
    weeks = rollups.roll_up_sketched(spark.read.parquet(path), "week")
    start = F.date_trunc("week", F.col("event_time")).cast("date").alias("week_start")
    exact = fact(events, [start], list(DISTINCTS)).withColumnsRenamed({n: f"exact_{n}" for n in DISTINCTS})
    close = {f"{n}_close": _close(F.col(n), F.col(f"exact_{n}")) for n in DISTINCTS}
    about = [c for c in weeks.columns if c.endswith("per_user")]
    return weeks.join(exact, "week_start").withColumns(close).drop(
        *DISTINCTS, *(f"exact_{n}" for n in DISTINCTS), *about
    )


def _stream_distincts(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate measures of the closed hourly windows against exact counts: windows compared, and
    whether the root mean square of the relative errors is within the five percent the sketch promises."""
    columns = ["unique_users", "unique_sessions"]
    found = _streamed(_stream_hours, ["window_start", *columns])(spark, folder)
    hour = F.date_trunc("hour", F.col("event_time").cast("timestamp")).cast("timestamp_ntz")
    events = cleaning.keep_valid_prices(_raw(spark, folder))
    exact = fact(events, [hour.alias("window_start")], columns)
    both = found.join(exact.withColumnsRenamed({c: f"exact_{c}" for c in columns}), "window_start", "left")
    error = lambda c: F.sqrt(F.avg(F.pow(F.col(c) / F.col(f"exact_{c}") - 1, F.lit(2))))
    return both.agg(
        F.count(F.lit(1)).alias("windows"), *((error(c) <= 0.05).alias(f"{c}_close") for c in columns)
    )


def _stream_abandoned(spark: SparkSession, folder: str) -> DataFrame:
    """Carts and purchases as two streams, each without repeated events."""
    root = _run_folder(spark)
    topic = lambda kind: jobs.dedup(
        shop_event_stream(configure(spark), folder).transform(cleaning.keep_valid_prices).where(F.col("event_type") == kind)
    )
    found = abandoned_cart_stream(topic(fixed.CART), topic(fixed.PURCHASE), ABANDONED_AFTER_HOURS, delay=None)
    table = sinks.run_available(found, f"{root}/table", f"{root}/checkpoint")
    return table.withColumn("cart_time", F.col("cart_time").cast("timestamp_ntz"))


def _stream_expiring(spark: SparkSession, folder: str) -> DataFrame:
    """The furthest stage of each pair from the changes that the expiring state gives out."""
    root = _run_folder(spark)
    settings = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # State with a time to live asks for one more batch for ever, which a run of what is there
        # (availableNow) must not wait for.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        changes = funnel_state.expiring_stage(shop_event_stream(configure(spark), folder))
        batch = lambda rows, n: rows.write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{root}/changes/batch={n}")
        writer = changes.writeStream.outputMode("update").foreachBatch(batch)
        writer = writer.option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    last = F.max_by("conversion_stage", "batch").alias("conversion_stage")
    return spark.read.parquet(f"{root}/changes").groupBy("user_id", "product_id").agg(last)


def _stream_hours(stream: DataFrame) -> DataFrame:
    return jobs.hourly_windows(stream.transform(cleaning.keep_valid_prices))


def queries() -> dict[str, Query]:
    halves = (FIRST_HALF, SECOND_HALF)
    by_time = _events()
    coded = _events("category_code")
    window_measures = [
        m for m in jobs.WINDOW_MEASURES if m not in ("unique_users", "unique_sessions", "events_per_user")
    ]
    moments = ("mean", "std", "p25", "p50", "p75")
    return {
        # Scans and samples
        "bronze_partitions": _bronze_partitions,
        "scan_partition_range": _scan_range,
        "scan_projected": _over(_raw, lambda df: df.select(*fixed.STEP_COLUMNS)),
        "head_sample": _head_sample,
        "rows_per_source_file": _rows_per_source_file,
        "row_estimate": _over(_source_tables, layout.row_estimate),
        "storage_layout": _over(_source_tables, layout.storage_layout),
        # Written layers, read back
        "csv_round_trip": _csv_round_trip,
        "bronze_written": _written_layer(0),
        "silver_written": _written_layer(1),
        "silver_by_week": _silver_by_week,
        "gold_daily_written": _written_fact("fact_daily_metrics"),
        "gold_hourly_written": _written_fact("fact_hourly_metrics"),
        "gold_category_written": _written_fact("fact_category_metrics"),
        # Silver transforms
        "clean_price_filter": _over(_raw, cleaning.keep_valid_prices),
        "clean_fill_nulls": _fill_nulls,
        "clean_dedup": _over(_raw, cleaning.dedup_events),
        "clean_data": _over(_raw, cleaning.clean),
        "enrich_temporal": _temporal,
        "parse_categories": _categories,
        "conversion_stage": _stages,
        "silver_events": _silver,
        # Facts
        "gold_daily": _over(_events("user_session", "price"), gold.gold_daily),
        "gold_hourly": _over(_events("user_session", "price"), gold.gold_hourly),
        "gold_category": _over(_events("category_code", "price"), gold.gold_category),
        "gold_weekly": _over(_events("user_session", "price"), gold.gold_period, "week"),
        "gold_monthly": _over(_events("user_session", "price"), gold.gold_period, "month"),
        # Profiles
        "clean_audit": _over(_raw, cleaning.clean_audit),
        "null_profile": _over(_raw, profiles.null_profile),
        "nulls_found": _over(_raw, bronze.nulls_found),
        "duplicate_profile": _over(_raw, profiles.duplicate_profile),
        "describe_numeric": _rounded(_over(_raw, profiles.describe_numeric), *moments),
        "price_stats": _rounded(
            _over(_events("price"), profiles.price_stats), "avg_price", "std_price", "median_price"
        ),
        "bronze_price_stats": _rounded(
            _over(_raw, profiles.price_stats), "avg_price", "std_price", "median_price"
        ),
        "schema_check": _over(_silver, schemas.schema_check, schemas.SILVER),
        "schema_report": _over(_silver, schemas.schema_report),
        # Daily reports
        "period_compare": _rounded(
            _over(_daily, by_day.period_compare, *halves),
            "before_avg_conversion_rate", "after_avg_conversion_rate",
            "before_avg_events_per_user", "after_avg_events_per_user", "conversion_change_points",
        ),
        "traffic_quality_flag": _over(_daily, by_day.traffic_quality_flag, *halves),
        "spike_days": _over(_daily, by_day.spike_days, SPIKE_HALF),
        "spike_impact": _over(_daily, by_day.spike_impact, SPIKE_HALF),
        "event_day": _over(_daily, by_day.event_day, SPIKE_HALF),
        "top_days_traffic": _over(_daily, by_day.top_days_traffic),
        "top_days_revenue": _over(_daily, by_day.top_days_revenue),
        "daily_overall": _rounded(
            _over(_daily, by_day.daily_overall),
            "avg_conversion_rate", "avg_events_per_user", "avg_purchases_per_user",
            "avg_order_value",
        ),
        "weekend_vs_weekday": _rounded(
            _over(_daily, by_day.weekend_vs_weekday), "avg_conversion_rate", "avg_events_per_user"
        ),
        "gold_daily_totals": _rounded(_over(_daily, by_day.fact_totals), "avg_conversion_rate"),
        "monthly_rollup": _rounded(
            _over(_daily, by_day.monthly_rollup, *halves),
            "avg_conversion_rate", "conversion_change_pct",
        ),
        "revenue_series": _over(_daily, by_day.revenue_series, SPIKE_HALF),
        "revenue_peaks": _over(_daily, by_day.revenue_peaks, SPIKE_HALF),
        # Hourly reports
        "hourly_pattern": _rounded(_over(_hourly, by_hour.hourly_pattern), "avg_conversion_rate"),
        "peak_hours": _rounded(_over(_hourly, by_hour.peak_hours), "conversion_rate"),
        "time_of_day_share": _rounded(
            _over(_hourly, by_hour.time_of_day_share), "avg_conversion_rate"
        ),
        "time_of_day_winners": _rounded(
            _over(_hourly, by_hour.time_of_day_winners), "conversion_rate"
        ),
        "weekend_hours_top5": _rounded(
            _over(_hourly, by_hour.best_hours, True), "avg_conversion_rate"
        ),
        "weekday_hours_top5": _rounded(
            _over(_hourly, by_hour.best_hours, False), "avg_conversion_rate"
        ),
        "hourly_overall": _rounded(_over(_hourly, by_hour.hourly_overall), "avg_conversion_rate"),
        "gold_hourly_totals": _rounded(_over(_hourly, by_day.fact_totals), "avg_conversion_rate"),
        "hourly_purchase_share": _rounded(
            _over(_hourly, by_hour.hourly_purchase_share), "avg_conversion_rate"
        ),
        "golden_hours": _rounded(
            _over(_hourly, by_hour.golden_hours),
            "golden_pct_purchases", "golden_avg_conversion_rate", "mean_pct_purchases",
            "mean_conversion_rate",
        ),
        # Category reports
        "category_overview": _over(_category, by_category.category_overview),
        "category_top_conversion": _over(_category, by_category.top_conversion),
        "category_top_revenue": _over(_category, by_category.top_revenue),
        "category_top_abandonment": _over(_category, by_category.by_abandonment, True),
        "category_low_abandonment": _over(_category, by_category.by_abandonment, False),
        "category_top_aov": _over(_category, by_category.top_order_value),
        "category_top3": _over(_category, by_category.category_top3),
        "category_best_overall": _over(_category, by_category.best_overall),
        "category_overall": _rounded(
            _over(_category, by_category.category_overall),
            "avg_conversion_rate", "avg_cart_abandonment_rate", "avg_order_value",
        ),
        "category_winners": _over(_category, by_category.category_winners),
        "gold_category_totals": _rounded(
            _over(_category, by_category.category_totals), "avg_conversion_rate"
        ),
        "top5_category_share": _over(_category, by_category.top_category_share),
        # Silver reports
        "records_by_month": _over(by_time, quality.records_by_month),
        "records_by_day": _over(by_time, quality.records_by_day),
        "busiest_days": _over(by_time, quality.busiest_days),
        "event_type_dist": _over(by_time, quality.event_type_dist),
        "stage_dist": _over(_staged, quality.stage_dist),
        "time_of_day_dist": _over(_timed, quality.time_of_day_dist),
        "weekend_share": _over(_timed, quality.weekend_share),
        "temporal_ranges": _over(_timed, quality.temporal_ranges),
        "top_categories": _over(coded, quality.top_categories),
        "valid_category_share": _over(coded, quality.valid_category_share),
        "category_depth": _over(coded, quality.category_depth),
        "category_paths": _over(coded, quality.category_paths),
        "distinct_entities": _over(_events("brand"), quality.distinct_entities),
        "critical_nulls": _over(_silver, quality.critical_nulls),
        "month_traffic_change": _over(by_time, quality.month_traffic_change, *halves),
        "month_purchase_share": _over(by_time, quality.month_purchase_share, *halves),
        "partition_coverage": _over(by_time, quality.partition_coverage, EXPECTED_DAYS),
        "missing_days": _over(by_time, quality.missing_days, *CALENDAR),
        "event_by_stage": _over(_staged, quality.event_by_stage),
        "users_by_stage": _over(_staged, quality.users_by_stage),
        "stage_consistency": _over(_staged, quality.stage_consistency),
        "stage_examples": _over(_staged, quality.stage_examples),
        "buyer_trail": _over(_staged, quality.buyer_trail),
        "column_growth": _column_growth,
        "layer_summary": _layer_summary,
        # Bronze reports
        "bronze_event_dist": _over(_raw, bronze.event_dist),
        "bronze_time_range": _over(_raw, bronze.time_range),
        "bronze_top_categories": _over(_raw, bronze.top_values, "category_code"),
        "bronze_top_categories_10": _over(_raw, bronze.top_values, "category_code", 10),
        "bronze_top_brands": _over(_raw, bronze.top_values, "brand"),
        "bronze_category_examples": _over(_raw, bronze.value_examples, "category_code"),
        "invalid_prices": _over(_raw, bronze.invalid_prices),
        "zero_price_examples": _over(_raw, bronze.zero_price_examples),
        "duplicate_examples": _over(_raw, bronze.duplicate_examples),
        "bronze_category_l1_dist": _over(_raw, bronze.category_root_dist),
        "bronze_category_l1_rarest": _over(_raw, bronze.rarest_category_roots),
        "quality_verdicts": _over(_raw, bronze.quality_verdicts),
        # Sessions, dimensions, retention
        "session_duration": _over(_events("user_session"), dimensions.session_duration),
        "conversion_paths": _over(_events("user_session"), dimensions.conversion_paths),
        "session_paths": _over(_events("user_session"), dimensions.session_paths),
        "anomaly_sessions": _rounded(
            _over(_events("user_session"), dimensions.anomaly_sessions), "z_score"
        ),
        "negative_prices": _over(_raw, dimensions.negative_prices),
        "normalized_brands": _over(_events("brand"), dimensions.normalized_brands),
        "dim_product": _over(_rows, dimensions.dim_product),
        "dim_user": _over(_events("price"), dimensions.dim_user),
        "dim_category": _over(coded, dimensions.dim_category),
        "star_revenue": _over(_rows, dimensions.star_revenue),
        "weekly_retention": _over(by_time, dimensions.weekly_retention),
        "group_anomaly_sessions": _rounded(
            _over(_events("user_session"), dimensions.group_anomaly_sessions), "z_score"
        ),
        "dim_product_history": _over(_priced, history.dim_product_history, PRODUCT_STATE),
        "star_revenue_as_of": _over(_priced, history.star_revenue_as_of, PRODUCT_STATE),
        # Abandonment, recommendations, churn
        "cart_outcomes": _cart_outcomes,
        "abandoned_carts": _over(by_time, abandonment.abandoned_carts, ABANDONED_AFTER_HOURS),
        "recommend_products": _over(by_time, recommend.recommend_products, CUT_OFF),
        "recommendation_recall": _over(by_time, recommend.recommendation_recall, CUT_OFF),
        "product_neighbours": _over(_events("user_session"), recommend.product_neighbours),
        "churn_scores": _over(_events("user_session", "price"), churn.churn_scores, CUT_OFF),
        # Facts of several grains, stored sketches
        "gold_grains": _over(_events("user_session", "price"), rollups.gold_grains),
        "gold_weekly_sketched": _weekly_sketched,
        # Streams
        "stream_silver_rows": _streamed(
            jobs.silver_rows, [c for c in schemas.SILVER.names if c != "conversion_stage"]
        ),
        "stream_dedup": _streamed(jobs.dedup, schemas.RAW.names),
        "stream_hourly_windows": _streamed(
            _stream_hours, ["window_start", "window_end", "time_of_day", *window_measures]
        ),
        "stream_sliding_traffic": _streamed(
            jobs.sliding_traffic, ["window_start", "window_end", *window_measures]
        ),
        "stream_user_sessions": _streamed(
            jobs.user_sessions,
            ["user_id", "visit_start", "visit_end", "total_events", "total_purchases"],
        ),
        "stream_daily_upsert": _daily_upsert,
        "stream_category_upsert": _category_upsert,
        "stream_hourly_distincts": _stream_distincts,
        "stream_abandoned_carts": _stream_abandoned,
        "stream_expiring_stage": _stream_expiring,
        "stream_running_stage": _streamed(
            jobs.running_stage, ["user_id", "product_id", "conversion_stage"], True
        ),
    }
