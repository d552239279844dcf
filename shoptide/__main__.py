"""Run the layers and reports from the command line or with spark-submit.

    python -m shoptide ingest 'raw/*.csv' lake/bronze
    python -m shoptide silver lake/bronze lake/silver --first 2019-10-01 --last 2019-10-07
    python -m shoptide gold lake/silver lake/gold
    python -m shoptide --input-gb 4000 silver lake/bronze lake/silver
    python -m shoptide report period_compare lake/gold/fact_daily_metrics
    python -m shoptide reports
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoptide.operators import cleaning, profiles
from shoptide.plans import (
    abandonment,
    bronze_reports,
    category_reports,
    daily_reports,
    dimensions,
    history,
    hourly_reports,
    lakehouse,
    recommend,
    rollups,
    silver_reports,
)
from shoptide.schemas import schema_report
from shoptide.session import configure
from shoptide.sources import layout
from shoptide.sources.tables import read_events

Report = Callable[[DataFrame], DataFrame]

# Reports by the table they read, with the defaults of the library.
FACT_REPORTS: dict[str, Report] = {
    report.__name__: report
    for report in (
        daily_reports.period_compare, daily_reports.traffic_quality_flag, daily_reports.spike_days,
        daily_reports.spike_impact, daily_reports.event_day, daily_reports.top_days_traffic,
        daily_reports.top_days_revenue, daily_reports.daily_overall,
        daily_reports.weekend_vs_weekday, daily_reports.fact_totals, daily_reports.monthly_rollup,
        daily_reports.revenue_series, daily_reports.revenue_peaks,
        hourly_reports.hourly_pattern, hourly_reports.peak_hours,
        hourly_reports.time_of_day_share, hourly_reports.time_of_day_winners,
        hourly_reports.hourly_overall, hourly_reports.hourly_purchase_share,
        hourly_reports.golden_hours,
        category_reports.category_overview, category_reports.top_conversion,
        category_reports.top_revenue, category_reports.top_order_value,
        category_reports.category_top3, category_reports.best_overall,
        category_reports.category_overall, category_reports.category_totals,
        category_reports.category_winners, category_reports.top_category_share,
        schema_report,
    )
}
FACT_REPORTS |= {
    "top_abandonment": lambda fact: category_reports.by_abandonment(fact, highest=True),
    "low_abandonment": lambda fact: category_reports.by_abandonment(fact, highest=False),
    "weekend_hours": lambda fact: hourly_reports.best_hours(fact, weekend=True),
    "weekday_hours": lambda fact: hourly_reports.best_hours(fact, weekend=False),
}
EVENT_REPORTS: dict[str, Report] = {
    report.__name__: report
    for report in (
        silver_reports.records_by_month, silver_reports.records_by_day,
        silver_reports.busiest_days, silver_reports.event_type_dist, silver_reports.stage_dist,
        silver_reports.time_of_day_dist, silver_reports.weekend_share,
        silver_reports.top_categories, silver_reports.valid_category_share,
        silver_reports.distinct_entities, silver_reports.critical_nulls,
        silver_reports.month_traffic_change, silver_reports.month_purchase_share,
        silver_reports.partition_coverage, silver_reports.temporal_ranges,
        silver_reports.category_depth, silver_reports.category_paths,
        silver_reports.event_by_stage, silver_reports.users_by_stage,
        silver_reports.stage_consistency, silver_reports.stage_examples,
        silver_reports.buyer_trail, bronze_reports.zero_price_examples,
        bronze_reports.duplicate_examples,
        bronze_reports.event_dist, bronze_reports.time_range, bronze_reports.nulls_found,
        bronze_reports.invalid_prices, bronze_reports.category_root_dist,
        bronze_reports.rarest_category_roots, bronze_reports.quality_verdicts,
        cleaning.clean_audit, profiles.null_profile, profiles.duplicate_profile,
        profiles.describe_numeric, profiles.price_stats,
        layout.storage_layout, layout.storage_summary, layout.rows_per_file, layout.row_estimate,
        dimensions.session_duration, dimensions.conversion_paths, dimensions.session_paths,
        dimensions.anomaly_sessions,
        dimensions.negative_prices, dimensions.normalized_brands, dimensions.dim_product,
        dimensions.dim_user, dimensions.dim_category, dimensions.star_revenue,
        dimensions.weekly_retention, dimensions.group_anomaly_sessions,
        history.dim_product_history, history.star_revenue_as_of, abandonment.abandoned_carts,
        recommend.product_neighbours, rollups.gold_grains,
    )
}
EVENT_REPORTS |= {
    "top_codes": lambda events: bronze_reports.top_values(events, "category_code"),
    "top_brands": lambda events: bronze_reports.top_values(events, "brand"),
    "code_examples": lambda events: bronze_reports.value_examples(events, "category_code"),
}


def report(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A report by name over the table at ``path``."""
    if name in FACT_REPORTS:
        return FACT_REPORTS[name](spark.read.parquet(path))
    if name in EVENT_REPORTS:
        return EVENT_REPORTS[name](read_events(spark, path))
    raise ValueError(f"no report named {name}")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shoptide", description="Shop clickstream tables and reports")
    parser.add_argument(
        "--input-gb", type=float, help="gigabytes a step will shuffle: sizes the shuffle partitions"
    )
    steps = parser.add_subparsers(dest="step", required=True)
    ingest = steps.add_parser("ingest", help="CSV files to Bronze")
    ingest.add_argument("csv", nargs="+")
    ingest.add_argument("bronze")
    ingest.add_argument("--append", action="store_true", help="add to the days instead of replacing")
    silver = steps.add_parser("silver", help="Bronze to Silver")
    silver.add_argument("bronze")
    silver.add_argument("silver")
    for edge in ("--first", "--last"):
        silver.add_argument(edge, type=dt.date.fromisoformat, help="YYYY-MM-DD")
    gold = steps.add_parser("gold", help="Silver to the three fact tables")
    gold.add_argument("silver")
    gold.add_argument("gold")
    gold.add_argument("--approximate", action="store_true", help="estimate distinct counts")
    shown = steps.add_parser("report", help="show a report over a table")
    shown.add_argument("name", choices=sorted({*FACT_REPORTS, *EVENT_REPORTS}), metavar="name")
    shown.add_argument("path")
    shown.add_argument("--rows", type=int, default=100)
    steps.add_parser("reports", help="list the reports")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    chosen = _arguments(argv)
    if chosen.step == "reports":
        print("over a fact table:", *sorted(FACT_REPORTS), sep="\n  ")
        print("over Bronze or Silver:", *sorted(EVENT_REPORTS), sep="\n  ")
        return
    size = None if chosen.input_gb is None else int(chosen.input_gb * 2**30)
    spark = configure(SparkSession.builder.appName("shoptide").getOrCreate(), size)
    if chosen.step == "ingest":
        mode = "append" if chosen.append else "overwrite"
        stats = lakehouse.ingest_csv(spark, chosen.csv, chosen.bronze, mode)
        print(f"{stats.rows} rows in {stats.seconds:.1f} s, {stats.rows_per_second:.0f} rows/s")
    elif chosen.step == "silver":
        stats = lakehouse.build_silver(
            spark, chosen.bronze, chosen.silver, chosen.first, chosen.last
        )
        print(f"{stats.rows} rows in {stats.seconds:.1f} s, {stats.rows_per_second:.0f} rows/s")
    elif chosen.step == "gold":
        facts = lakehouse.build_gold(spark, chosen.silver, chosen.gold, not chosen.approximate)
        for name, rows in facts.items():
            print(f"{name}: {rows} rows")
    else:
        report(spark, chosen.name, chosen.path).show(chosen.rows, truncate=False)


if __name__ == "__main__":
    main()
