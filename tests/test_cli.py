from __future__ import annotations

import pytest
from frames import EDGE
from test_sources import HEADER, csv_line

from shoptide.__main__ import EVENT_REPORTS, FACT_REPORTS, main, report


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    (root / "raw.csv").write_text("\n".join([HEADER, *map(csv_line, EDGE)]) + "\n")
    main(["ingest", str(root / "raw.csv"), str(root / "bronze")])
    main(["silver", str(root / "bronze"), str(root / "silver")])
    main(["gold", str(root / "silver"), str(root / "gold")])
    return root


def test_all_steps_print_rows(lake, capsys):
    main(["silver", str(lake / "bronze"), str(lake / "silver"), "--first", "2019-10-01"])
    assert capsys.readouterr().out.startswith("8 rows in")


def fact_of(name):
    daily = {
        "period_compare", "traffic_quality_flag", "spike_days", "spike_impact", "event_day",
        "top_days_traffic", "top_days_revenue", "daily_overall", "weekend_vs_weekday",
        "fact_totals", "monthly_rollup", "revenue_series", "revenue_peaks", "schema_report",
    }
    if name in daily:
        return "fact_daily_metrics"
    hourly = {"hourly_pattern", "peak_hours", "time_of_day_share", "time_of_day_winners",
              "hourly_overall", "hourly_purchase_share", "golden_hours", "weekend_hours", "weekday_hours"}
    return "fact_hourly_metrics" if name in hourly else "fact_category_metrics"


@pytest.mark.parametrize("name", sorted(FACT_REPORTS))
def test_fact_reports(spark, lake, name):
    rows = report(spark, name, str(lake / "gold" / fact_of(name))).collect()
    # The edge frame has no event in November.
    november = {"spike_days", "event_day", "revenue_series"}
    assert (not rows) if name in november else rows


@pytest.mark.parametrize("name", sorted(EVENT_REPORTS))
def test_event_reports_over_silver(spark, lake, name):
    rows = report(spark, name, str(lake / "silver")).collect()
    assert rows or name in {"anomaly_sessions", "group_anomaly_sessions", "nulls_found", "zero_price_examples", "duplicate_examples"}


def test_report_is_shown(lake, capsys):
    main(["report", "event_type_dist", str(lake / "silver")])
    assert "purchase" in capsys.readouterr().out
    main(["reports"])
    assert "price_stats" in capsys.readouterr().out


def test_input_size_sets_the_shuffle(spark, lake):
    names = [
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    ]
    try:
        main(["--input-gb", "4", "report", "time_range", str(lake / "silver")])
        assert spark.conf.get(names[0]) == "32"
    finally:
        for name in names:
            spark.conf.unset(name)


def test_unknown_report(spark):
    with pytest.raises(ValueError):
        report(spark, "nothing", "x")
