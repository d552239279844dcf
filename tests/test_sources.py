from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import EDGE, edge_frame, events
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shoptide.operators.enrichment import add_calendar_parts
from shoptide.plans import lakehouse
from shoptide.plans.silver import silver_events
from shoptide.schemas import BRONZE, GOLD_DAILY, RAW, SILVER
from shoptide.sources import layout
from shoptide.sources.raw_csv import read_csv_head, read_raw_csv, read_raw_folder
from shoptide.sources.tables import read_events, write_events, write_fact

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def csv_line(row):
    time, kind, product, code, brand, price, user, session = row
    shown = ["" if v is None else "NaN" if v != v else str(v) for v in (code, brand, price)]
    return f"2019-{time} UTC,{kind},{product},,{','.join(shown)},{user},{session}"


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = [csv_line(r) for r in EDGE]
    (folder / "a.csv").write_text("\n".join([HEADER, *lines[:6]]) + "\n")
    (folder / "b.csv").write_text("\n".join([HEADER, *lines[6:]]) + "\n")
    (folder / "notes.txt").write_text("not a table\n")
    return folder


def key(df):
    return sorted(str(tuple(r)) for r in df.select(*RAW.names).collect())


def test_csv_scan(spark, csv_folder):
    df = read_raw_folder(spark, str(csv_folder))
    assert df.schema.names == RAW.names
    assert key(df) == key(edge_frame(spark))
    assert df.agg(F.min("event_time")).first()[0] == dt.datetime(2019, 10, 1, 0, 30)


def test_csv_reads_one_file_or_a_glob(spark, csv_folder):
    assert read_raw_csv(spark, f"{csv_folder}/a.csv").count() == 6
    assert read_raw_csv(spark, f"{csv_folder}/*.csv").count() == 12


def test_csv_missing_file_raises(spark, csv_folder):
    with pytest.raises(AnalysisException):
        read_raw_csv(spark, f"{csv_folder}/c.csv")


def test_csv_empty_match_warns(spark, csv_folder):
    with pytest.warns(UserWarning):
        assert read_raw_folder(spark, str(csv_folder), "*.tsv") is None


def test_csv_bad_row_policy(spark, csv_folder):
    (csv_folder / "c.csv").write_text(f"{HEADER}\n2019-10-01 00:00:00 UTC,view,oops,,,,1.0,1,s\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, f"{csv_folder}/c.csv").collect()
    assert len(read_raw_csv(spark, f"{csv_folder}/c.csv", mode="DROPMALFORMED").collect()) == 0


def test_csv_wrong_header_raises(spark, csv_folder):
    (csv_folder / "d.csv").write_text(HEADER.replace("brand", "maker") + "\n" + csv_line(EDGE[0]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"{csv_folder}/d.csv").collect()


def test_bronze_round_trip_and_statistics(spark, csv_folder, tmp_path):
    bronze = str(tmp_path / "bronze")
    for _ in range(2):
        # Running twice replaces the days instead of doubling them.
        stats = lakehouse.ingest_csv(spark, f"{csv_folder}/*.csv", bronze)
        assert stats.rows == 12 and stats.rows_per_second > 0
        df = read_events(spark, bronze)
        assert df.count() == 12
    assert sorted(df.columns) == sorted(BRONZE.names)
    assert {f.name: f.dataType for f in df.schema.fields} == {f.name: f.dataType for f in BRONZE.fields}
    assert (tmp_path / "bronze" / "year=2019" / "month=10" / "day=1").exists()
    assert key(df) == key(edge_frame(spark))


def test_files_that_share_a_day_stay_beside_each_other(spark, csv_folder, tmp_path):
    bronze = str(tmp_path / "bronze")
    lines = [csv_line(row) for row in EDGE]
    (csv_folder / "one.csv").write_text("\n".join([HEADER, *lines[:1]]) + "\n")
    (csv_folder / "two.csv").write_text("\n".join([HEADER, *lines[:2]]) + "\n")
    for name in ("one", "two", "one"):
        lakehouse.ingest_csv(spark, f"{csv_folder}/{name}.csv", bronze)
    assert read_events(spark, bronze).count() == 3


def test_a_day_without_rows_vanishes_from_silver(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    write_events(add_calendar_parts(edge_frame(spark)), bronze)
    lakehouse.build_silver(spark, bronze, silver)
    before = read_events(spark, silver).where("day = 5").count()
    write_events(add_calendar_parts(events(spark, [("10-05 00:00:00",)]).withColumn("price", F.lit(0.0))), bronze)
    lakehouse.build_silver(spark, bronze, silver, dt.date(2019, 10, 5), dt.date(2019, 10, 5))
    found = read_events(spark, silver)
    assert before == 1 and found.where("day = 5").count() == 0 and found.count() == 7


def test_bronze_append(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = add_calendar_parts(edge_frame(spark))
    write_events(df, path, mode="append")
    write_events(df, path, mode="append")
    assert read_events(spark, path).count() == 24


def test_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_events(add_calendar_parts(edge_frame(spark)), path)
    write_events(add_calendar_parts(events(spark, [("10-05 00:00:00",)])), path)
    days = {r["day"]: r["count"] for r in read_events(spark, path).groupBy("day").count().collect()}
    assert days == {1: 5, 5: 1, 6: 4, 7: 2}


def test_day_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_events(add_calendar_parts(edge_frame(spark)), path)
    some = read_events(spark, path, dt.date(2019, 10, 1), dt.date(2019, 10, 5))
    assert some.count() == 6
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(" in plan
    files = some.select("_metadata.file_path").distinct().count()
    assert files < read_events(spark, path).select("_metadata.file_path").distinct().count()


def test_nanosecond_files(spark, tmp_path):
    folder = tmp_path / "ns" / "year=2019" / "month=10" / "day=1"
    folder.mkdir(parents=True)
    times = pa.array([1569889800123456789, None], pa.timestamp("ns", tz="UTC"))
    pq.write_table(pa.table({"event_time": times, "event_type": ["view", "cart"]}), folder / "x.parquet")
    found = read_events(spark, str(tmp_path / "ns")).orderBy("event_type").collect()
    assert found[1].event_time == dt.datetime(2019, 10, 1, 0, 30, 0, 123456)
    assert found[0].event_time is None


def test_layers(spark, csv_folder, tmp_path):
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    lakehouse.ingest_csv(spark, f"{csv_folder}/*.csv", bronze)
    assert lakehouse.build_silver(spark, bronze, silver).rows == 8
    assert lakehouse.build_silver(spark, bronze, silver).rows == 8
    written = read_events(spark, silver)
    assert written.count() == 8 and set(written.columns) == set(SILVER.names)
    direct = silver_events(edge_frame(spark))
    assert key(written) == key(direct)
    facts = lakehouse.build_gold(spark, silver, gold)
    assert facts == {"fact_daily_metrics": 4, "fact_hourly_metrics": 7, "fact_category_metrics": 4}
    daily = spark.read.parquet(f"{gold}/fact_daily_metrics")
    assert daily.columns == GOLD_DAILY.names
    assert len(daily.inputFiles()) == 1


def test_silver_of_some_days_sees_the_whole_funnel(spark, csv_folder, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    lakehouse.ingest_csv(spark, f"{csv_folder}/*.csv", bronze)
    lakehouse.build_silver(spark, bronze, silver)
    # User 11 views on the 1st and puts into the cart on the 5th.
    lakehouse.build_silver(spark, bronze, silver, dt.date(2019, 10, 1), dt.date(2019, 10, 1))
    found = read_events(spark, silver)
    assert found.count() == 8
    assert {r[0] for r in found.where("user_id = 11").select("conversion_stage").collect()} == {"added_to_cart"}


def test_silver_by_day_is_silver_at_once(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    days = [
        [("10-01 08:00:00", "view", 1), ("10-01 09:00:00", "view", 2)],
        [("10-02 08:00:00", "view", 2), ("10-02 08:30:00", "cart", 1)],
        [("10-03 08:00:00", "purchase", 1), ("10-03 09:00:00", "view", 3)],
    ]
    for i, rows in enumerate(days):
        day = dt.date(2019, 10, 1 + i)
        write_events(add_calendar_parts(events(spark, rows)), bronze)
        lakehouse.build_silver(spark, bronze, silver, day, day)
    stages = lambda df: sorted((r.event_time, r.product_id, r.conversion_stage) for r in df.collect())
    whole = events(spark, [row for rows in days for row in rows])
    assert stages(read_events(spark, silver)) == stages(silver_events(whole))


def test_write_fact_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert write_fact(spark.range(10).toDF("n"), path) == 10
    assert write_fact(spark.range(3).toDF("n"), path, files=1) == 3


def test_layout(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_events(add_calendar_parts(edge_frame(spark)), path)
    df = read_events(spark, path)
    files = layout.storage_layout(df).collect()
    assert sum(r.total_rows for r in files) == 12 and all(r.file_bytes > 0 for r in files)
    assert {r.partition_path for r in files} == {f"year=2019/month=10/day={d}" for d in (1, 5, 6, 7)}
    summary = layout.storage_summary(df).first()
    assert (summary.files, summary.total_rows, summary.partitions) == (len(files), 12, 4)
    assert sorted(layout.rows_per_file(df).collect()) == sorted((r.file_name, r.total_rows) for r in files)
    estimate = layout.row_estimate(df, files=2).first()
    assert (estimate.files, estimate.sampled_files) == (len(files), 2)
    assert estimate.estimated_rows == round(estimate.avg_rows_per_file * len(files))
    assert layout.file_sample(df, files=2).select("_metadata.file_path").distinct().count() == 2


def test_head_of_a_csv(spark, csv_folder):
    lines = spark.read.text(f"{csv_folder}/a.csv").count() - 1
    whole = read_raw_csv(spark, f"{csv_folder}/a.csv").collect()
    assert read_csv_head(spark, f"{csv_folder}/a.csv", 3).collect() == whole[:3]
    assert read_csv_head(spark, f"{csv_folder}/a.csv", 99).count() == len(whole) == lines
    assert read_csv_head(spark, f"{csv_folder}/a.csv", 0).collect() == []


def test_head_reads_the_beginning_of_a_large_file(spark, tmp_path):
    rows = "".join(f"2019-10-01 00:00:00 UTC,view,{i},1,a.b,x,1.0,1,s\n" for i in range(50_000))
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    (tmp_path / "large.csv").write_text(header + rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = read_csv_head(spark, str(tmp_path / "large.csv"), 2_000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.product_id for r in found] == list(range(2_000))
