"""Versions of products, grains, sketches, grouped anomalies and the category fact kept by deltas."""

from __future__ import annotations

import datetime as dt
import random
import statistics
import uuid
from collections import defaultdict

import pytest
from frames import EDGE, events
from pyspark.sql import functions as F

from shoptide.plans import dimensions, history, rollups
from shoptide.plans.gold import PERIOD_FACT, gold_category, gold_period
from shoptide.plans.silver import silver_events, silver_rows
from shoptide.schemas import GOLD_CATEGORY, RAW
from shoptide.sources import tables
from shoptide.sources.driver_tables import shop_events
from shoptide.streaming import category_deltas


@pytest.fixture(scope="module")
def silver(spark):
    return silver_events(shop_events(spark, "/root/testdata/sf0.001")).cache()


def content(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def test_versions_of_a_product(spark):
    rows = [
        ("10-01 10:00:00", "view", 1, "a", "x"), ("10-01 11:00:00", "view", 1, "a", "y"),  # the last of a day counts
        ("10-02 10:00:00", "view", 1, "a", "y"), ("10-04 10:00:00", "view", 1, "a", None),
        ("10-05 10:00:00", "view", 1, "a", None), ("10-06 10:00:00", "view", 1, "a", "y"),
        ("10-03 10:00:00", "view", 2, "b", "z"),
    ]
    found = history.dim_product_history(events(spark, rows), ("category_code", "brand")).collect()
    day = lambda n: dt.date(2019, 10, n)
    assert sorted((r.product_id, r.version, r.valid_from, r.valid_to, r.is_current, r.brand) for r in found) == [
        (1, 1, day(1), day(4), False, "y"), (1, 2, day(4), day(6), False, None),
        (1, 3, day(6), None, True, "y"), (2, 1, day(3), None, True, "z"),
    ]
    facts = spark.createDataFrame(
        [(1, day(1), 1), (1, day(3), 2), (1, day(9), 3), (2, day(1), 4), (3, day(1), 5), (1, day(4), 6), (1, day(4), 7)],
        "product_id BIGINT, date DATE, n INT",
    )
    dim = history.dim_product_history(events(spark, rows), ("category_code", "brand"))
    seen = {r.n: (r.version, r.brand) for r in history.as_of(facts, dim).collect()}
    assert seen == {1: (1, "y"), 2: (1, "y"), 3: (3, "y"), 4: (None, None), 5: (None, None), 6: (2, None), 7: (2, None)}


def test_history_of_an_empty_table(spark):
    empty = spark.createDataFrame([], RAW)
    assert history.dim_product_history(empty).collect() == [] and history.star_revenue_as_of(empty).collect() == []


def test_grains_equal_the_single_facts_from_one_scan(spark, silver):
    grains = rollups.gold_grains(silver)
    for unit in ("week", "month"):
        mine = grains.where(f"grain = '{unit}'").withColumnRenamed("period_start", f"{unit}_start").drop("grain")
        assert content(mine) == content(gold_period(silver, unit))
    whole = grains.where("grain = 'all'").collect()
    assert len(whole) == 1 and whole[0].period_start is None and whole[0].total_events == silver.count()
    assert grains.where("grain = 'day'").count() == 30
    plain = rollups.gold_grains(spark.read.schema(silver.schema).parquet(_written(spark, silver)))
    plan = plain._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def _written(spark, df):
    from shoptide.session import shared_folder

    path = shared_folder(spark, f"t{uuid.uuid4().hex}")
    df.write.parquet(path)
    return path


def test_weeks_from_stored_sketches(spark, tmp_path):
    """30,000 users and 60,000 sessions over two weeks: sums exact, distinct counts within the bound."""
    base = spark.range(120_000).selectExpr(
        "timestamp'2019-10-07 00:00:00' + make_interval(0, 0, 0, cast(id % 14 as int), 1) AS event_time",
        "CASE WHEN id % 5 = 0 THEN 'purchase' ELSE 'view' END AS event_type", "id % 997 AS product_id",
        "1L AS category_id", "'a.b' AS category_code", "'x' AS brand", "(id % 1000) / 100D + 0.01 AS price",
        "id % 30011 AS user_id", "concat('s', id % 60013) AS user_session",
    )
    daily = rollups.daily_sketches(base)
    tables.write_fact(daily, str(tmp_path / "daily"))
    stored = spark.read.parquet(str(tmp_path / "daily"))
    weeks = rollups.roll_up_sketched(stored, "week")
    exact = gold_period(base, "week")
    assert weeks.columns == exact.columns
    sums = [c for c in PERIOD_FACT if not c.startswith("unique") and not c.endswith("per_user")]
    assert content(weeks.select("week_start", *sums)) == content(exact.select("week_start", *sums))
    errors = rollups.distinct_errors(weeks, base, "week").collect()
    assert len(errors) == 2
    for r in errors:
        for name in ("unique_users_error", "unique_sessions_error", "unique_products_error"):
            assert r[name] <= rollups.ERROR_BOUND
        assert 0 < r.unique_sessions_error  # an estimate, not a count
    # A user of every day of a week counts once.
    assert all(r.unique_products == pytest.approx(997, rel=rollups.ERROR_BOUND) for r in errors)


def test_grouped_anomalies_equal_brute_force(spark):
    rng, rows, sizes = random.Random(2), [], {}
    for s in range(300):
        hour, stage = rng.choice([9, 20]), rng.choice(["view", "cart"])
        n = rng.choice([2, 3, 4, 5]) if s % 40 else 30
        rows += [(f"10-01 {hour:02d}:{i:02d}:00", stage if i == 0 else "view", i, "a", "x", 1.0, s, f"s{s}") for i in range(n)]
        sizes[f"s{s}"] = (hour, stage, n)
    groups = defaultdict(list)
    for hour, stage, n in sizes.values():
        groups[hour, stage].append(n)
    wanted = {}
    for s, (hour, stage, n) in sizes.items():
        values = groups[hour, stage]
        middle = statistics.median(values)
        mad = statistics.median(abs(v - middle) for v in values)
        if 0.6745 * (n - middle) / mad > 3.5:
            wanted[s] = round(0.6745 * (n - middle) / mad, 9)
    found = {r.user_session: round(r.z_score, 9) for r in dimensions.group_anomaly_sessions(events(spark, rows)).collect()}
    assert found == wanted and wanted


def test_groups_without_spread(spark):
    same = [(f"10-01 10:{i:02d}:00", "view", i, "a", "x", 1.0, s, f"s{s}") for s in range(9) for i in range(2)]
    assert dimensions.group_anomaly_sessions(events(spark, same)).collect() == []
    odd = same + [(f"10-01 10:{i:02d}:00", "view", i, "a", "x", 1.0, 99, "odd") for i in range(50)]
    # Half of the group is equal: the mean distance stands for the median one.
    assert [r.user_session for r in dimensions.group_anomaly_sessions(events(spark, odd)).collect()] == ["odd"]


EXACT = [c for c in GOLD_CATEGORY.names if not c.startswith("unique") and c != "revenue_per_user"]


def test_category_fact_by_deltas(spark, tmp_path):
    """Batches out of the order of time, with copies of earlier events that win or lose, one batch run
    again, and an earlier one run again after a later."""
    cheap = list(EDGE[3])
    cheap[5] = 1.0  # a copy with a lower price takes the place of the one before
    dear = list(EDGE[10])
    dear[5] = 99.0  # this one does not
    batches = [list(EDGE[6:]), list(EDGE[:5]), [tuple(cheap), tuple(dear), EDGE[5], EDGE[5]]]
    apply = category_deltas.upsert_category(*(str(tmp_path / n) for n in ("silver", "deltas", "gold")))
    rows = lambda part: silver_rows(events(spark, part))
    for i in (0, 1, 1, 2, 0):
        apply(rows(batches[i]), i)
        part = [r for b in batches[: 3 if i == 2 else i + 1] for r in b]
        if i:
            found, exact = spark.read.parquet(str(tmp_path / "gold")), gold_category(silver_rows(events(spark, part)))
            assert content(found.select(*EXACT)) == content(exact.select(*EXACT))
    found = spark.read.parquet(str(tmp_path / "gold"))
    exact = gold_category(silver_rows(events(spark, [r for b in batches for r in b])))
    assert content(found.select(*GOLD_CATEGORY.names)) == content(exact.select(*GOLD_CATEGORY.names))


def test_keys_of_a_batch_do_not_pass_the_driver(spark, tmp_path):
    """They are as many as its events. Whatever Spark takes for small, no join broadcasts them."""
    path = str(tmp_path / "silver")
    batch = silver_rows(events(spark, EDGE)).withColumn("batch", F.lit(0).cast("bigint"))
    tables.write_events(batch, path, partitions=(*tables.DAY_PARTITIONS, "batch"))
    days = [tuple(d) for d in batch.select(*tables.DAY_PARTITIONS).distinct().collect()]
    change = category_deltas.batch_delta(spark, path, 0, days)
    assert change.collect()
    plan = change._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_batch_without_rows(spark, tmp_path):
    apply = category_deltas.upsert_category(*(str(tmp_path / n) for n in ("silver", "deltas", "gold")))
    apply(silver_rows(events(spark, EDGE[:3])), 0)
    before = content(spark.read.parquet(str(tmp_path / "gold")))
    apply(silver_rows(spark.createDataFrame([], RAW)), 1)
    assert content(spark.read.parquet(str(tmp_path / "gold"))) == before
