from __future__ import annotations

import datetime as dt
import random

import pytest
from frames import edge_frame, event, events
from pyspark.sql import functions as F

from shoptide.operators import cleaning, enrichment, profiles
from shoptide.operators.metrics import fact
from shoptide.operators.quantiles import exact_quantiles
from shoptide.operators.shares import value_shares
from shoptide.plans import gold, silver_reports
from shoptide.plans.silver import silver_events, silver_needed
from shoptide.schemas import GOLD_CATEGORY, GOLD_DAILY, GOLD_HOURLY, RAW, SILVER, schema_check


def rows(df):
    return [r.asDict() for r in df.collect()]


def one(df):
    (row,) = rows(df)
    return row


def test_clean_audit(spark):
    audit = one(cleaning.clean_audit(edge_frame(spark)))
    assert audit["pct_removed"] == pytest.approx(100 / 3)
    del audit["pct_removed"]
    assert audit == {
        "initial_rows": 12, "removed_by_price": 3, "removed_as_duplicates": 1, "final_rows": 8,
        "removed_rows": 4,
    }


def test_audit_agrees_with_clean(spark):
    raw = edge_frame(spark)
    assert cleaning.clean(raw).count() == one(cleaning.clean_audit(raw))["final_rows"]


def test_audit_of_nothing(spark):
    audit = one(cleaning.clean_audit(edge_frame(spark).limit(0)))
    assert audit["final_rows"] == 0 and audit["pct_removed"] == 0


def test_profiles(spark):
    raw = edge_frame(spark)
    assert one(profiles.duplicate_profile(raw))["duplicate_rows"] == 2
    nulls = {r["column_name"]: r["null_rows"] for r in rows(profiles.null_profile(raw))}
    assert (nulls["category_code"], nulls["brand"], nulls["price"]) == (2, 3, 1)


def test_duplicates_are_found_to_the_second(spark):
    raw = events(spark, [("10-01 00:00:01",), ("10-01 00:00:01",), ("10-01 00:00:02",)])
    shifted = raw.withColumn("event_time", F.col("event_time") + F.expr("interval 300 milliseconds"))
    assert one(profiles.duplicate_profile(raw.unionByName(shifted)))["duplicate_rows"] == 6


def test_clean_leaves_no_nulls(spark):
    cleaned = cleaning.clean(edge_frame(spark))
    assert cleaned.where("brand IS NULL OR category_code IS NULL OR NOT price > 0").count() == 0
    assert cleaned.columns == RAW.names


def test_survivor_is_the_same_on_every_run(spark):
    base = [
        event("10-01 00:00:00", price=3.0, session="b"),
        event("10-01 00:00:00", price=2.0, session="a"),
        event("10-01 00:00:00", price=1.0, session=None),
        event("10-01 00:00:00", price=2.5, session="a"),
    ]
    for seed in range(5):
        random.Random(seed).shuffle(base)
        df = spark.createDataFrame(base, RAW).repartition(4)
        (row,) = cleaning.clean(df).collect()
        assert (row.user_session, row.price) == ("a", 2.0)


def test_dedup_treats_null_keys_as_equal(spark):
    raw = events(spark, [("10-01 00:00:00", "view", None), ("10-01 00:00:00", "view", None)])
    assert cleaning.dedup_events(raw).count() == 1


def test_needed_columns_give_the_same_survivor(spark):
    raw = events(
        spark,
        [("10-01 00:00:00", "view", 1, code, "x", price, 1, session)
         for code in ("a", "b") for price in (2.0, 1.0) for session in ("t", "s")],
    )
    full = one(cleaning.clean(raw))
    for needed in (("price",), ("user_session",), ("category_code",), ("brand",), ()):
        few = one(cleaning.clean_needed(raw, *needed))
        assert all(full[c] == v for c, v in few.items())


def test_time_of_day(spark):
    raw = edge_frame(spark)
    parts = {
        (r["event_time"].day, r["hour"]): r["time_of_day"]
        for r in rows(enrichment.enrich_temporal(cleaning.clean(raw)))
    }
    assert parts == {
        (1, 0): "night", (1, 5): "night", (1, 6): "morning", (1, 12): "afternoon",
        (5, 18): "evening", (6, 22): "night", (7, 0): "night",
    }
    bands = {
        (r["day"], r["hour"]): r["time_of_day"] for r in rows(gold.gold_hourly(silver_events(raw)))
    }
    assert bands == {
        (1, 0): "madrugada", (1, 5): "madrugada", (1, 6): "mañana", (1, 12): "tarde",
        (5, 18): "noche", (6, 22): "noche", (7, 0): "madrugada",
    }


def test_category_levels(spark):
    parsed = enrichment.parse_categories(cleaning.clean(edge_frame(spark)))
    levels = {
        r["category_code"]: (r["category_l1"], r["category_l2"], r["category_l3"])
        for r in rows(parsed)
    }
    assert levels == {
        "electronics.smartphone": ("electronics", "smartphone", None),
        "Unknown": ("Unknown", None, None),
        "a.b.c.d": ("a", "b", "c"),
        "apparel.shoes": ("apparel", "shoes", None),
    }


def test_funnel_stages(spark):
    stages = {}
    for r in rows(silver_events(edge_frame(spark))):
        stages.setdefault((r["user_id"], r["product_id"]), []).append(r["conversion_stage"])
    assert stages == {
        (10, 1): ["purchased"] * 3, (11, 2): ["added_to_cart"] * 2, (12, 3): ["viewed_only"],
        (13, 4): ["purchased"], (13, 5): ["purchased"],
    }


def test_stage_of_rows_without_user(spark):
    raw = events(
        spark,
        [("10-01 00:00:00", "view", 1, "a", "x", 1.0, None),
         ("10-01 00:00:01", "purchase", 1, "a", "x", 1.0, None)],
    )
    assert {r["conversion_stage"] for r in rows(enrichment.conversion_stage(raw))} == {"purchased"}


def test_stage_ignores_events_with_a_bad_price(spark):
    raw = events(
        spark, [("10-01 00:00:00", "view"), ("10-01 00:00:01", "purchase", 1, "a", "x", 0.0)]
    )
    assert [r["conversion_stage"] for r in rows(silver_events(raw))] == ["viewed_only"]


def test_stage_on_random_events_equals_the_window_form(spark):
    rng = random.Random(7)
    raw = events(
        spark,
        [(f"10-{rng.randint(1, 28):02d} 00:00:{rng.randint(0, 59):02d}",
          rng.choice(["view", "view", "cart", "purchase", "other"]), rng.choice([1, 2, 3, None]),
          "a", "x", 1.0, rng.choice([1, 2, 3, 4, None])) for _ in range(400)],
    )
    from pyspark.sql import Window

    reached = F.collect_set("event_type").over(Window.partitionBy("user_id", "product_id"))
    expected = raw.withColumn(
        "stage",
        F.when(F.array_contains(reached, "purchase"), "purchased")
        .when(F.array_contains(reached, "cart"), "added_to_cart")
        .otherwise("viewed_only"),
    )
    want = sorted(str(tuple(r)) for r in expected.collect())
    assert sorted(str(tuple(r)) for r in enrichment.conversion_stage(raw).collect()) == want


DAILY = {
    # date: events users sessions products v c p revenue avg aov conv abandon c2p ev/user p/user
    (10, 1): (3, False, 4, 2, 2, 2, 2, 1, 1, 100, 87.5, 100, 50, 0, 100, 2, 0.5),
    (10, 5): (7, True, 1, 1, 1, 1, 0, 1, 0, 0, 50, 0, 0, 100, 0, 1, 0),
    (10, 6): (1, True, 1, 1, 1, 1, 1, 0, 0, 0, 10, 0, 0, 0, 0, 1, 0),
    (10, 7): (2, False, 2, 1, 1, 2, 0, 0, 2, 50, 25, 25, 0, 0, 0, 2, 2),
}


@pytest.mark.parametrize("zone", ["UTC", "America/Lima"])
def test_daily_fact(spark, zone):
    from shoptide import configure

    # Whatever zone a caller runs in, configuring the session brings the days back to UTC.
    spark.conf.set("spark.sql.session.timeZone", zone)
    configure(spark)
    daily = gold.gold_daily(silver_events(edge_frame(spark)))
    assert daily.schema.names == GOLD_DAILY.names
    names = GOLD_DAILY.names[4:]
    found = {(r["month"], r["day"]): tuple(r[n] for n in names) for r in rows(daily)}
    assert found == DAILY
    assert [r["date"] for r in rows(daily)] == [dt.date(2019, 10, d) for d in (1, 5, 6, 7)]


def test_category_fact(spark):
    found = {r["category_l1"]: r for r in rows(gold.gold_category(silver_events(edge_frame(spark))))}
    assert list(found) == ["electronics", "apparel", "Unknown", "a"]
    assert found["electronics"]["pct_revenue"] == pytest.approx(200 / 3)
    assert found["electronics"]["pct_purchases"] == pytest.approx(100 / 3)
    assert found["electronics"]["conversion_rate"] == 100
    assert (found["apparel"]["total_revenue"], found["apparel"]["conversion_rate"]) == (50, 0)
    assert found["Unknown"]["add_to_cart_rate"] == 100
    assert found["a"]["total_revenue"] == 0


def test_category_exclusion_is_case_sensitive(spark):
    raw = events(spark, [("10-01 00:00:00", "view", 1, "unknown"), ("10-01 00:00:01", "view", 1, None)])
    assert [r["category_l1"] for r in rows(gold.gold_category(silver_events(raw)))] == ["Unknown"]


def test_no_purchase_gives_zero_shares(spark):
    found = one(gold.gold_category(silver_events(events(spark, [("10-01 00:00:00",)]))))
    assert (found["pct_revenue"], found["pct_purchases"]) == (0, 0)


def test_abandonment_is_not_clamped(spark):
    raw = events(
        spark,
        [("10-01 00:00:00", "cart"), ("10-01 00:00:01", "purchase"), ("10-01 00:00:02", "purchase")],
    )
    found = one(gold.gold_daily(silver_events(raw)))
    assert found["cart_abandonment_rate"] == -100
    assert found["cart_abandonment_rate"] + found["cart_to_purchase_rate"] == 100


def test_schemas(spark):
    silver = silver_events(edge_frame(spark))
    for df, schema in (
        (silver, SILVER),
        (gold.gold_daily(silver), GOLD_DAILY),
        (gold.gold_hourly(silver), GOLD_HOURLY),
        (gold.gold_category(silver), GOLD_CATEGORY),
    ):
        assert df.columns == schema.names
        assert {r["status"] for r in rows(schema_check(df, schema))} == {"ok"}
    broken = silver.drop("brand").withColumn("helper", F.lit(1)).withColumn("hour", F.lit("x"))
    status = {r["column_name"]: r["status"] for r in rows(schema_check(broken, SILVER))}
    assert (status["brand"], status["helper"], status["hour"]) == ("missing", "extra", "type")
    filled = {r["column_name"]: r["filled_rows"] for r in rows(schema_check(broken, SILVER))}
    assert (filled["brand"], filled["price"], filled["category_l3"]) == (None, 8, 1)


def test_facts_agree_with_each_other(spark, sf001):
    from shoptide.sources.driver_tables import shop_events

    silver = silver_events(shop_events(spark, sf001)).cache()
    sums = [
        one(f.agg(*(F.sum(c).alias(c) for c in ("total_events", "total_views", "total_carts", "total_purchases")),
                  F.round(F.sum("total_revenue"), 2).alias("revenue")))
        for f in (gold.gold_daily(silver), gold.gold_hourly(silver), gold.gold_category(silver))
    ]
    assert sums[0] == sums[1] == sums[2]
    shares = one(gold.gold_category(silver).agg(F.sum("pct_revenue").alias("r"), F.sum("pct_purchases").alias("p")))
    assert shares["r"] == pytest.approx(100) and shares["p"] == pytest.approx(100)
    assert one(silver_reports.stage_consistency(silver))["violating_pairs"] == 0
    assert silver.where("NOT price > 0").count() == 0
    assert silver.count() == 9798
    silver.unpersist()


def test_needed_events_give_the_same_daily_fact(spark, sf001):
    from shoptide.sources.driver_tables import shop_events

    raw = shop_events(spark, sf001)
    direct = gold.gold_daily(silver_needed(raw, "user_session", "price")).collect()
    assert direct == gold.gold_daily(silver_events(raw)).collect()


def test_approximate_fact_keeps_all_columns(spark):
    exact = fact(edge_frame(spark), ["event_type"], ["total_events", "unique_users"])
    approx = fact(edge_frame(spark), ["event_type"], ["total_events", "unique_users"], exact=False)
    assert sorted(exact.collect()) == sorted(approx.collect())


def test_value_shares_count_nulls(spark):
    shares = {r["brand"]: (r["n"], r["pct"]) for r in rows(value_shares(edge_frame(spark), "brand"))}
    assert shares[None] == (3, 25.0)


@pytest.mark.parametrize("slices", [2, 7, 200])
def test_exact_quantiles_equal_sorting(spark, slices):
    import numpy as np

    rng = random.Random(slices)
    a = [round(rng.expovariate(1) * 100, 2) for _ in range(500)] + [5.0] * 400
    b = [float(rng.randint(0, 3)) for _ in range(900)]
    c = [None] * 899 + [42.0]
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double").repartition(5)
    points = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = {r["column_name"]: r["q"] for r in rows(exact_quantiles(df, "abc", points, slices))}
    for name, values in (("a", a), ("b", b), ("c", [42.0])):
        assert found[name] == pytest.approx(list(np.quantile(values, points)))


def test_missing_days(spark):
    silver = silver_events(edge_frame(spark))
    missing = silver_reports.missing_days(silver, dt.date(2019, 10, 1), dt.date(2019, 10, 7))
    assert [r["date"].day for r in rows(missing)] == [2, 3, 4]


def test_a_nan_price_counts_as_missing_in_money(spark):
    raw = events(
        spark,
        [("10-01 00:00:00", "purchase", 1, "a", "x", float("nan")),
         ("10-01 00:00:01", "purchase", 1, "a", "x", 2.5),
         ("10-01 00:00:02", "purchase", 1, "a", "x", None)],
    )
    found = one(fact(raw, ["user_id"], ["total_revenue", "avg_price"]))
    assert (found["total_revenue"], found["avg_price"]) == (2.5, 2.5)


def test_money_does_not_depend_on_row_order(spark):
    prices = [0.1, 0.2, 0.3, 1e9, 0.7, 0.01] * 50
    raw = events(spark, [("10-01 00:00:00", "purchase", i, "a", "x", p) for i, p in enumerate(prices)])
    sums = {
        one(fact(raw.repartition(n), ["user_id"], ["total_revenue"]))["total_revenue"] for n in (1, 3, 7)
    }
    assert sums == {50 * 1_000_000_001.31}


def test_session_paths_hold_every_step(spark):
    from shoptide.plans.dimensions import session_paths

    steps = [("10-01 08:00:00", "view"), ("10-01 08:01:00", "cart"), ("10-01 08:02:00", "view")]
    rows = [(*step, 1, "a.b", "x", 1.0, 1, "long") for step in steps]
    rows += [("10-02 23:59:59", "purchase", 1, "a.b", "x", 1.0, 1, "long")]
    rows += [("10-01 08:00:00", kind, n, "a.b", "x", 1.0, 2, "tie") for n in (1, 2) for kind in ("cart", "view", "gift")]
    rows += [("10-01 08:00:00", "view", 1, "a.b", "x", 1.0, 3, None)]
    got = {r.path: r.sessions for r in session_paths(events(spark, rows)).collect()}
    assert got == {"view>cart>view>purchase": 1, "view>view>cart>cart>gift>gift": 1}
