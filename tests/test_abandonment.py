"""Carts and what follows them, in batch and as two joined streams."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pytest
from frames import events
from pyspark.sql import functions as F

from shoptide.plans import abandonment
from shoptide.schemas import RAW
from shoptide.streaming.abandonment import abandoned_cart_stream


def at(hours: float) -> str:
    return (dt.datetime(2019, 10, 1) + dt.timedelta(hours=hours)).strftime("%m-%d %H:%M:%S")


def brute(rows, hours):
    end = max(t for t, *_ in rows)
    out = []
    for time, kind, user, product in rows:
        if kind == "cart":
            bought = any(k == "purchase" and u == user and p == product and time <= t <= time + hours for t, k, u, p in rows)
            out.append((round(time, 3), user, product, "converted" if bought else "open" if time + hours > end else "abandoned"))
    return sorted(out)


def frame(spark, rows):
    return events(spark, [(at(t), k, p, "a", "x", 1.0, u, "s") for t, k, u, p in rows])


def outcomes(spark, rows, hours):
    start = F.unix_timestamp(F.lit("2019-10-01 00:00:00"))
    found = abandonment.cart_outcomes(frame(spark, rows), hours).select(
        ((F.unix_timestamp("event_time") - start) / 3600).alias("t"), "user_id", "product_id", "outcome"
    )
    return sorted((round(r.t, 3), r.user_id, r.product_id, r.outcome) for r in found.collect())


def test_outcomes_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(0, 400 * 4) / 4, rng.choice(["view", "cart", "purchase"]), rng.randrange(4), rng.randrange(5)) for _ in range(900)]
    for hours in (1, 24, 72):
        assert outcomes(spark, rows, hours) == brute(rows, hours)


@pytest.mark.parametrize("gap,outcome", [(0, "converted"), (24, "converted"), (24.25, "abandoned"), (-0.25, "abandoned")])
def test_bounds_of_the_time(spark, gap, outcome):
    """Bought at once, at the last moment, too late, before."""
    for cart in (0.5, 24, 47.75):
        rows = [(cart, "cart", 1, 1), (cart + gap, "purchase", 1, 1), (200, "view", 1, 1)]
        assert [o for *_, o in outcomes(spark, rows, 24)] == [outcome]


def test_open_carts_are_reported_apart(spark):
    rows = [(0, "cart", 1, 1), (1, "cart", 1, 2), (2, "purchase", 1, 2), (30, "cart", 1, 3), (40, "cart", 2, 1)]
    found = {r.date.day: r.asDict() for r in abandonment.abandoned_carts(frame(spark, rows)).collect()}
    assert found[1]["converted_carts"] == 1 and found[1]["abandoned_carts"] == 1 and found[1]["abandonment_pct"] == 50
    assert found[2]["open_carts"] == 2 and found[2]["abandonment_pct"] is None


def test_carts_without_user_and_empty_table(spark):
    df = events(spark, [(at(0), "cart", 1, "a", "x", 1.0, None, "s"), (at(1), "purchase", 1, "a", "x", 1.0, None, "s"), (at(99), "view", 1, "a", "x", 1.0, 1, "s")])
    assert [r.outcome for r in abandonment.cart_outcomes(df).collect()] == ["abandoned"]
    assert abandonment.abandoned_carts(spark.createDataFrame([], RAW)).collect() == []


def test_hot_pair_is_spread_and_nothing_crosses(spark):
    rows = [(i / 10, "cart" if i % 2 else "purchase", 1, 1) for i in range(4000)]
    df = abandonment.cart_outcomes(frame(spark, rows), 1)
    assert df.groupBy("outcome").count().collect() and df.count() == 2000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "bucket" in plan


def stream_of(spark, folder: Path, kind: str):
    raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return raw.where(F.col("event_type") == kind)


def run(spark, tmp_path, feed):
    """The batches of a feed one file after the other; carts given out."""
    folder = tmp_path / "in"
    for rows in feed:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))
    found = abandoned_cart_stream(stream_of(spark, folder, "cart"), stream_of(spark, folder, "purchase"), 24)
    writer = found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
    writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint"))
    assert writer.trigger(availableNow=True).start().awaitTermination(120) is not False
    return sorted((r.user_id, r.product_id, r.cart_time.day, r.cart_time.hour) for r in spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect())


def test_stream_gives_abandoned_carts_once_their_time_is_up(spark, tmp_path):
    feed = [
        [(0, "cart", 1, 1), (1, "cart", 1, 2), (2, "purchase", 9, 9)],
        [(20, "purchase", 1, 2), (21, "cart", 1, 3)],  # the second cart is converted in a later file
        [(60, "cart", 9, 8), (60, "purchase", 9, 9)],
    ]
    assert run(spark, tmp_path, feed) == [(1, 1, 1, 0), (1, 3, 1, 21)]  # that of hour 60 is open


def test_late_rows_of_a_stream(spark, tmp_path):
    feed = [
        [(0, "cart", 1, 1), (0, "purchase", 9, 9)],
        [(100, "cart", 9, 7), (100, "purchase", 9, 9)],
        # Spark tells late rows by the watermark of the batch before the last.
        [(100.5, "cart", 9, 4), (100.5, "purchase", 9, 9)],
        # Far behind the watermark: the cart was given out already, this one is never seen.
        [(5, "purchase", 1, 1), (6, "cart", 1, 2), (101, "cart", 9, 6)],
        [(200, "cart", 9, 5), (200, "purchase", 9, 9)],
    ]
    found = run(spark, tmp_path, feed)
    assert (1, 1, 1, 0) in found and not any(p == 2 for _, p, *_ in found)
    assert found == sorted(set(found))
