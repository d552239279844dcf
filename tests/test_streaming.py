"""Streams over files give what the batch gives, but for windows the watermark still holds open."""

from __future__ import annotations

import json
import uuid

import pandas as pd
import pytest
from frames import EDGE, edge_frame, events
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import TimerValues

from shoptide.operators import cleaning, enrichment
from shoptide.operators.metrics import fact
from shoptide.plans.gold import gold_daily
from shoptide.plans.silver import silver_rows
from shoptide.schemas import RAW
from shoptide.sources.driver_tables import shop_events
from shoptide.sources.tables import read_events
from shoptide.streaming import funnel_state, jobs, sinks, sources
from shoptide.streaming.funnel_state import expiring_stage


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """The raw shop events of sf0.001 as files, in time order so that no event comes late."""
    folder = tmp_path_factory.mktemp("feed") / "events"
    raw = shop_events(spark, "/root/testdata/sf0.001")
    zoned = raw.withColumn("event_time", F.col("event_time").cast("timestamp"))
    zoned.coalesce(1).sortWithinPartitions("event_time").write.parquet(str(folder))
    return str(folder)


def run(stream, mode, tmp_path, spark):
    name = f"t{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    finished = query.awaitTermination(120)
    query.stop()
    assert finished
    return spark.table(name)


def content(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


def test_silver_rows(spark, feed, tmp_path):
    found = run(jobs.silver_rows(sources.read_file_stream(spark, feed)), "append", tmp_path, spark)
    raw = spark.read.parquet(feed)
    expected = raw.transform(cleaning.keep_valid_prices).transform(cleaning.fill_unknown)
    expected = expected.transform(enrichment.enrich_temporal).transform(enrichment.parse_categories)
    assert content(found) == content(expected.transform(enrichment.add_calendar_parts))


def test_dedup(spark, feed, tmp_path):
    stream = jobs.dedup(sources.read_file_stream(spark, feed).transform(cleaning.keep_valid_prices))
    found = run(stream, "append", tmp_path, spark)
    # Copies are equal in every column, so any survivor is the same row.
    expected = cleaning.dedup_events(cleaning.keep_valid_prices(spark.read.parquet(feed)))
    assert content(found) == content(expected)


def test_hourly_windows(spark, feed, tmp_path):
    rows = sources.read_file_stream(spark, feed).transform(cleaning.keep_valid_prices)
    found = run(jobs.hourly_windows(jobs.dedup(rows), delay=None), "append", tmp_path, spark)
    clean = cleaning.dedup_events(cleaning.keep_valid_prices(spark.read.parquet(feed)))
    hours = fact(
        clean, [F.date_trunc("hour", "event_time").alias("window_start")],
        ["total_events", "unique_users", "total_views", "total_purchases", "total_revenue"],
    )
    got = {r.window_start: r for r in found.collect()}
    want = {r.window_start: r for r in hours.collect()}
    assert set(got) <= set(want) and 0 <= len(want) - len(got) <= 1
    assert max(want) not in got
    for start, row in got.items():
        for c in ("total_events", "total_views", "total_purchases", "total_revenue", "unique_users"):
            assert row[c] == want[start][c]


def test_sliding_traffic_sees_each_event_four_times(spark, feed, tmp_path):
    stream = jobs.sliding_traffic(sources.read_file_stream(spark, feed))
    found = run(stream, "complete", tmp_path, spark)
    total = found.agg(F.sum("total_events")).first()[0]
    assert total == 4 * spark.read.parquet(feed).count()


def test_user_sessions(spark, feed, tmp_path):
    found = run(jobs.user_sessions(sources.read_file_stream(spark, feed)), "append", tmp_path, spark)
    batch = jobs.user_sessions(spark.read.parquet(feed), delay=None)
    got, want = set(map(str, found.collect())), set(map(str, batch.collect()))
    assert got < want and len(want) - len(got) <= 2


def test_running_stage(spark, feed, tmp_path):
    stream = jobs.running_stage(sources.read_file_stream(spark, feed))
    found = run(stream, "complete", tmp_path, spark)
    staged = enrichment.conversion_stage(spark.read.parquet(feed))
    assert content(found) == content(staged.select("user_id", "product_id", "conversion_stage").distinct())


def test_expiring_stage(spark, tmp_path):
    folder = tmp_path / "in"
    settings = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # State with a time to live asks for one more batch for ever, which a run of what is there
        # (availableNow) must not wait for.
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        for i, part in enumerate((EDGE[:3], EDGE[3:])):
            events(spark, part).coalesce(1).write.mode("append").parquet(str(folder))
        stream = sources.read_file_stream(spark, str(folder), maxFilesPerTrigger="1")
        found = run(expiring_stage(stream), "update", tmp_path, spark)
        last = {}
        order = ["viewed_only", "added_to_cart", "purchased"]
        for r in found.collect():
            pair = (r.user_id, r.product_id)
            last[pair] = max(last.get(pair, -1), order.index(r.conversion_stage))
        assert {k: order[v] for k, v in last.items()} == {
            (10, 1): "purchased", (11, 2): "added_to_cart", (12, 3): "viewed_only",
            (13, 4): "purchased", (13, 5): "purchased",
        }
    finally:
        for setting in settings:
            spark.conf.unset(setting)


def test_expiring_stage_keeps_nulls_and_long_numbers(spark, tmp_path):
    big = 2**60 + 1
    rows = [("10-01 10:00:00", kind, product, "a", "x", 5.0, user, "s") for kind, product, user in (
        ("view", big, None), ("cart", big, None), ("view", None, big), ("purchase", big, big), ("view", 0, 0)
    )]
    events(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    settings = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    for setting, value in settings.items():
        spark.conf.set(setting, value)
    try:
        found = run(expiring_stage(sources.read_file_stream(spark, str(tmp_path / "in"))), "update", tmp_path, spark)
        assert {tuple(r) for r in found.collect()} == {
            (None, big, "added_to_cart"), (big, None, "viewed_only"), (big, big, "purchased"), (0, 0, "viewed_only"),
        }
    finally:
        for setting in settings:
            spark.conf.unset(setting)


class Remembered:
    """A value state that counts how often it is read and written."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema, ttlDurationMs):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value


def test_many_pairs_read_their_state_at_once():
    """A bucket of pairs costs one read and one write, pairs expire one by one, nulls are values."""
    state = Remembered()
    stages = funnel_state._FurthestStages(100)
    stages.init(state)

    def rose(now, *batches):
        frames = [pd.DataFrame(b, columns=["user_id", "product_id", "missing", "rank"]) for b in batches]
        found = stages.handleInputRows((0,), iter(frames), TimerValues(now, -1))
        return sorted(tuple(r) for frame in found for r in frame.itertuples(index=False))

    many = [(u, 1, 0, u % 3) for u in range(1000)]
    assert rose(0, many[:600], many[500:]) == many and state.calls == 2
    assert rose(50, [(7, 1, 0, 0), (0, 1, 0, 2), (0, 1, 1, 0)]) == [(0, 1, 0, 2), (0, 1, 1, 0)]
    # All but the pairs of the batch before are forgotten by now.
    assert rose(100, [(7, 1, 0, 1), (8, 1, 0, 0), (0, 1, 0, 1)]) == [(8, 1, 0, 0)]
    assert {u for u, *_ in zip(*state.value)} == {0, 7, 8} and len(state.value[0]) == 4


def test_daily_upsert(spark, tmp_path):
    folder, silver, gold = (str(tmp_path / n) for n in ("in", "silver", "gold"))
    # The third file holds a copy of an event of the first.
    for part in (EDGE[:3], EDGE[3:8], EDGE[8:] + EDGE[:1]):
        events(spark, part).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.silver_rows(sources.read_file_stream(spark, folder, maxFilesPerTrigger="1"))
    query = sinks.start_daily_upsert(stream, silver, gold, f"u{uuid.uuid4().hex}", availableNow=True)
    assert query.awaitTermination(120)
    expected = gold_daily(silver_rows(edge_frame(spark)))
    found = spark.read.parquet(gold).select(*expected.columns)
    assert content(found) == content(expected)

    # A batch that runs again changes nothing.
    before = read_events(spark, silver).count()
    again = jobs.silver_rows(events(spark, EDGE[:3]))
    sinks.upsert_daily(silver, gold)(again, 0)
    assert read_events(spark, silver).count() == before
    assert content(spark.read.parquet(gold).select(*expected.columns)) == content(expected)


def test_events_sink(spark, feed, tmp_path):
    path = str(tmp_path / "out")
    stream = jobs.silver_rows(sources.read_file_stream(spark, feed))
    query = sinks.start_events_sink(stream, path, f"s{uuid.uuid4().hex}", availableNow=True)
    assert query.awaitTermination(120)
    assert read_events(spark, path).count() == cleaning.keep_valid_prices(spark.read.parquet(feed)).count()


def test_messages(spark):
    message = {
        "event_time": "2019-10-01T00:30:00Z", "event_type": "cart", "product_id": 1, "category_id": 2,
        "category_code": "a.b", "brand": None, "price": 1.5, "user_id": 3, "user_session": "s",
    }
    raw = spark.createDataFrame([(bytearray(json.dumps(message).encode()),)], "value BINARY")
    decoded = sources.decode_messages(raw)
    assert decoded.schema == RAW
    row = decoded.first()
    assert (row.event_type, row.price, row.brand, row.event_time.isoformat()) == (
        "cart", 1.5, None, "2019-10-01T00:30:00",
    )


def test_messages_that_do_not_fit_are_kept_apart(spark):
    rows = [(b"no json", 1), (b'{"product_id": "x", "event_type": "cart"}', 2), (None, 3)]
    rows += [(b'{"event_type": "cart", "price": 1.5}', 4)]
    raw = spark.createDataFrame([(bytearray(v) if v else None, k) for v, k in rows], "value BINARY, k INT")
    assert [r.price for r in sources.decode_messages(raw).collect()] == [1.5]
    rejected = sources.rejected_messages(raw)
    assert rejected.columns == ["value", "k"]
    assert sorted(r.k for r in rejected.collect()) == [1, 2, 3]


def test_checkpoints_need_a_shared_folder(spark):
    from shoptide.session import shared_folder

    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
