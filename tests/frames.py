"""The hand-made edge frame."""

from __future__ import annotations

import datetime as dt

from shoptide.schemas import RAW

EDGE = [
    ("10-01 00:30:00", "view", 1, "electronics.smartphone", "samsung", 100.0, 10, "s1"),
    ("10-01 00:30:00", "view", 1, "electronics.smartphone", "samsung", 100.0, 10, "s1"),
    ("10-01 05:59:59", "cart", 1, "electronics.smartphone", "samsung", 100.0, 10, "s1"),
    ("10-01 06:00:00", "purchase", 1, "electronics.smartphone", "samsung", 100.0, 10, "s1"),
    ("10-01 12:00:00", "view", 2, None, None, 50.0, 11, "s2"),
    ("10-05 18:00:00", "cart", 2, None, None, 50.0, 11, "s2"),
    ("10-06 22:00:00", "view", 3, "a.b.c.d", "acme", 10.0, 12, "s3"),
    ("10-06 23:00:00", "view", 3, "apparel", "acme", 0.0, 12, "s3"),
    ("10-06 23:10:00", "view", 3, "apparel", "acme", None, 12, "s3"),
    ("10-06 23:20:00", "view", 3, "apparel", "acme", float("nan"), 12, "s3"),
    ("10-07 00:00:00", "purchase", 4, "apparel.shoes", None, 20.0, 13, "s4"),
    ("10-07 00:00:00", "purchase", 5, "apparel.shoes", "x", 30.0, 13, "s4"),
]


def event(time, event_type="view", product=1, code="a.b", brand="x", price=1.0, user=1, session="s"):
    moment = dt.datetime.strptime(f"2019-{time}", "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc)
    return (moment, event_type, product, None, code, brand, price, user, session)


def events(spark, rows):
    return spark.createDataFrame([event(*r) for r in rows], RAW)


def edge_frame(spark):
    return events(spark, EDGE)
