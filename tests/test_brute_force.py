"""Clean events and facts against plain Python on random events."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from frames import events

from shoptide.plans.gold import gold_category, gold_daily, gold_hourly
from shoptide.plans.silver import silver_events


def random_events(seed, n=300):
    rng = random.Random(seed)
    kinds = ["view"] * 6 + ["cart", "purchase", "remove"]
    codes = [None, "a", "a.b", "a.b.c", "d.e", "unknown", "Unknown", "d.e.f.g"]
    prices = [None, 0.0, -1.0, float("nan"), 0.01, 10.1, 99.99, 1234.56]
    return [
        (
            f"10-{rng.randint(1, 4):02d} {rng.randint(0, 23):02d}:00:00", rng.choice(kinds),
            rng.randint(1, 3), rng.choice(codes), rng.choice([None, "x", "y"]), rng.choice(prices),
            rng.choice([None, 1, 2, 3]), rng.choice([None, "s", "t"]),
        )
        for _ in range(n)
    ]


def clean(rows):
    best = {}
    for time, kind, product, code, brand, price, user, session in rows:
        if price is None or not price > 0:
            continue
        moment = dt.datetime.strptime(f"2019-{time}", "%Y-%m-%d %H:%M:%S")
        tie = (session is None, session or "", price, code or "Unknown", brand or "Unknown")
        key = (user, product, kind, moment)
        best[key] = min(best.get(key, tie), tie)
    return [
        dict(user=k[0], product=k[1], kind=k[2], time=k[3], session=None if t[0] else t[1],
             price=t[2], code=t[3], brand=t[4])
        for k, t in best.items()
    ]


def measures(rows):
    def distinct(name):
        return len({r[name] for r in rows} - {None})

    kinds = [r["kind"] for r in rows]
    views, carts, buys = (kinds.count(k) for k in ("view", "cart", "purchase"))
    revenue = sum(round(r["price"] * 100) for r in rows if r["kind"] == "purchase") / 100

    def ratio(a, b, scale=1.0):
        return a / b * scale if b else 0.0

    return {
        "total_events": len(rows), "unique_users": distinct("user"),
        "unique_sessions": distinct("session"), "unique_products": distinct("product"),
        "total_views": views, "total_carts": carts, "total_purchases": buys,
        "total_revenue": revenue,
        "avg_price": sum(round(r["price"] * 100) for r in rows) / 100 / len(rows),
        "avg_order_value": ratio(revenue, buys), "revenue_per_user": ratio(revenue, distinct("user")),
        "conversion_rate": ratio(buys, views, 100), "add_to_cart_rate": ratio(carts, views, 100),
        "cart_to_purchase_rate": ratio(buys, carts, 100),
        "cart_abandonment_rate": ratio(carts - buys, carts, 100),
        "events_per_user": ratio(len(rows), distinct("user")),
        "purchases_per_user": ratio(buys, distinct("user")),
    }


def grouped(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return {k: measures(v) for k, v in groups.items()}


def check(df, key_columns, expected):
    found = {tuple(r[c] for c in key_columns): r.asDict() for r in df.collect()}
    assert set(found) == set(expected)
    for key, want in expected.items():
        for name, value in want.items():
            if name in found[key]:
                assert found[key][name] == pytest.approx(value), (key, name)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_silver_and_facts(spark, seed):
    rows = random_events(seed)
    silver = silver_events(events(spark, rows).repartition(4)).cache()
    expected = clean(rows)
    assert sorted(
        str((r.user_id, r.product_id, r.event_type, r.event_time, r.user_session, r.price,
             r.category_code, r.brand)) for r in silver.collect()
    ) == sorted(
        str((r["user"], r["product"], r["kind"], r["time"], r["session"], r["price"], r["code"],
             r["brand"])) for r in expected
    )
    check(gold_daily(silver), ["date"], grouped(expected, lambda r: (r["time"].date(),)))
    check(gold_hourly(silver), ["date", "hour"],
          grouped(expected, lambda r: (r["time"].date(), r["time"].hour)))
    categories = grouped(
        [r for r in expected if r["code"].split(".")[0] != "unknown"],
        lambda r: (r["code"].split(".")[0],),
    )
    revenue = sum(m["total_revenue"] for m in categories.values())
    buys = sum(m["total_purchases"] for m in categories.values())
    for m in categories.values():
        m["pct_revenue"] = m["total_revenue"] / revenue * 100
        m["pct_purchases"] = m["total_purchases"] / buys * 100
    check(gold_category(silver), ["category_l1"], categories)
    silver.unpersist()
