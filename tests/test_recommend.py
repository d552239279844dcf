"""Recommendations, neighbours and churn on events with a planted answer."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from frames import events
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoptide.plans import churn, recommend
from shoptide.schemas import RAW

DAY = dt.date(2019, 10, 15)


@pytest.fixture(scope="module")
def tastes(spark):
    """60 users in 4 groups, each group with 12 products of its own out of 48; before the 15th every user
    sees eight of them, from the 15th on each buys two others of the group. Products of group 0 are seen
    most often by far."""
    rng, rows = random.Random(3), []
    for user in range(60):
        group = user % 4
        own = [group * 12 + i for i in range(12)]
        rng.shuffle(own)
        for product in own[:8]:
            for n in range(6 if group == 0 else 2):
                rows.append((f"10-{1 + rng.randrange(14):02d} 10:00:{n:02d}", "view", product, "a", "x", 1.0, user, f"s{user}"))
        for product in own[8:10]:
            rows.append(("10-16 10:00:00", "purchase", product, "a", "x", 1.0, user, f"t{user}"))
    rows.append(("10-17 10:00:00", "view", 3, "a", "x", 1.0, 999, "new"))  # only after the 15th
    return events(spark, rows).cache()


OPTIONS = {"factors": 8, "rounds": 8}


def test_factors_beat_popularity(spark, tastes):
    found = {r.method: r for r in recommend.recommendation_recall(tastes, DAY, 12, **OPTIONS).collect()}
    assert found["als"].users == found["popular"].users == 60
    assert found["als"].recall > 0.9 and found["popular"].recall < 0.5


def test_every_user_gets_products(spark, tastes):
    rows = recommend.recommend_products(tastes, DAY, 5, **OPTIONS).collect()
    by_user = defaultdict(list)
    for r in rows:
        by_user[r.user_id].append(r)
    assert set(by_user) == {*range(60), 999}
    for user, mine in by_user.items():
        assert sorted(r.rank for r in mine) == [1, 2, 3, 4, 5] and len({r.product_id for r in mine}) == 5
        assert {r.source for r in mine} == {"popular" if user == 999 else "als"}
        ordered = sorted(mine, key=lambda r: r.rank)
        assert [r.score for r in ordered] == sorted((r.score for r in mine), reverse=True)
    assert {r.product_id for r in by_user[999]} <= set(range(12))


def test_later_events_change_no_recommendation_but_for_new_users(spark, tastes):
    more = tastes.unionByName(events(spark, [("10-20 10:00:00", "purchase", 47, "a", "x", 1.0, u, "z") for u in range(60)]))
    first = {(r.user_id, r.rank): r.product_id for r in recommend.recommend_products(tastes, DAY, 3, **OPTIONS).collect()}
    second = {(r.user_id, r.rank): r.product_id for r in recommend.recommend_products(more, DAY, 3, **OPTIONS).collect()}
    assert first == second


def test_nothing_to_learn_from(spark, tastes):
    assert recommend.recommend_products(tastes, dt.date(2019, 1, 1)).collect() == []
    assert recommend.recommend_products(spark.createDataFrame([], RAW), DAY).collect() == []


def test_blocks_give_the_best_of_all_products(spark, monkeypatch):
    monkeypatch.setattr(recommend, "BLOCK", 7)
    rng = random.Random(4)
    users, products = ([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(n)] for n in (23, 40))
    frame = lambda rows: spark.createDataFrame(rows, "id INT, features ARRAY<FLOAT>")
    found = recommend.best_products(frame(users), frame(products), 6).collect()
    for user, u in users:
        best = sorted(((-sum(a * b for a, b in zip(u, p)), i) for i, p in products))[:6]
        assert [r.product for r in sorted((r for r in found if r.user == user), key=lambda r: r.rank)] == [i for _, i in best]


def test_numbers_have_no_gap(spark):
    df = spark.range(0, 5000, 7).selectExpr("id * id AS v").union(spark.range(50).selectExpr("id AS v"))
    rows = recommend.dense_numbers(df, "v", "n").collect()
    assert sorted(r.n for r in rows) == list(range(len({r.v for r in df.collect()})))
    assert len({r.v for r in rows}) == len(rows)


def neighbours(rows, reach, k):
    sessions = defaultdict(dict)
    for time, product, session in rows:
        seen = sessions[session]
        seen[product] = min(time, seen.get(product, time))
    norm, weight, count = Counter(), Counter(), Counter()
    for seen in sessions.values():
        order = sorted(seen, key=lambda p: (seen[p], p))
        w = 1_000_000 // len(order)
        for i, a in enumerate(order):
            norm[a] += w
            for b in order[i + 1 : i + 1 + reach]:
                for pair in ((a, b), (b, a)):
                    weight[pair] += w
                    count[pair] += 1
    out = set()
    for product in norm:
        mine = [(-weight[a, b] / math.sqrt(float(norm[a]) * norm[b]), b) for a, b in weight if a == product]
        out |= {(product, i, b, count[product, b], round(-c, 12)) for i, (c, b) in enumerate(sorted(mine)[:k], 1)}
    return out


def test_neighbours_equal_brute_force(spark):
    rng, rows = random.Random(5), []
    for session in range(80):
        for _ in range(rng.choice([1, 2, 5, 40])):
            rows.append((f"10-01 10:{rng.randrange(60):02d}:00", rng.randrange(30), f"s{session}"))
    # A product in every session, and a session of very many products.
    rows += [("10-01 10:30:00", 7, f"s{s}") for s in range(80)] + [(f"10-01 11:{p % 60:02d}:00", p, "long") for p in range(30)]
    df = events(spark, [(t, "view", p, "a", "x", 1.0, 1, s) for t, p, s in rows])
    found = recommend.product_neighbours(df, 4, 3)
    got = {(r.product_id, r["rank"], r.neighbour_id, r.sessions, round(r.cosine, 12)) for r in found.collect()}
    assert got == neighbours(rows, 3, 4)
    assert max(r.cosine for r in found.collect()) <= 1


def test_pairs_grow_with_events_not_their_square(spark):
    rows = [(f"10-01 {p // 3600:02d}:{p // 60 % 60:02d}:{p % 60:02d}", "view", p, "a", "x", 1.0, 1, "s") for p in range(3000)]
    found = recommend.product_neighbours(events(spark, rows), 100, 5)
    assert found.count() == 2 * (3000 * 5 - 15)


@pytest.fixture(scope="module")
def buyers(spark):
    """Users that buy nearly every day, and users whose purchases end, or become rare, on a day of their
    own; before they stop they see fewer and fewer products."""
    rng, rows = random.Random(6), []
    for user in range(300):
        stops = rng.randrange(8, 40) if user % 2 else 99
        for day in range(1, 29):
            left = stops - day
            if left <= 0 and rng.random() < 0.93:
                continue
            for n in range(max(1, min(left, 6))):
                kind = "purchase" if n == 0 and rng.random() < (0.85 if left > 0 else 0.02) else "view"
                rows.append((f"10-{day:02d} 1{n}:00:00", kind, rng.randrange(20), "a", "x", 5.0, user, f"{user}-{day}"))
    return events(spark, rows).cache()


AS_OF = dt.date(2019, 10, 22)


def test_held_out_users_are_told_apart(spark, buyers):
    scored = churn.churn_scores(buyers, AS_OF)
    labels = churn.labelled(buyers, AS_OF).select("user_id", "label")
    held = scored.where("held_out").join(labels, "user_id")
    assert held.groupBy("label").count().count() == 2
    assert churn.area_under_curve(held) > 0.85


def test_nothing_after_the_day_changes_features_or_scores(spark, buyers):
    later = events(spark, [(f"10-{d} 10:00:00", "purchase", 1, "a", "x", 9.0, u, "z") for u in range(300) for d in (22, 23)])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(churn.churn_features(buyers, AS_OF)) == rows(churn.churn_features(buyers.unionByName(later), AS_OF))
    before = {r.user_id: r.churn_probability for r in churn.churn_scores(buyers, AS_OF).collect()}
    after = {r.user_id: r.churn_probability for r in churn.churn_scores(buyers.unionByName(later), AS_OF).collect()}
    assert before.keys() == after.keys() and all(abs(before[u] - after[u]) < 1e-6 for u in before)


def test_scores_in_a_session_that_observed_rows(spark, buyers):
    """A model straight from its fit drags the session along, and that cannot be sent any more then."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    assert all(0 <= r.churn_probability <= 1 for r in churn.churn_scores(buyers, AS_OF).collect())


def test_held_out_users_are_not_learnt_from(spark, buyers):
    examples = churn.labelled(buyers, dt.date(2019, 10, 15))
    turned = examples.withColumn("label", F.when(F.col("held_out"), 1 - F.col("label")).otherwise(F.col("label")))
    models = [churn.train_churn(e).stages[-1] for e in (examples, turned)]
    assert all(abs(a - b) < 1e-6 for a, b in zip(*(m.coefficients for m in models)))


def test_features_of_one_user(spark):
    rows = [
        ("10-01 10:00:00", "purchase", 1, "a", "x", 50.0, 1, "old"),  # before the lookback
        ("10-10 10:00:00", "purchase", 1, "a", "x", 2.5, 1, "s"), ("10-10 10:05:00", "cart", 2, "a", "x", 1.0, 1, "s"),
        ("10-20 23:59:59", "view", 2, "a", "x", 1.0, 1, "t"), ("10-22 00:00:00", "purchase", 2, "a", "x", 1.0, 1, "u"),
    ]
    found = churn.churn_features(events(spark, rows), AS_OF).collect()
    assert [r.asDict() for r in found] == [
        {
            "user_id": 1, "days_since_event": 2, "days_since_purchase": 12, "events": 3, "carts": 1,
            "purchases": 1, "sessions": 2, "products": 2, "active_days": 2, "revenue": 2.5,
            "recent_events": 1, "recent_purchases": 0,
        }
    ]


def test_no_history_gives_no_probability(spark):
    df = events(spark, [("10-20 10:00:00", "view", 1, "a", "x", 1.0, 1, "s")])
    assert [r.churn_probability for r in churn.churn_scores(df, AS_OF).collect()] == [None]
    assert churn.churn_scores(spark.createDataFrame([], RAW), AS_OF).collect() == []


def test_area_under_curve(spark):
    rows = [(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.3, 0.0), (0.1, 0.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "churn_probability DOUBLE, label DOUBLE")
    assert churn.area_under_curve(df) == pytest.approx((3 + 2.5) / 6)
    assert churn.area_under_curve(df.where("label = 1")) is None
