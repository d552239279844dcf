"""Which users are about to stop buying."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.functions import is_cart, is_purchase, total_money
from shoptide.session import reloaded

#: Inputs of the model; all of them are known on the evening before the day they are taken as of.
FEATURES = (
    "days_since_event", "days_since_purchase", "events", "carts", "purchases", "sessions", "products",
    "active_days", "revenue", "recent_events", "recent_purchases",
)
#: Days that features look back on: as many at every day they are taken as of, else counts would only
#: tell how long the data go back.
LOOKBACK_DAYS = 14
#: One of so many users, by a hash of the id, is never learnt from.
HELD_OUT_OF = 5


def churn_features(silver: DataFrame, as_of: dt.date, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """user_id and ``FEATURES`` from the ``lookback_days`` before ``as_of``; users without an event in
    them are not here. Recent is the later half of the time.

    One aggregate, combined in the map tasks; distinct counts are by sketch, so a user with very many
    events is no large group. Who bought nothing has ``days_since_purchase`` one above the lookback.
    """
    day = F.to_date("event_time")
    first = as_of - dt.timedelta(days=lookback_days)
    seen = silver.where((day >= F.lit(first)) & (day < F.lit(as_of)) & F.col("user_id").isNotNull())
    recent = day >= F.lit(as_of - dt.timedelta(days=lookback_days // 2))
    since = lambda c: F.date_diff(F.lit(as_of), F.max(c))
    return seen.groupBy("user_id").agg(
        since(day).alias("days_since_event"),
        F.coalesce(since(F.when(is_purchase(), day)), F.lit(lookback_days + 1)).alias("days_since_purchase"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_cart()).alias("carts"),
        F.count_if(is_purchase()).alias("purchases"),
        F.approx_count_distinct("user_session").alias("sessions"),
        F.approx_count_distinct("product_id").alias("products"),
        F.approx_count_distinct(day).alias("active_days"),
        total_money(F.col("price"), where=is_purchase()).alias("revenue"),
        F.count_if(recent).alias("recent_events"),
        F.count_if(recent & is_purchase()).alias("recent_purchases"),
    )


def churn_labels(silver: DataFrame, as_of: dt.date, horizon_days: int = 7) -> DataFrame:
    """The users that buy within the horizon that begins on ``as_of``."""
    day, last = F.to_date("event_time"), as_of + dt.timedelta(days=horizon_days)
    buys = silver.where(is_purchase() & (day >= F.lit(as_of)) & (day < F.lit(last)))
    return buys.select("user_id").where("user_id is not null").distinct()


def labelled(
    silver: DataFrame, as_of: dt.date, horizon_days: int = 7, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Features as of a day, ``label`` (1.0: no purchase within the horizon) and ``held_out``."""
    features = churn_features(silver, as_of, lookback_days)
    buyers = churn_labels(silver, as_of, horizon_days).withColumn("label", F.lit(0.0))
    held_out = F.pmod(F.crc32(F.col("user_id").cast("string")), F.lit(HELD_OUT_OF)) == 0
    joined = features.join(buyers, "user_id", "left").fillna(1.0, ["label"])
    return joined.withColumn("held_out", held_out)


def train_churn(examples: DataFrame, penalty: float = 0.01) -> PipelineModel:
    """Logistic regression on scaled features, from the examples that are not held out."""
    stages = [
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", regParam=penalty, maxIter=50),
    ]
    return reloaded(examples.sparkSession, Pipeline(stages=stages).fit(examples.where("not held_out")))


def churn_scores(
    silver: DataFrame, as_of: dt.date, horizon_days: int = 7, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Every user seen in the ``lookback_days`` before ``as_of``: user_id, features, held_out and churn_probability, the chance
    of no purchase in the ``horizon_days`` from that day on.

    The model learns from features one horizon earlier and from what followed them until ``as_of``, so
    nothing of the time it speaks about is used, in features or labels. Without a user at that earlier
    day there is nothing to learn from, and probabilities are null.
    """
    then = as_of - dt.timedelta(days=horizon_days)
    examples = labelled(silver, then, horizon_days, lookback_days)
    now = churn_features(silver, as_of, lookback_days)
    held_out = F.pmod(F.crc32(F.col("user_id").cast("string")), F.lit(HELD_OUT_OF)) == 0
    now = now.withColumn("held_out", held_out)
    if examples.where("not held_out").isEmpty():
        return now.withColumn("churn_probability", F.lit(None).cast("double"))
    scored = train_churn(examples).transform(now)
    chance = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*now.columns, chance.alias("churn_probability"))


def area_under_curve(
    scored: DataFrame, score: str = "churn_probability", label: str = "label", bins: int = 10_000
) -> float | None:
    """Chance that a random positive scores above a random negative, ties counting half; null where one
    of the two is missing. Scores from 0 to 1 are counted in ``bins`` steps, and those of one step tie."""
    counts = scored.where(F.col(score).isNotNull()).groupBy(F.round(F.col(score) * bins).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
    )
    # At most one row per bin.
    return counts.agg(
        F.expr(
            "aggregate(sort_array(collect_list(struct(s, p, n))),"
            " named_struct('below', 0D, 'won', 0D, 'p', 0D),"
            " (a, x) -> named_struct('below', a.below + x.n, 'won', a.won + x.p * (a.below + x.n / 2),"
            " 'p', a.p + x.p), a -> try_divide(a.won, a.p * a.below))"
        ).alias("area")
    ).first().area
