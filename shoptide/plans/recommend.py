"""What to show next: products per user by matrix factorisation, products beside a product by what
sessions see together."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.functions import is_purchase
from shoptide.session import shared_folder

#: How much an event says about a preference.
WEIGHTS = {fixed.VIEW: 1.0, fixed.CART: 3.0, fixed.PURCHASE: 5.0}
#: Rows of a block of factors: with 32 factors a block has 2 MB.
BLOCK = 16_384
#: Users scored against a block of products at once: 64 MB of scores.
TILE = 1_024
#: Products after a product in its session that count as seen together.
REACH = 10
#: Weights of sessions are whole millionths, so that sums do not depend on the order of rows.
UNIT = 1_000_000


def before(day: dt.date) -> Column:
    """Events of the days before ``day``."""
    return F.to_date("event_time") < F.lit(day)


def preferences(silver: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """user_id, product_id and the summed weight of the user's events of the product."""
    weight = F.coalesce(*(F.when(F.col("event_type") == t, F.lit(w)) for t, w in weights.items()), F.lit(0.0))
    known = silver.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    summed = known.groupBy("user_id", "product_id").agg(F.sum(weight).alias("weight"))
    return summed.where(F.col("weight") > 0)


def _written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, f"recommend-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_numbers(df: DataFrame, column: str, number: str) -> DataFrame:
    """The distinct values of a column numbered from 0 without a gap.

    Ranges are numbered by themselves, and the counts of the ranges before are added: one small row per
    range. The ranges are written first, as a second run could cut them elsewhere.
    """
    values = df.select(column).distinct().repartitionByRange(column)
    ranges = _written(values.withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return ranges.join(starts, "_range").select(column, (F.col("_start") + place).cast("int").alias(number))


def _blocks(factors: DataFrame, name: str) -> DataFrame:
    """Rows of at most ``BLOCK`` factors: numbers without a gap make the blocks even."""
    return factors.groupBy(F.floor(F.col("id") / BLOCK).cast("int").alias(f"{name}_block")).agg(
        F.collect_list(F.struct("id", "features")).alias(name)
    )


def _best_of_blocks(k: int):
    def matrix(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
        ids, features = cell.values.flatten()
        return ids.to_numpy(), features.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                users, u = matrix(batch.column(0)[row])
                products, p = matrix(batch.column(1)[row])
                take = min(k, len(products))
                for start in range(0, len(users), TILE):
                    scores = u[start : start + TILE] @ p.T
                    best = np.argpartition(-scores, take - 1, axis=1)[:, :take]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(users[start : start + TILE], take)),
                            pa.array(products[best.ravel()]),
                            pa.array(np.take_along_axis(scores, best, axis=1).ravel().astype(float)),
                        ],
                        names=["user", "product", "score"],
                    )

    return run


def best_products(users: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """user, product, score: the k products of the largest inner product per user.

    Both sides are frames of (id, features) with dense ids. Each block of users meets each block of
    products once, by an equal key, and hands on k products per user: what is shuffled grows with users
    times blocks of products, and a task holds two blocks.
    """
    right = _blocks(products, "products")
    last = right.agg(F.max("products_block")).scalar()
    left = _blocks(users, "users").withColumn("products_block", F.explode(F.sequence(F.lit(0), last)))
    met = left.join(right, "products_block").select("users", "products")
    found = met.mapInArrow(_best_of_blocks(k), "user INT, product INT, score DOUBLE")
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.col("score").desc(), "product"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def popular_products(liked: DataFrame, k: int) -> DataFrame:
    """rank, product_id, score: the products of the largest total weight."""
    totals = liked.groupBy("product_id").agg(F.sum("weight").alias("score"))
    first = totals.orderBy(F.col("score").desc(), "product_id").limit(k)
    # k rows.
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), "product_id"))
    return first.select(place.alias("rank"), "product_id", "score")


def recommend_products(
    silver: DataFrame, until: dt.date, k: int = 10, factors: int = 32, rounds: int = 10, seed: int = 7,
    strength: float = 10.0, penalty: float = 0.1,
) -> DataFrame:
    """k products per user from the events before ``until``: user_id, rank, product_id, score, source.

    Every user of ``silver`` gets products. Those with a preference before ``until`` get them by
    alternating least squares on implicit feedback (source ``als``, score the predicted preference); all
    others, who are cold, get the most popular ones (source ``popular``, score the total weight).
    Products bought before are not left out: shops sell again. With no event before ``until`` there is
    nothing to recommend, and no row.
    """
    liked = _written(preferences(silver.where(before(until))))
    users = _written(dense_numbers(liked, "user_id", "user"))
    products = _written(dense_numbers(liked, "product_id", "product"))
    popular = popular_products(liked, k)
    known = silver.select("user_id").where("user_id is not null").distinct()
    cold = known.join(users, "user_id", "left_anti")
    listed = popular.agg(F.sort_array(F.collect_list(F.struct("rank", "product_id", "score")))).scalar()
    fallback = cold.select("user_id", F.inline(listed)).withColumn("source", F.lit("popular"))
    if liked.isEmpty():
        return fallback
    ratings = liked.join(users, "user_id").join(products, "product_id").select("user", "product", "weight")
    model = ALS(
        userCol="user", itemCol="product", ratingCol="weight", implicitPrefs=True, rank=factors,
        maxIter=rounds, seed=seed, alpha=strength, regParam=penalty,
    ).fit(ratings)
    best = best_products(model.userFactors, model.itemFactors, k)
    named = best.join(users, "user").join(products, "product")
    warm = named.select("user_id", "rank", "product_id", "score", F.lit("als").alias("source"))
    return warm.unionByName(fallback)


def recall_of(recommended: DataFrame, silver: DataFrame, since: dt.date) -> DataFrame:
    """Share of the products a user bought from ``since`` on that were recommended to them, as mean over
    the buyers with recommendations: method, users, recall.

    ``recommended`` holds method, user_id, product_id.
    """
    bought = silver.where(is_purchase() & ~before(since)).select("user_id", "product_id").distinct()
    sizes = bought.groupBy("user_id").agg(F.count(F.lit(1)).alias("bought"))
    hits = recommended.join(bought, ["user_id", "product_id"], "left_semi")
    hit = hits.groupBy("method", "user_id").agg(F.count(F.lit(1)).alias("hits"))
    asked = recommended.select("method", "user_id").distinct().join(sizes, "user_id")
    share = F.coalesce("hits", F.lit(0)) / F.col("bought")
    return asked.join(hit, ["method", "user_id"], "left").groupBy("method").agg(
        F.count(F.lit(1)).alias("users"), F.avg(share).alias("recall")
    )


def recommendation_recall(silver: DataFrame, until: dt.date, k: int = 10, **options) -> DataFrame:
    """Recall of the factorisation and of the popular products, for the users that have both."""
    found = recommend_products(silver, until, k, **options).where("source = 'als'")
    by_als = _written(found.select(F.lit("als").alias("method"), "user_id", "product_id"))
    listed = popular_products(preferences(silver.where(before(until))), k).agg(
        F.collect_list(F.struct("product_id"))
    ).scalar()
    users = by_als.select("user_id").distinct()
    popular = users.select(F.lit("popular").alias("method"), "user_id", F.inline(listed))
    return recall_of(by_als.unionByName(popular), silver, until)


def product_neighbours(silver: DataFrame, k: int = 10, reach: int = REACH) -> DataFrame:
    """The k products most often seen near a product: product_id, rank, neighbour_id, sessions, cosine.

    A session is its distinct products in the order they were first seen. Two products are seen together
    if at most ``reach`` places lie between them, so a session of m products gives at most m * reach
    pairs; none is left out for its length, but a session weighs 1 / m (in whole millionths). ``cosine``
    is the weight of the sessions that see both over the root of the products' own weights: at most 1.

    Pairs are summed in the map tasks and dealt by both products, so a product that is in every session
    spreads over the tasks; the first k per product are taken before they meet.
    """
    seen = silver.where(F.col("user_session").isNotNull() & F.col("product_id").isNotNull())
    firsts = seen.groupBy("user_session", "product_id").agg(F.min("event_time").alias("first_seen"))
    # A window partition has at most one row per product.
    session = Window.partitionBy("user_session")
    ordered = session.orderBy("first_seen", "product_id")
    later = [F.lead("product_id", i).over(ordered) for i in range(1, reach + 1)]
    placed = firsts.select(
        "product_id",
        F.floor(F.lit(UNIT) / F.count(F.lit(1)).over(session)).cast("bigint").alias("weight"),
        F.filter(F.array(*later), lambda p: p.isNotNull()).alias("later"),
    )
    norms = placed.groupBy("product_id").agg(F.sum("weight").alias("norm"))
    pairs = placed.select("product_id", "weight", F.explode("later").alias("other")).groupBy(
        F.least("product_id", "other").alias("a"), F.greatest("product_id", "other").alias("b")
    ).agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("sessions"))
    left = norms.select(F.col("product_id").alias("a"), F.col("norm").alias("norm_a"))
    right = norms.select(F.col("product_id").alias("b"), F.col("norm").alias("norm_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn(
        "cosine", F.col("weight") / F.sqrt(F.col("norm_a").cast("double") * F.col("norm_b"))
    )
    sides = F.array(
        F.struct(F.col("a").alias("product_id"), F.col("b").alias("neighbour_id")),
        F.struct(F.col("b").alias("product_id"), F.col("a").alias("neighbour_id")),
    )
    directed = both.select(F.inline(sides), "sessions", "cosine")
    place = Window.partitionBy("product_id").orderBy(F.col("cosine").desc(), "neighbour_id")
    ranked = directed.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("product_id", "rank", "neighbour_id", "sessions", "cosine")
