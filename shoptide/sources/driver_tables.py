"""Raw shop events from the test tables ``events`` and ``part``.

The tables lack sessions, category codes, carts, bad prices and repeated rows; each is derived from
the row itself, the same way on every run. All rows of ``events`` take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide import fixed_values as fixed
from shoptide.schemas import RAW

# Known schemas spare the job that would read a file footer to infer them.
SCHEMAS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def _word(name: str, n: int) -> Column:
    return F.get(F.split(F.col(name), " "), n - 1)


def shop_products(part: DataFrame) -> DataFrame:
    """product_id, category_code and brand."""
    depth = F.col("p_size") % 4
    levels = [F.lower("p_type"), _word("p_name", 2), _word("p_name", 1)]
    return part.select(
        F.col("p_partkey").alias("part_id"),
        F.when(depth > 0, F.concat_ws(".", F.slice(F.array(*levels), 1, depth))).alias(
            "category_code"
        ),
        F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("brand"),
    )


def shop_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw events (schema ``RAW``, zone-less times) from the tables below ``folder``."""
    return as_shop_events(read_table(spark, folder, "events"), read_table(spark, folder, "part"))


def shop_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream over the file of events; times carry a zone, as watermarks require."""
    events = (
        spark.readStream.schema(SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(str(folder))
    )
    raw = as_shop_events(events, read_table(spark, folder, "part"))
    return raw.withColumn("event_time", F.col("event_time").cast("timestamp"))


def as_shop_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Raw shop events from the rows of ``events`` and the products of ``part``."""
    products = shop_products(part)
    event_id, time = F.col("event_id"), F.col("ts")
    event_type = (
        F.when(F.col("event_type") == "purchase", fixed.PURCHASE)
        .when(F.col("event_type") == "click", fixed.CART)
        .otherwise(fixed.VIEW)
    )
    price = F.when(event_id % 97 == 0, F.lit(0.0)).when(event_id % 101 != 0, F.col("value"))
    quarter = F.floor(F.hour(time) / 6).cast("int").cast("string")
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.to_date(time).cast("string"), quarter)
    product_id = F.get_json_object("props", "$.k").cast("bigint")
    rows = events.select(
        time.alias("event_time"),
        event_type.alias("event_type"),
        product_id.alias("product_id"),
        price.alias("price"),
        "user_id",
        session.alias("user_session"),
        # Every 50th event arrives twice.
        F.when(event_id % 50 == 0, 2).otherwise(1).alias("_copies"),
    )
    # No broadcast hint: Spark broadcasts `part` only when its real size allows it, and splits a hot
    # product over many tasks otherwise.
    joined = rows.join(products, F.col("product_id") == F.col("part_id"), "left")
    return (
        joined.withColumn("category_id", F.col("product_id") % 13)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
        .select(*RAW.names)
    )
