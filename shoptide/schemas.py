"""Table schemas and the schema check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
}


def _struct(columns: str) -> T.StructType:
    # StructType.fromDDL needs a live session, and this module is imported before there is one.
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _struct(
    "event_time TIMESTAMP, event_type STRING, product_id BIGINT, category_id BIGINT, "
    "category_code STRING, brand STRING, price DOUBLE, user_id BIGINT, user_session STRING"
)
CALENDAR_PARTS = _struct("year INT, month INT, day INT")
BRONZE = T.StructType(RAW.fields + CALENDAR_PARTS.fields)
SILVER = T.StructType(
    RAW.fields
    + _struct(
        "hour INT, day_of_week INT, is_weekend BOOLEAN, time_of_day STRING, "
        "category_l1 STRING, category_l2 STRING, category_l3 STRING, conversion_stage STRING"
    ).fields
    + CALENDAR_PARTS.fields
)
GOLD_DAILY = _struct(
    "date DATE, year INT, month INT, day INT, day_of_week INT, is_weekend BOOLEAN, "
    "total_events BIGINT, unique_users BIGINT, unique_sessions BIGINT, unique_products BIGINT, "
    "total_views BIGINT, total_carts BIGINT, total_purchases BIGINT, "
    "total_revenue DOUBLE, avg_price DOUBLE, avg_order_value DOUBLE, "
    "conversion_rate DOUBLE, cart_abandonment_rate DOUBLE, cart_to_purchase_rate DOUBLE, "
    "events_per_user DOUBLE, purchases_per_user DOUBLE"
)
GOLD_HOURLY = _struct(
    "date DATE, year INT, month INT, day INT, hour INT, time_of_day STRING, day_of_week INT, "
    "is_weekend BOOLEAN, total_events BIGINT, unique_users BIGINT, unique_sessions BIGINT, "
    "total_views BIGINT, total_carts BIGINT, total_purchases BIGINT, "
    "total_revenue DOUBLE, avg_price DOUBLE, avg_order_value DOUBLE, "
    "conversion_rate DOUBLE, cart_abandonment_rate DOUBLE, events_per_user DOUBLE"
)
GOLD_CATEGORY = _struct(
    "category_l1 STRING, total_events BIGINT, unique_users BIGINT, unique_products BIGINT, "
    "total_views BIGINT, total_carts BIGINT, total_purchases BIGINT, "
    "total_revenue DOUBLE, avg_price DOUBLE, avg_order_value DOUBLE, revenue_per_user DOUBLE, "
    "conversion_rate DOUBLE, add_to_cart_rate DOUBLE, cart_to_purchase_rate DOUBLE, "
    "cart_abandonment_rate DOUBLE, pct_revenue DOUBLE, pct_purchases DOUBLE"
)


def _kind(data_type: T.DataType) -> str:
    # A zone-less timestamp counts as a timestamp: the library runs in UTC either way.
    return data_type.simpleString().replace("timestamp_ntz", "timestamp")


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per expected or present column: ``ok``, ``missing``, ``extra`` or ``type``, with the
    rows that hold a value."""
    want = {f.name: _kind(f.dataType) for f in expected.fields}
    have = {f.name: _kind(f.dataType) for f in df.schema.fields}

    def status(name: str) -> str:
        if name not in have:
            return "missing"
        if name not in want:
            return "extra"
        return "ok" if want[name] == have[name] else "type"

    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            _text(want.get(name)).alias("expected_type"),
            _text(have.get(name)).alias("actual_type"),
            F.lit(status(name)).alias("status"),
            (F.col(name) if name in have else F.lit(None).cast("bigint")).alias("filled_rows"),
        )
        for name in [*want, *(n for n in have if n not in want)]
    ]
    return _filled_rows(df).select(F.inline(F.array(*rows)))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and rows with a value of each column of a layer."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("filled_rows"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return _filled_rows(df).select(F.inline(F.array(*rows)))


def _filled_rows(df: DataFrame) -> DataFrame:
    return df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns))
