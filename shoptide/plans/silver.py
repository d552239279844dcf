"""The cleaned, enriched layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.operators.cleaning import clean, clean_needed, keep_valid_prices
from shoptide.operators.enrichment import (
    add_calendar_parts,
    conversion_stage,
    enrich_temporal,
    parse_categories,
)
from shoptide.schemas import RAW, SILVER


def _raw_columns(df: DataFrame) -> DataFrame:
    """Without the partition columns of Bronze: they follow from the time and are added back."""
    return df.select(*(c for c in RAW.names if c in df.columns))


def silver_rows(raw: DataFrame) -> DataFrame:
    """Everything in Silver that a row knows about itself: all columns but the funnel stage."""
    return (
        clean(_raw_columns(raw))
        .transform(enrich_temporal)
        .transform(parse_categories)
        .transform(add_calendar_parts)
    )


def silver_needed(raw: DataFrame, *needed: str) -> DataFrame:
    """Clean rows with calendar parts and category levels, for a fact straight from raw events.

    Carries only the columns named, so the deduplication shuffles no more than the fact reads.
    """
    rows = clean_needed(raw, *needed).transform(add_calendar_parts)
    return rows.transform(parse_categories) if "category_code" in needed else rows


def silver_events(raw: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """Raw events to Silver, 20 columns.

    Two shuffles of the events: one on the event key, one on the (user, product) pair. The second
    branch of the plan reads only the cart and purchase events, from before deduplication.

    A stage looks at all events of a pair, so a run over some days may pass more raw events as
    ``evidence``, such as all of Bronze; by default the stage sees what is processed.
    """
    events = _raw_columns(raw)
    seen = keep_valid_prices(events if evidence is None else evidence)
    staged = conversion_stage(clean(events), evidence=seen)
    rows = (
        staged.transform(enrich_temporal).transform(parse_categories).transform(add_calendar_parts)
    )
    return rows.select(*(F.col(name) for name in SILVER.names if name in rows.columns))
