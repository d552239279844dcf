"""Column expressions shared by batch and stream."""

from shoptide.functions.calendar import (
    calendar_date,
    date_text,
    day_part,
    hour_band,
    hour_band_rank,
    on_weekend,
)
from shoptide.functions.events import (
    category_level,
    category_root,
    has_valid_price,
    is_cart,
    is_purchase,
    is_view,
    known_or_unknown,
    stage_label,
    stage_rank,
)
from shoptide.functions.money import average_money, money_total, total_money
from shoptide.functions.ratios import change_pct, safe_ratio

__all__ = [
    "average_money", "calendar_date", "category_level", "category_root", "change_pct", "date_text",
    "day_part", "has_valid_price", "hour_band", "hour_band_rank", "is_cart", "is_purchase",
    "is_view", "known_or_unknown", "money_total", "on_weekend", "safe_ratio", "stage_label",
    "stage_rank", "total_money",
]
