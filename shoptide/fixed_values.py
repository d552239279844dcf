"""Labels, bounds and defaults that decide the results.

They are stated here once, as plain text, and are never derived or re-encoded.
"""

from __future__ import annotations

# Event types of the shop.
VIEW = "view"
CART = "cart"
PURCHASE = "purchase"

# What a missing brand or category code becomes, and the category label a category fact leaves out
# (the two differ in case on purpose: "Unknown" stays one of the categories).
UNKNOWN = "Unknown"
EXCLUDED_CATEGORIES = ("unknown",)

# Columns that make two events the same event.
EVENT_KEY = ("user_id", "product_id", "event_type", "event_time")

# Order in which the remaining columns pick the survivor among events with an equal key.
TIE_ORDER = ("user_session", "price", "category_code", "brand", "category_id")

# Funnel stages of a (user, product) pair, weakest first.
VIEWED_ONLY = "viewed_only"
ADDED_TO_CART = "added_to_cart"
PURCHASED = "purchased"

# Part of the day in the cleaned events: (label, first hour, hour after the last); else "night".
DAY_PARTS = (("morning", 6, 12), ("afternoon", 12, 18), ("evening", 18, 22))
DAY_PART_REST = "night"

# Part of the day in the hourly fact: four equal parts of six hours, in the order of the day.
HOUR_BANDS = ("madrugada", "mañana", "tarde", "noche")
HOURS_PER_BAND = 6

# Days of the week are 1 = Sunday ... 7 = Saturday.
WEEKEND_DAYS = (1, 7)

# Columns that must never be null: full Silver report, short Silver report, pipeline check.
CRITICAL_SILVER = ("event_time", "event_type", "product_id", "price", "user_id")
CRITICAL_SILVER_SHORT = (
    "event_time", "event_type", "product_id", "user_id", "price", "conversion_stage", "category_l1",
)
CRITICAL_PIPELINE = (
    "event_type", "product_id", "user_id", "price", "brand", "category_code", "conversion_stage",
)

# Columns the step checks read: everything but category_id and user_session.
STEP_COLUMNS = ("event_time", "event_type", "product_id", "user_id", "category_code", "brand", "price")

# Report defaults.
SPIKE_DAYS = (15, 16, 17)
EVENT_DAY = 29
GOLDEN_HOURS = (2, 3, 4)
EXPECTED_DAYS = 61
SAMPLE_FILES = 10

# Grades of the quality verdicts, in percent and in number of categories.
DUPLICATES_FEW = 0.1
DUPLICATES_MODERATE = 2
BAD_PRICES_FEW = 0.1
CATEGORIES_CLEAN = 20

# Names of the two months the reports compare by default.
MONTH_NAMES = {10: "Octubre", 11: "Noviembre"}
