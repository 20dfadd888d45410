"""Raw layer to staging layer."""

from __future__ import annotations

from marketlens.operators import cleaning
from marketlens.rules import OrderRules
from marketlens.sources.tables import Lake, stage_copy

COPIES = {
    "customers": "customers_cleaned",
    "sellers": "sellers_cleaned",
    "geolocation": "geolocation",
    "payments": "payments_cleaned",
    "product_category_name_translation": "product_category_name_translation",
}


def run_cleaning(lake: Lake, rules: OrderRules = OrderRules()) -> dict[str, int]:
    """Build all staging tables; returns the rows of each."""
    counts = {staged: stage_copy(lake, raw, staged) for raw, staged in COPIES.items()}
    cleaned = {
        "order_items": cleaning.clean_order_items,
        "orders": lambda df: cleaning.clean_orders(df, rules),
        "products": cleaning.clean_products,
        "reviews": cleaning.clean_reviews,
    }
    for name, clean in cleaned.items():
        table = f"{name}_cleaned"
        counts[table] = lake.write(clean(lake.read("raw_data", name)), "staging", table)
    return counts
