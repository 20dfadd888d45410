"""Staging layer to star schema, and the shared extracts."""

from __future__ import annotations

from marketlens.operators import warehouse
from marketlens.sources.tables import Lake, export_warehouse


def run_transformation(lake: Lake, export_folder: str | None = None) -> dict[str, int]:
    """Build dimensions and facts; returns the rows of each table."""
    def staged(name: str):
        return lake.read("staging", name)

    orders, items = staged("orders_cleaned"), staged("order_items_cleaned")
    tables = {
        "dim_date": warehouse.dim_date(orders),
        "dim_customers": warehouse.dim_customers(staged("customers_cleaned")),
        "dim_products": warehouse.dim_products(
            staged("products_cleaned"), staged("product_category_name_translation")),
        "dim_sellers": warehouse.dim_sellers(staged("sellers_cleaned")),
        "fact_order_items": warehouse.fact_order_items(items),
        "fact_orders": warehouse.fact_orders(orders, items, staged("reviews_cleaned")),
    }
    counts = {name: lake.write(df, "warehouse", name) for name, df in tables.items()}
    if export_folder:
        export_warehouse(lake, export_folder)
    return counts
