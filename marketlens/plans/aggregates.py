"""Star schema to aggregates, seller inputs and review subsets."""

from __future__ import annotations

from marketlens.operators import reviews, sales, sellers
from marketlens.session import materialize
from marketlens.sources.tables import Lake


def run_aggregation(lake: Lake) -> dict[str, int]:
    """Build all aggregate tables; returns the rows of each.

    A step that fails raises; nothing is reported as an empty table.
    """
    def read(name: str):
        return lake.read("warehouse", name)

    facts, items, customers = read("fact_orders"), read("fact_order_items"), read("dim_customers")
    products, staged_reviews = read("dim_products"), lake.read("staging", "reviews_cleaned")
    staged_items = lake.read("staging", "order_items_cleaned")
    counts = {}

    def store(name, df):
        counts[name] = lake.write(df, "warehouse", name)

    store("agg_daily_sales", sales.daily_sales(facts, customers))
    totals = materialize(sales.product_totals(staged_items, facts), "product-totals")
    store("agg_product_performance", sales.product_performance(totals))
    store("agg_category_performance", sales.category_performance(staged_items, products, facts))
    store("agg_state_performance", sales.state_performance(facts, customers))
    store("seller_evaluation", sellers.seller_evaluation(items, facts, staged_reviews))
    store("logistics_analytics", sellers.logistics_distance(
        items, facts, customers, read("dim_sellers"), lake.read("staging", "geolocation")))
    # Stored first, so that the exchanges of both sides do not lie on disk together.
    item_metrics = materialize(sellers.seller_item_metrics(items, products), "item-metrics")
    store("seller_segmentation", sellers.seller_segmentation(
        sellers.seller_order_metrics(items, facts, customers, read("logistics_analytics")), item_metrics))
    store("nlp_bad_review", reviews.bad_reviews(staged_reviews))
    store("nlp_good_review", reviews.good_reviews(staged_reviews))
    return counts
