"""Pipeline tables over the test data, built on demand and stored once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marketlens.fixtures.driver_tables import RAW_TABLES, source
from marketlens.fixtures.driver_tables import sellers as sellers_of_items
from marketlens.operators import (
    activity, cleaning, clustering, fairness, features, sales, scoring, segments, sellers,
    warehouse,
)
from marketlens.plans import scoring as scoring_plan
from marketlens.rules import MODEL_FEATURES
from marketlens.session import configure, materialize


class Workspace:
    """One set of input tables. ``x_stored`` properties are written and read back."""

    _open: dict[tuple[str, str], Workspace] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.topic_results: dict[str, object] = {}  # one fitted model per review subset

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        """The workspace of this application and folder; its stored tables are shared."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    def raw(self, name: str) -> DataFrame:
        return RAW_TABLES[name](self.spark, self.sf_dir)

    def source(self, name: str) -> DataFrame:
        return source(self.spark, self.sf_dir, name)

    # Staging.
    @cached_property
    def orders(self) -> DataFrame:
        return cleaning.clean_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return materialize(cleaning.clean_order_items(self.raw("order_items")), "order-items")

    @cached_property
    def reviews(self) -> DataFrame:
        return materialize(cleaning.clean_reviews(self.raw("reviews")), "reviews")

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.clean_products(self.raw("products"))

    # Star schema.
    @cached_property
    def customers(self) -> DataFrame:
        return warehouse.dim_customers(self.raw("customers"))

    @cached_property
    def sellers(self) -> DataFrame:
        # Stored items know their sellers; raw ones would be joined with their orders once more.
        return warehouse.dim_sellers(sellers_of_items(self.spark, self.sf_dir, self.items))

    @cached_property
    def dim_products(self) -> DataFrame:
        return materialize(warehouse.dim_products(
            self.products, self.raw("product_category_name_translation")), "dim-products")

    @cached_property
    def fact_items(self) -> DataFrame:
        return warehouse.fact_order_items(self.items)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return materialize(
            warehouse.fact_orders(self.orders, self.items, self.reviews), "fact-orders")

    # Seller inputs.
    @cached_property
    def product_totals(self) -> DataFrame:
        return materialize(sales.product_totals(self.items, self.fact_orders), "product-totals")

    @cached_property
    def evaluation(self) -> DataFrame:
        return materialize(
            sellers.seller_evaluation(self.fact_items, self.fact_orders, self.reviews),
            "seller-evaluation")

    @cached_property
    def distances(self) -> DataFrame:
        return materialize(sellers.logistics_distance(
            self.fact_items, self.fact_orders, self.customers, self.sellers,
            self.raw("geolocation")), "distances")

    @cached_property
    def order_metrics(self) -> DataFrame:
        return sellers.seller_order_metrics(
            self.fact_items, self.fact_orders, self.customers, self.distances)

    @cached_property
    def item_metrics(self) -> DataFrame:
        # Stored, so that its exchanges do not lie on disk together with those of the order metrics.
        return materialize(sellers.seller_item_metrics(self.fact_items, self.dim_products), "item-metrics")

    @cached_property
    def segmentation(self) -> DataFrame:
        return materialize(
            sellers.seller_segmentation(self.order_metrics, self.item_metrics), "segmentation")

    # Scoring.
    @cached_property
    def lifetime(self) -> DataFrame:
        return materialize(activity.seller_lifetime(self.evaluation), "lifetime")

    @cached_property
    def active(self) -> DataFrame:
        return activity.active_sellers(self.lifetime)

    @cached_property
    def judged(self) -> DataFrame:
        return fairness.with_adjusted_score(self.evaluation)

    @cached_property
    def operations(self) -> DataFrame:
        return features.with_operations(self.evaluation)

    @cached_property
    def tiered(self) -> DataFrame:
        return scoring_plan.scored_sellers(self.evaluation)

    @cached_property
    def vectors(self) -> DataFrame:
        """Standardized model features, laid out by seller for repeatable fits."""
        columns = ["seller_id", "gmv", "total_orders", *MODEL_FEATURES]
        vectors = clustering.standardized_vectors(
            self.tiered.select(*dict.fromkeys(columns)), MODEL_FEATURES)
        # Without a number of partitions their size decides, so small data does not
        # cost every k-means step a task per core.
        laid_out = vectors.repartitionByRange("seller_id").sortWithinPartitions("seller_id")
        return materialize(laid_out, "model-vectors")

    # Segments, on a label every engine can compute: the order value quartile.
    @cached_property
    def segment_input(self) -> DataFrame:
        return materialize(
            segments.segmentation_input(self.tiered, self.segmentation), "segment-input")

    @cached_property
    def by_order_value(self) -> DataFrame:
        return materialize(
            scoring.with_quarter(self.segment_input, "avg_order_value", "seller_cluster"),
            "order-value-segments")

    @cached_property
    def profile(self) -> DataFrame:
        return materialize(segments.cluster_profile(self.by_order_value), "profile")

    @cached_property
    def matrix(self) -> DataFrame:
        return materialize(segments.seller_matrix(self.tiered, self.by_order_value), "matrix")

    @cached_property
    def segmented(self) -> scoring_plan.Segments:
        return scoring_plan.segmented_sellers(self.tiered, self.segmentation)
