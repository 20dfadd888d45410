"""Registered queries: one per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.fixtures.driver_tables import sellers as sellers_of_items
from marketlens.fixtures.workspace import Workspace
from marketlens.functions import order_stats, scaling, text
from marketlens.operators import (
    activity, cleaning, clustering, fairness, features, reviews, sales, scoring, segments,
    sellers, sweep, topic_model, topics, views, ward, warehouse,
)
from marketlens.plans import aggregates as aggregate_plan
from marketlens.plans import staging as staging_plan
from marketlens.plans import topics as topic_plan
from marketlens.plans import warehouse as warehouse_plan
from marketlens.rules import (
    BAD_TOPIC_NAMES, BAD_TOPICS, GOOD_TOPICS, MODEL_FEATURES, NEUTRAL_TOPICS, SEGMENT_FEATURES,
    SELLER_FEATURES,
)
from marketlens.session import materialize, shared_dir
from marketlens.sources import reports, tables
from marketlens.sources.schemas import NOT_NULL, PRIMARY_KEYS, RAW_SCHEMAS

Query = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Query] = {}

# Stop words of the text queries, a parameter as for any corpus.
TEXT_STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "que", "de", "la", "el", "en", "los", "le",
    "les", "des", "und", "der", "die", "das",
)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round as decimals, so that both engines treat ties alike."""
    return df.withColumns({
        c: F.round(F.col(c).cast("decimal(28,8)"), digits).cast("double") for c in columns
    })


def fresh_path(w: Workspace, label: str) -> str:
    return f"{shared_dir(w.spark)}/{label}-{uuid4().hex}"


def fresh_lake(w: Workspace) -> tables.Lake:
    return tables.Lake(w.spark, fresh_path(w, "lake"))


# Sources and sinks.

@query
def read_raw_reviews(w):
    path = fresh_path(w, "reviews-csv")
    tables.export_csv(w.raw("reviews"), path)
    back = tables.read_raw(w.spark, path, "reviews")
    # A CSV file does not tell '' from null.
    return cleaning.typed_reviews(back).fillna("", subset=["review_comment_message"]).drop(
        "review_comment_title")


@query
def read_raw_orders(w):
    path = fresh_path(w, "orders-csv")
    tables.export_csv(w.raw("orders"), path)
    back = tables.read_raw(w.spark, path, "orders")
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                         for f in RAW_SCHEMAS["orders"].fields])


def _read_raw(raw_name: str) -> Query:
    def build(w):
        path = fresh_path(w, f"{raw_name}-csv")
        tables.export_csv(w.raw(raw_name), path)
        out = tables.read_raw(w.spark, path, raw_name).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[raw_name].fields])
        return rounded(out, 6, "geolocation_lat", "geolocation_lng") if raw_name == "geolocation" else out
    return build


for _raw in ("customers", "sellers", "products", "order_items", "payments", "geolocation",
             "product_category_name_translation"):
    QUERIES[f"read_raw_{_raw}"] = _read_raw(_raw)


@query
def load_row_counts(w):
    """Rows of every table that the three load runs store, from the raw tables on."""
    lake = fresh_lake(w)
    for name in RAW_SCHEMAS:
        if name != "sellers":
            lake.write(w.raw(name), "raw_data", name)
    lake.write(sellers_of_items(w.spark, w.sf_dir, lake.read("raw_data", "order_items")), "raw_data", "sellers")
    counts = staging_plan.run_cleaning(lake) | warehouse_plan.run_transformation(lake) | aggregate_plan.run_aggregation(lake)
    layers = dict.fromkeys(counts, "warehouse") | dict.fromkeys(
        [*staging_plan.COPIES.values(), *[n for n in counts if n.endswith("_cleaned")]], "staging")
    return reports.row_count_report({name: lake.read(layers[name], name) for name in counts})


@query
def write_and_read_table(w):
    lake = fresh_lake(w)
    lake.write(w.fact_items, "warehouse", "fact_order_items")
    return lake.read("warehouse", "fact_order_items")


def _copied(raw_name: str) -> Query:
    def build(w):
        lake = fresh_lake(w)
        lake.write(w.raw(raw_name), "raw_data", raw_name)
        staged = staging_plan.COPIES[raw_name]
        tables.stage_copy(lake, raw_name, staged)
        out = lake.read("staging", staged)
        return rounded(out, 6, "geolocation_lat", "geolocation_lng") if raw_name == "geolocation" else out
    return build


for _raw in staging_plan.COPIES:
    QUERIES[f"stage_{_raw}"] = _copied(_raw)


@query
def constraint_report(w):
    names = ("customers", "sellers", "orders", "order_items", "products", "payments", "geolocation",
             "product_category_name_translation")
    return reduce(DataFrame.unionByName, [
        reports.check_constraints(w.raw(n), n, PRIMARY_KEYS[n], NOT_NULL.get(n, ())) for n in names
    ])


@query
def exported_warehouse(w):
    lake = fresh_lake(w)
    for name, df in (("fact_orders", w.fact_orders), ("fact_order_items", w.fact_items),
                     ("dim_sellers", w.sellers), ("dim_customers", w.customers),
                     ("dim_products", w.dim_products)):
        lake.write(df, "warehouse", name)
    paths = tables.export_warehouse(lake, fresh_path(w, "export"))
    loaded = {p.rsplit("/", 1)[-1].removesuffix(".csv"): tables.load_csv(w.spark, p) for p in paths}
    return reports.row_count_report(loaded)


@query
def loaded_fact_orders(w):
    path = fresh_path(w, "fact-orders-csv")
    tables.export_csv(w.fact_orders, path)
    back = tables.load_csv(w.spark, path, w.fact_orders.schema)
    return back.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_delivered_customer_date", "total_price", "total_freight", "item_count", "avg_review_score",
    ).transform(rounded, 6, "avg_review_score")


@query
def exported_scorecard(w):
    lake = fresh_lake(w)
    tables.export_scorecard(lake, w.matrix, fresh_path(w, "scorecard"), date(2020, 1, 31))
    out = lake.read("warehouse", "seller_scorecard").select(
        F.col("seller_id").cast("string").alias("seller_id"), "gmv", "final_score", "segment",
        F.col("seller_cluster").cast("int").alias("seller_cluster"))
    return rounded(out, 4, "final_score")


@query
def staging_row_counts(w):
    return reports.row_count_report({
        "customers": w.raw("customers"), "sellers": w.raw("sellers"),
        "geolocation": w.raw("geolocation"), "payments": w.raw("payments"),
        "translation": w.raw("product_category_name_translation"), "order_items": w.items,
        "orders": w.orders, "products": w.products, "reviews": w.reviews,
    })


@query
def warehouse_row_counts(w):
    return reports.row_count_report({
        "dim_date": warehouse.dim_date(w.orders), "dim_customers": w.customers,
        "dim_products": w.dim_products, "dim_sellers": w.sellers,
        "fact_order_items": w.fact_items, "fact_orders": w.fact_orders,
    })


# Cleaning.

@query
def clean_reviews(w):
    return cleaning.clean_reviews(w.raw("reviews"))


@query
def reviews_removed_by_dedup(w):
    return cleaning.removed_by_dedup(w.raw("reviews"))


@query
def clean_orders(w):
    return cleaning.clean_orders(w.raw("orders"))


@query
def clean_order_items(w):
    return cleaning.clean_order_items(w.raw("order_items"))


@query
def clean_products(w):
    return cleaning.clean_products(w.raw("products"))


# Star schema.

@query
def dim_date(w):
    return warehouse.dim_date(w.orders)


@query
def dim_customers(w):
    return w.customers


@query
def dim_products(w):
    return warehouse.dim_products(w.products, w.raw("product_category_name_translation"))


@query
def dim_sellers(w):
    return w.sellers


@query
def fact_order_items(w):
    return warehouse.fact_order_items(cleaning.clean_order_items(w.raw("order_items")))


@query
def order_totals(w):
    return warehouse.order_totals(w.items)


@query
def order_reviews(w):
    return rounded(warehouse.order_reviews(w.reviews), 6, "avg_review_score")


@query
def fact_orders(w):
    facts = warehouse.fact_orders(
        w.orders, cleaning.clean_order_items(w.raw("order_items")),
        cleaning.clean_reviews(w.raw("reviews")))
    return rounded(facts, 6, "avg_review_score")


# Aggregates.

@query
def daily_sales(w):
    return sales.daily_sales(w.fact_orders, w.customers)


@query
def product_performance(w):
    return sales.product_performance(w.product_totals)


@query
def category_performance(w):
    return sales.category_performance(w.items, w.dim_products, w.fact_orders)


@query
def state_performance(w):
    return sales.state_performance(w.fact_orders, w.customers)


@query
def seller_evaluation(w):
    return sellers.seller_evaluation(w.fact_items, w.fact_orders, w.reviews)


@query
def logistics_distance(w):
    out = sellers.logistics_distance(
        w.fact_items, w.fact_orders, w.customers, w.sellers, w.raw("geolocation"))
    return rounded(out, 4, "distance_km")


@query
def seller_order_metrics(w):
    return rounded(w.order_metrics, 4, "distance_km")


@query
def seller_item_metrics(w):
    return rounded(w.item_metrics, 4, "avg_item_weight_g")


@query
def seller_segmentation(w):
    return rounded(sellers.seller_segmentation(w.order_metrics, w.item_metrics), 4,
                   "avg_weight_g", "avg_distance_km", "avg_order_value", "avg_freight_ratio")


@query
def bad_reviews(w):
    return reviews.bad_reviews(w.reviews)


@query
def good_reviews(w):
    return reviews.good_reviews(w.reviews)


@query
def neutral_reviews(w):
    return reviews.neutral_reviews(w.reviews)


# Text.

@query
def bad_review_share(w):
    return rounded(reviews.subset_share(w.reviews), 4, "percentage")


@query
def normalized_ascii(w):
    return w.source("documents").select("doc_id", text.normalize_ascii(F.col("text")).alias("cleaned"))


@query
def normalized_unicode(w):
    return w.source("documents").select("doc_id", text.normalize_unicode(F.col("text")).alias("cleaned"))


@query
def without_stop_words(w):
    cleaned = text.remove_stopwords(text.normalize_ascii(F.col("text")), TEXT_STOP_WORDS)
    return w.source("documents").select("doc_id", cleaned.alias("cleaned"))


@query
def prepared_bad_reviews(w):
    stop_words = (*TEXT_STOP_WORDS, "o", "na")
    return reviews.bad_reviews(w.reviews).select(
        reviews.TEXT, topic_plan.complaint_text(stop_words).alias("cleaned"))


def _prepared_documents(w):
    cleaned = text.remove_stopwords(text.normalize_ascii(F.col("text")), TEXT_STOP_WORDS)
    return w.source("documents").select("doc_id", cleaned.alias("cleaned"))


@query
def term_frequency(w):
    return topics.term_frequency(_prepared_documents(w), "cleaned")


@query
def top_terms(w):
    return topics.top_terms(topics.term_frequency(_prepared_documents(w), "cleaned"), 200)


@query
def model_vocabulary(w):
    return topics.vocabulary(_prepared_documents(w), "cleaned", min_df=25, max_df=0.9)


def _bags(w):
    """Index and bags of words of the documents, under the vocabulary of the complaint model."""
    prepared = _prepared_documents(w)
    index = topics.term_index(topics.vocabulary(prepared, "cleaned", min_df=25, max_df=0.9))
    return index, topics.bag_of_words(prepared, "cleaned", index, document="doc_id")


@query
def term_numbers(w):
    return _bags(w)[0].select("term", "term_id")


@query
def bag_of_words(w):
    return _bags(w)[1]


@query
def sparse_vectors(w):
    vectors = topics.vectorize(w.source("documents").select("doc_id"), _bags(w)[1], "doc_id")
    joined = F.zip_with("term_ids", "term_counts", lambda i, n: F.concat_ws(":", i, n))
    return vectors.select("doc_id", F.array_join(joined, " ").alias("vector"))


@query
def topic_step_given(w):
    """Document weights after one step under given topics, whose word weights are whole numbers."""
    index, bags = _bags(w)
    words = materialize(index.select("term_id", *[
        (F.lit(1.0) + (F.col("term_id") * 7 + 13 * i) % 11).alias(f"w{i}") for i in range(4)]), "given-topics")
    totals = list(words.agg(*[F.sum(f"w{i}") for i in range(4)]).first())
    model = topic_model.TopicModel(words, totals, 0.25, [])
    bags = materialize(bags.withColumnRenamed("doc_id", "document"), "given-bags")
    weights = topic_model.document_weights(bags, model, steps=1)
    return rounded(weights.select(F.col("document").alias("doc_id"), *[
        F.col("topic_weights")[i].alias(f"topic_{i + 1}") for i in range(4)]), 4, *[f"topic_{i + 1}" for i in range(4)])


@query
def limited_vocabulary(w):
    cleaned = w.source("documents").select(text.normalize_unicode(F.col("text")).alias("cleaned"))
    return topics.vocabulary(cleaned, "cleaned", min_df=5, max_df=0.9,
                             stop_words=TEXT_STOP_WORDS, max_features=2000)


def _given_topics(w):
    """Bad reviews under a topic every engine can compute."""
    topic = F.length(reviews.TEXT) % 5 + 1
    return reviews.bad_reviews(w.reviews).withColumn("dominant_topic", topic)


@query
def topic_distribution_given(w):
    return topics.topic_distribution(_given_topics(w), BAD_TOPIC_NAMES)


@query
def topic_ranking_given(w):
    return topics.topic_ranking(topics.topic_distribution(_given_topics(w), BAD_TOPIC_NAMES))


def _found(w, subset, prepared, rules):
    if subset.__name__ not in w.topic_results:
        w.topic_results[subset.__name__] = topic_plan.find_topics(subset(w.reviews), prepared, rules)
    return w.topic_results[subset.__name__]


def _complaints(w, subset, rules):
    return _found(w, subset, topic_plan.complaint_text(topics.portuguese_stop_words()), rules)


def _praise(w):
    rules = replace(GOOD_TOPICS, stop_words=tuple(topics.shopping_stop_words()))
    return _found(w, reviews.good_reviews, topic_plan.praise_text(), rules)


@query
def bad_topic_words(w):
    return _complaints(w, reviews.bad_reviews, BAD_TOPICS).top_words


@query
def bad_topic_documents(w):
    return _complaints(w, reviews.bad_reviews, BAD_TOPICS).documents.select(
        "review_score", "cleaned", "dominant_topic")


@query
def bad_topic_distribution(w):
    return topics.topic_ranking(_complaints(w, reviews.bad_reviews, BAD_TOPICS).distribution)


@query
def neutral_topic_words(w):
    return _complaints(w, reviews.neutral_reviews, NEUTRAL_TOPICS).top_words


@query
def neutral_topic_distribution(w):
    return topics.topic_ranking(_complaints(w, reviews.neutral_reviews, NEUTRAL_TOPICS).distribution)


@query
def good_topic_words(w):
    return _praise(w).top_words


@query
def document_topic_words(w):
    """Topics of the long documents, with the settings of the complaint model."""
    cleaned = text.remove_stopwords(text.normalize_ascii(F.col("text")), TEXT_STOP_WORDS)
    return topic_plan.find_topics(w.source("documents").select("text"), cleaned, BAD_TOPICS).top_words


# Seller activity.

@query
def seller_recency(w):
    return activity.seller_recency(w.evaluation)


@query
def recency_histogram(w):
    return rounded(order_stats.histogram(w.lifetime, "days_since_last_sale", 50), 6, "lower", "upper")


@query
def churn_thresholds(w):
    return rounded(activity.churn_thresholds(w.lifetime), 4, "pct_active")


@query
def frequency_quantiles(w):
    return rounded(activity.frequency_quantiles(w.lifetime), 6, "total_orders")


@query
def cutoff_impact(w):
    return rounded(activity.cutoff_impact(w.lifetime), 4, "pct_impact")


@query
def seller_lifetime(w):
    return activity.seller_lifetime(w.evaluation)


@query
def active_sellers(w):
    return activity.active_sellers(activity.seller_lifetime(w.evaluation))


@query
def active_rows(w):
    return activity.rows_of(w.evaluation, w.active).select(
        "seller_id", "order_id", "product_id", "review_score", "price", "freight_value")


@query
def filter_report(w):
    return rounded(activity.filter_report(w.lifetime), 4, "pct_dropped", "pct_kept")


@query
def evaluation_overview(w):
    return scaling.column_overview(w.evaluation).select("column_name", "non_null")


# Fairness.

@query
def logistics_fault(w):
    return w.evaluation.select("seller_id", "order_id", "product_id", "review_score",
                               fairness.logistics_fault().alias("is_logistics_fault"))


@query
def adjusted_score(w):
    return w.judged.select("seller_id", "order_id", "product_id", "adjusted_review_score")


@query
def bias_report(w):
    return rounded(fairness.bias_report(w.judged, w.active), 6,
                   "share_of_reviews", "share_of_comments", "share_of_negative")


# Features.

@query
def prep_time_and_lateness(w):
    return rounded(w.operations.select("seller_id", "order_id", "prep_time_hours",
                                       "is_late_shipment"), 6, "prep_time_hours")


@query
def seller_ops(w):
    return rounded(activity.rows_of(features.seller_ops(w.operations), w.active), 6,
                   "late_shipment_rate", "avg_prep_time_hours")


@query
def seller_scale(w):
    return rounded(activity.rows_of(features.seller_scale(w.judged), w.active), 6, "avg_rating")


def _joined(w):
    return features.joined_features(
        activity.rows_of(features.seller_scale(w.judged), w.active), features.seller_ops(w.operations))


@query
def missing_operations(w):
    return features.missing_operations(_joined(w))


@query
def seller_features(w):
    out = features.log_features(features.seller_features(_joined(w)))
    return rounded(out, 6, "avg_rating", "late_shipment_rate", "avg_prep_time_hours",
                   "log_gmv", "log_orders")


@query
def log_segment_features(w):
    logs = features.log_segment_features(w.segment_input)
    names = [c for c in logs.columns if c.startswith("log_")]
    return rounded(logs.select("seller_id", *names), 4, *names)


@query
def correlation_matrix(w):
    return rounded(scaling.correlation_matrix(w.tiered, SELLER_FEATURES), 6, "correlation")


@query
def feature_profile(w):
    return rounded(scaling.profile(w.tiered, SELLER_FEATURES), 4,
                   "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def raw_column_types(w):
    """Types of the raw reviews, as declared and as their values tell."""
    return scaling.column_overview(w.raw("reviews"))


@query
def segment_profile(w):
    return rounded(scaling.profile(w.segment_input, SEGMENT_FEATURES), 4,
                   "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def standardized_features(w):
    names = [f"z_{c}" for c in MODEL_FEATURES]
    return rounded(scaling.standardize(w.tiered, MODEL_FEATURES).select("seller_id", *names), 4, *names)


# Scoring.

@query
def minmax_features(w):
    names = [f"m_{c}" for c in MODEL_FEATURES]
    scaled = scaling.minmax(w.tiered, MODEL_FEATURES, inverted=scoring.COST_FEATURES)
    return rounded(scaled.select("seller_id", *names), 4, *names)


@query
def seller_score(w):
    base = w.tiered.drop("final_score", "segment", "segment_rank")
    return rounded(scoring.seller_score(base).select("seller_id", "final_score"), 4, "final_score")


@query
def score_tier(w):
    tiers = scoring.score_tier(w.tiered.drop("segment", "segment_rank"))
    return rounded(tiers.select("seller_id", "final_score", "segment"), 4, "final_score")


@query
def top_sellers(w):
    return rounded(scoring.top_sellers(w.tiered), 4,
                   "gmv", "avg_rating", "late_shipment_rate", "final_score")


@query
def tier_counts(w):
    return scoring.tier_counts(w.tiered)


@query
def score_histogram(w):
    return rounded(scoring.score_histogram(w.tiered), 4, "lower", "upper")


@query
def kmeans_sweep(w):
    return sweep.kmeans_sweep(w.vectors, [f"z_{c}" for c in MODEL_FEATURES])


@query
def kmeans_means_k3(w):
    labelled, _ = clustering.kmeans_label(w.vectors, 3)
    return clustering.cluster_means(labelled)


@query
def kmeans_means_k4(w):
    labelled, _ = clustering.kmeans_label(w.vectors, 4)
    return clustering.cluster_means(labelled)


@query
def kmeans_labels(w):
    labelled, _ = clustering.kmeans_label(w.vectors, 4)
    return labelled.select("seller_id", "cluster")


@query
def davies_bouldin_given(w):
    """The index on the score tiers as clusters."""
    prepared = scaling.standardize(w.tiered, MODEL_FEATURES)
    columns = [f"z_{c}" for c in MODEL_FEATURES]
    return rounded(clustering.davies_bouldin(prepared, columns, "segment"), 4, "davies_bouldin")


@query
def cluster_means_given(w):
    return rounded(clustering.cluster_means(w.tiered, cluster="segment"), 4, *SELLER_FEATURES)


@query
def feature_importance(w):
    labelled, _ = clustering.kmeans_label(w.vectors, 4)
    return clustering.feature_importance(labelled)


# Segments.

@query
def segmentation_input(w):
    return rounded(segments.segmentation_input(w.tiered, w.segmentation), 4,
                   "avg_weight_g", "avg_distance_km", "avg_order_value", "avg_freight_ratio")


@query
def ward_merges(w):
    return w.segmented.merges


@query
def ward_labels_k7(w):
    return w.segmented.sellers.select("seller_id", "seller_cluster")


@query
def ward_labels_k12(w):
    found = w.segmented
    relabelled = ward.label_sellers(found.sellers.drop("seller_cluster"), ward.ward_labels(found.leaves, found.merges, 12))
    return relabelled.select("seller_id", "seller_cluster")


@query
def ward_personas(w):
    return segments.persona_label(segments.cluster_profile(w.segmented.sellers))


@query
def ward_personas_k12(w):
    found = w.segmented
    twelve = ward.label_sellers(found.sellers.drop("seller_cluster"), ward.ward_labels(found.leaves, found.merges, 12))
    return segments.persona_label(segments.cluster_profile(twelve))


@query
def ward_totals(w):
    """What SQL can say of a hierarchy: sellers labelled and clusters of both cuts, rows of its top."""
    found = w.segmented
    twelve = ward.label_sellers(found.sellers.drop("seller_cluster"), ward.ward_labels(found.leaves, found.merges, 12))
    count = lambda df: df.agg(F.count("*").alias("n"), F.countDistinct("seller_cluster").alias("k"))
    seven, top = count(found.sellers), found.merges.agg(F.max("size").alias("top"))
    return seven.select(
        F.col("n").alias("sellers_k7"), F.col("k").alias("clusters_k7"),
        count(twelve).select("n").scalar().alias("sellers_k12"), count(twelve).select("k").scalar().alias("clusters_k12"),
        top.scalar().alias("top_size"))


@query
def ward_hierarchy(w):
    """All merge heights and the cluster sizes of two cuts, on coordinates of six digits."""
    points = rounded(ward.ward_input(w.segment_input), 6, *ward.Z_COLUMNS).select("seller_id", *ward.Z_COLUMNS)
    sellers, leaves = ward.ward_leaves(materialize(points, "ward-points"))
    leaves = materialize(leaves, "ward-leaves")
    merges = materialize(ward.ward_merges(leaves), "ward-merges")
    parts = [rounded(merges.select(F.lit("height").alias("part"), F.col("step").alias("place"), F.col("height").alias("value")), 4, "value")]
    for k in (7, 12):
        sizes = ward.label_sellers(sellers, ward.ward_labels(leaves, merges, k)).groupBy("seller_cluster").agg(F.count("*").alias("n"))
        listed = sizes.agg(F.sort_array(F.collect_list(F.col("n").cast("double")), asc=False).alias("n"))  # k figures
        parts.append(listed.select(F.lit(f"k{k}").alias("part"), F.posexplode("n").alias("place", "value")).withColumn(
            "place", F.col("place").cast("long")))
    return reduce(DataFrame.unionByName, parts)


@query
def topic_totals(w):
    """Documents labelled and topics named for each review subset."""
    found = {"bad": _complaints(w, reviews.bad_reviews, BAD_TOPICS),
             "neutral": _complaints(w, reviews.neutral_reviews, NEUTRAL_TOPICS), "good": _praise(w)}
    return reduce(DataFrame.unionByName, [
        result.documents.agg(
            F.lit(name).alias("subset"), F.count("*").alias("documents"),
            F.count_if(F.col("dominant_topic").between(1, rules.topics)).alias("in_range"))
        for (name, result), rules in zip(found.items(), (BAD_TOPICS, NEUTRAL_TOPICS, GOOD_TOPICS))])


@query
def cluster_profile(w):
    return rounded(segments.cluster_profile(w.by_order_value), 4, *SEGMENT_FEATURES)


@query
def persona_label(w):
    return segments.persona_label(w.profile).select("seller_cluster", "persona", "count")


@query
def seller_matrix(w):
    out = segments.seller_matrix(w.tiered, w.by_order_value)
    return rounded(out.select("seller_id", "gmv", "total_orders", "final_score", "segment",
                              "seller_cluster"), 4, "final_score")


@query
def tier_cluster_crosstab(w):
    return segments.tier_cluster_crosstab(w.matrix, range(4))


@query
def score_spread(w):
    return rounded(segments.score_spread(w.matrix), 4, "q25", "median", "q75", "whisker_low",
                   "whisker_high", "overall_mean")


# Governance views.

_VIEW_COLUMNS = ("seller_id", "gmv", "avg_rating", "late_shipment_rate", "final_score")


@query
def risk_alert(w):
    return rounded(views.risk_alert(w.tiered).select(*_VIEW_COLUMNS), 4, *_VIEW_COLUMNS[2:])


@query
def vip_program(w):
    # Segments by the number of regions reached, so that some are national.
    by_reach = materialize(w.segment_input.withColumn("seller_cluster", F.col("market_reach").cast("int")), "reach-segments")
    matrix = materialize(segments.seller_matrix(w.tiered, by_reach), "reach-matrix")
    vip = views.vip_program(matrix, segments.persona_label(segments.cluster_profile(by_reach)))
    return rounded(vip.select("seller_id", "gmv", "seller_cluster", "persona"), 4, "gmv")


@query
def training_focus(w):
    return rounded(views.training_focus(w.tiered).select(*_VIEW_COLUMNS), 4, *_VIEW_COLUMNS[2:])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Workspace.of(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
