"""Raw tables to staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import known, to_number, to_timestamp
from marketlens.functions.order_stats import column_quantiles
from marketlens.functions.scaling import with_statistics
from marketlens.rules import OrderRules

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
COUNT_COLUMNS = ("product_name_lenght", "product_description_lenght", "product_photos_qty")
SIZE_COLUMNS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def latest_per_key(df: DataFrame, key: str, recency: list[str]) -> DataFrame:
    """One row per key: the greatest by ``recency``, where null counts as latest.

    Remaining columns break ties, so the choice does not depend on row order. A
    maximum combines on the map side, so a key with very many copies is no
    hot spot. Rows with a null key form one group.
    """
    others = [c for c in df.columns if c != key and c not in recency]
    order = [x for c in recency for x in (F.col(c).isNull().alias(f"_{c}_open"), F.col(c))]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *others)).alias("_best"))
    return best.select(*[F.col(key) if c == key else F.col(f"_best.{c}").alias(c)
                         for c in df.columns])


def typed_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with score and dates coerced; what does not parse becomes null."""
    return reviews.withColumns({
        "review_score": to_number(F.col("review_score")),
        "review_creation_date": to_timestamp(F.col("review_creation_date")),
        "review_answer_timestamp": to_timestamp(F.col("review_answer_timestamp")),
    })


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Typed reviews, the latest row of each review id, missing text as ''."""
    latest = latest_per_key(
        typed_reviews(reviews), "review_id", ["review_answer_timestamp", "review_creation_date"]
    )
    return latest.fillna("", subset=["review_comment_title", "review_comment_message"])


def removed_by_dedup(reviews: DataFrame) -> DataFrame:
    """How many review rows deduplication removes."""
    per_id = reviews.groupBy("review_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_removed"),
    )


def clean_orders(orders: DataFrame, rules: OrderRules = OrderRules()) -> DataFrame:
    """Orders in a counted status whose dates do not contradict each other."""
    typed = orders.withColumns({c: to_timestamp(F.col(c)) for c in ORDER_TIMESTAMPS})
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    undated = (F.col("order_status") == "delivered") & delivered.isNull()
    return typed.where(
        F.col("order_status").isin(*rules.statuses)
        & ~undated
        & ~known(purchased > delivered)
        & ~known(estimated < purchased)
    )


def clean_order_items(items: DataFrame) -> DataFrame:
    """Items with a typed shipping limit and amounts, missing amounts as 0."""
    return items.withColumns({
        "shipping_limit_date": to_timestamp(F.col("shipping_limit_date")),
        "price": F.coalesce(to_number(F.col("price")), F.lit(0.0)),
        "freight_value": F.coalesce(to_number(F.col("freight_value")), F.lit(0.0)),
    })


def clean_products(products: DataFrame) -> DataFrame:
    """Products with gaps filled; sizes take the median of all known values.

    The medians count values of zero or less too, which are replaced only
    afterwards. Columns the table lacks are skipped.
    """
    present = set(products.columns)
    counts = [c for c in COUNT_COLUMNS if c in present]
    sizes = [c for c in SIZE_COLUMNS if c in present]
    changes = {c: F.coalesce(to_number(F.col(c)), F.lit(0.0)) for c in counts}
    if "product_category_name" in present:
        changes["product_category_name"] = F.coalesce(
            F.col("product_category_name").cast("string"), F.lit("unknown")
        )
    if not sizes:
        return products.withColumns(changes)
    typed = products.select(*[to_number(F.col(c)).alias(c) for c in sizes])
    medians = column_quantiles(typed, sizes, [0.5])
    known = with_statistics(products, medians, **{
        c: F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("q0"))), F.lit(0.0))
        for c in sizes
    })
    for c in sizes:
        size = to_number(F.col(c))
        changes[c] = F.when(size > 0, size).otherwise(F.col(f"_stats.{c}"))
    return known.withColumns(changes).drop("_stats")
