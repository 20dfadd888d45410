"""Raw table schemas, keys and NOT NULL columns."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("raw_data", "staging", "warehouse")


_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "geolocation": _schema(
        id="BIGINT", geolocation_zip_code_prefix="STRING", geolocation_lat="DOUBLE",
        geolocation_lng="DOUBLE", geolocation_city="STRING", geolocation_state="STRING",
    ),
    "customers": _schema(
        customer_id="STRING", customer_unique_id="STRING", customer_zip_code_prefix="STRING",
        customer_city="STRING", customer_state="STRING",
    ),
    "sellers": _schema(
        seller_id="STRING", seller_zip_code_prefix="STRING", seller_city="STRING",
        seller_state="STRING",
    ),
    "products": _schema(
        product_id="STRING", product_category_name="STRING", product_name_lenght="DOUBLE",
        product_description_lenght="DOUBLE", product_photos_qty="DOUBLE",
        product_weight_g="DOUBLE", product_length_cm="DOUBLE", product_height_cm="DOUBLE",
        product_width_cm="DOUBLE",
    ),
    "product_category_name_translation": _schema(
        product_category_name="STRING", product_category_name_english="STRING",
    ),
    "orders": _schema(
        order_id="STRING", customer_id="STRING", order_status="STRING",
        order_purchase_timestamp="TIMESTAMP_NTZ", order_approved_at="TIMESTAMP_NTZ",
        order_delivered_carrier_date="TIMESTAMP_NTZ",
        order_delivered_customer_date="TIMESTAMP_NTZ",
        order_estimated_delivery_date="TIMESTAMP_NTZ",
    ),
    "order_items": _schema(
        order_id="STRING", order_item_id="INT", product_id="STRING", seller_id="STRING",
        shipping_limit_date="TIMESTAMP_NTZ", price="DOUBLE", freight_value="DOUBLE",
    ),
    "payments": _schema(
        order_id="STRING", payment_sequential="INT", payment_type="STRING",
        payment_installments="INT", payment_value="DOUBLE",
    ),
    "reviews": _schema(
        review_id="STRING", order_id="STRING", review_score="INT",
        review_comment_title="STRING", review_comment_message="STRING",
        review_creation_date="TIMESTAMP_NTZ", review_answer_timestamp="TIMESTAMP_NTZ",
    ),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "geolocation": ("id",),
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
    "product_category_name_translation": ("product_category_name",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
}

NOT_NULL: dict[str, tuple[str, ...]] = {
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    "customers": ("customer_unique_id",),
}

# Columns the cleaning step coerces itself, so files deliver them as text.
COERCED: dict[str, tuple[str, ...]] = {
    "orders": tuple(RAW_SCHEMAS["orders"].names[3:]),
    "order_items": ("shipping_limit_date", "price", "freight_value"),
    "products": tuple(RAW_SCHEMAS["products"].names[2:]),
    "reviews": ("review_score", "review_creation_date", "review_answer_timestamp"),
}


def file_schema(name: str) -> T.StructType:
    """Schema to read a raw file with: coerced columns stay text."""
    as_text = COERCED.get(name, ())
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in as_text else f.dataType, True)
        for f in RAW_SCHEMAS[name].fields
    ])
