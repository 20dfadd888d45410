"""The nine raw marketplace tables, derived from the TPC-H-like test tables.

Pure column expressions (see FIXTURES.md); ``oracle.py`` holds the same mapping
as SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGES = (
    "Atrasou muito, demorou",
    "Produto veio quebrado na caixa amassada",
    "Não recebi o produto ainda",
    "Nao chegou no prazo",
    "Muito bom, recomendo",
    "Qualidade péssima",
    "",
    None,
    "Veio o produto errado 123!",
    None,
)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, in the splits that its files come in."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _at(micros: str) -> str:
    """SQL of the timestamp without zone at some microseconds (the session runs in UTC)."""
    return f"cast(timestamp_micros({micros}) as timestamp_ntz)"


def _keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders plus the integer key ``k`` the other tables derive from.

    Times are worked out as whole microseconds (``p_us``, ``est_us``), which costs a
    small part of what calendar functions do.
    """
    day = "86400000000"
    return (
        source(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey as k", "o_custkey", "o_totalprice",
            "case when o_orderkey % 37 = 0 then 'canceled'"
            " when o_orderstatus = 'O' and o_orderkey % 2 = 0 then 'shipped'"
            " when o_orderstatus = 'O' and o_orderkey % 6 = 1 then 'invoiced'"
            " else 'delivered' end as order_status",
            "unix_micros(cast(o_orderdate as timestamp)) + (o_orderkey * 7919) % 86400 * 1000000 as p_us",
        )
        .selectExpr(
            "*",
            "case when order_status not in ('invoiced', 'canceled')"
            " then p_us + (k * 37 % 240) * 3600000000 end as carr_us",
            f"case when k % 211 = 0 then p_us - {day}"
            f" else p_us - pmod(p_us, {day}) + (k * 17 % 25 + 8) * {day} end as est_us",
        )
        .selectExpr(
            "k", "o_totalprice", "p_us", "est_us",
            "cast(k as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            "order_status",
            f"{_at('p_us')} as order_purchase_timestamp",
            f"{_at('case when k % 97 <> 0 then p_us + (k * 31 % 48) * 3600000000 end')} as order_approved_at",
            f"{_at('carr_us')} as order_delivered_carrier_date",
            _at("case when order_status = 'delivered' and k % 101 <> 0 then"
                " case when k % 103 = 0 then p_us - 18000000000"
                " else carr_us + (k * 53 % 600) * 3600000000 end end") + " as order_delivered_customer_date",
            f"{_at('est_us')} as order_estimated_delivery_date",
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_orders(spark, sf_dir).drop("k", "o_totalprice", "p_us", "est_us")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _keyed_orders(spark, sf_dir).select("k", "p_us")
    lines = source(spark, sf_dir, "lineitem")
    return lines.join(keyed, lines.l_orderkey == keyed.k).selectExpr(
        "cast(l_orderkey as string) as order_id",
        "l_linenumber as order_item_id",
        "cast(l_partkey as string) as product_id",
        "case when l_partkey % 7 = 0 then concat(l_suppkey, '-p', l_partkey)"
        " else concat(l_suppkey, '-', l_partkey % 50) end as seller_id",
        f"{_at('p_us + (l_orderkey * 13 % 8 + 2) * 86400000000')} as shipping_limit_date",
        "l_extendedprice as price",
        "case when l_tax <> cast(0.08 as double) then l_quantity * cast(1.25 as double) end"
        " as freight_value",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews; the score is still text, as a file would deliver it."""
    keyed = _keyed_orders(spark, sf_dir).select("k", "order_id", "est_us")
    message = F.element_at(
        F.array(*[F.lit(m).cast("string") for m in MESSAGES]),
        F.expr("cast((k div 3) % 10 + 1 as int)"),
    )
    first = keyed.where("k % 13 <> 0").select(
        F.expr("concat('r', k - case when k % 19 = 1 then 1 else 0 end)").alias("review_id"),
        "order_id",
        F.expr("case when k % 61 = 0 then 'n/a' else cast(1 + (k * 29 % 11) % 5 as string) end")
        .alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        message.alias("review_comment_message"),
        F.expr(_at("est_us + 86400000000")).alias("review_creation_date"),
        F.expr(_at("case when k % 53 <> 0 then est_us + (24 + k % 72) * 3600000000 end"))
        .alias("review_answer_timestamp"),
    )
    second = keyed.where("k % 29 = 0").selectExpr(
        "concat('s', k) as review_id",
        "order_id",
        "cast(1 + k % 5 as string) as review_score",
        "cast(null as string) as review_comment_title",
        "'Entrega atrasada' as review_comment_message",
        f"{_at('est_us + 108000000000')} as review_creation_date",
        f"{_at('est_us + 216000000000')} as review_answer_timestamp",
    )
    return first.unionByName(second)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = source(spark, sf_dir, "nation")
    customer = source(spark, sf_dir, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "cast(c_custkey as string) as customer_id",
        "concat('u', c_custkey - c_custkey % 3) as customer_unique_id",
        "cast(10000 + c_nationkey * 4 + c_custkey % 4 as string) as customer_zip_code_prefix",
        "concat('city', c_custkey % 40) as customer_city",
        "n_name as customer_state",
    )


def sellers(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """Raw sellers; ``items`` are the raw order items or a stored copy with their sellers."""
    nation = source(spark, sf_dir, "nation")
    supplier = source(spark, sf_dir, "supplier")
    home = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", "s_nationkey", "n_name"
    )
    ids = (
        (order_items(spark, sf_dir) if items is None else items).select("seller_id").distinct()
        .withColumn("suppkey", F.substring_index("seller_id", "-", 1).cast("long"))
    )
    return ids.join(home, ids.suppkey == home.s_suppkey).selectExpr(
        "seller_id",
        "cast(10000 + s_nationkey * 4 as string) as seller_zip_code_prefix",
        "concat('city', s_suppkey % 40) as seller_city",
        "n_name as seller_state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as product_id",
        "case when p_partkey % 41 <> 0 then concat(lower(p_type), '_', p_partkey % 12) end"
        " as product_category_name",
        "cast(case when p_partkey % 43 <> 0 then length(p_name) end as double)"
        " as product_name_lenght",
        "cast(p_size * 11 as double) as product_description_lenght",
        "cast(p_size % 6 as double) as product_photos_qty",
        "cast(case when p_partkey % 23 = 0 then null when p_partkey % 31 = 0 then 0"
        " else p_size * 100 end as double) as product_weight_g",
        "cast(p_size + 10 as double) as product_length_cm",
        "cast(case when p_partkey % 29 = 0 then -1 else p_size + 2 end as double)"
        " as product_height_cm",
        "cast(p_size + 5 as double) as product_width_cm",
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        products(spark, sf_dir).select("product_category_name").distinct()
        .where("product_category_name is not null and product_category_name not like '%\\\\_11'")
        .withColumn("product_category_name_english",
                    F.concat(F.lit("en_"), F.col("product_category_name")))
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        source(spark, sf_dir, "nation")
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(1))))
        .selectExpr(
            "cast(n_nationkey * 6 + j * 2 + g as bigint) as id",
            "cast(10000 + n_nationkey * 4 + j as string) as geolocation_zip_code_prefix",
            "cast(-30.0 + n_nationkey * 1.1 + j * 0.07 + g * 0.01 as double) as geolocation_lat",
            "cast(-65.0 + (n_nationkey * 7 % 25) * 1.2 + j * 0.05 - g * 0.02 as double)"
            " as geolocation_lng",
            "cast(null as string) as geolocation_city",
            "n_name as geolocation_state",
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_orders(spark, sf_dir).selectExpr(
        "order_id",
        "1 as payment_sequential",
        "case when k % 4 = 0 then 'boleto' else 'credit_card' end as payment_type",
        "cast(1 + k % 10 as int) as payment_installments",
        "o_totalprice as payment_value",
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "geolocation": geolocation,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "product_category_name_translation": translation,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
}
