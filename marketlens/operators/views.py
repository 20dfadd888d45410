"""Governance views over scored sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.order_stats import quantiles
from marketlens.rules import PERSONA_NATIONAL, ViewRules


def risk_alert(scored: DataFrame, rules: ViewRules = ViewRules()) -> DataFrame:
    """Sellers to warn: low score or many late shipments."""
    return scored.where(
        (F.col("final_score") < rules.risk_score)
        | (F.col("late_shipment_rate") > rules.risk_late_rate)
    )


def _gmv_quantile(sellers: DataFrame, share: float):
    return quantiles(sellers, "gmv", [share]).select("q0").scalar()


def vip_program(matrix: DataFrame, personas: DataFrame, rules: ViewRules = ViewRules()) -> DataFrame:
    """Sellers of a national persona whose revenue is in the upper part."""
    national = personas.where(F.col("persona").contains(PERSONA_NATIONAL))
    floor = _gmv_quantile(matrix, rules.vip_gmv_quantile)
    return matrix.where(F.col("gmv") >= floor).join(
        national.select("seller_cluster", "persona"), "seller_cluster"
    )


def training_focus(scored: DataFrame, rules: ViewRules = ViewRules()) -> DataFrame:
    """Sellers with high revenue and a poor rating."""
    floor = _gmv_quantile(scored, rules.training_gmv_quantile)
    return scored.where(
        (F.col("gmv") >= floor) & (F.col("avg_rating") < rules.training_max_rating)
    )
