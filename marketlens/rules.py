"""Business parameters with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values.
VALID_STATUSES = ("delivered", "shipped", "invoiced")
CHURN_THRESHOLDS_DAYS = (30, 60, 90, 120, 180, 365)
FREQUENCY_QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
SHIPPING_KEYWORDS = (
    "atras", "demor", "entreg", "correio", "transport", "aguard",
    "não receb", "nao receb", "não cheg", "nao cheg", "extravi", "prazo",
)
DAMAGE_KEYWORDS = (
    "danifi", "quebr", "amass", "rasg", "molha", "abert", "viola", "caixa",
    "embalagem", "avaria",
)
SHOPPING_STOP_WORDS = (
    "produto", "entrega", "prazo", "antes", "chegou", "recomendo", "muito",
    "bom", "bem", "tido", "fazer", "loja", "vendedor",
)
SCORE_WEIGHTS = {
    "log_gmv": 0.2478,
    "log_orders": 0.2281,
    "avg_rating": 0.3288,
    "late_shipment_rate": 0.1142,
    "avg_prep_time_hours": 0.0812,
}
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
BAD_TOPIC_NAMES = {
    1: "SP LỖI / ĐỔI TRẢ",
    2: "GIAO TRỄ / KHÔNG NHẬN HÀNG",
    3: "GIAO SAI / THIẾU HÀNG",
    4: "CHẤT LƯỢNG KÉM / VẤN ĐỀ VỚI SELLER",
}
NEUTRAL_TOPIC_NAMES = {
    1: "CHẤT LƯỢNG / SẢN PHẨM",
    2: "TRẢI NGHIỆM GIAO HÀNG",
}
PERSONA_HIGH_TICKET = "High-Ticket (Giá cao)"
PERSONA_LOW_COST = "Low-Cost (Giá rẻ)"
PERSONA_BULKY = "Bulky (Hàng nặng)"
PERSONA_LIGHTWEIGHT = "Lightweight (Hàng nhẹ)"
PERSONA_NATIONAL = "National (Toàn quốc)"
PERSONA_LOCAL = "Local/Regional (Địa phương)"

# Lower values of these features are better, so scoring inverts them.
COST_FEATURES = ("late_shipment_rate", "avg_prep_time_hours")
SELLER_FEATURES = (
    "gmv", "total_orders", "avg_rating", "late_shipment_rate", "avg_prep_time_hours",
)
MODEL_FEATURES = (
    "log_gmv", "log_orders", "avg_rating", "late_shipment_rate", "avg_prep_time_hours",
)
SEGMENT_FEATURES = (
    "avg_weight_g", "category_diversity", "market_reach", "avg_distance_km",
    "avg_order_value", "avg_freight_ratio",
)
SEGMENT_LOG_FEATURES = SEGMENT_FEATURES[:5]


@dataclass(frozen=True)
class OrderRules:
    """Which orders count."""

    statuses: tuple[str, ...] = VALID_STATUSES


@dataclass(frozen=True)
class ActivityRules:
    """When a seller counts as gone quiet or too small to judge."""

    max_recency_days: int = 180
    min_orders: int = 2
    newcomer_days: int = 60


@dataclass(frozen=True)
class ViewRules:
    """Cuts of the governance views."""

    risk_score: float = 40.0
    risk_late_rate: float = 0.30
    vip_gmv_quantile: float = 0.75
    training_gmv_quantile: float = 0.50
    training_max_rating: float = 3.0


@dataclass(frozen=True)
class TopicRules:
    """Vectorizer and model settings of one review subset."""

    topics: int
    min_df: float
    max_df: float = 0.9
    max_features: int | None = None
    stop_words: tuple[str, ...] = ()
    names: dict[int, str] = field(default_factory=dict)


BAD_TOPICS = TopicRules(topics=4, min_df=25, names=BAD_TOPIC_NAMES)
NEUTRAL_TOPICS = TopicRules(topics=5, min_df=25, names=NEUTRAL_TOPIC_NAMES)
GOOD_TOPICS = TopicRules(topics=10, min_df=5, max_features=2000)
