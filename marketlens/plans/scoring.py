"""Seller evaluation rows to scores, segments and the exported scorecard."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from marketlens.operators import activity, fairness, features, scoring, segments, views, ward
from marketlens.rules import ActivityRules
from marketlens.session import materialize
from marketlens.sources.tables import Lake, export_scorecard


def scored_sellers(evaluation: DataFrame, rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Active sellers with features, score and tier, from stored evaluation rows.

    Rows are reduced to one per seller before inactive sellers are left out, so
    the filter never moves item rows. Lifetime and scale come from one pass, as both
    count distinct orders, the step that moves most.
    """
    judged = fairness.with_adjusted_score(evaluation)
    active = activity.active_sellers(activity.seller_lifetime(judged, **features.scale_measures()), rules)
    ops = features.seller_ops(features.with_operations(evaluation))
    joined = materialize(
        features.joined_features(features.seller_scale(judged, active), ops), "seller-features")
    complete = features.log_features(features.seller_features(joined))
    scored = materialize(scoring.seller_score(complete), "seller-scores")
    return materialize(scoring.score_tier(scored), "seller-tiers")


@dataclass(frozen=True)
class Segments:
    """Sellers with their segment, and the merge history behind it."""

    sellers: DataFrame
    merges: DataFrame
    leaves: DataFrame


def segmented_sellers(tiered: DataFrame, segmentation: DataFrame, k: int = 7) -> Segments:
    """Hierarchical segments of scored sellers."""
    described = segments.segmentation_input(tiered, segmentation)
    prepared = materialize(ward.ward_input(materialize(described, "segment-input")), "ward-input")
    labelled, leaves = ward.ward_leaves(prepared)
    labelled = materialize(labelled, "ward-sellers")
    leaves = materialize(leaves, "ward-leaves")
    merges = materialize(ward.ward_merges(leaves), "ward-merges")
    return Segments(ward.label_sellers(labelled, ward.ward_labels(leaves, merges, k)), merges, leaves)


def run_scoring(lake: Lake, export_folder: str, k: int = 7, day: date | None = None) -> dict[str, int]:
    """Score and segment sellers, store the matrix, its personas and the governance views, export the scorecard."""
    tiered = scored_sellers(lake.read("warehouse", "seller_evaluation"))
    result = segmented_sellers(tiered, lake.read("warehouse", "seller_segmentation"), k)
    sellers = materialize(result.sellers, "seller-segments")
    personas = segments.persona_label(materialize(segments.cluster_profile(sellers), "profile"))
    matrix = segments.seller_matrix(tiered, sellers)
    counts = {
        "seller_matrix": lake.write(matrix, "warehouse", "seller_matrix"),
        "seller_personas": lake.write(personas, "warehouse", "seller_personas"),
    }
    stored = lake.read("warehouse", "seller_matrix")
    counts["view_risk_alert"] = lake.write(views.risk_alert(tiered), "warehouse", "view_risk_alert")
    counts["view_vip_program"] = lake.write(
        views.vip_program(stored, lake.read("warehouse", "seller_personas")), "warehouse", "view_vip_program")
    counts["view_training_focus"] = lake.write(views.training_focus(tiered), "warehouse", "view_training_focus")
    counts["seller_scorecard"] = export_scorecard(
        lake, lake.read("warehouse", "seller_matrix"), export_folder, day)
    return counts
