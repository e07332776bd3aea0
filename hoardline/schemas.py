"""Schemas of files whose types are not stored with them."""

from __future__ import annotations

PAIR_SIDE = "struct<image_path: string>"

MANIFEST = (
    "id long, image_path string, side string, obverse struct<image_path: string>, "
    "reverse struct<image_path: string>, obv_path string, rev_path string, obverse_path string, "
    "reverse_path string, has_obv string, has_rev string, coin_identity string, coin_id string, "
    "period string, authority string, denomination string, label_confidence double"
)

CORRECTIONS = (
    "timestamp long, filename string, type string, original_prediction string, "
    "original_confidence double, corrected_label string"
)
CONFIRMATIONS = "timestamp long, filename string, type string, label string, confidence double"

# Both shapes in one log folder.
FEEDBACK = (
    "timestamp long, filename string, type string, original_prediction string, "
    "original_confidence double, corrected_label string, label string, confidence double"
)

CLUSTER_RESULTS = (
    "id string, image_path string, parser_period string, visual_cluster string, cluster_id string, "
    "cluster_confidence double"
)

# Nested output of the detector, flattened into detection rows.
DETECTION_JSON = (
    "detection_index int, inferred_side string, bbox array<int>, final_classification string, "
    "layer_1 struct<classification: struct<label: string, confidence: double>, "
    "geometry: struct<area: long, circularity: double, solidity: double, coin_likelihood: double>>, "
    "layer_2 struct<context_classification: struct<inferred_container: string, confidence: double>>"
)
