"""Thresholds and vocabularies of the annotation operators, as frozen values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Policy:
    """Defaults of every threshold; pass another instance to change some."""

    tile_size: int = 1024
    tile_stride: int = 824
    min_overlap: float = 0.5
    roi_min_overlap: float = 0.25
    edge_touch: float = 2.5
    cluster_angle: float = 10.0
    hull_iou: float = 0.12
    gap_ratio: float = 0.18
    gap_floor: float = 4.0
    winner_gap: float = 15.0
    link_cell: float = 256.0
    edge_margin: float = 3.0
    min_visible: float = 0.25
    duplicate_iou: float = 0.85
    containment: float = 0.95
    centroid: float = 8.0
    small_side: float = 12.0
    match_iou: float = 0.5
    match_ios: float = 0.75
    area_ratio: tuple[float, float] = (0.4, 2.5)
    bucket_px: int = 64
    dense_labels: int = 80
    nearby_labels: int = 10
    nearby_iou: float = 0.3
    redundant_window_iou: float = 0.7
    min_retained: float = 0.25
    best_existing: float = 0.9
    confidence: float = 0.25
    nms_iou: float = 0.5
    max_detections: int = 300
    pre_nms: int = 3000
    track_gap: int = 2
    track_window: int = 5
    track_match: float = 0.15


DEFAULT = Policy()

# Fixed values of the domain.
MARITIME_TYPES = (40, 41, 42, 44, 45, 47, 49, 50, 51, 52)
EXCLUDED_PARENTS = ("P1277", "P1591", "P1927", "P2662", "P2769")
CONFIDENCE_EDGES = (0.01, 0.025, 0.05, 0.10, 0.25)
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tif", "tiff")
KEYPAD = {7: (0, 0), 8: (0, 1), 9: (0, 2), 4: (1, 0), 5: (1, 1), 6: (1, 2), 1: (2, 0), 2: (2, 1), 3: (2, 2)}
SOURCE_PRIORITY = {"second_pass": 2000, "smart_retile": 2000, "merged": 1500, "cleaned": 1000, "assembled": 1000, "first_pass": 1000}
SIZE_POLICY = {"xview_aggressive": (36.0, 5.0), "small_aggressive": (36.0, 5.0), "low_aggressive": (64.0, 6.0)}

#: Severity of each finding; a parent without any tile makes uncovered_by_any_tile high instead.
SEVERITY = {
    "high": (
        "tile_missing_from_training_index", "missing_training_label", "wrong_field_count", "non_numeric", "non_finite", "zero_area",
        "self_intersection_or_invalid_polygon", "missing_tile_image", "tile_dimension_metadata_mismatch", "unreadable_tile_image",
        "duplicate_tile_filename", "impossible_tile_offset_or_size", "duplicate_tile_record", "tile_bounds_outside_parent",
        "recovery_tile_missing_metadata", "covered_but_missing_label",
    ),
    "medium": (
        "invalid_class_id", "normalized_out_of_bounds", "non_distinct_corners", "orphan_training_label", "unresolved_parent_image_reference",
        "likely_duplicate_tile_label", "covered_but_clipped_below_threshold", "uncovered_by_any_tile", "ambiguous_match",
        "possible_roi_grid_exclusion", "tile_below_roi_threshold", "recovery_tile_missing_plan", "zero_label_recovery_tile",
        "recovery_instance_covered_by_multiple_windows",
    ),
    "low": (
        "parent_dimensions_unavailable", "boundary_touching_obb", "tiny_obb", "dense_scene_pairwise_review_required",
        "nearby_distinct_dense_scene_labels", "intentionally_filtered_training_label", "intentional_strict_roi_exclusion", "redundant_recovery_window",
    ),
}
