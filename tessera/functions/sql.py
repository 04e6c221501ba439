"""The column builders as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

RING = "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"

#: Name, parameters, type and body of each function, written in terms of Spark's own functions.
FUNCTIONS = {
    "ring_area": (f"p {RING}", "DOUBLE", "CASE WHEN size(p) >= 3 THEN abs(aggregate(transform(p, (v, i) -> v.x * get(p, (i + 1) % size(p)).y - get(p, (i + 1) % size(p)).x * v.y), CAST(0 AS DOUBLE), (a, x) -> a + x)) / 2 ELSE 0D END"),
    "rect_ring": ("x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE", RING, "array(named_struct('x', x0, 'y', y0), named_struct('x', x1, 'y', y0), named_struct('x', x1, 'y', y1), named_struct('x', x0, 'y', y1))"),
    "rect_overlap": ("a0 DOUBLE, b0 DOUBLE, a1 DOUBLE, b1 DOUBLE, c0 DOUBLE, d0 DOUBLE, c1 DOUBLE, d1 DOUBLE", "DOUBLE", "greatest(least(a1, c1) - greatest(a0, c0), 0D) * greatest(least(b1, d1) - greatest(b0, d0), 0D)"),
    "rect_iou": (
        "a0 DOUBLE, b0 DOUBLE, a1 DOUBLE, b1 DOUBLE, c0 DOUBLE, d0 DOUBLE, c1 DOUBLE, d1 DOUBLE", "DOUBLE",
        "coalesce(try_divide(rect_overlap(a0, b0, a1, b1, c0, d0, c1, d1), greatest(a1 - a0, 0D) * greatest(b1 - b0, 0D) + greatest(c1 - c0, 0D) * greatest(d1 - d0, 0D) - rect_overlap(a0, b0, a1, b1, c0, d0, c1, d1)), 0D)",
    ),
    "source_group_key": ("name STRING", "STRING", r"coalesce(nullif(regexp_extract(regexp_replace(substring_index(name, '/', -1), '[.][^.]*$', ''), '^(.+?)_row[0-9]+_col[0-9]+$', 1), ''), nullif(regexp_extract(regexp_replace(substring_index(name, '/', -1), '[.][^.]*$', ''), '^(.+?)_[0-9]+_[0-9]+$', 1), ''), regexp_replace(substring_index(name, '/', -1), '[.][^.]*$', ''))"),
    "angle_between_axes": ("a DOUBLE, b DOUBLE", "DOUBLE", "least(abs(pmod(a, 180D) - pmod(b, 180D)), 180D - abs(pmod(a, 180D) - pmod(b, 180D)))"),
    "frame_time": ("frame BIGINT, fps DOUBLE", "DOUBLE", "CASE WHEN fps > 0 THEN floor(frame / fps * 1000000 + 0.5D) / 1000000D END"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions temporary SQL functions of the session; returns their names. They are inlined,
    so the optimizer sees plain expressions."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
