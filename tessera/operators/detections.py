"""Detector output: tensors to detections, and detections to images and parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..policy import DEFAULT, Policy


def _finite(values: Column) -> Column:
    return F.forall(values, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))


def decode_rows(rows: DataFrame, vector: str, confidence: float, rotated: bool = True) -> DataFrame:
    """Detections of raw output rows: an array of cx, cy, w, h, one score for each class, and the angle
    if `rotated`. Adds class_id (first greatest score), conf and rot; rows that aren't finite, are
    below the confidence or have an empty box go."""
    v = F.col(vector)
    scores = F.slice(v, F.lit(5), F.size(v) - (5 if rotated else 4))
    out = rows.filter(_finite(v)).withColumn("_s", scores)
    out = out.withColumn("conf", F.array_max("_s").cast("double")).withColumn("class_id", (F.array_position("_s", F.array_max("_s")) - 1).cast("int"))
    out = out.filter((F.col("conf") >= confidence) & (v[2] > 0) & (v[3] > 0))
    angle = F.element_at(v, -1).cast("double") if rotated else F.lit(0.0)
    return out.select(*[c for c in rows.columns if c != vector], "class_id", "conf", *[v[k].cast("double").alias(n) for k, n in enumerate(("cx", "cy", "w", "h"))], angle.alias("rot"))


def feature_rows(tensors: DataFrame, tensor: str, key: list[str]) -> DataFrame:
    """Rows of a [features, anchors] tensor held as an array of feature arrays, one row for each anchor:
    key, anchor, vector."""
    t = F.col(tensor)
    turned = F.transform(F.sequence(F.lit(0), F.size(t[0]) - 1), lambda i: F.transform(t, lambda f: F.get(f, i)))
    return tensors.select(*key, F.posexplode(turned).alias("anchor", "vector"))


def to_image(detections: DataFrame, scale: Column, pad_x: Column, pad_y: Column, width: Column, height: Column) -> DataFrame:
    """Undoes the letterbox: polygon of each detection in image shares, clamped to [0, 1] and rounded
    to six decimals, with its confidence to four. Boxes without area go."""
    poly = g.corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), F.col("rot"))
    share = lambda v, pad, length: g.round_half_up(F.least(F.greatest((v - pad) / scale / length, F.lit(0.0)), F.lit(1.0)), 6)
    out = detections.withColumn("_p", poly).filter(g.area(F.col("_p")) > 0)
    points = F.transform("_p", lambda p: g.point(share(p["x"], pad_x, width), share(p["y"], pad_y, height)))
    return out.withColumn("polygon", points).withColumn("confidence", g.round_half_up(F.col("conf"), 4)).drop("_p")


def to_parent(points: Column, tile_x: Column, tile_y: Column) -> Column:
    return F.transform(points, lambda p: g.point(p["x"] + tile_x, p["y"] + tile_y))


def serve(tensors: DataFrame, key: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """Detections of single-class raw tensors (key, tensor, width, height): decoded, suppressed by
    rotation-aware overlap, placed in the image. Tensors of another shape are an error."""
    from .greedy import rotated_nms

    shape = F.when((F.size("tensor") == 6) & F.forall("tensor", lambda f: F.size(f) == F.size(F.col("tensor")[0])), F.col("tensor")).otherwise(F.raise_error(F.lit("raw output must have six feature rows")))
    rows = feature_rows(tensors.withColumn("tensor", shape), "tensor", [*key, "width", "height"])
    found = decode_rows(rows, "vector", policy.confidence)
    found = found.withColumn("poly", g.corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), F.col("rot")))
    kept = rotated_nms(found, key, "conf", "poly", "anchor", policy).withColumn("box", g.letterbox(F.col("width"), F.col("height"), 640))
    return to_image(kept, F.col("box.scale"), F.col("box.pad_x"), F.col("box.pad_y"), F.col("width"), F.col("height")).drop("box", "poly")


def summary(detections: DataFrame, by: list[str], conf: str) -> DataFrame:
    """detections, greatest and mean confidence (six decimals) of each group."""
    return detections.groupBy(*by).agg(F.count("*").alias("detections"), F.max(conf).alias("top"), g.round_half_up(F.avg(conf), 6).alias("mean"))


def xyxy_to_xywh(box: Column) -> Column:
    """x0, y0, x1, y1 as an array to x, y, width, height."""
    at = lambda k: F.get(box, F.lit(k))
    return F.array(at(0), at(1), at(2) - at(0), at(3) - at(1))


def valid_xyxy(box: Column) -> Column:
    """Whether a box is finite and has a width and a height; false if null."""
    at = lambda k: F.get(box, F.lit(k))
    return F.coalesce(_finite(box) & (at(2) > at(0)) & (at(3) > at(1)), F.lit(False))


def xyxy_to_source(box: Column, scale: Column, pad_x: Column, pad_y: Column, width: Column, height: Column) -> Column:
    """A box of the letterboxed picture in the original image's pixels, clamped to it."""
    value = lambda k, pad, most: F.least(F.greatest((F.get(box, F.lit(k)) - pad) / scale, F.lit(0.0)), most.cast("double"))
    return F.array(value(0, pad_x, width), value(1, pad_y, height), value(2, pad_x, width), value(3, pad_y, height))


def shift_flat(points: Column, dx: Column, dy: Column) -> Column:
    """Alternating x and y coordinates (a box, or four corners) moved by a tile's offset."""
    return F.transform(points, lambda v, i: v + F.when(i % 2 == 0, dx).otherwise(dy))


def normalise(poly: Column, width: Column, height: Column) -> Column:
    """Points as shares of an image, clamped to [0, 1], to six decimals."""
    share = lambda v, n: g.round_half_up(F.least(F.greatest(v / n, F.lit(0.0)), F.lit(1.0)), 6)
    return F.transform(poly, lambda p: g.point(share(p["x"], width), share(p["y"], height)))
