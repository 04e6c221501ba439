"""Whole flows over files: raw features to labelled tiles, and tile annotations back to their parents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import parsing as p
from ..policy import DEFAULT, EXCLUDED_PARENTS, Policy
from . import recovery
from .tiles import tile_grid


def tile_features(features: DataFrame, images: DataFrame, policy: Policy = DEFAULT, min_overlap: float = 0.5) -> DataFrame:
    """Tiles of images with their objects: seq (from 0, by name, row and column), name, width, height,
    polygons (rings in tile pixels). features: image, x0, y0, x1, y1; images: name, width, height.

    An image's features are found by its file name, else by its stem. A feature is in a tile if at least
    `min_overlap` of its area is; what lies outside is cut off. Features without area are left out;
    images smaller than a tile give none, and tiles without objects stay.
    """
    named = images.select("name", "width", "height", p.stem(F.col("name")).alias("stem"))
    whole = features.filter("x1 > x0 AND y1 > y0")
    by_name = named.join(whole, F.col("name") == F.col("image"))
    by_stem = named.join(whole.select("image").distinct(), F.col("name") == F.col("image"), "left_anti").join(whole, F.col("stem") == F.col("image"))
    found = by_name.unionByName(by_stem).select(F.col("name").alias("_image"), *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    tiles = tile_grid(named, policy).withColumn("tile", F.format_string("%s_row%d_col%d.png", "stem", F.col("row"), F.col("col")))
    size = policy.tile_size
    low = [F.greatest(F.col("x0"), F.col("tile_x")) - F.col("tile_x"), F.greatest(F.col("y0"), F.col("tile_y")) - F.col("tile_y")]
    high = [F.least(F.col("x1"), F.col("tile_x") + size) - F.col("tile_x"), F.least(F.col("y1"), F.col("tile_y") + size) - F.col("tile_y")]
    meet = (F.col("x1") > F.col("tile_x")) & (F.col("x0") < F.col("tile_x") + size) & (F.col("y1") > F.col("tile_y")) & (F.col("y0") < F.col("tile_y") + size)
    enough = (high[0] - low[0]) * (high[1] - low[1]) >= min_overlap * (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    inside = tiles.join(found, (F.col("name") == F.col("_image")) & meet & enough).groupBy("tile").agg(F.array_sort(F.collect_list(g.rect_polygon(low[0], low[1], high[0], high[1]))).alias("polygons"))
    out = tiles.select("stem", "row", "col", "tile").join(inside, "tile", "left")
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    return _numbered(out, tiles).select("seq", F.col("tile").alias("name"), F.lit(size).alias("width"), F.lit(size).alias("height"), F.coalesce("polygons", none).alias("polygons"))


def tile_feature_counts(features: DataFrame, images: DataFrame, policy: Policy = DEFAULT, min_overlap: float = 0.5) -> DataFrame:
    """seq, name, objects and pixels (their area) of the tiles that `tile_features` makes, counted and not gathered.
    features: key, x0, y0, x1, y1; images: name, width, height, key. Images that share a key hold all its
    features, each of them; tiles that share a name are rows of their own and count what all of them hold."""
    c, size = F.col, policy.tile_size
    tiles = tile_grid(images.select("name", "width", "height", "key", p.stem(c("name")).alias("stem")), policy).withColumn("tile", F.format_string("%s_row%d_col%d.png", "stem", c("row"), c("col")))
    whole = features.filter("x1 > x0 AND y1 > y0").select(c("key").alias("_key"), *[c(k).cast("double").alias(k) for k in ("x0", "y0", "x1", "y1")])
    places = tiles.groupBy("key", "tile", "tile_x", "tile_y").agg(F.count("*").alias("_times"))
    low = [F.greatest(c(f"{a}0"), c(f"tile_{a}")) - c(f"tile_{a}") for a in "xy"]
    high = [F.least(c(f"{a}1"), c(f"tile_{a}") + size) - c(f"tile_{a}") for a in "xy"]
    seen = (high[0] - low[0]) * (high[1] - low[1])
    meet = (c("x1") > c("tile_x")) & (c("x0") < c("tile_x") + size) & (c("y1") > c("tile_y")) & (c("y0") < c("tile_y") + size)
    pairs = whole.join(places, (c("key") == c("_key")) & meet & (seen >= min_overlap * (c("x1") - c("x0")) * (c("y1") - c("y0"))))
    held = pairs.groupBy("tile").agg(F.sum("_times").alias("objects"), F.sum(seen * c("_times")).alias("pixels"))
    found = tiles.select("stem", "row", "col", "tile").join(held, "tile", "left").fillna(0, ["objects"]).fillna(0.0, ["pixels"])
    return _numbered(found, tiles).select("seq", c("tile").alias("name"), "objects", "pixels")


def _numbered(rows: DataFrame, tiles: DataFrame) -> DataFrame:
    """Adds seq, the place by stem, row and column, in two steps, so that no task orders all tiles: inside
    each stem, then over stems."""
    place = F.row_number().over(Window.partitionBy("stem").orderBy("row", "col")) - 1
    sizes = tiles.groupBy("stem").agg(F.count("*").alias("_n"))
    bases = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("stem").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row for each stem
    return rows.withColumn("_place", place).join(bases, "stem").withColumn("seq", F.col("_base") + F.col("_place")).drop("_base", "_place")


def lift_cleaned(tiles: DataFrame, members: DataFrame, kind: str, stride: int = 824) -> tuple[DataFrame, DataFrame]:
    """Candidates of parents from annotated tiles (name, width, height, boxes), and the parents named by
    tiles that are no members (stale). members: parent, width, height. Tile names give the parent and
    the origin (`kind` dota: pixels, else rows and columns); tiles without one give nothing."""
    origin = (p.grid_origin if kind == "dota" else lambda n: p.row_col_origin(n, stride))(F.col("name"))
    rows = tiles.select(p.source_group_key(F.col("name")).alias("parent"), origin.alias("o"), "name", F.col("width").alias("tile_width"), F.col("height").alias("tile_height"), "boxes")
    stale = rows.join(members.select("parent"), "parent", "left_anti").select("parent").distinct()
    held = rows.filter("o IS NOT NULL").join(members.select("parent", F.col("width").alias("parent_width"), F.col("height").alias("parent_height")), "parent")
    boxes = held.select("parent", "name", "tile_width", "tile_height", "parent_width", "parent_height", F.col("o.x").alias("tile_x"), F.col("o.y").alias("tile_y"), F.posexplode("boxes").alias("at", "b"))
    frame = F.struct(F.col("b.xtl").alias("x0"), F.col("b.ytl").alias("y0"), F.col("b.xbr").alias("x1"), F.col("b.ybr").alias("y1"), F.col("b.rotation").alias("rotation"))
    lifted = boxes.withColumn("local", g.box_corners(frame)).withColumn("poly", F.transform("local", lambda v: g.point(v["x"] + F.col("tile_x"), v["y"] + F.col("tile_y"))))
    seq = F.row_number().over(Window.partitionBy("parent").orderBy("name", "at")).cast("long")
    turn = F.pmod(F.col("b.rotation"), F.lit(180.0))
    out = lifted.filter(g.area(F.col("poly")) > 1e-6).select("parent", seq.alias("seq"), "poly", turn.alias("angle"), F.lit("cleaned").alias("source_kind"), "parent_width", "parent_height", "local", "tile_width", "tile_height", "tile_x", "tile_y")
    return out, stale


def recover_split(members: DataFrame, cleaned: DataFrame, raw: DataFrame, stale: DataFrame, policy: Policy = DEFAULT, excluded: tuple[str, ...] = EXCLUDED_PARENTS) -> dict[str, DataFrame]:
    """Annotations of the members of a split from their cleaned tiles, or from raw labels where there are
    none: annotations, review, parents and summary. cleaned, raw: candidates (as `lift_cleaned` gives
    them); raw ones count as source kind raw_fallback and only for members without cleaned ones."""
    mine = members.filter(~F.col("parent").isin(list(excluded)))
    own = cleaned.join(mine.select("parent"), "parent", "left_semi")
    have = own.select("parent").distinct()
    fallback = raw.join(mine.select("parent"), "parent", "left_semi").join(have, "parent", "left_anti").withColumn("source_kind", F.lit("raw_fallback"))
    candidates = own.unionByName(fallback.select(own.columns))
    scored = recovery.with_score(candidates, policy)
    clustered = scored.join(recovery.clusters(scored, recovery.cluster_links(scored, policy)), ["parent", "seq"])
    made = recovery.recover(candidates, policy)
    parents = recovery.parent_summary(mine, candidates, made)
    known = have.unionByName(stale.select("parent")).distinct()
    return {"annotations": made, "review": recovery.review_entries(clustered, made, policy), "parents": parents, "summary": recovery.recovery_summary(mine, known, parents)}


def in_output_order(rows: DataFrame, by: tuple[str, ...] = ("split", "image_name")) -> DataFrame:
    """Rows as files list them."""
    return rows.orderBy(*by)
