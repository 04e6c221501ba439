"""Derived annotation views used by several queries, in Spark and as checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import spatial, tiles
from . import check_sql as q
from .testbed import ctes, view


def parents(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "parents")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """Parent boxes with polygon and envelope."""
    return boxed(view(spark, d, "obbs"))


def boxed(o: DataFrame) -> DataFrame:
    return spatial.with_bounds(g.once(o, "poly", g.corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), F.radians("rot"))))


def all_tiles(spark: SparkSession, d: str) -> DataFrame:
    grid = tiles.tile_grid(parents(spark, d).filter("s % 10 <> 9"))
    kinds = F.array(*[F.lit(k) for k in ("smart_grid", "strict_grid", "smart_grid", "annotation_recovery")])
    key = F.concat_ws("_", F.col("parent_id"), F.concat(F.lit("row"), F.col("row")), F.concat(F.lit("col"), F.col("col")))
    return grid.withColumn("tile_source", F.get(kinds, ((F.col("s") + 3 * F.col("row") + F.col("col")) % 4).cast("int"))).withColumn("tile_key", key)


def shown(spark: SparkSession, d: str) -> DataFrame:
    """Boxes in the tiles that their envelopes touch."""
    return spatial.visible_tiles(boxes(spark, d), all_tiles(spark, d))


def labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of tiles in parent pixels: boxes seen at least by half, some left out, some as the tile
    holds them, some twice with a jitter of one pixel."""
    seen = shown(spark, d).filter((F.col("visible") >= 0.5) & (F.col("p") % 11 != 0) & (F.col("p") % 13 != 0))
    held = g.project_to_tile(F.when((F.col("p") % 7 == 0) & (F.col("visible") < 1), F.col("poly")), F.col("tile_x"), F.col("tile_y"), F.col("tile_width"), F.col("tile_height"))
    back = F.transform("_j.points", lambda c: g.point(c["x"] + F.col("tile_x"), c["y"] + F.col("tile_y")))
    seen = g.once(seen, "_j", held).withColumn("poly", F.coalesce(back, "poly"))
    copies = F.when(F.col("p") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = seen.withColumn("copy", F.explode(copies))
    moved = F.transform("poly", lambda v: g.point(v["x"] + F.col("copy"), v["y"] + F.col("copy")))
    line = F.col("o") * 1000000 + F.col("p") * 20 + F.col("n") * 2 + F.col("copy")
    return out.select("tile_key", "group_key", "tile_x", "tile_y", "tile_width", "tile_height", "p", line.alias("line"), F.explode(F.array(moved)).alias("poly"), "instance_id")


def removed(spark: SparkSession, d: str) -> DataFrame:
    seen = shown(spark, d).filter((F.col("visible") >= 0.5) & (F.col("p") % 13 == 0))
    return seen.select("tile_key", (F.col("o") * 1000 + F.col("n")).alias("line"), "poly")


def ledger(spark: SparkSession, d: str) -> DataFrame:
    seen = shown(spark, d).filter(F.col("p") % 22 == 0)
    return seen.select("instance_id", "tile_key")


SQL_BOXES = f"boxes_p AS (SELECT *, {q.ring('cx', 'cy', 'w', 'h', 'rot')} AS poly FROM obbs)"
SQL_BOUNDED = f"bounded AS (SELECT *, {q.low('poly', 'x')} AS x0, {q.low('poly', 'y')} AS y0, {q.high('poly', 'x')} AS x1, {q.high('poly', 'y')} AS y1 FROM boxes_p)"
SQL_TILES = """tiles AS (
    SELECT p.*, c AS col, r AS row, c * 824 AS tile_x, r * 824 AS tile_y, 1024 AS tile_width, 1024 AS tile_height,
           ['smart_grid', 'strict_grid', 'smart_grid', 'annotation_recovery'][CAST((s + 3 * r + c) % 4 + 1 AS INT)] AS tile_source,
           parent_id || '_row' || r || '_col' || c AS tile_key
    FROM parents p, (SELECT CAST(unnest(range(0, 4)) AS INT) AS c), (SELECT CAST(unnest(range(0, 4)) AS INT) AS r)
    WHERE s % 10 <> 9 AND c <= (width - 1024) // 824 AND r <= (height - 1024) // 824)"""
_PAIRS = """SELECT b.*, t.tile_key, t.tile_source, t.tile_x, t.tile_y FROM bounded b JOIN tiles t ON t.group_key = b.group_key
    AND b.x1 >= t.tile_x AND b.x0 <= t.tile_x + 1024 AND b.y1 >= t.tile_y AND b.y0 <= t.tile_y + 1024"""
SQL_SEEN = f"""seen AS (SELECT * EXCLUDE (clip), CASE WHEN x0 >= tile_x AND x1 <= tile_x + 1024 AND y0 >= tile_y AND y1 <= tile_y + 1024 THEN 1.0
    ELSE {q.poly_area('clip')} / (w * h) END AS visible FROM ({q.clipped(f'({_PAIRS})', 'poly', q.rect_planes('tile_x', 'tile_y', 'tile_x + 1024', 'tile_y + 1024'))}))"""
_CUT = "CASE WHEN p % 7 = 0 AND visible < 1 AND fit IS NOT NULL THEN list_transform(fit, lambda c: {'x': c.x + tile_x, 'y': c.y + tile_y}) ELSE poly END"
SQL_SHOWN = f"""shown AS (SELECT * REPLACE ({_CUT} AS poly) FROM ({q.truncated('(SELECT * FROM seen WHERE visible >= 0.5 AND p % 11 <> 0 AND p % 13 <> 0)')}))"""
SQL_LABELS = """labelled AS (
    SELECT tile_key, group_key, tile_x, tile_y, p, o * 1000000 + p * 20 + n * 2 + copy AS line, list_transform(poly, lambda v: {'x': v.x + copy, 'y': v.y + copy}) AS poly, instance_id
    FROM (SELECT *, unnest(CASE WHEN p % 17 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM shown))"""


def base(*names: str) -> str:
    """WITH list of the views named: boxes, tiles, seen, labels."""
    parts = [ctes("parents", "obbs")]
    parts += [SQL_BOXES, SQL_BOUNDED] if {"boxes", "seen", "labels"} & set(names) else []
    parts += [SQL_TILES] if {"tiles", "seen", "labels"} & set(names) else []
    parts += [SQL_SEEN] if {"seen", "labels"} & set(names) else []
    parts += [SQL_SHOWN, SQL_LABELS] if "labels" in names else []
    return "WITH " + ",\n".join(parts)
