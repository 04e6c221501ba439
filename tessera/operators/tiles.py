"""Tiles over large parent images: grids, windows, regions of interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..policy import DEFAULT, KEYPAD, Policy


def stepped_positions(start: Column, stop: Column, step: int) -> Column:
    """start, start + step, ... and the stop itself."""
    return F.when(stop <= start, F.array(start)).otherwise(F.array_distinct(F.concat(F.sequence(start, stop, F.lit(step).cast("long")), F.array(stop))))


def clamp_origin(value: Column, length: Column, size: Column | int) -> Column:
    size = size if isinstance(size, Column) else F.lit(size)
    return F.greatest(F.lit(0).cast("long"), F.least(value.cast("long"), (length - size).cast("long")))


def tile_grid(parents: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """One row per whole tile of each parent (columns width, height), with col, row, tile_x, tile_y,
    tile_width, tile_height. No tile covers a remainder; parents smaller than a tile give none."""
    size, stride = policy.tile_size, policy.tile_stride
    steps = lambda length: F.when(F.col(length) >= size, F.sequence(F.lit(0), F.floor((F.col(length) - size) / stride).cast("int")))
    grid = parents.withColumn("col", F.explode(steps("width"))).withColumn("row", F.explode(steps("height")))
    return grid.withColumns({"tile_x": F.col("col") * stride, "tile_y": F.col("row") * stride, "tile_width": F.lit(size), "tile_height": F.lit(size)})


def origins_around(poly: Column, width: Column, height: Column, size: int) -> Column:
    """Distinct clamped window origins around a box: centred, and with each corner of its envelope in
    the window's own corner; as structs (x, y), in that order."""

    def listed(b: Column) -> Column:
        centre = ((b["x0"] + b["x1"]) / 2 - size / 2, (b["y0"] + b["y1"]) / 2 - size / 2)
        raw = [centre, (b["x0"], b["y0"]), (b["x1"] - size, b["y0"]), (b["x0"], b["y1"] - size), (b["x1"] - size, b["y1"] - size)]
        return F.array_distinct(F.array(*[F.struct(clamp_origin(F.rint(x), width, size).alias("x"), clamp_origin(F.rint(y), height, size).alias("y")) for x, y in raw]))

    return g.let(g.bounds(poly), listed)


def choose_recovery_origin(obbs: DataFrame, key: str, policy: Policy = DEFAULT) -> DataFrame:
    """The window around each box that keeps most of it, then the topmost, then the leftmost: key,
    x, y, retained. Boxes of which no window keeps the policy's least share have no row."""
    size = policy.tile_size
    options = obbs.select(key, "poly", F.explode(origins_around(F.col("poly"), F.col("parent_width"), F.col("parent_height"), size)).alias("o"))
    options = g.with_overlap(options, "_share", "poly", F.col("o.x"), F.col("o.y"), F.col("o.x") + size, F.col("o.y") + size).withColumn("retained", g.round_half_up(F.col("_share"), 6))
    best = options.groupBy(key).agg(F.max(F.struct("retained", (-F.col("o.y")).alias("y"), (-F.col("o.x")).alias("x"))).alias("b"))
    return best.filter(F.col("b.retained") >= policy.min_retained).select(key, (-F.col("b.x")).alias("x"), (-F.col("b.y")).alias("y"), F.col("b.retained").alias("retained"))


def canonical_tiles(tiles: DataFrame, window: list[str], kind: str, name: str, split: str) -> DataFrame:
    """One tile for each window, by kind (smart, strict, recovery, full, other) and then name. Windows
    whose tiles disagree on the split are an error."""
    order = F.when(F.col(kind) == "smart_grid", 0).when(F.col(kind) == "strict_grid", 1).when(F.col(kind) == "annotation_recovery", 2).when(F.col(kind) == "full", 3).otherwise(9)
    by = Window.partitionBy(*window)
    ranked = tiles.withColumns({"_n": F.row_number().over(by.orderBy(order, name)), "_lo": F.min(split).over(by), "_hi": F.max(split).over(by)})
    agree = F.when(F.col("_lo") == F.col("_hi"), F.lit(True)).otherwise(F.raise_error(F.lit("tiles of one window are in different splits")).cast("boolean"))
    return ranked.filter((F.col("_n") == 1) & agree).drop("_n", "_lo", "_hi")


def grid_cells(width: Column, height: Column, mask: Column, rounded: bool = True) -> Column:
    """Cells of the keypad grid whose ids are set in a bit mask (id 1 is the lowest bit), as structs
    id, x0, y0, x1, y1, by id. Thirds are rounded (half to even) or floored."""
    cut = g.rounded_thirds if rounded else g.floor_thirds

    def cells(t: Column) -> Column:
        cell = lambda k: F.struct(F.lit(k).alias("id"), t["x"][KEYPAD[k][1]].alias("x0"), t["y"][KEYPAD[k][0]].alias("y0"), t["x"][KEYPAD[k][1] + 1].alias("x1"), t["y"][KEYPAD[k][0] + 1].alias("y1"))
        return F.filter(F.array(*[cell(k) for k in range(1, 10)]), lambda c: (F.shiftright(mask, 0).cast("int").bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(9)]), c["id"]))) > 0)

    return g.let(F.struct(cut(width).alias("x"), cut(height).alias("y")), cells)


def roi_coverage(x0, y0, x1, y1, cells: Column) -> Column:
    """Share of a tile inside the cells, which don't overlap."""
    inside = g.total(F.transform(cells, lambda c: g.rect_intersection((x0, y0, x1, y1), (c["x0"].cast("double"), c["y0"].cast("double"), c["x1"].cast("double"), c["y1"].cast("double")))))
    return F.coalesce(F.try_divide(inside, g.rect_area(x0, y0, x1, y1)), F.lit(0.0))


def grid_components(spark: SparkSession) -> DataFrame:
    """grid_mask, component (sorted ids as text), size: the connected parts of all 511 sets of cells
    of the 3 x 3 grid, four-connected. A rule, not data, so it is broadcast safely."""
    near = {a: [b for b in KEYPAD if sum(abs(x - y) for x, y in zip(KEYPAD[a], KEYPAD[b], strict=True)) == 1] for a in KEYPAD}
    rows = []
    for mask in range(1, 512):
        left = {k for k in range(1, 10) if mask >> (k - 1) & 1}
        while left:
            part, edge = set(), {min(left)}
            while edge:
                part |= edge
                edge = {b for a in edge for b in near[a] if b in left} - part
            left -= part
            rows.append((mask, ",".join(map(str, sorted(part))), len(part)))
    return spark.createDataFrame(rows, "grid_mask int, component string, size int")
