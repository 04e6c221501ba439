"""Geometry of rotated boxes as Catalyst expressions.

A polygon is an array of (x, y) structs in order, a rectangle four scalar columns. Every builder
takes and returns columns, so filters and joins see plain expressions and nothing leaves the JVM.
Null or empty polygons have area 0 and overlap nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Number = Column | float | int


def lit(value: Number) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that is computed once a row. A plain projection would be repeated wherever
    a later filter or projection names it; a generator of one row is not."""
    return df.withColumn(name, F.explode(F.array(value)))


def point(x: Number, y: Number) -> Column:
    return F.struct(lit(x).alias("x"), lit(y).alias("y"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def best(items: Column, better: Callable[[Column, Column], Column]) -> Column:
    """The first item that none later beats; null for an empty array."""
    return F.reduce(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), F.get(items, F.lit(0)), lambda a, x: F.when(better(x, a), x).otherwise(a))


def xs(poly: Column) -> Column:
    return F.transform(poly, lambda p: p["x"])


def ys(poly: Column) -> Column:
    return F.transform(poly, lambda p: p["y"])


def following(poly: Column, i: Column) -> Column:
    """The vertex after the i-th, around the corner."""
    return F.get(poly, (i + 1) % F.size(poly))


def bounds(poly: Column) -> Column:
    """Envelope as a struct x0, y0, x1, y1. Up to four corners need no loop."""
    at = lambda axis: [F.get(poly, F.lit(k))[axis] for k in range(4)]
    few = F.struct(F.least(*at("x")).alias("x0"), F.least(*at("y")).alias("y0"), F.greatest(*at("x")).alias("x1"), F.greatest(*at("y")).alias("y1"))
    many = F.struct(F.array_min(xs(poly)).alias("x0"), F.array_min(ys(poly)).alias("y0"), F.array_max(xs(poly)).alias("x1"), F.array_max(ys(poly)).alias("y1"))
    return F.when(F.size(poly) <= 4, few).otherwise(many)


def corners(cx: Number, cy: Number, width: Number, height: Number, radians: Number) -> Column:
    """Corners of a rotated box, from (-, -) around by (+, -), (+, +) and (-, +) of its own axes."""
    a, b, c, s = lit(width) / 2, lit(height) / 2, F.cos(lit(radians)), F.sin(lit(radians))
    return F.array(*[point(lit(cx) + i * a * c - j * b * s, lit(cy) + i * a * s + j * b * c) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))])


def rect_polygon(x0: Number, y0: Number, x1: Number, y1: Number) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def signed_area(poly: Column) -> Column:
    """Shoelace area; positive if the vertices turn from the x axis to the y axis."""
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    parts = lambda v: F.transform(v, lambda p, i: let(following(v, i), lambda q: cross(p, q)))
    return let(poly, lambda v: F.coalesce(total(parts(v)) / 2, F.lit(0.0)))


def area(poly: Column) -> Column:
    general = let(poly, lambda v: F.when(F.size(v) >= 3, F.abs(signed_area(v))).otherwise(0.0))
    return F.when(F.size(poly) == 4, F.abs(_shoelace(poly))).otherwise(general)


def _shoelace(poly: Column) -> Column:
    """Signed area of four corners summed edge by edge, as the kernels and checking SQL do: comparisons with a
    bound that boxes meet exactly come out alike."""
    p = [F.get(poly, F.lit(k)) for k in range(4)]
    edges = [a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(p, p[1:] + p[:1], strict=True)]
    return (edges[0] + edges[1] + edges[2] + edges[3]) / 2


def centre_of(poly: Column) -> Column:
    """Mean of four corners."""
    mean = lambda axis: sum(F.get(poly, F.lit(k))[axis] for k in range(1, 4)) + F.get(poly, F.lit(0))[axis]
    return point(mean("x") / 4, mean("y") / 4)


def vertex_mean(poly: Column) -> Column:
    return let(poly, lambda v: point(F.try_divide(total(xs(v)), F.size(v)), F.try_divide(total(ys(v)), F.size(v))))


def centroid(poly: Column) -> Column:
    """Area centroid; the vertex mean if the area is 0, and of parallelograms, of which it is the area
    centroid without the rounding of products."""

    def weighted(v: Column) -> Column:
        """Sums of each edge's cross product, and of it times both coordinates."""
        term = lambda p, q, c: F.struct(c.alias("c"), ((p["x"] + q["x"]) * c).alias("x"), ((p["y"] + q["y"]) * c).alias("y"))
        terms = F.transform(v, lambda p, i: let(following(v, i), lambda q: term(p, q, p["x"] * q["y"] - q["x"] * p["y"])))
        zero = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
        return F.aggregate(terms, zero, lambda a, t: F.struct(*[(a[k] + t[k]).alias(k) for k in ("c", "x", "y")]))

    p = [(F.get(poly, F.lit(k))["x"], F.get(poly, F.lit(k))["y"]) for k in range(4)]
    edges = [(a, b, a[0] * b[1] - b[0] * a[1]) for a, b in zip(p, p[1:] + p[:1], strict=True)]
    whole = edges[0][2] + edges[1][2] + edges[2][2] + edges[3][2]
    mean = [sum((e[0][axis] + e[1][axis]) * e[2] for e in edges) / (3 * whole) for axis in (0, 1)]
    skew = sum(F.abs(p[0][axis] - p[1][axis] + p[2][axis] - p[3][axis]) for axis in (0, 1))
    quad = F.when((F.abs(whole) < 2e-12) | (skew < 1e-9), point((p[0][0] + p[1][0] + p[2][0] + p[3][0]) / 4, (p[0][1] + p[1][1] + p[2][1] + p[3][1]) / 4)).otherwise(point(*mean))
    general = let(poly, lambda v: let(weighted(v), lambda t: F.when(F.abs(t["c"]) < 2e-12, vertex_mean(v)).otherwise(point(t["x"] / (3 * t["c"]), t["y"] / (3 * t["c"])))))
    return F.when(F.size(poly) == 4, quad).otherwise(general)


def distance(p: Column, q: Column) -> Column:
    return F.hypot(p["x"] - q["x"], p["y"] - q["y"])


def centroid_distance(first: Column, second: Column) -> Column:
    """The root of the sum of squares, as checking SQL has it: centres that lie a threshold apart are common."""
    square = lambda p, q, a: (p[a] - q[a]) * (p[a] - q[a])
    return let(F.struct(centroid(first).alias("p"), centroid(second).alias("q")), lambda w: F.sqrt(square(w["p"], w["q"], "x") + square(w["p"], w["q"], "y")))


def plane(a: Number, b: Number, c: Number) -> Column:
    return F.struct(lit(a).alias("a"), lit(b).alias("b"), lit(c).alias("c"))


def clip_half_plane(poly: Column, half: Column) -> Column:
    """The part of a convex polygon where a x + b y + c >= 0."""

    def cut(t: Column) -> Column:
        inside, crossing = t["f"] >= 0, (t["f"] >= 0) != (t["g"] >= 0)
        k = t["f"] / (t["f"] - t["g"])
        share = point(t["p"]["x"] + (t["q"]["x"] - t["p"]["x"]) * k, t["p"]["y"] + (t["q"]["y"] - t["p"]["y"]) * k)
        none = F.slice(F.array(t["p"]), 1, 0)
        return F.when(inside & crossing, F.array(t["p"], share)).when(inside, F.array(t["p"])).when(crossing, F.array(share)).otherwise(none)

    def edges(v: Column) -> Column:
        side = lambda p: half["a"] * p["x"] + half["b"] * p["y"] + half["c"]
        with_next = lambda p, i: let(following(v, i), lambda q: F.struct(p.alias("p"), q.alias("q"), side(p).alias("f"), side(q).alias("g")))
        return F.flatten(F.transform(v, lambda p, i: let(with_next(p, i), cut)))

    return let(poly, edges)


def clip_planes(poly: Column, planes: Column) -> Column:
    """Clips by an array of half planes, one after another: the expression holds the step once."""
    return F.reduce(planes, poly, clip_half_plane)


def clip_rect(poly: Column, x0: Number, y0: Number, x1: Number, y1: Number) -> Column:
    return clip_planes(poly, F.array(plane(1, 0, -lit(x0)), plane(-1, 0, x1), plane(0, 1, -lit(y0)), plane(0, -1, y1)))


def clip_convex(poly: Column, quad: Column) -> Column:
    """Intersection with a convex polygon of either winding."""

    def inner(w: Column, p: Column, q: Column) -> Column:
        normal = F.struct((w["s"] * (p["y"] - q["y"])).alias("a"), (w["s"] * (q["x"] - p["x"])).alias("b"))
        return let(normal, lambda n: plane(n["a"], n["b"], -(n["a"] * p["x"] + n["b"] * p["y"])))

    planes = lambda w: F.transform(w["q"], lambda p, i: let(following(w["q"], i), lambda q: inner(w, p, q)))
    turned = let(quad, lambda v: F.struct(v.alias("q"), F.signum(signed_area(v)).alias("s")))
    return clip_planes(poly, let(turned, planes))


def rect_area(x0: Number, y0: Number, x1: Number, y1: Number) -> Column:
    return F.greatest(lit(x1) - lit(x0), F.lit(0.0)) * F.greatest(lit(y1) - lit(y0), F.lit(0.0))


def rect_intersection(a: tuple, b: tuple) -> Column:
    low = [F.greatest(lit(a[k]), lit(b[k])) for k in (0, 1)]
    high = [F.least(lit(a[k]), lit(b[k])) for k in (2, 3)]
    return rect_area(*low, *high)


def rect_iou(a: tuple, b: tuple) -> Column:
    inter = rect_intersection(a, b)
    return F.coalesce(F.try_divide(inter, rect_area(*a) + rect_area(*b) - inter), F.lit(0.0))


def _quad_in_rect(poly: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Signed area of a quadrilateral inside a rectangle, without clipping: the sum over its edges of the
    integral along x, within the rectangle, of the height clamped to it. Plain arithmetic of doubles."""
    p = [(F.get(poly, F.lit(k))["x"], F.get(poly, F.lit(k))["y"]) for k in range(4)]
    clamp = lambda v, a, b: F.least(F.greatest(v, a), b)
    parts = []
    for (px, py), (qx, qy) in zip(p, p[1:] + p[:1], strict=True):
        left, right = clamp(px, x0, x1), clamp(qx, x0, x1)
        slope = F.when(F.abs(qx - px) > 0, (qy - py) / (qx - px)).otherwise(0.0)
        ya, yb = py + (left - px) * slope, py + (right - px) * slope
        ca, cb = clamp(ya, y0, y1), clamp(yb, y0, y1)
        # The mean height: of an edge that crosses a side, the part inside counts as it is, what lies above as y1.
        straight = ((ca == ya) & (cb == yb)) | (F.abs(yb - ya) < 1e-6)
        above = F.greatest(yb - y1, F.lit(0.0)) - F.greatest(ya - y1, F.lit(0.0))
        height = F.when(straight, (ca + cb) / 2 - y0).otherwise(((cb - ca) * ((ca + cb) / 2 - y0) + above * (y1 - y0)) / (yb - ya))
        parts.append((right - left) * height)
    return parts[0] + parts[1] + parts[2] + parts[3]


def quad_area(poly: Column) -> Column:
    """Signed area of four corners, by its diagonals."""
    at = lambda k, a: F.get(poly, F.lit(k))[a]
    return ((at(0, "x") - at(2, "x")) * (at(1, "y") - at(3, "y")) - (at(1, "x") - at(3, "x")) * (at(0, "y") - at(2, "y"))) / 2


def overlap_ratio(poly: Column, x0: Number, y0: Number, x1: Number, y1: Number) -> Column:
    """Share of a convex polygon's area inside a rectangle; 0 if it has no area."""
    rect = [lit(v).cast("double") for v in (x0, y0, x1, y1)]
    quad = F.greatest(F.least(F.coalesce(F.try_divide(F.abs(_quad_in_rect(poly, *rect)), F.abs(quad_area(poly))), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    other = let(poly, lambda p: let(area(p), lambda a: F.when(a > 0, area(clip_rect(p, *rect)) / a).otherwise(0.0)))
    return F.when(F.size(poly) == 4, quad).otherwise(other)


def with_overlap(df: DataFrame, name: str, poly: str, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """Adds `overlap_ratio` of a polygon and a rectangle, by a kernel: the same closed form as columns makes
    code too large to be compiled and plans that take seconds to build."""
    from .kernels import shares

    return once(df, name, shares(F.col(poly), x0, y0, x1, y1))


def overlaps(first: Column, second: Column) -> Column:
    """Struct of inter, a, b: areas of the intersection and of both convex quadrilaterals."""
    from .kernels import overlaps as kernel

    return kernel(first, second)


def iou(first: Column, second: Column, eps: float = 1e-6) -> Column:
    """Intersection over union; 0 if the union is at most `eps`."""
    return let(overlaps(first, second), lambda o: F.when(o["a"] + o["b"] - o["inter"] > eps, o["inter"] / (o["a"] + o["b"] - o["inter"])).otherwise(0.0))


def intersection_over_smaller(first: Column, second: Column) -> Column:
    return let(overlaps(first, second), lambda o: F.coalesce(F.try_divide(o["inter"], F.least(o["a"], o["b"])), F.lit(0.0)))


def round_half_up(value: Number, digits: int) -> Column:
    """Rounding that other engines repeat: floor(x 10^d + 0.5) / 10^d, where what lies within 1e-7 of a
    tie counts as one, so that the last bits of a sum don't decide."""
    return F.floor(lit(value) * 10.0**digits + (0.5 + 1e-7)) / F.lit(10.0**digits)


def order_points(poly: Column) -> Column:
    """Vertices by angle about their mean; two or fewer stay as they are."""

    def ordered(v: Column, m: Column) -> Column:
        keyed = F.transform(v, lambda p, i: F.struct(F.atan2(p["y"] - m["y"], p["x"] - m["x"]).alias("k"), i.alias("i"), p.alias("p")))
        return F.transform(F.array_sort(keyed), lambda t: t["p"])

    return let(poly, lambda v: F.when(F.size(v) <= 2, v).otherwise(let(vertex_mean(v), lambda m: ordered(v, m))))


def rotated_box(poly: Column, clockwise: bool = False) -> Column:
    """Box x0, y0, x1, y1, rotation (degrees) of a rectangle given by four corners in any order, the
    long side as width; all to two decimals. Null without four corners or with an empty first edge."""

    def fit(w: Column) -> Column:
        edge = lambda i: (following(w["p"], F.lit(i))["x"] - F.get(w["p"], F.lit(i))["x"], following(w["p"], F.lit(i))["y"] - F.get(w["p"], F.lit(i))["y"])
        edges = [F.struct(x.alias("x"), y.alias("y"), F.hypot(x, y).alias("n")) for x, y in map(edge, range(4))]

        def oriented(e: Column) -> Column:
            one = F.get(e, F.lit(0))
            across = F.filter(F.slice(e, 2, 3), lambda v: (v["n"] > 0) & (F.abs(v["x"] * one["x"] + v["y"] * one["y"]) < 0.01 * v["n"] * one["n"]))
            two = F.coalesce(F.get(across, F.lit(0)), F.get(e, F.lit(1)))
            long = F.when(one["n"] >= two["n"], one).otherwise(two)
            short = F.when(one["n"] >= two["n"], two).otherwise(one)
            turn = F.pmod(F.degrees(F.atan2(long["y"], long["x"])), F.lit(360.0))
            turn = F.pmod(-turn, F.lit(360.0)) if clockwise else turn
            c = w["c"]
            values = {"x0": c["x"] - long["n"] / 2, "y0": c["y"] - short["n"] / 2, "x1": c["x"] + long["n"] / 2, "y1": c["y"] + short["n"] / 2, "rotation": turn}
            return F.when(one["n"] > 0, F.struct(*[round_half_up(v, 2).alias(k) for k, v in values.items()]))

        return let(F.array(*edges), oriented)

    return let(poly, lambda v: F.when(F.size(v) == 4, let(F.struct(order_points(v).alias("p"), vertex_mean(v).alias("c")), fit)))


def box_corners(box: Column, clockwise: bool = True) -> Column:
    """Corners of a box struct whose rotation is in degrees (clockwise on screen by default)."""
    turn = F.radians(box["rotation"])
    return corners((box["x0"] + box["x1"]) / 2, (box["y0"] + box["y1"]) / 2, F.abs(box["x1"] - box["x0"]), F.abs(box["y1"] - box["y0"]), turn if clockwise else -turn)


def inside_pixels(poly: Column, width: Number, height: Number, eps: float = 1e-6) -> Column:
    """All vertices within [0, width - 1] x [0, height - 1]."""
    right, low = F.greatest(lit(width) - 1, F.lit(0.0)), F.greatest(lit(height) - 1, F.lit(0.0))
    return F.forall(poly, lambda p: (p["x"] >= -eps) & (p["x"] <= right + eps) & (p["y"] >= -eps) & (p["y"] <= low + eps))


def clamp_points(poly: Column, width: Number, height: Number) -> Column:
    right, low = F.greatest(lit(width) - 1, F.lit(0.0)), F.greatest(lit(height) - 1, F.lit(0.0))
    return F.transform(poly, lambda p: point(F.least(F.greatest(p["x"], F.lit(0.0)), right), F.least(F.greatest(p["y"], F.lit(0.0)), low)))


def truncate_box(box: Column, width: Number, height: Number, clockwise: bool = True) -> Column:
    """Corners of the box shortened along one axis to fit the pixels; null if no side can stay.

    A side that is inside stays where it is and the box grows from it as far as the pixels reach, but
    not past its old length. Of the four sides the one that keeps the largest share of the area
    wins, the axis that sticks out more (width on ties) being favoured by 0.05, the first on ties.
    """
    right, low = F.greatest(lit(width) - 1, F.lit(0.0)), F.greatest(lit(height) - 1, F.lit(0.0))

    def reach(base: Column, step: Column, high: Column) -> Column:
        return F.when(step > 1e-12, (high - base) / step).when(step < -1e-12, -base / step).otherwise(F.lit(float("inf")))

    def candidate(w: Column, axis: int, sign: int) -> Column:
        # Corner pairs of the kept side, and the direction away from it.
        kept = {(0, -1): (0, 3), (0, 1): (1, 2), (1, -1): (0, 1), (1, 1): (3, 2)}[axis, sign]
        size, across = (w["w"], w["h"]) if axis == 0 else (w["h"], w["w"])
        ux, uy = (w["c"], w["s"]) if axis == 0 else (-w["s"], w["c"])
        dx, dy = -sign * ux, -sign * uy
        p, q = (F.get(w["p"], F.lit(k)) for k in kept)
        length = F.least(size, *[reach(v["x"], dx, right) for v in (p, q)], *[reach(v["y"], dy, low) for v in (p, q)])

        def grown(n: Column) -> Column:
            far = [point(v["x"] + n * dx, v["y"] + n * dy) for v in (p, q)]
            ring = {kept[0]: p, kept[1]: q, (kept[0] ^ 1 if axis == 0 else 3 - kept[0]): far[0], (kept[1] ^ 1 if axis == 0 else 3 - kept[1]): far[1]}
            return F.struct(F.array(*[ring[k] for k in range(4)]).alias("p"), (n / size).alias("share"), F.lit(axis).alias("axis"))

        return let(length, lambda n: F.when(inside_pixels(F.array(p, q), width, height) & (n > 0) & (across > 0), grown(n)))

    def chosen(w: Column) -> Column:
        over = lambda axis, high: total(F.transform(w["p"], lambda v: F.greatest(-v[axis], F.lit(0.0)) + F.greatest(v[axis] - high, F.lit(0.0))))
        preferred = F.when(over("x", right) >= over("y", low), 0).otherwise(1)
        options = F.array(*[candidate(w, axis, sign) for axis in (0, 1) for sign in (-1, 1)])
        fitting = F.filter(options, lambda o: o.isNotNull() & inside_pixels(o["p"], width, height))
        value = lambda o: o["share"] + F.when(o["axis"] == preferred, 0.05).otherwise(0.0)
        return F.when(inside_pixels(w["p"], width, height), w["p"]).when((w["w"] > 0) & (w["h"] > 0), let(fitting, lambda f: best(f, lambda x, a: value(x) > value(a)))["p"])

    def framed(b: Column) -> Column:
        turn = F.radians(b["rotation"]) * (1 if clockwise else -1)
        frame = F.struct(box_corners(b, clockwise).alias("p"), F.abs(b["x1"] - b["x0"]).alias("w"), F.abs(b["y1"] - b["y0"]).alias("h"), F.cos(turn).alias("c"), F.sin(turn).alias("s"))
        return let(frame, chosen)

    return F.when((lit(width) > 0) & (lit(height) > 0), let(box, framed))


def project_to_tile(poly: Column, tile_x: Number, tile_y: Number, width: Number, height: Number) -> Column:
    """A parent polygon as a tile sees it: struct points, overlap, retained; null if it cannot fit.
    The box is rounded to two decimals before it is fitted, and retained is its kept share of area."""

    from .kernels import project

    return project(poly, lit(tile_x), lit(tile_y), lit(width), lit(height))


def tile_margin(poly: Column, width: Number, height: Number) -> Column:
    """Least distance of a vertex to the pixel border, 0 outside."""
    right, low = F.greatest(lit(width) - 1, F.lit(0.0)), F.greatest(lit(height) - 1, F.lit(0.0))
    margins = F.transform(poly, lambda p: F.least(p["x"], p["y"], right - p["x"], low - p["y"]))
    return F.when((lit(width) <= 0) | (lit(height) <= 0), 0.0).otherwise(F.greatest(F.array_min(margins), F.lit(0.0)))


def extents(poly: Column, degrees: Number) -> Column:
    """Struct u0, u1, v0, v1 of a polygon in a frame turned by an angle."""

    def spans(t: Column) -> Column:
        us = F.transform(poly, lambda p: p["x"] * t["c"] + p["y"] * t["s"])
        vs = F.transform(poly, lambda p: p["y"] * t["c"] - p["x"] * t["s"])
        return F.struct(F.array_min(us).alias("u0"), F.array_max(us).alias("u1"), F.array_min(vs).alias("v0"), F.array_max(vs).alias("v1"))

    return let(F.struct(F.cos(F.radians(lit(degrees))).alias("c"), F.sin(F.radians(lit(degrees))).alias("s")), spans)


def quad_extents(poly: Column, c: Column, s: Column) -> Column:
    """`extents` of four corners in the frame of a cosine and a sine, without a loop."""
    at = [(F.get(poly, F.lit(k))["x"], F.get(poly, F.lit(k))["y"]) for k in range(4)]
    us, vs = [x * c + y * s for x, y in at], [y * c - x * s for x, y in at]
    return F.struct(F.least(*us).alias("u0"), F.greatest(*us).alias("u1"), F.least(*vs).alias("v0"), F.greatest(*vs).alias("v1"))


def angle_difference(first: Number, second: Number) -> Column:
    """Of two axes, modulo a half turn."""
    apart = F.abs(F.pmod(lit(first), F.lit(180.0)) - F.pmod(lit(second), F.lit(180.0)))
    return F.least(apart, 180.0 - apart)


def hull_overlap(a: Column, b: Column) -> Column:
    """Struct hull_iou (over the hull of both extents), gap_u, gap_v, inter_u, inter_v."""
    inter = {k: F.greatest(F.least(a[f"{k}1"], b[f"{k}1"]) - F.greatest(a[f"{k}0"], b[f"{k}0"]), F.lit(0.0)) for k in "uv"}
    gap = {k: F.greatest(F.greatest(a[f"{k}0"], b[f"{k}0"]) - F.least(a[f"{k}1"], b[f"{k}1"]), F.lit(0.0)) for k in "uv"}
    hull = {k: F.greatest(a[f"{k}1"], b[f"{k}1"]) - F.least(a[f"{k}0"], b[f"{k}0"]) for k in "uv"}
    ratio = F.when((hull["u"] > 0) & (hull["v"] > 0), inter["u"] * inter["v"] / (hull["u"] * hull["v"])).otherwise(0.0)
    return F.struct(ratio.alias("hull_iou"), gap["u"].alias("gap_u"), gap["v"].alias("gap_v"), inter["u"].alias("inter_u"), inter["v"].alias("inter_v"))


def polygon_is_valid(poly: Column, min_area: float = 1.0) -> Column:
    """Four finite, distinct corners of a convex quadrilateral of at least `min_area`."""
    turns = F.transform(poly, lambda p, i: (following(poly, i)["x"] - p["x"]) * (following(poly, i + 1)["y"] - following(poly, i)["y"]) - (following(poly, i)["y"] - p["y"]) * (following(poly, i + 1)["x"] - following(poly, i)["x"]))
    finite = F.forall(poly, lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")) & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    convex = F.forall(turns, lambda t: t > 0) | F.forall(turns, lambda t: t < 0)
    return F.coalesce((F.size(poly) == 4) & finite & convex & (area(poly) >= min_area), F.lit(False))


def canonical_polygon(poly: Column, width: Number, height: Number) -> Column:
    """Clamped to the frame, ordered around, starting at the least (y, x)."""

    def started(v: Column) -> Column:
        keyed = F.transform(v, lambda p, i: F.struct(p["y"].alias("y"), p["x"].alias("x"), i.alias("i")))
        return let(F.array_min(keyed)["i"], lambda i: F.concat(F.slice(v, i + 1, F.size(v) - i), F.slice(v, F.lit(1), i)))

    return let(order_points(clamp_points(poly, lit(width) + 1, lit(height) + 1)), started)


def align_polygon(poly: Column, reference: Column) -> Column:
    """The cyclic shift of four corners nearest to the reference's, the first on ties."""

    def apart(v: Column) -> Column:
        return total(F.zip_with(v, reference, lambda p, q: (p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))

    def pick(v: Column) -> Column:
        shifts = [F.concat(F.slice(v, k + 1, 4 - k), F.slice(v, 1, k)) if k else v for k in range(4)]
        options = F.array(*[F.struct(s.alias("p"), apart(s).alias("d")) for s in shifts])
        return let(options, lambda o: best(o, lambda x, a: x["d"] < a["d"]))["p"]

    return let(poly, pick)


def diagonal(poly: Column) -> Column:
    return let(bounds(poly), lambda b: F.hypot(b["x1"] - b["x0"], b["y1"] - b["y0"]))


def match_score(first: Column, second: Column) -> Column:
    """Tracker score: 0.7 of the IoU and 0.3 of the nearness of the vertex means."""
    reach = F.greatest(F.lit(64.0), 2.5 * F.greatest(diagonal(first), diagonal(second)))
    near = F.greatest(1 - distance(vertex_mean(first), vertex_mean(second)) / reach, F.lit(0.0))
    return 0.7 * iou(first, second, 0.0) + 0.3 * near


def floor_thirds(length: Column) -> Column:
    return F.array(F.lit(0).cast("long"), *[F.floor(length * k / 3) for k in (1, 2)], length.cast("long"))


def rounded_thirds(length: Column) -> Column:
    return F.array(F.lit(0).cast("long"), *[F.rint(length * k / 3.0).cast("long") for k in (1, 2)], length.cast("long"))


def letterbox(width: Column, height: Column, size: int) -> Column:
    """Struct scale, w, h, pad_x, pad_y of an image fitted into a square; sizes round half to even."""
    scale = F.least(F.lit(float(size)) / width, F.lit(float(size)) / height)
    w, h = (F.greatest(F.rint(v * scale), F.lit(1.0)) for v in (width, height))
    pad = lambda v: F.rint((size - v) / 2 - 0.1).cast("int")
    return F.struct(scale.alias("scale"), w.cast("int").alias("w"), h.cast("int").alias("h"), pad(w).alias("pad_x"), pad(h).alias("pad_y"))
