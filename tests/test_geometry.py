import math
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions.kernels import Polygons


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def quad(*points):
    return F.array(*[g.point(x, y) for x, y in points])


def pairs(poly):
    return [(round(p.x, 6), round(p.y, 6)) for p in poly]


def square():
    return quad((0, 0), (10, 0), (10, 10), (0, 10))


def test_overlap_and_areas(spark):
    assert value(spark, g.overlap_ratio(square(), 5, 0, 20, 20)) == pytest.approx(0.5)
    assert value(spark, g.area(square())) == 100
    assert value(spark, g.area(quad((0, 0), (1, 1)))) == 0
    assert value(spark, g.iou(square(), quad((5, 0), (15, 0), (15, 10), (5, 10)))) == pytest.approx(1 / 3)
    assert value(spark, g.intersection_over_smaller(square(), quad((2, 2), (4, 2), (4, 4), (2, 4)))) == pytest.approx(1)
    # winding of the second polygon makes no difference, and the measure is symmetric
    a, b = g.corners(50, 50, 40, 10, 0.5), g.corners(55, 48, 30, 20, 1.1)
    first, second = value(spark, g.iou(a, b)), value(spark, g.iou(F.reverse(b), a))
    assert 0 < first < 1 and first == pytest.approx(second)


def test_hull_iou_divides_by_the_hull(spark):
    span = lambda a, b, c, d: F.struct(*[F.lit(float(x)).alias(k) for k, x in zip(("u0", "u1", "v0", "v1"), (a, b, c, d), strict=True)])
    assert value(spark, g.hull_overlap(span(0, 10, 0, 10), span(5, 15, 0, 10))["hull_iou"]) == pytest.approx(50 / 150)
    assert value(spark, g.hull_overlap(span(0, 10, 0, 10), span(5, 15, 5, 15))["hull_iou"]) == pytest.approx(25 / 225)


@pytest.mark.parametrize("degrees", [0, 30, 45, 90, 120, 179])
def test_box_and_corners_are_inverse(spark, degrees):
    poly = g.corners(100, 80, 40, 10, math.radians(degrees))
    box = value(spark, g.rotated_box(poly))
    assert ((box.x0 + box.x1) / 2, (box.y0 + box.y1) / 2) == pytest.approx((100, 80), abs=0.01)
    assert (box.x1 - box.x0, box.y1 - box.y0) == pytest.approx((40, 10), abs=0.02)
    assert min((box.rotation - degrees) % 180, (degrees - box.rotation) % 180) < 0.01


def box(x0, y0, x1, y1, rotation):
    return F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("x0", "y0", "x1", "y1", "rotation"), (x0, y0, x1, y1, rotation), strict=True)])


def test_truncation_keeps_a_rectangle_inside(spark):
    assert pairs(value(spark, g.truncate_box(box(10, 10, 50, 20, 0), 100, 100))) == [(10, 10), (50, 10), (50, 20), (10, 20)]
    # sticks out on the right: the left side stays
    assert pairs(value(spark, g.truncate_box(box(80, 10, 120, 20, 0), 100, 100))) == [(80, 10), (99, 10), (99, 20), (80, 20)]
    # no side lies inside
    assert value(spark, g.truncate_box(box(-10, -10, 200, 200, 0), 100, 100)) is None
    kept = value(spark, g.truncate_box(box(70, 30, 130, 50, 30), 100, 100))
    assert all(-1e-6 <= p.x <= 99 + 1e-6 and -1e-6 <= p.y <= 99 + 1e-6 for p in kept)
    sides = [math.dist((kept[i].x, kept[i].y), (kept[(i + 1) % 4].x, kept[(i + 1) % 4].y)) for i in range(4)]
    assert sides[0] == pytest.approx(sides[2]) and sides[1] == pytest.approx(sides[3]) == pytest.approx(20)


def test_projection_lifts_back(spark):
    seen = value(spark, g.project_to_tile(g.corners(500, 400, 60, 20, 0.3), 300, 200, 1024, 1024))
    assert seen.overlap == pytest.approx(1) and seen.retained == pytest.approx(1, abs=0.01)
    lifted = value(spark, g.vertex_mean(F.array(*[g.point(p.x + 300, p.y + 200) for p in seen.points])))
    assert (lifted.x, lifted.y) == pytest.approx((500, 400), abs=0.01)


def test_thirds_and_letterbox(spark):
    assert value(spark, g.floor_thirds(F.lit(1000))) == [0, 333, 666, 1000]
    assert value(spark, g.rounded_thirds(F.lit(1000))) == [0, 333, 667, 1000]
    fit = value(spark, g.letterbox(F.lit(1280), F.lit(720), 640))
    assert (fit.scale, fit.pad_x, fit.pad_y) == (0.5, 0, 140)


def test_validity(spark):
    assert value(spark, g.polygon_is_valid(square()))
    assert not value(spark, g.polygon_is_valid(quad((0, 0), (10, 10), (10, 0), (0, 10))))
    assert not value(spark, g.polygon_is_valid(quad((0, 0), (10, 0), (10, 0), (0, 10))))
    assert not value(spark, g.polygon_is_valid(quad((0, 0), (10, 0), (10, float("nan")), (0, 10))))


def test_alignment_and_score(spark):
    turned = quad((10, 10), (0, 10), (0, 0), (10, 0))
    assert pairs(value(spark, g.align_polygon(turned, square()))) == [(0, 0), (10, 0), (10, 10), (0, 10)]
    assert value(spark, g.match_score(square(), square())) == pytest.approx(1)
    assert value(spark, g.match_score(square(), quad((500, 0), (510, 0), (510, 10), (500, 10)))) == 0


def test_bounds_met_exactly_count_alike(spark):
    """Centres of equal boxes eight pixels apart, and the area of a row whatever its batch holds."""
    rows = [(k, 100.37 + 13 * k, 900.61 + 7 * k, float(k)) for k in range(180)]
    at = lambda d: g.corners(F.col("x") + d, F.col("y"), F.lit(40.0), F.lit(12.0), F.radians("t"))
    pairs = spark.createDataFrame(rows, "k int, x double, y double, t double").withColumn("a", at(0)).withColumn("b", at(8))
    plain = lambda values: reduce(lambda a, b: a + b, values)
    for r in pairs.withColumn("d", g.centroid_distance(F.col("a"), F.col("b"))).withColumn("s", g.area(F.col("a"))).collect():
        mean = [[plain(c[i] for c in p) / 4 for i in (0, 1)] for p in (r.a, r.b)]
        assert r.d == math.sqrt((mean[0][0] - mean[1][0]) ** 2 + (mean[0][1] - mean[1][1]) ** 2)
        assert r.s == abs(plain(p.x * q.y - q.x * p.y for p, q in zip(r.a, r.a[1:] + r.a[:1], strict=True))) / 2
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0, 3000, (500, 8)), rng.uniform(0, 3000, (500, 8))
    one = [Polygons(x[k : k + 1, :4], y[k : k + 1, :4], np.array([4])).area()[0] for k in range(500)]
    assert Polygons(x, y, np.full(500, 4)).area().tolist() == one
    six = [Polygons(x[k : k + 1, :6], y[k : k + 1, :6], np.array([6])).area()[0] for k in range(500)]
    assert Polygons(x, y, np.full(500, 6)).area().tolist() == six
