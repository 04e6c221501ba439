"""Small scalar functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import parsing as p
from tessera.operators import repair


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ring(*points):
    return F.array(*[g.point(x, y) for x, y in points])


def test_text_and_names(spark):
    lit = F.lit
    assert one(spark, p.normalize_whitespace(lit(" a \t\n b c ")), p.parent_of_group(lit("dota:train:P1")), p.stem(lit("a/b.c.png")), p.base_name(lit("x/y.png"))) == ("a b c", "P1", "b.c", "y.png")
    assert one(spark, p.is_image(lit("x/Y.JPG")), p.is_image(lit("x/jpg")), p.is_image(lit("a.txt"))) == (True, False, False)
    assert one(spark, p.normalized_class(lit("Dock")), p.normalized_class(lit("ship")), p.parse_flag(lit(" TRUE ")), p.first_text(lit(None).cast("string"), lit(" "), lit("x"))) == ("non_vessel", "ship", True, "x")
    assert one(spark, p.recovery_name(lit("dota"), lit("P1.png"), lit(7), lit(1024)))[0] == "dota__P1_0007_1024_recovery_audit_v1.png"
    found = one(spark, p.points_from_text(lit("1,2;x,4")))[0]
    assert [(q.x, q.y) for q in found] == [(1.0, 2.0), (None, 4.0)]


def test_polygons(spark):
    square = ring((10, 0), (0, 10), (0, 0), (10, 10))
    ordered = [(q.x, q.y) for q in one(spark, g.order_points(square))[0]]
    assert ordered == [(0, 0), (10, 0), (10, 10), (0, 10)]
    canonical = [(q.x, q.y) for q in one(spark, g.canonical_polygon(ring((-5, 8), (9, 8), (9, 2), (-5, 2)), 8, 20))[0]]
    assert canonical[0] == (0, 2) and set(canonical) == {(0, 2), (8, 2), (8, 8), (0, 8)}
    shifted = [(q.x, q.y) for q in one(spark, g.align_polygon(ring((9, 9), (1, 9), (1, 1), (9, 1)), ring((0, 0), (10, 0), (10, 10), (0, 10))))[0]]
    assert shifted[0] == (1, 1)
    assert one(spark, g.area(F.array().cast("array<struct<x:double,y:double>>")), g.area(ring((0, 0), (4, 0))), g.area(ring((0, 0), (4, 0), (0, 3)))) == (0.0, 0.0, 6.0)
    mean = one(spark, g.centre_of(ring((0, 0), (4, 0), (4, 2), (0, 2))))[0]
    assert (mean.x, mean.y) == (2, 1)


def test_recovery_tiles(spark):
    boxes = spark.createDataFrame([("i1", "dota:train:P1", "P1"), ("i2", "dota:train:P2", "P2")], "instance_id string, group_key string, parent_id string")
    origins = spark.createDataFrame([("i1", 5, 6, 0.9)], "instance_id string, x long, y long, retained double")
    rows = repair.template_rows(boxes, origins, "instance_id", 1024).collect()
    assert [(r.instance_id, r.parent_id, r.tile_x, r.tile_y, r.tile_width, r.tile_source) for r in rows] == [("i1", "P1", 5, 6, 1024, "annotation_recovery")]
    hull = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(30.0).alias("x1"), F.lit(40.0).alias("y1"))
    at = lambda *v: repair.centre_bonus(*[F.lit(float(x)) for x in v], hull)
    assert one(spark, at(10, 15, 20, 25), at(0, 0, 0, 0), at(500, 0, 600, 0)) == (pytest.approx(1.0), pytest.approx(0.5), 0.0)
