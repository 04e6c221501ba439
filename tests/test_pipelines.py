"""Whole flows over small files."""

import json

from pyspark.sql import functions as F

from tessera.operators import pipelines
from tessera.sources import readers, writers


def test_features_to_tiles_to_xml(spark, tmp_path):
    feature = lambda b, i: {"properties": {"type_id": 40, "image_id": i, "bounds_imcoords": ",".join(map(str, b))}}
    (tmp_path / "x.geojson").write_text(json.dumps({"features": [feature((10, 10, 30, 20), "1.tif"), feature((800, 5, 1100, 25), "1.tif"), feature((5, 5, 5, 9), "1.tif"), feature((900, 900, 920, 910), "2"), feature((1, 1, 9, 9), "3.tif")]}))
    images = spark.createDataFrame([("1.tif", 1900, 1024), ("2.tif", 1024, 1024), ("3.tif", 500, 500), ("4.tif", 1024, 1024)], "name string, width int, height int")
    made = pipelines.tile_features(readers.read_geojson(spark, str(tmp_path / "x.geojson")), images)
    found = {r.name: (r.seq, [[(q.x, q.y) for q in ring] for ring in r.polygons]) for r in made.collect()}
    assert found == {
        "1_row0_col0.png": (0, [[(10, 10), (30, 10), (30, 20), (10, 20)], [(800, 5), (1024, 5), (1024, 25), (800, 25)]]), "1_row0_col1.png": (1, [[(0, 5), (276, 5), (276, 25), (0, 25)]]),
        "2_row0_col0.png": (2, [[(900, 900), (920, 900), (920, 910), (900, 910)]]), "4_row0_col0.png": (3, []),
    }
    writers.write_cvat_polygons(made, str(tmp_path / "xml"))
    assert readers.count_cvat_shapes(spark, str(tmp_path / "xml")).first().asDict() == {"images": 4, "shapes": 4}


def test_recovery_from_annotated_tiles(spark, tmp_path):
    box = lambda x, y, r=0.0: {"label": "ship", "xtl": float(x), "ytl": float(y), "xbr": float(x + 40), "ybr": float(y + 12), "rotation": r}
    tiles = [(0, "P1_0_0.png", 1024, 1024, [box(900, 100), box(100, 100, 30.0)]), (1, "P1_824_0.png", 1024, 1024, [box(77, 100)]), (2, "P9_0_0.png", 1024, 1024, [box(1, 1)]), (3, "P3.png", 1024, 1024, [box(1, 1)]), (4, f"{pipelines.EXCLUDED_PARENTS[0]}_0_0.png", 1024, 1024, [box(5, 5)])]
    kind = "seq int, name string, width int, height int, boxes array<struct<label:string,xtl:double,ytl:double,xbr:double,ybr:double,rotation:double>>"
    writers.write_cvat(spark.createDataFrame(tiles, kind), str(tmp_path / "c"))
    members = spark.createDataFrame([("P1", 3000, 2000), ("P2", 1024, 1024), ("P3", 1024, 1024), (pipelines.EXCLUDED_PARENTS[0], 1024, 1024)], "parent string, width int, height int")
    cleaned, stale = pipelines.lift_cleaned(readers.read_cvat(spark, str(tmp_path / "c")), members, "dota")
    assert [r.parent for r in stale.collect()] == ["P9"]
    raw = cleaned.filter("parent = 'P1'").limit(1).withColumn("parent", F.lit("P2")).unionByName(cleaned.filter("parent = 'P1'").limit(1))
    raw = spark.createDataFrame(raw.collect(), raw.schema)
    out = pipelines.recover_split(members, cleaned, raw, stale)
    parents = {r.parent: (r.source_kind, r.annotation_count, r.merged_count, r.raw_fallback_used) for r in out["parents"].collect()}
    assert parents == {"P1": ("merged", 2, 1, False), "P2": ("raw_fallback", 1, 0, True), "P3": ("empty", 0, 0, False)}
    one = next(r for r in out["annotations"].collect() if r.parent == "P1" and r.source_kind == "merged")
    assert sorted(round(q.x) for q in one.points) == [900, 900, 941, 941] and one.cluster_size == 2
    summary = out["summary"].first()
    assert (summary.membership_parent_count, summary.cleaned_parent_count, summary.stale_cleaned_parent_count, summary.missing_current_parent_count, summary.raw_fallback_parents, summary.empty_parent_count) == (3, 1, 1, 2, 1, 1)
    assert out["review"].count() == 0
    listed = pipelines.in_output_order(spark.createDataFrame([("val", "a"), ("train", "b"), ("train", "a")], "split string, image_name string"))
    assert [tuple(r) for r in listed.collect()] == [("train", "a"), ("train", "b"), ("val", "a")]


def test_features_are_counted_in_tiles(spark):
    """As the gathered polygons count; images that share a key, or a name, count what all of them hold."""
    boxes = [("1", 10, 10, 30, 20), ("1", 800, 5, 1100, 25), ("1", 5, 5, 5, 9), ("2", 900, 900, 920, 910), ("3", 1, 1, 9, 9)]
    kind = "double, x0 double, y0 double, x1 double, y1 double".replace("double", "string", 1)
    features = spark.createDataFrame([(k, *map(float, b)) for k, *b in boxes], f"key {kind}")
    images = spark.createDataFrame([("1.tif", 1900, 1024, "1"), ("2.tif", 1024, 1024, "2"), ("3.tif", 500, 500, "3"), ("4.tif", 1024, 1024, "4")], "name string, width int, height int, key string")
    counted = lambda i: sorted(tuple(r) for r in pipelines.tile_feature_counts(features, i).collect())
    gathered = pipelines.tile_features(features.withColumnRenamed("key", "image"), images).collect()
    area = lambda q: (q[2].x - q[0].x) * (q[2].y - q[0].y)
    assert counted(images) == sorted((r.seq, r.name, len(r.polygons), sum(map(area, r.polygons))) for r in gathered)
    shared = spark.createDataFrame([("1.tif", 1024, 1024, "1"), ("1.tif", 1900, 1024, "1"), ("1.tif", 1024, 1024, "2")], "name string, width int, height int, key string")
    # two of key 1 hold two features each in the first tile, the one of key 2 holds one
    assert [r[1:3] for r in counted(shared)] == [("1_row0_col0.png", 5)] * 3 + [("1_row0_col1.png", 1)]
