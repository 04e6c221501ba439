import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import parsing as p
from tessera.sources import readers, writers
from tessera.streaming.tracker import track_stream
from tests.test_operators import TRACK, square


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_cvat_round_trip(spark, tmp_path):
    boxes = "array<struct<label:string,xtl:double,ytl:double,xbr:double,ybr:double,rotation:double>>"
    images = [(0, "a.png", 100, 50, []), (1, "b.png", 100, 50, [("ship", 1.0, 2.0, 3.0, 4.0, 5.0)]), (2, "c.png", 10, 10, [("ship", 0.0, 0.0, 1.5, 1.25, 0.0), ("ship", 2.0, 2.0, 3.0, 3.0, 90.0)])]
    df = spark.createDataFrame(images, f"seq long, name string, width int, height int, boxes {boxes}")
    writers.write_cvat(df, str(tmp_path / "x"))
    back = readers.read_cvat(spark, str(tmp_path / "x"))
    assert rows(back, "name") == rows(df.drop("seq"), "name")
    assert tuple(readers.count_cvat_shapes(spark, str(tmp_path / "x")).first()) == (3, 3)


def test_cvat_drops_what_is_not_a_ship(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<annotations><image id="0" name="a" width="9" height="8"><box label=" ship " xtl="1" ytl="x" xbr="2" ybr="2"/><box label="ship" xtl="1" ytl="1" xbr="2"  ybr="2"/><box label="dock" xtl="1" ytl="1" xbr="2" ybr="2"/></image><image id="1" width="1" height="1"/></annotations>')
    (only,) = readers.read_cvat(spark, str(tmp_path / "a.xml")).collect()
    assert only.name == "a" and [tuple(b) for b in only.boxes] == [("ship", 1.0, 1.0, 2.0, 2.0, 0.0)]


def test_dota_geojson_and_objects(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "P1.txt").write_text("imagesource:x\n10 10 50 10 50 20 10 20 ship 0\n10 10 50 10 50 20 10 x ship 0\n1 1 2 1 2 2 1 2 plane 0\n")
    assert [(r.file, r.line, r.difficulty, len(r.poly)) for r in readers.read_dota(spark, str(tmp_path / "d")).collect()] == [("P1.txt", 2, "0", 4)]
    feature = lambda t, b: {"properties": {"type_id": t, "image_id": "7.tif", **({"bounds_imcoords": b} if b else {})}}
    (tmp_path / "x.json").write_text(json.dumps({"features": [feature(40, "10,10,50,40"), feature(39, "1,1,2,2"), feature("x", "1,1,2,2"), feature(41, None)]}))
    assert rows(readers.read_geojson(spark, str(tmp_path / "x.json")), "image") == [("7.tif", 40, 10.0, 10.0, 50.0, 40.0)]
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "1.xml").write_text("<a><b><object><x/></object></b><object/></a>")
    (tmp_path / "h" / "2.xml").write_text("<a/>")
    assert rows(readers.count_objects(spark, str(tmp_path / "h")), "file") == [("1.xml", 2), ("2.xml", 0)]


def test_json_sources(spark, tmp_path):
    (tmp_path / "roi.json").write_text('[{"image": "a.png", "grids": ["5", 0, 12, 5, 1,],}, {"image": "b.png", "grids": []}]')
    assert rows(readers.read_roi(spark, str(tmp_path / "roi.json")), "image") == [("a.png", [1, 5])]
    entry = [{"parent_annotation_id": "i", "suppressed_tile": "t"}] * 2
    for value in (entry, {"entries": entry}):
        (tmp_path / "l.json").write_text(json.dumps(value))
        assert rows(readers.read_ledger(spark, str(tmp_path / "l.json")), "tile_key") == [("i", "t")]
    record = {"instance_id": "a1", "parent_group_key": "dota:train:P:1", "obb_cxcywhr": [100, 80, 40, 10, 30], "obb_vertices_xy": [[85.18, 65.67], [119.82, 85.67], [114.82, 94.33], [80.18, 74.33]], "image_width": 2048, "image_height": 2048}
    (tmp_path / "i.jsonl").write_text("\n".join(json.dumps(r) for r in (record, record | {"obb_cxcywhr": [1, 1, 0, 1, 0]})))
    assert [(r.dataset, r.split, r.parent_id) for r in readers.read_instances(spark, str(tmp_path / "i.jsonl")).collect()] == [("dota", "train", "P:1")]
    assert readers.read_instances(spark, str(tmp_path / "i.jsonl"), split="val").count() == 0
    (tmp_path / "m.jsonl").write_text('{"image_name": "a", "covered_instance_ids": ["x", "y"]}\n{"image_name": "b", "covered_instance_ids": "[\\"z\\"]"}')
    assert [r.covered for r in readers.read_recovery_metadata(spark, str(tmp_path / "m.jsonl")).orderBy("image_name").collect()] == [["x", "y"], ["z"]]


def test_tables_and_yolo_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "x,\"y\""), (None, "|")], "k string, v string")
    writers.write_table(df, str(tmp_path / "t"), ["v", "missing", "k"])
    back = readers.read_table(spark, str(tmp_path / "t"), {"k"})
    assert sorted((r.v, r.k) for r in back.collect()) == [("x,\"y\"", "a\nb"), ("|", None)]
    with pytest.raises(ValueError, match="z"):
        readers.require_columns(back, {"z"})
    label = spark.range(1).select(F.lit("t1").alias("tile_key"), F.lit(1).alias("line"), F.lit(0).alias("class_id"), g.rect_polygon(10, 20, 30, 40).alias("poly"), F.lit(100).alias("tile_width"), F.lit(100).alias("tile_height"))
    text = label.select(p.yolo_line(F.col("class_id"), F.col("poly"), F.col("tile_width"), F.col("tile_height"))).first()[0]
    assert text == "0 0.100000 0.200000 0.300000 0.200000 0.300000 0.400000 0.100000 0.400000"
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "t1.txt").write_text(text + "\nbad\n")
    tiles = spark.createDataFrame([("t1.txt", "t1", 100, 100)], "label_file string, tile_key string, tile_width int, tile_height int")
    found = readers.read_yolo(spark, str(tmp_path / "y"), tiles).orderBy("line").collect()
    assert [(r.line, r.errors) for r in found] == [(1, []), (2, ["wrong_field_count"])]
    assert (found[0].poly[2].x, found[0].poly[2].y) == pytest.approx((30, 40))
    assert p and spark.range(1).select(p.points_to_text(p.points_from_text(F.lit("1,2;3.456,4")))).first()[0] == "1.00,2.00;3.46,4.00"


def test_image_headers_and_reports(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big"))
    (tmp_path / "b.txt").write_bytes(b"x")
    found = {r.path.rsplit("/", 1)[1]: (r.width, r.height) for r in readers.image_sizes(readers.read_files(spark, str(tmp_path), content=True)).collect()}
    assert found == {"a.png": (640, 480), "b.txt": (None, None)}
    assert "a\\|b" in writers.markdown_table([{"k": "a|b"}], ["k"])
    writers.write_json(str(tmp_path / "o" / "x.json"), {"b": 1, "a": 2})
    assert (tmp_path / "o" / "x.json").read_text().index('"a"') < (tmp_path / "o" / "x.json").read_text().index('"b"')
    entries = spark.createDataFrame([("/a.py", "a", ""), ("../a.py", "a", ""), ("x/a.bin", "a", ""), ("x/a.py", "a", ""), ("docs/a.py", "a", "token = 'abcdefghijk'"), ("docs/b.py", "b", "/home/x"), ("docs/c.py", "c", "fine")], "source string, destination string, text string")
    reasons = [r.reason for r in writers.rejected_entries(entries, ("docs/",), (".py",)).collect()]
    assert reasons == ["absolute_path", "path_escape", "suffix", "prefix", "secret", "home_path"]


def test_tracker_stream_keeps_ids_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    df = lambda frames: spark.createDataFrame([("v", f, 0, "ship", 0.5, square(f, 0)) for f in frames], TRACK).coalesce(1)
    df([0, 1]).write.mode("append").parquet(str(source))
    stream = track_stream(spark.readStream.schema(TRACK).parquet(str(source)))
    for k in range(2):
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        if not k:
            df([2, 9]).write.mode("append").parquet(str(source))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("frame", "track_id"), "frame") == [(0, 1), (1, 1), (2, 1), (9, 2)]
