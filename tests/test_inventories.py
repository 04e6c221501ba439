"""Readers, writers, gates and SQL functions on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.functions import parsing as p
from tessera.functions import sql as functions
from tessera.operators import audit, detections, reports
from tessera.sources import readers, writers


def test_label_counts_and_missing_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "P1.txt").write_text("gsd:1\n1 1 2 1 2 2 1 2 ship 0\n1 1 2 1 2 2 1 2 plane 0\r\n 1 1 2 1 2 2 1 2 ship\n")
    (tmp_path / "d" / "P2.txt").write_text("")
    assert {r.file: r.objects for r in readers.count_dota(spark, str(tmp_path / "d")).collect()} == {"P1.txt": 2, "P2.txt": 0}
    names = spark.createDataFrame([("P1.txt",), ("P3.txt",)], "file string")
    assert {tuple(r) for r in readers.count_dota(spark, str(tmp_path / "d"), names).collect()} == {("P1.txt", 2, False), ("P3.txt", 0, True)}
    feature = lambda t, i: {"properties": {"type_id": t, "image_id": i, "bounds_imcoords": "1,2"}}
    (tmp_path / "x.geojson").write_text(json.dumps({"features": [feature(40, "a/1.tif"), feature("41", "1.tif"), feature(7, "1.tif"), feature("x", "2.tif"), feature(40, "2.tif"), feature(40, "")]}))
    assert {r.image: r.objects for r in readers.count_geojson(spark, str(tmp_path / "x.geojson")).collect()} == {"1.tif": 2, "2.tif": 1}
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.xml").write_text("<a><object/><!-- <object/> --><b><object x='1'></object></b><![CDATA[<object>]]></a>")
    assert readers.count_objects(spark, str(tmp_path / "h")).first().objects == 2


def test_removed_labels_and_results(spark, tmp_path):
    tiles = spark.createDataFrame([("t1.png", 100, 100)], "tile_key string, tile_width int, tile_height int")
    assert readers.read_removed(spark, str(tmp_path / "none.csv"), tiles).count() == 0
    good = "0 0.1 0.1 0.2 0.1 0.2 0.2 0.1 0.2"
    (tmp_path / "r.csv").write_text(f"image_name,label_line,why\nt1.png,{good},x\nt1.png,bad,x\nt2.png,{good},x\n")
    found = readers.read_removed(spark, str(tmp_path / "r.csv"), tiles).collect()
    assert [(r.tile_key, r.line, round(r.poly[2].x)) for r in found] == [("t1.png", 0, 20)]
    (tmp_path / "runs" / "a").mkdir(parents=True)
    (tmp_path / "runs" / "a" / "results.csv").write_text("  epoch,  time,  metrics/mAP50(B),  metrics/mAP50-95(B)\n 1, 2.5, 0.5, 0.25\n x, 1, 1, 1\n 2, 5.0, nan?, 0.75\n")
    rows = readers.read_results(spark, str(tmp_path / "runs" / "*" / "results.csv")).orderBy("epoch").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 0.5, 0.25, 2.5), ("a", 2, None, 0.75, 5.0)]
    best = reports.best_epochs(readers.read_results(spark, str(tmp_path / "runs" / "*" / "results.csv")), "run", "epoch", "map50", "map95", "time").first()
    assert (best.best_epoch, best.last_time) == (2, 5.0)


def test_configurations(tmp_path):
    writers.write_yaml(str(tmp_path / "c.yaml"), {"names": ["ship"], "nc": 1, "seed": 3})
    config = readers.read_yaml(str(tmp_path / "c.yaml"), {"seed": 3})
    assert readers.require_single_class(config) == {"names": ["ship"], "nc": 1, "seed": 3} and readers.require_single_class({"names": {0: "ship"}})
    with pytest.raises(ValueError, match="seed"):
        readers.read_yaml(str(tmp_path / "c.yaml"), {"seed": 4})
    with pytest.raises(ValueError, match="dock"):
        readers.require_single_class({"names": ["dock"]})
    (tmp_path / "l.yaml").write_text("- 1\n")
    with pytest.raises(ValueError, match="mapping"):
        readers.read_yaml(str(tmp_path / "l.yaml"))
    ranges = {"MAX_MB": (int, 20, 1, 100), "CONFIDENCE": (float, 0.25, 0.0, 1.0)}
    assert readers.settings({"MAX_MB": "30"}, ranges) == {"MAX_MB": 30, "CONFIDENCE": 0.25}
    for bad in ({"MAX_MB": "x"}, {"MAX_MB": "1000"}, {"CONFIDENCE": "nan"}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            readers.settings(bad, ranges)
    writers.write_lineage(str(tmp_path / "l.json"), [{"name": "raw"}, {"name": "tiles", "inputs": ["raw"]}])
    assert json.loads((tmp_path / "l.json").read_text())["stages"][1]["inputs"] == ["raw"]
    with pytest.raises(ValueError, match="other"):
        writers.write_lineage(str(tmp_path / "m.json"), [{"name": "tiles", "inputs": ["other"]}])


def test_classes_and_cells(spark):
    names = p.class_map({"id2label": {"0": "ship", "1": "Tug"}})
    assert p.class_map({"label2id": {"ship": 0, "Tug": "1"}}) == names and p.resolve_class_ids(["TUG", 0, "1"], names) == [0, 1]
    with pytest.raises(ValueError, match="dock"):
        p.resolve_class_ids(["dock"], names)
    df = spark.createDataFrame([(0, '["a"]', 3.0), (5, None, 0.0), (None, "{}", None)], "c int, j string, fps double")
    found = df.select(p.class_label(F.col("c"), names), p.json_list(F.col("j")), p.frame_time(F.lit(10), F.col("fps"))).collect()
    assert [tuple(r) for r in found] == [("ship", ["a"], 3.333333), ("5", [], None), (None, [], None)]
    boxes = spark.createDataFrame([([0.0, 0.0, 2.0, 3.0],), ([0.0, 0.0, 0.0, 3.0],), ([0.0, 0.0, float("nan"), 3.0],), (None,)], "b array<double>")
    assert [r[0] for r in boxes.select(detections.valid_xyxy(F.col("b"))).collect()] == [True, False, False, False]


def test_inventory_and_references(spark, tmp_path):
    for name, text in (("docs/a.md", "x"), ("data/b.txt", "see /home/u/sam9/x.yaml and C:\\w\\SAM9\\y, sam9"), (".git/c", "x"), ("d.txt", "")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    files = readers.read_files(spark, str(tmp_path))
    found = {r.path: (r.name, r.is_large, r.is_relevant) for r in readers.inventory(files, str(tmp_path), relevant=("docs",), large_bytes=10).collect()}
    assert found == {"docs/a.md": ("a.md", False, True), "data/b.txt": ("b.txt", True, False), "d.txt": ("d.txt", False, False)}
    lines = readers.read_lines(spark, str(tmp_path / "data"))
    assert {r.value for r in readers.absolute_references(lines, "sam9").collect()} == {"/home/u/sam9/x.yaml", "C:\\w\\SAM9\\y,"}
    uploads = spark.createDataFrame([("a", 10, 100, 100), ("b", 99, 100, 100), ("c", 10, None, None), ("d", 10, 9000, 9000)], "path string, size long, width int, height int")
    assert [r.problem for r in readers.upload_problems(uploads, 50).collect()] == [None, "too_large", "not_an_image", "too_many_pixels"]


def test_subsets_are_copied(spark, tmp_path):
    for split in ("train", "val"):
        for kind in ("images", "labels"):
            (tmp_path / "set" / kind / split).mkdir(parents=True)
        (tmp_path / "set" / "images" / split / "1.png").write_text(split)
        (tmp_path / "set" / "labels" / split / "1.txt").write_text("l")
    rows = spark.createDataFrame([("a", "train", "1.png"), ("b", "val", "1.png"), ("a", "val", "1.png")], "dataset string, split string, image_name string")
    named = writers.subset_manifest(rows, str(tmp_path / "set"), ["split", "image_name"])
    assert {(r.dataset, r.split): (r.subset_image, r.subset_label) for r in named.collect()} == {("a", "train"): ("a__1.png", "a__1.txt"), ("a", "val"): ("a__1__2.png", "a__1__2.txt"), ("b", "val"): ("b__1.png", "b__1.txt")}
    one = named.filter("dataset = 'b'").withColumn("to", F.concat(F.lit(f"{tmp_path}/out/"), "subset_image"))
    assert writers.copy_files(spark, one, "source_image", "to") == 1 and not (tmp_path / "out").exists()
    assert writers.copy_files(spark, one, "source_image", "to", dry_run=False) == 1 and (tmp_path / "out" / "b__1.png").read_text() == "val"
    writers.write_jsonl(spark.createDataFrame([(1, "x")], "b int, a string"), str(tmp_path / "j"))
    line = next(f.read_text() for f in (tmp_path / "j").glob("part-*") if f.stat().st_size)
    assert line == '{"a":"x","b":1}\n'
    report = writers.markdown_report("T", {"n": 1}, spark.createDataFrame([("a|b", 1)], "k string, n int"), ["k", "n"])
    assert report.startswith("# T\n\n- n: 1\n") and "| a\\|b | 1 |" in report
    assert writers.manifest("test", {"x": 1}, root=str(tmp_path))["arguments"] == {"x": "1"}


def test_gates(spark):
    coverage = spark.createDataFrame([("high", "covered_but_missing_label"), ("none", "covered_and_labeled")], "severity string, status string")
    tiles = spark.createDataFrame([("P1", 0), ("P1", 0), ("P2", 0)], "parent_id string, x int")
    checks = reports.promotion_gate(coverage, tiles, tiles.limit(0), ["parent_id", "x"], "parent_id", ["P2"])
    assert {r.check: r.found for r in checks.collect()} == {"readiness": 1, "covered_but_missing_label": 1, "uncovered_by_any_tile": 0, "duplicate_windows": 1, "excluded_parents": 1, "invalid_labels": 0}
    with pytest.raises(ValueError, match="covered_but_missing_label, duplicate_windows, excluded_parents, readiness"):
        reports.require(checks)
    clear = reports.promotion_gate(coverage.filter("severity = 'none'"), tiles.limit(1), tiles.limit(0), ["parent_id", "x"], "parent_id", [])
    reports.require(clear)
    graded = audit.with_severity(spark.createDataFrame([("zero_area",), ("orphan_training_label",), ("redundant_recovery_window",), ("other",)], "issue_type string"))
    assert [r.severity for r in graded.collect()] == ["high", "medium", "low", None]


def test_sql_functions(spark):
    assert "rect_iou" in functions.register(spark)
    row = spark.sql("SELECT rect_iou(0D, 0D, 10D, 10D, 5D, 0D, 15D, 10D), ring_area(rect_ring(0D, 0D, 3D, 2D)), ring_area(NULL), rect_iou(0D, 0D, 0D, 0D, 0D, 0D, 0D, 0D), source_group_key('x/P1_row2_col3.png'), source_group_key('P1_824_0.png'), source_group_key('P1.png'), frame_time(1, 0D)").first()
    assert tuple(row) == (pytest.approx(1 / 3), 6.0, 0.0, 0.0, "P1", "P1", "P1", None)


def test_category_of_paths(spark):
    df = spark.createDataFrame([("data/x",), ("app/y",), ("x",), ("docs/a/b",), ("database/x",)], "path string")
    found = [r[0] for r in df.select(p.path_category(F.col("path"), deployment=("app",))).collect()]
    assert found == ["private_dataset_or_annotation", "deployment_candidate", "requires_manual_classification", "code_or_public_documentation_candidate", "requires_manual_classification"]
    lines = spark.createDataFrame([("f", 1, "C:\\\\Users\\x"), ("f", 2, "C:\\Users\\x"), ("f", 3, "/home/x")], "source string, line int, text string")
    assert {(r.line, r.kind) for r in p.secret_findings(lines).collect()} == {(1, "absolute_local_path"), (3, "absolute_local_path")}
    assert os.sep == "/"
