import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import parsing as p
from tessera.operators import detections, greedy, recovery, reports, spatial, tiles, tracks
from tessera.policy import Policy


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_tile_grid_has_no_remainder_tile(spark):
    parents = spark.createDataFrame([("a", 2048, 1024), ("b", 1000, 2000)], "id string, width int, height int")
    assert rows(tiles.tile_grid(parents).select("id", "tile_x", "tile_y"), "tile_x") == [("a", 0, 0), ("a", 824, 0)]


def test_positions_and_components(spark):
    one = spark.range(1)
    assert one.select(tiles.stepped_positions(F.lit(0).cast("long"), F.lit(10).cast("long"), 4)).first()[0] == [0, 4, 8, 10]
    mask = sum(1 << (k - 1) for k in (1, 3, 7, 8))
    found = rows(tiles.grid_components(spark).filter(F.col("grid_mask") == mask).select("component"), "component")
    assert found == [("1",), ("3",), ("7,8",)]


def test_names(spark):
    names = spark.createDataFrame([("P1_row3_col4.png",), ("P1_824_0.png",), ("P1.png",), ("d/7_row3_col4.png",)], "n string")
    out = names.select(p.source_group_key(F.col("n")).alias("k"), p.row_col_origin(F.col("n")).alias("o")).collect()
    assert [r.k for r in out] == ["P1", "P1", "P1", "7"]
    assert tuple(out[3].o) == ("7", 3296, 2472) and out[1].o is None


def test_parse_cells(spark):
    cells = spark.createDataFrame([("-3.7",), ("x",), (None,), ("1e3",)], "c string")
    assert [r[0] for r in cells.select(p.parse_int(F.col("c"))).collect()] == [-3, 0, 0, 1000]
    assert spark.range(1).select(p.parse_int_list(F.lit("[1, 2, x]"))).first()[0] == [1, 2]
    got = spark.createDataFrame([(0.05,), (0.25,), (0.0,)], "c double").select(p.confidence_bucket(F.col("c"))).collect()
    assert [r[0] for r in got] == ["0.05-0.10", ">=0.25", "<0.01"]


def test_yolo_lines(spark):
    lines = ["0 .1 .1 .2 .1 .2 .2 .1 .2", "0 .1 .1", "0 a .1 .2 .1 .2 .2 .1 .2", "1 .1 .1 .2 .1 .2 .2 .1 .2", "0 nan .1 .2 .1 .2 .2 .1 .2", "0 1.5 .1 .2 .1 .2 .2 .1 .2", "0 .1 .1 .1 .1 .2 .2 .1 .2"]
    df = spark.createDataFrame([(x,) for x in lines], "t string").select(p.parse_yolo(F.col("t"), F.lit(100), F.lit(100))["errors"])
    found = [r[0] for r in df.collect()]
    assert found[:4] == [[], ["wrong_field_count"], ["non_numeric"], ["invalid_class_id"]]
    assert found[4] == ["non_finite", "normalized_out_of_bounds"]
    assert "normalized_out_of_bounds" in found[5] and "non_distinct_corners" in found[6]


def test_size_policy(spark):
    case = lambda d, t, a, s: spark.range(1).select(greedy.size_policy(F.lit(d), F.lit(t), F.lit(a), F.lit(s))).first()[0]
    assert case("xview", "low", 40.0, 4.9) == "threshold_area_and_short_side:xview_aggressive+low_aggressive"
    assert case("dota", "bad", 1.0, 1.0) is None
    assert case("dota", "small", 50.0, 4.0) == "threshold_short_side:aggressive"


def brute_nms(boxes, threshold):
    kept = []
    for b in sorted(boxes, key=lambda b: (-b[1], b[0])):
        def over(a):
            w, h = (max(0, min(a[k + 2], b[k + 2]) - max(a[k], b[k])) for k in (2, 3))
            return w * h / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - w * h)
        if all(over(a) <= threshold for a in kept):
            kept.append(b)
    return sorted(b[0] for b in kept)


def test_nms_against_brute_force(spark):
    rng = random.Random(3)
    boxes = []
    for k in range(300):
        x, y = rng.randint(0, 200), rng.randint(0, 200)
        boxes.append((k, rng.randint(0, 20) / 20, float(x), float(y), float(x + 40), float(y + 40)))
    df = spark.createDataFrame([("a", *b) for b in boxes], "g string, k long, conf double, x0 double, y0 double, x1 double, y1 double")
    found = greedy.nms(df, ["g"], "conf", ("x0", "y0", "x1", "y1"), "k", 0.3)
    assert sorted(r.k for r in found.collect()) == brute_nms(boxes, 0.3)
    again = greedy.nms(found, ["g"], "conf", ("x0", "y0", "x1", "y1"), "k", 0.3)
    assert again.count() == found.count()
    assert greedy.nms(df.limit(0), ["g"], "conf", ("x0", "y0", "x1", "y1"), "k").count() == 0


def test_serving_suppresses_and_restores(spark):
    n = 20
    tensor = [[0.0] * n for _ in range(6)]
    for at, row in {4: (300, 300, 100, 30, 0.95, 0.1), 8: (300, 300, 100, 30, 0.90, 0.1), 12: (500, 300, 100, 30, 0.80, 0.1), 16: (100, 100, 40, 40, 0.10, 0)}.items():
        for k, x in enumerate(row):
            tensor[k][at] = float(x)
    df = spark.createDataFrame([("i", tensor, 1280, 720)], "image string, tensor array<array<double>>, width int, height int")
    found = detections.serve(df, ["image"]).orderBy(F.desc("conf")).collect()
    assert [r.confidence for r in found] == [0.95, 0.8]
    assert all(0 <= q.x <= 1 and 0 <= q.y <= 1 for r in found for q in r.polygon)
    one = [[0.0], [0.0], [0.0], [0.0], [0.0]]
    with pytest.raises(Exception, match="six feature rows"):
        detections.serve(spark.createDataFrame([("i", one, 64, 64)], df.schema), ["image"]).collect()


def test_greedy_match_tries_only_the_best_free_partner(spark):
    pairs = spark.createDataFrame([("t", 1, 0.9, 0, 0.6), ("t", 2, 0.8, 0, 0.6), ("t", 2, 0.8, 1, 0.1)], "g string, pred long, conf double, gt long, iou double")
    assert rows(greedy.greedy_match(pairs, "g", 0.5), "pred") == [("t", 1, 0, 0.6)]


def test_dedup_labels_keeps_the_larger(spark):
    poly = lambda x, w: [(float(x), 0.0), (float(x + w), 0.0), (float(x + w), 10.0), (float(x), 10.0)]
    data = [("t", 1, poly(0, 20)), ("t", 2, poly(0, 21)), ("t", 3, poly(100, 20)), ("t", 4, [(0.0, 0.0)] * 4)]
    df = spark.createDataFrame(data, "tile_key string, line long, poly array<struct<x:double,y:double>>")
    assert rows(greedy.dedup_labels(df), "line") == [("t", 1, False, "duplicate_label"), ("t", 2, True, None), ("t", 3, True, None), ("t", 4, False, "invalid_polygon")]


def square(x, y):
    return [{"x": float(x + a), "y": float(y + b)} for a, b in ((0, 0), (10, 0), (10, 10), (0, 10))]


TRACK = "video string, frame long, det long, cls string, conf double, poly array<struct<x:double,y:double>>"


def test_tracks_fill_and_smooth(spark):
    seen = [("v", f, 0, "ship", 0.5, square(f, 0)) for f in (10, 13, 30)] + [("v", 10, 1, "ship", 0.9, square(500, 500))]
    out = tracks.assign_tracks(spark.createDataFrame(seen, TRACK))
    assert rows(out.select("frame", "det", "track_id"), "frame", "det") == [(10, 0, 1), (10, 1, 2), (13, 0, 1), (30, 0, 3)]
    line = [("v", f, 0, "ship", c, square(x, 0)) for f, c, x in ((10, 0.5, 0), (13, 0.4, 9))]
    filled = tracks.fill_gaps(spark.createDataFrame(line, TRACK), ["video"])
    assert rows(filled.select("frame", F.col("poly")[0]["x"], "conf", "interpolated"), "frame") == [(10, 0.0, 0.5, False), (11, 3.0, 0.4, True), (12, 6.0, 0.4, True), (13, 9.0, 0.4, False)]
    assert tracks.fill_gaps(spark.createDataFrame([line[0], ("v", 14, 0, "ship", 0.4, square(9, 0))], TRACK), ["video"]).count() == 2
    moving = spark.createDataFrame([("v", f, 0, "ship", 0.5, square(10 * f, 0)) for f in range(5)], TRACK)
    assert [r[1] for r in rows(tracks.smooth(moving, ["video"]).select("frame", F.col("poly")[0]["x"]), "frame")] == [10, 15, 20, 25, 30]
    assert tracks.smooth(moving, ["video"], Policy(track_window=1)) is moving


def test_reports(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)] + [("b", 7)], "k string, n long")
    assert rows(reports.inventory(df, ["k"], "n"), "k") == [("a", 4, 10, 1, 4, 3), ("b", 1, 7, 7, 7, 7)]
    files = spark.createDataFrame([("a/b/c/d/e.txt", 3), ("a/x", 2)], "path string, size long")
    assert dict((r[0], (r[1], r[2])) for r in reports.path_rollup(files, "path", "size").collect()) == {".": (2, 5), "a": (2, 5), "a/b": (1, 3), "a/b/c": (1, 3)}
    epochs = spark.createDataFrame([("r", 1, 0.8, 0.7, 1.0), ("r", 2, 0.89688, 0.70666, 2.0), ("r", 3, 0.5, 0.70666, 3.0)], "run string, epoch long, m50 double, m95 double, t double")
    assert rows(reports.best_epochs(epochs, "run", "epoch", "m50", "m95", "t"), "run") == [("r", 2, 0.725682, 3.0)]
    assert reports.setting_changes({"a": 1, "b": 2}, {"a": 1, "b": 3}) == {"b": (2, 3)}
    with pytest.raises(ValueError, match="b"):
        reports.require_frozen({"b": 2}, {"b": 3}, ["b"])


def test_metadata_checks_in_any_order(spark):
    """Records of one seq and place that differ in their parent's size only."""
    tile = [("t", 0, "g:0:0", "g", 0, 0, 1024, 1024), ("u", 0, "h:0:0", "h", 0, 0, 1024, 1024), ("u2", 0, "h:0:0", "h", 0, 0, 1024, 1024)]
    size = [("g", 512, 512, 3), ("g", 2048, 512, 1), ("g", 2048, 2048, 2), ("h", 2048, 2048, 4)]
    repeats = [("t", "duplicate_tile_record", "t")] * 2 + [("u2", "duplicate_tile_record", "u")]
    for turn in (1, -1):
        tiles_of = spark.createDataFrame(tile[::turn], "tile_key string, seq int, identity string, group_key string, tile_x int, tile_y int, tile_width int, tile_height int").coalesce(1)
        sizes = spark.createDataFrame(size[::turn], "group_key string, width int, height int, s int").coalesce(1)
        assert sorted(tuple(r) for r in reports.metadata_checks(tiles_of, sizes).collect()) == repeats
        last = reports.metadata_checks(tiles_of, sizes, order="s").collect()
        assert sorted(tuple(r) for r in last if r.previous) == repeats
        assert [tuple(r) for r in last if not r.previous] == [("t", "tile_bounds_outside_parent", None)]


def test_recovery_merges_small_clusters(spark):
    def candidate(seq, cx, kind):
        poly = [{"x": cx + a * 20.0, "y": 100.0 + b * 5} for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
        return ("P", seq, poly, 0.0, kind, 1000, 1000, poly, 1000, 1000, 0, 0)

    schema = "parent string, seq long, poly array<struct<x:double,y:double>>, angle double, source_kind string, parent_width int, parent_height int, local array<struct<x:double,y:double>>, tile_width int, tile_height int, tile_x int, tile_y int"
    df = spark.createDataFrame([candidate(1, 100.0, "cleaned"), candidate(2, 110.0, "cleaned"), candidate(3, 500.0, "raw")], schema)
    out = recovery.recover(df).orderBy("cluster").collect()
    assert [(r.cluster, r.cluster_size, r.source_kind) for r in out] == [(1, 2, "merged"), (3, 1, "raw")]
    assert sorted(round(q.x) for q in out[0].points) == [80, 80, 130, 130]


def test_rect_relations(spark):
    one = spark.range(1)
    rect = lambda *v: tuple(F.lit(float(x)) for x in v)
    assert one.select(g.rect_iou(rect(0, 0, 10, 10), rect(5, 0, 15, 10))).first()[0] == pytest.approx(1 / 3)
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(spatial.presence(left, right, ["k"]), "k") == [(1, True, False), (2, True, True), (3, False, True)]
    assert rows(spatial.left_miss(left, right, ["k"]), "k") == [(1,)]


def test_tracker_score_matches_columns(spark):
    a, b = square(0, 0), square(4, 3)
    as_col = lambda s: F.array(*[g.point(q["x"], q["y"]) for q in s])
    far = square(300, 0)
    want = spark.range(1).select(g.match_score(as_col(a), as_col(b)), g.match_score(as_col(a), as_col(far))).first()
    pairs = np.array([tracks._polygon(x) for x in (a, a)]), np.array([tracks._polygon(x) for x in (b, far)])
    assert tracks.scores(*pairs).tolist() == pytest.approx(list(want))


def brute_tracks(seen, gap, match, score):
    """Ids and polygons by going through frames and pairs one by one; `score` of two polygons."""
    tracks_of, out = {}, {}
    for frame in sorted({s[1] for s in seen}):
        now = sorted((s for s in seen if s[1] == frame), key=lambda s: s[2])
        pairs = sorted((-score(t[2], s[5]), k, n) for n, s in enumerate(now) for k, t in tracks_of.items() if frame - t[0] <= gap + 1 and t[1] == s[3] and score(t[2], s[5]) >= match)
        taken = {}
        for _, k, n in pairs:
            if n not in taken and k not in taken.values():
                taken[n] = k
        for n, s in enumerate(now):
            k, poly = taken.get(n), [(p["x"], p["y"]) for p in s[5]]
            if k is None:
                k = len(tracks_of) + 1
            else:
                last = [(p["x"], p["y"]) for p in tracks_of[k][2]]
                poly = min((poly[i:] + poly[:i] for i in range(4)), key=lambda q: sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(q, last, strict=True)))
            tracks_of[k] = (frame, s[3], [{"x": x, "y": y} for x, y in poly])
            out[frame, s[2]] = (k, poly)
    return out


@pytest.mark.parametrize("stretches", [1, 2, 256])
def test_tracks_align_corners_and_go_on_over_stretches(spark, stretches):
    rng = random.Random(stretches)
    seen = []
    for frame in [*range(6), *range(12, 16), 17, 30, 31]:
        for k in range(4):
            corners = square(40 * k + 3 * frame % 17 + rng.random(), 5 * k + rng.random())
            turn = rng.randrange(4)
            seen.append(("v", frame, k, "ab"[k % 2], 0.5, corners[turn:] + corners[:turn]))
    score = lambda a, b: float(tracks.scores(np.array([tracks._polygon(a)]), np.array([tracks._polygon(b)]))[0])
    want = brute_tracks(seen, Policy().track_gap, Policy().track_match, score)
    found = tracks.assign_tracks(spark.createDataFrame(seen, TRACK), stretches=stretches).collect()
    assert {(r.frame, r.det): (r.track_id, [(p.x, p.y) for p in r.poly]) for r in found} == want and max(k for k, _ in want.values()) > 8
    lengths = Counter(k for k, _ in want.values())
    assert rows(tracks.track_lengths(spark.createDataFrame(found), ["video"]), "video") == [("v", len(lengths), min(lengths.values()), pytest.approx(sum(lengths.values()) / len(lengths), abs=1e-4), max(lengths.values()))]
    # corners in one order: what is between two polygons isn't twisted
    between = tracks.fill_gaps(spark.createDataFrame(found), ["video", "track_id"]).filter("interpolated").select(g.area(F.col("poly")).alias("a")).collect()
    assert between and all(r.a > 90 for r in between)
    final = tracks.final_by_frame(spark.createDataFrame(found)).collect()
    for frame in {r.frame for r in final}:
        mine = sorted((r for r in final if r.frame == frame), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, len(mine) + 1)) and [r.track_id for r in mine] == sorted(r.track_id for r in mine)


def test_tracks_stream_through_batches():
    """A long video's tracks come out before its last batch goes in, and are those of the video in one piece."""
    rng, kind = random.Random(11), pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    corners = lambda x: [{"x": float(x + i), "y": float(j)} for i, j in ((0, 0), (30, 0), (30, 30), (0, 30))]
    seen = [(v, 0, f, 10 * f + d, "ship", 0.5, corners(100 * d + rng.randint(0, 9))) for v in "ab" for f in range(12) for d in range(3)]
    polys = [r[6] for r in seen]
    table = pa.table({n: pa.array([r[k] for r in seen]) for k, n in enumerate(("video", "stretch", "frame", "det", "cls", "conf"))} | {"poly": pa.array(polys, kind)})
    went = []
    feed = lambda size: (went.append(b.num_rows) or b for b in table.to_batches(size))
    pieces = tracks.track_batches(feed(5))
    first = next(pieces)
    assert len(went) == 1 and first.num_rows == 3  # the frame that the batch may cut waits
    small = pa.Table.from_batches([first, *pieces])
    assert small.to_pylist() == pa.Table.from_batches(list(tracks.track_batches(feed(1000)))).to_pylist()
    assert small.column("track_id").to_pylist() == [1, 2, 3] * 24 and len(small) == len(seen)
