"""Order-dependent and geometric operators that have no SQL, against brute force over small random tables."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import kernels
from tessera.operators import audit, greedy, recovery, repair, spatial
from tessera.operators.spatial import with_bounds
from tessera.policy import DEFAULT, EXCLUDED_PARENTS

RING = "array<struct<x:double,y:double>>"


def ring(cx, cy, w, h, degrees):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(cx + i * w / 2 * c - j * h / 2 * s, cy + i * w / 2 * s + j * h / 2 * c) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))]


def area(p):
    return abs(sum(a * d - c * b for (a, b), (c, d) in zip(p, p[1:] + p[:1], strict=True))) / 2 if len(p) > 2 else 0.0


def clip(p, q):
    turn = math.copysign(1, sum(a * d - c * b for (a, b), (c, d) in zip(q, q[1:] + q[:1], strict=True)))
    for (ax, ay), (bx, by) in zip(q, q[1:] + q[:1], strict=True):
        f = [turn * ((bx - ax) * (y - ay) - (by - ay) * (x - ax)) for x, y in p]
        out = []
        for k, v in enumerate(p):
            n = (k + 1) % len(p)
            if f[k] >= 0:
                out.append(v)
            if (f[k] >= 0) != (f[n] >= 0):
                out.append(tuple(a + (b - a) * f[k] / (f[k] - f[n]) for a, b in zip(v, p[n], strict=True)))
        p = out
        if not p:
            return []
    return p


def iou(p, q):
    both = area(clip(p, q))
    return both / (area(p) + area(q) - both)


def points(p):
    return [{"x": x, "y": y} for x, y in p]


def projected(p, x, y, size=1024):
    """What a tile holds of a polygon, by the kernel that the test of kernels compares with columns."""
    one = lambda v: pa.array([float(v)])
    out = kernels._project(pa.array([points(p)], kernels_type()), one(x), one(y), one(size), one(size))[0].as_py()
    return out and ([(q["x"], q["y"]) for q in out["points"]], out["overlap"], out["retained"])


def kernels_type():
    return pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def test_kernels_and_closed_forms_equal_the_column_forms(spark):
    rng = random.Random(1)
    data = []
    for k in range(400):
        at = (rng.choice([0, 1024, 500, rng.uniform(-40, 1100)]), rng.choice([0, 1024, rng.uniform(-40, 1100)]))
        w = rng.choice([4.0, 40.0, rng.uniform(5, 1500)])
        data.append((k, points(ring(*at, w, rng.uniform(2, w), rng.choice([0, 45, 90, 180, rng.uniform(0, 360)]))), points(ring(at[0] + rng.uniform(-9, 9), at[1], w, w / 2, rng.uniform(0, 360)))))
    data += [(401, None, data[0][2]), (402, [], data[0][2]), (403, data[0][1][:3], data[0][2]), (404, data[0][1], data[0][1]), (405, data[0][1], None)]
    df = spark.createDataFrame(data, f"k int, p {RING}, q {RING}").withColumns({"tx": F.lit(0), "ty": F.lit(0), "n": F.lit(1024)})
    df = g.once(df, "box", g.rotated_box(F.col("p")))
    df = g.once(df, "cut", g.truncate_box(F.col("box"), F.col("n"), F.col("n")))
    found = df.select(
        "k", "p", "cut", "box", g.project_to_tile(F.col("p"), F.col("tx"), F.col("ty"), F.col("n"), F.col("n")).alias("j"), g.overlaps(F.col("p"), F.col("q")).alias("o"), g.area(g.clip_convex(F.col("p"), F.col("q"))).alias("inter"),
        g.overlap_ratio(F.col("p"), 0, 0, 1024, 1024).alias("share"), g.area(F.col("p")).alias("a"), g.area(g.clip_rect(F.col("p"), 0, 0, 1024, 1024)).alias("inside"), g.centroid(F.col("p")).alias("c"), g.vertex_mean(F.col("p")).alias("m"),
    ).collect()
    fits = 0
    for r in found:
        assert r.o.inter == pytest.approx(r.inter or 0, abs=1e-9) and r.o.a == pytest.approx(r.a or 0)
        if r.p:
            assert r.share == pytest.approx(r.inside / r.a if r.a else 0, abs=1e-9) and len(r.p) < 4 or (r.c.x, r.c.y) == pytest.approx((r.m.x, r.m.y), abs=1e-6)
        if r.cut is None or not r.inside:
            assert r.j is None
        else:
            fits += 1
            assert [(v.x, v.y) for v in r.j.points] == [(pytest.approx(v.x, abs=1e-9), pytest.approx(v.y, abs=1e-9)) for v in r.cut] and r.j.overlap == pytest.approx(r.share, abs=1e-9)
            assert r.j.retained == pytest.approx(area([(v.x, v.y) for v in r.cut]) / ((r.box.x1 - r.box.x0) * (r.box.y1 - r.box.y0)))
    assert fits > 200


def test_rotated_suppression(spark):
    rng = random.Random(2)
    data = [(f"g{k % 3}", k, rng.choice([0.1, 0.3, 0.5, rng.random()]), points(ring(rng.uniform(0, 120), rng.uniform(0, 60), 40, 20, rng.uniform(0, 180)))) for k in range(150)] + [(None, 200, 0.9, points(ring(0, 0, 9, 9, 0))), (None, 201, 0.8, points(ring(0, 0, 9, 9, 90)))]
    found = {r.k for r in greedy.rotated_nms(spark.createDataFrame(data, f"g string, k long, conf double, poly {RING}"), ["g"], "conf", "poly", "k").collect()}
    want = set()
    for group in {d[0] for d in data}:
        kept = []
        for _, k, _, poly in sorted((d for d in data if d[0] == group and d[2] >= DEFAULT.confidence), key=lambda d: (-d[2], d[1])):
            mine = [(v["x"], v["y"]) for v in poly]
            if all(iou(mine, other) <= DEFAULT.nms_iou for other in kept):
                kept.append(mine)
                want.add(k)
    assert found == want and 5 < len(want) < len(data) - 20


def test_label_deduplication(spark):
    rng = random.Random(3)
    labels = []
    for k in range(90):
        at, size = (rng.choice([0, 100, 200]), rng.choice([0, 100])), rng.choice([40, 41, 42])
        labels.append((f"t{k % 2}", k, ring(*at, size + rng.random(), 20 + rng.random(), rng.choice([0, 1]))))
    found = {(r.tile_key, r.line): r.kept for r in greedy.dedup_labels(spark.createDataFrame([(t, k, points(p)) for t, k, p in labels], f"tile_key string, line long, poly {RING}")).collect()}
    for tile in ("t0", "t1"):
        kept = []
        for _, line, poly in (x for x in labels if x[0] == tile):
            hit = next((n for n, (_, other) in enumerate(kept) if iou(poly, other) >= DEFAULT.duplicate_iou), None)
            if hit is None:
                kept.append((line, poly))
            elif area(poly) > area(kept[hit][1]):
                kept[hit] = (line, poly)
        assert {k for (t, k), ok in found.items() if t == tile and ok} == {k for k, _ in kept}
    assert not all(found.values())


def extents(p, degrees):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    us, vs = [x * c + y * s for x, y in p], [y * c - x * s for x, y in p]
    return {"u": (min(us), max(us)), "v": (min(vs), max(vs))}


def may_be_one(a, b):
    """Whether candidate b may show the object that a shows, seen along a's angle."""
    turn = abs(a["angle"] % 180 - b["angle"] % 180)
    if min(turn, 180 - turn) > DEFAULT.cluster_angle:
        return False
    x, y = extents(a["poly"], a["angle"]), extents(b["poly"], a["angle"])
    inter = {k: max(min(x[k][1], y[k][1]) - max(x[k][0], y[k][0]), 0) for k in "uv"}
    gap = {k: max(max(x[k][0], y[k][0]) - min(x[k][1], y[k][1]), 0) for k in "uv"}
    hull = {k: max(x[k][1], y[k][1]) - min(x[k][0], y[k][0]) for k in "uv"}
    near = all(gap[k] <= max(DEFAULT.gap_floor, DEFAULT.gap_ratio * max(x[k][1] - x[k][0], y[k][1] - y[k][0])) for k in "uv")
    return inter["u"] * inter["v"] / (hull["u"] * hull["v"]) >= DEFAULT.hull_iou or (a["edge"] or b["edge"]) and near or inter["u"] > 0 and inter["v"] > 0


def test_candidate_clusters(spark):
    rng = random.Random(4)
    items = []
    for k in range(120):
        angle = rng.choice([0.0, 5.0, 60.0, 178.0])
        items.append({"parent": f"p{k % 2}", "seq": k, "angle": angle, "edge": rng.random() < 0.3, "poly": ring(rng.uniform(0, 400), rng.uniform(0, 200), 40, 12, angle)})
    df = spark.createDataFrame([(x["parent"], x["seq"], points(x["poly"]), x["angle"], x["edge"]) for x in items], f"parent string, seq long, poly {RING}, angle double, edge_touch boolean")
    links = recovery.cluster_links(df)
    want = {(a["parent"], a["seq"], b["seq"]) for a in items for b in items if a["parent"] == b["parent"] and a["seq"] < b["seq"] and may_be_one(a, b)}
    assert {(r.parent, r.a, r.b) for r in links.collect()} == want and len(want) > 20
    root = {x["seq"]: x["seq"] for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for _, a, b in want:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {r.seq: r.cluster for r in recovery.clusters(df, links).collect()} == {k: find(k) for k in root}


def cases(rng, n):
    for k in range(n):
        box = ring(rng.choice([1024, 500, rng.uniform(0, 1000)]) + rng.uniform(-15, 15), rng.uniform(0, 900), rng.choice([60, 30, 6]), rng.choice([12, 4]), rng.choice([0, 30]))
        yield {"instance_id": f"i{k % (n - 5)}", "seq": k, "tile_key": f"t{k % 3}", "parent_id": EXCLUDED_PARENTS[0] if k % 17 == 0 else f"P{k}", "dataset": rng.choice(["xview", "dota"]), "qa_tag": rng.choice(["small", "low", "unflagged"]), "poly": None if k % 19 == 0 else box, "best": rng.choice([None, 0.92, 0.97]), "visible": round(rng.random(), 3)}


def too_small(case, poly):
    rules = [(w, *v) for w, v in ((case["dataset"] == "xview", (36, 5, "xview_aggressive")), (case["qa_tag"] == "small", (36, 5, "aggressive")), (case["qa_tag"] == "low", (64, 6, "low_aggressive"))) if w]
    if not rules:
        return None
    side = min(math.dist(a, b) for a, b in zip(poly, poly[1:] + poly[:1], strict=True))
    failed = ["area"] * (area(poly) < max(r[1] for r in rules)) + ["short_side"] * (side < max(r[2] for r in rules))
    return f"threshold_{'_and_'.join(failed)}:{'+'.join(r[3] for r in rules)}" if failed else None


def test_projection_decisions_in_order(spark):
    rng = random.Random(5)
    made = list(cases(rng, 140))
    labels = {f"t{k}": [] for k in range(3)}
    for c in made:
        if c["poly"] and rng.random() < 0.1 and (p := projected(c["poly"], 0, 0)):
            labels[c["tile_key"]].append(p[0])
    for c in made[60:75]:  # the same box again, later
        made.append({**c, "seq": c["seq"] + 1000, "instance_id": c["instance_id"] + "b"})
    df = spark.createDataFrame([(c["instance_id"], c["seq"], c["tile_key"], c["parent_id"], c["dataset"], c["qa_tag"], c["poly"] and points(c["poly"]), 0, 0, 1024, 1024, c["best"], "wanted") for c in made], f"instance_id string, seq long, tile_key string, parent_id string, dataset string, qa_tag string, poly {RING}, tile_x int, tile_y int, tile_width int, tile_height int, best_matched double, reason string")
    held = spark.createDataFrame([(t, points(p)) for t, ps in labels.items() for p in ps], f"tile_key string, poly {RING}")
    found = {r.seq: (r.action, r.reason) for r in repair.projection_decisions(df, held).collect()}
    want, there = {}, {t: list(ps) for t, ps in labels.items()}
    for c in sorted(made, key=lambda c: c["seq"]):
        p = c["poly"] and projected(c["poly"], 0, 0)
        if c["poly"] is None:
            reason = "parent_obb_not_found"
        elif c["parent_id"] in EXCLUDED_PARENTS:
            reason = "intentionally_excluded_parent"
        elif not p or p[1] < 0.5 or p[2] < DEFAULT.min_retained:
            reason = "below_projection_policy"
        elif p[2] < DEFAULT.containment and (c["best"] or 0) >= DEFAULT.containment:
            reason = "clean_representation_already_exists"
        else:
            reason = too_small(c, p[0]) or ("already_represented_geometrically" if any(iou(p[0], x) >= DEFAULT.duplicate_iou for x in there[c["tile_key"]]) else None)
        want[c["seq"]] = ("skipped", reason) if reason else ("added_projection", "wanted")
        if not reason:
            there[c["tile_key"]].append(p[0])
    assert found == want
    kinds = Counter(r.split(":")[0] for _, r in want.values())
    assert len(kinds) >= 7, kinds
    counts = repair.decision_counters(repair.projection_decisions(df, held)).first()
    assert counts.projection_additions == kinds["wanted"] and counts.represented == kinds["already_represented_geometrically"] and counts.projection_skips == len(made) - kinds["wanted"]


def test_residual_decisions(spark):
    rng = random.Random(6)
    made = list(cases(rng, 120))
    for k, c in enumerate(made):
        c["poly"], c["instance_id"] = c["poly"] or ring(50, 50, 60, 12, 0), f"i{k // 2}"
    labels = [(c["tile_key"], projected(c["poly"], 0, 0)[0]) for c in made[::9] if projected(c["poly"], 0, 0)]
    df = spark.createDataFrame([(c["instance_id"], c["tile_key"], c["dataset"], c["qa_tag"], points(c["poly"]), 0, 0, 1024, 1024, c["best"], c["visible"]) for c in made], f"instance_id string, tile_key string, dataset string, qa_tag string, poly {RING}, tile_x int, tile_y int, tile_width int, tile_height int, best_existing double, visible double")
    held = spark.createDataFrame([(t, points(p)) for t, p in labels], f"tile_key string, poly {RING}")
    found = Counter((r.instance_id, r.tile_key, r.decision, r.reason, r.chosen) for r in repair.residual_decisions(df, held).collect())
    judged = []
    for c in made:
        p = projected(c["poly"], 0, 0)
        if (c["best"] or 0) >= DEFAULT.best_existing:
            d = ("intentional_edge_fragment_suppression", "better_matching_label_at_or_above_0.90")
        elif not p:
            d = ("repair_add_or_adjust_recovery_tile", "projection_invalid")
        elif small := too_small(c, p[0]):
            d = ("valid_intentional_filter", small)
        elif any(t == c["tile_key"] and iou(p[0], x) >= DEFAULT.duplicate_iou for t, x in labels):
            d = ("audit_false_positive", "relaxed_tile_local_overlap_match")
        else:
            d = ("repair_add_projected_label", "best_available_valid_projection")
        judged.append((c, *d))
    best = {}
    for c, d, _ in judged:
        if d == "repair_add_projected_label":
            best[c["instance_id"]] = max(best.get(c["instance_id"], (-1, "")), (c["visible"], c["tile_key"]))
    want = Counter((c["instance_id"], c["tile_key"], d, r, d == "repair_add_projected_label" and best[c["instance_id"]] == (c["visible"], c["tile_key"])) for c, d, r in judged)
    assert found == want and len({d for _, d, _ in judged}) >= 4


def test_recovered_annotations(spark):
    """Each cluster gives its merged rectangle or its best candidate."""
    rng = random.Random(7)
    items = []
    for k in range(80):
        angle = rng.choice([0.0, 4.0, 70.0])
        items.append({"parent": f"p{k % 2}", "seq": k, "angle": angle, "poly": ring(rng.uniform(30, 900), rng.uniform(30, 300), 40, 12, angle), "kind": rng.choice(["cleaned", "second_pass", "raw"])})
    for x in items:
        x["margin"] = min(max(0.0, min(a, b, 999 - a, 399 - b)) for a, b in x["poly"])
        x["edge"] = x["margin"] <= DEFAULT.edge_touch
        x["score"] = {"cleaned": 1000, "second_pass": 2000, "raw": 100}[x["kind"]] + min(x["margin"], 100) + (0 if x["edge"] else 10)
    schema = f"parent string, seq long, poly {RING}, angle double, source_kind string, parent_width int, parent_height int, local {RING}, tile_width int, tile_height int, tile_x int, tile_y int"
    df = spark.createDataFrame([(x["parent"], x["seq"], points(x["poly"]), x["angle"], x["kind"], 1000, 400, points(x["poly"]), 1000, 400, 0, 0) for x in items], schema)
    root = {x["seq"]: x["seq"] for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in items:
        for b in items:
            if a["parent"] == b["parent"] and a["seq"] < b["seq"] and may_be_one(a, b):
                x, y = find(a["seq"]), find(b["seq"])
                root[max(x, y)] = min(x, y)
    groups = {}
    for x in items:
        groups.setdefault((x["parent"], find(x["seq"])), []).append(x)
    found = {(r.parent, r.cluster): r for r in recovery.recover(df).collect()}
    assert set(found) == set(groups)
    merged = 0
    for key, members in groups.items():
        ranked = sorted(members, key=lambda x: (-x["score"], x["seq"]))
        best, r = ranked[0], found[key]
        assert r.cluster_size == len(members) and r.score == pytest.approx(best["score"])
        turns = [min(t, 180 - t) for m in members for t in [abs(m["angle"] % 180 - best["angle"] % 180)]]
        if 2 <= len(members) <= 3 and max(turns) <= DEFAULT.cluster_angle:
            ends = [extents(m["poly"], best["angle"]) for m in members]
            u0, u1, v0, v1 = min(e["u"][0] for e in ends), max(e["u"][1] for e in ends), min(e["v"][0] for e in ends), max(e["v"][1] for e in ends)
            c, s = math.cos(math.radians(best["angle"])), math.sin(math.radians(best["angle"]))
            hull = [(u * c - v * s, u * s + v * c) for u, v in ((u0, v0), (u1, v0), (u1, v1), (u0, v1))]
            assert r.source_kind == "merged" and not r.ambiguous and iou([(p.x, p.y) for p in r.points], hull) > 0.99
            merged += 1
        else:
            assert r.source_kind == best["kind"] and [v for p in r.points for v in p] == pytest.approx([v for p in best["poly"] for v in p])
            assert r.ambiguous == (len(members) > 1 and best["score"] - ranked[1]["score"] < DEFAULT.winner_gap)
    assert merged >= 3
    assert with_bounds(df).count() == len(items)


def test_cluster_links_meet_in_cells(spark):
    """Far apart candidates share no key of the join; links over cells' borders are those of all pairs, of six corners too."""
    rng, items = random.Random(9), []
    for k in range(150):
        angle = rng.choice([0.0, 4.0, 90.0])
        poly = ring(rng.choice([-256, 0, 256, 512]) + rng.uniform(-30, 30), rng.choice([0, 256]) + rng.uniform(-30, 30), rng.choice([20, 100]), 12, angle)
        items.append(("p", k, points(poly[:1] + [tuple((a + b) / 2 for a, b in zip(*poly[:2], strict=True))] + poly[1:] if k % 7 == 0 else poly), angle, k % 3 == 0))
    df = spark.createDataFrame(items, f"parent string, seq long, poly {RING}, angle double, edge_touch boolean")
    links = recovery.cluster_links(df)
    a, b = df, df.select(*[F.col(c).alias(f"r_{c}") for c in df.columns])
    side = lambda p: {k: F.col(f"{p}{k}") for k in ("poly", "angle", "edge_touch")}
    want = a.join(b, F.col("seq") < F.col("r_seq")).filter(recovery.compatible(side(""), side("r_"))).select("seq", "r_seq").collect()
    assert sorted((r.a, r.b) for r in links.collect()) == sorted(map(tuple, want)) and len(want) > 50
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "(at_x#" in plan and "= r_at_x#" in plan


TILE = "s long, group_key string, tile_key string, tile_source string, tile_x int, tile_y int, tile_width int, tile_height int"


def test_roi_risk_of_parents_that_share_a_group(spark):
    """One region for both parents: a box is judged once, by the cells of both, and their tiles' shares add up."""
    parents = spark.createDataFrame([("g", "P1", "dota", 1200, 1200, 1 << 6), ("g", "P1", "dota", 1200, 1200, 1 << 8)], "group_key string, parent_id string, dataset string, width int, height int, grid_mask int")
    boxes = [("left", 200), ("edge", 405), ("middle", 600), ("right", 1000)]
    obbs = spark.createDataFrame([(k, "g", ring(x, 200, 20, 10, 0)) for k, x in boxes], f"instance_id string, group_key string, poly {RING}")
    state = spark.createDataFrame([(k, "uncovered_by_any_tile" if k != "edge" else "covered_by_roi_tile") for k, _ in boxes], "instance_id string, status string")
    tiles = spark.createDataFrame([(1, "g", "t", "smart_grid", 0, 0, 1024, 1024), (2, "g", "t", "annotation_recovery", 0, 0, 1024, 1024), (1, "g", "u", "smart_grid", 400, 400, 1024, 1024), (2, "g", "u", "smart_grid", 400, 400, 1024, 1024)], TILE)
    found = audit.roi_risk(obbs, tiles, state, parents, []).collect()
    assert sorted((r.issue_type, r.instance_id, r.tile_key) for r in found) == [("possible_roi_grid_exclusion", "middle", None), ("roi_boundary_object", "edge", None), ("tile_below_roi_threshold", None, "u")]


def reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def stored(spark, rows, kind, path):
    spark.createDataFrame(rows, kind).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_label_deduplication_reads_labels_once(spark, tmp_path):
    found = greedy.dedup_labels(stored(spark, [("t", k, ring(x, 50, 20, 10, 0)) for k, x in ((1, 50), (2, 51), (3, 90))], f"tile_key string, line long, poly {RING}", tmp_path / "l"))
    assert reads(found) == 1
    assert sorted((r.line, r.kept, r.reason) for r in found.collect()) == [(1, True, None), (2, False, "duplicate_label"), (3, True, None)]


CASE = f"instance_id string, seq long, tile_key string, parent_id string, dataset string, qa_tag string, poly {RING}, tile_x int, tile_y int, tile_width int, tile_height int, visible double, best_matched double, best_existing double, reason string"


@pytest.mark.parametrize("kind", ["projection", "residual"])
def test_decisions_read_cases_and_labels_once(spark, tmp_path, kind):
    case = lambda k, tile, x: (f"i{k}", k, tile, "P1", "dota", "bad", ring(x, 100, 40, 20, 0), 0, 0, 1024, 1024, 1.0, None, None, "why")
    cases = stored(spark, [case(1, "t", 100), case(2, "t", 101), case(3, "t", 300), case(4, "u", 300)], CASE, tmp_path / "c")
    labels = stored(spark, [("t", ring(300, 100, 40, 20, 0)), ("w", ring(300, 100, 40, 20, 0))], f"tile_key string, poly {RING}", tmp_path / "l")
    if kind == "projection":
        found = repair.projection_decisions(cases, labels)
        want = [(1, "added_projection"), (2, "skipped"), (3, "skipped"), (4, "added_projection")]
        assert sorted((r.seq, r.action) for r in found.collect()) == want
    else:
        found = repair.residual_decisions(cases.drop("reason"), labels)
        want = [(1, "repair_add_projected_label"), (2, "repair_add_projected_label"), (3, "audit_false_positive"), (4, "repair_add_projected_label")]
        assert sorted((r.seq, r.decision) for r in found.collect()) == want
    assert reads(found) == 2


def test_alike_pairs_against_all_pairs():
    rng = random.Random(3)
    a, b = ([ring(rng.uniform(0, 80), rng.uniform(0, 80), rng.choice([0, 20, 90]), 10, rng.uniform(0, 90)) if rng.random() > 0.1 else [] for _ in range(n)] for n in (60, 70))
    both = [kernels.Polygons.of(pa.array([[{"x": x, "y": y} for x, y in p] for p in v], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))) for v in (a, b)]
    want = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if p and q and area(p) > 0 and area(q) > 0 and (inter := area(clip(p, q))) / (area(p) + area(q) - inter) >= 0.2}
    assert set(zip(*(k.tolist() for k in kernels.alike(*both, 0.2)), strict=True)) == want and len(want) > 20


def test_pairs_that_cannot_fit_are_not_clipped(spark):
    """Envelopes that meet aren't enough: a label with a far centre or another area leaves before the costly step."""
    box = with_bounds(spark.createDataFrame([("a", "t", ring(100, 100, 60, 20, 0))], f"instance_id string, tile_key string, poly {RING}"))
    labels = spark.createDataFrame([("t", 1, ring(102, 100, 60, 20, 0)), ("t", 2, ring(140, 100, 60, 20, 0)), ("t", 3, ring(100, 100, 8, 8, 0))], f"tile_key string, line int, poly {RING}")
    assert [(r.l_line, r.fits, round(r.iou, 3)) for r in spatial.fit_pairs(box, labels, "inner").collect()] == [(1, True, 0.935)]


def test_labels_meet_across_cells_of_a_tile(spark):
    """Centres on both sides of a cell's border and near the very reach; a label that touches several cells counts once."""
    rng, boxes, labels = random.Random(5), [], []
    for k in range(60):
        x, y = rng.choice((120, 124, 128, 132, 256)) + rng.uniform(-1, 1), rng.choice((120, 124, 128, 384)) + rng.uniform(-1, 1)
        boxes.append((f"b{k}", "t", points(ring(x, y, 30, 20, 0))))
        labels.append(("t", k, points(ring(x + rng.choice((-7.99, -5, 0, 7.99, 8.01)), y + rng.choice((0, 0, 3)), 30, 20, 0))))
    mine = spark.createDataFrame(boxes, f"instance_id string, tile_key string, poly {RING}")
    theirs = spark.createDataFrame(labels, f"tile_key string, line long, poly {RING}")
    got = Counter((r.instance_id, r.l_line, r.fits) for r in spatial.fit_pairs(mine, theirs, "inner").collect())
    want = Counter()
    for name, _, p in boxes:
        for _, line, q in labels:
            p_, q_ = ([(v["x"], v["y"]) for v in z] for z in (p, q))
            if math.dist(*[[sum(v[a] for v in z) / 4 for a in (0, 1)] for z in (p_, q_)]) <= 8:
                share = area(clip(p_, q_)) / 600
                want[name, line, share / (2 - share) >= 0.5 or share >= 0.75] += 1
    assert got == want and len(want) > 300


def test_shares_kernel_is_the_closed_form_and_skips_nulls(spark):
    rng = random.Random(6)
    polys = [points(ring(rng.uniform(-20, 120), rng.uniform(-20, 120), rng.uniform(1, 60), rng.uniform(1, 40), rng.choice((0, 30, 90, 137)))) for _ in range(80)]
    polys += [None, [], points([(0.0, 0.0), (1.0, 1.0)]), points([(90.0, 90.0), (120.0, 90.0), (90.0, 120.0)]), points([(5.0, 5.0)] * 4)]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(polys)], f"k int, p {RING}")
    rect = [F.lit(v) for v in (0, 0, 100, 100)]
    rows = g.with_overlap(df, "share", "p", *rect).withColumn("column", g.overlap_ratio(F.col("p"), *rect)).withColumn("j", g.project_to_tile(F.when(F.col("k") % 2 == 0, F.col("p")), *rect)).collect()
    assert len(rows) == len(polys) and all(r.share == pytest.approx(r.column or 0.0, abs=1e-9) for r in rows)
    every = {r.k: r.j for r in df.withColumn("j", g.project_to_tile(F.col("p"), *rect)).collect()}
    assert all(r.j == (every[r.k] if r.k % 2 == 0 else None) for r in rows)
    same = df.filter("k < 80").select(g.overlaps(F.col("p"), F.col("p")).alias("o")).collect()
    assert all(r.o.inter == r.o.a == r.o.b for r in same)


def test_clusters_in_one_pass_are_those_of_links(spark):
    """Rows move once; null keys, shapes, angles and edges link nothing, seqs that recur share a cluster."""
    rng, items = random.Random(11), []
    for k in range(160):
        angle = rng.choice([0.0, 4.0, 90.0, 178.0, None])
        poly = ring(rng.uniform(0, 700), rng.uniform(0, 300), rng.choice([20, 100]), 12, angle or 0.0)
        poly = poly[:1] + [tuple((a + b) / 2 for a, b in zip(*poly[:2], strict=True))] + poly[1:] if k % 7 == 0 else poly
        items.append((None if k % 31 == 0 else f"p{k % 2}", None if k % 29 == 0 else k - k % 40 // 39, None if k % 23 == 0 else points(poly), angle, None if k % 5 == 0 else k % 3 == 0))
    df = spark.createDataFrame(items, f"parent string, seq long, poly {RING}, angle double, edge_touch boolean")
    key = lambda r: (r.parent or "", -1 if r.seq is None else r.seq, -1 if r.cluster is None else r.cluster)
    want, done = recovery.clusters(df, recovery.cluster_links(df)), recovery.with_clusters(df)
    assert sorted(map(key, done.collect())) == sorted(map(key, want.collect())) and done.columns == [*df.columns, "cluster"]
    assert len({key(r)[2] for r in want.collect()}) < 120
    assert recovery.with_clusters(df)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
