"""Registered queries over small tables, against brute force over all their rows."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tessera.operators import recovery, spatial
from tessera.plans import audit_queries, operation_queries, repair_queries, report_queries, views


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Boxes of parts 1 to 239, most of them in no subset that a modulus of a part leaves."""
    rng, path = random.Random(4), tmp_path_factory.mktemp("plans")
    lines = [(k // 3 + 1, rng.randrange(1, 240), rng.choice([0, 1, 2]), k % 3 + 1, float(rng.randint(20, 50)), 1000.0 + k, "ANR"[k % 3]) for k in range(300)]
    lines += [(200 + k, 5 + k, 1, 1, 30.0, 2000.0, "A") for k in range(4)] + [(300, 7, 2, 1, 30.0, 3000.0 + k, "N") for k in range(2)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    spark.createDataFrame(lines, schema).write.parquet(str(path / "lineitem.parquet"))
    spark.createDataFrame([(k, f"S{k}", k) for k in range(3)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(str(path / "supplier.parquet"))
    return str(path)


def area(p):
    return abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(p, p[1:] + p[:1], strict=True))) / 2


def clip(p, q):
    """The part of one convex polygon inside another."""
    turn = sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(q, q[1:] + q[:1], strict=True))
    for (ax, ay), (bx, by) in zip(q, q[1:] + q[:1], strict=True):
        side = lambda v: math.copysign(1, turn) * ((bx - ax) * (v[1] - ay) - (by - ay) * (v[0] - ax))  # noqa: B023, E731
        out = []
        for a, b in zip(p, p[1:] + p[:1], strict=True):
            s, t = side(a), side(b)
            if s >= 0:
                out.append(a)
            if s * t < 0:
                out.append(tuple(x + (y - x) * s / (s - t) for x, y in zip(a, b, strict=True)))
        p = out
        if not p:
            return 0.0
    return area(p)


def boxes(df, *keys):
    """Rows as (keys, polygon, envelope)."""
    out = []
    for r in df.select(*keys, "poly").collect():
        poly = [(v.x, v.y) for v in r.poly]
        xs, ys = zip(*poly, strict=True)
        out.append((tuple(r[k] for k in keys), poly, (min(xs), min(ys), max(xs), max(ys))))
    return out


def meet(a, b):
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


def near(found, want):
    assert set(found) == set(want)
    for k, value in want.items():
        assert found[k] == pytest.approx(value, abs=2e-4), k


def test_pairs_of_all_boxes(spark, folder):
    want = {}
    for a, b in combinations(sorted(boxes(views.boxes(spark, folder), "instance_id", "group_key")), 2):
        if a[0][1] == b[0][1] and meet(a[2], b[2]):
            both = clip(a[1], b[1])
            want[a[0][0], b[0][0]] = (both / (area(a[1]) + area(b[1]) - both), both / min(area(a[1]), area(b[1])))
    assert len(want) > 20
    near({(r.first, r.second): r.iou for r in audit_queries.quad_iou_pairs(spark, folder).collect()}, {k: v[0] for k, v in want.items()})
    near({(r.first, r.second): r.ios for r in audit_queries.ios_centroid(spark, folder).collect()}, {k: v[1] for k, v in want.items()})


def test_findings_on_all_labels(spark, folder):
    labels = boxes(views.labels(spark, folder), "tile_key", "line")
    assert [r[:2] for r in rows(audit_queries.label_flags(spark, folder))] == sorted((k for k, _, _ in labels), key=repr)
    sizes, want = {}, {}
    for (tile, _), _, _ in labels:
        sizes[tile] = sizes.get(tile, 0) + 1
    assert any(10 <= n <= 80 for n in sizes.values()) and any(n > 80 for n in sizes.values())
    middle = lambda p: [sum(x) / len(p) for x in zip(*p, strict=True)]
    for a, b in combinations(sorted(labels, key=lambda x: x[0][1]), 2):
        tile = a[0][0]
        apart = math.dist(middle(a[1]), middle(b[1]))
        if tile == b[0][0] and a[0][1] < b[0][1] and sizes[tile] <= 80 and (meet(a[2], b[2]) or apart <= 8):
            both = clip(a[1], b[1])
            iou = both / (area(a[1]) + area(b[1]) - both)
            if iou >= 0.85 or sizes[tile] >= 10 and apart <= 8 and iou < 0.3:
                want[tile, a[0][1], b[0][1]] = iou
    assert want
    found = audit_queries.dup_labels_bucketed(spark, folder).collect()
    near({(r.tile_key, r.first, r.second): r.iou for r in found if r.first is not None}, want)
    assert {r.tile_key for r in found if r.first is None} == {tile for tile, n in sizes.items() if n > 80}
    assert audit_queries.dedup_labels(spark, folder).agg(F.sum("n")).first()[0] == len(labels)


def test_recovery_origin_of_all_boxes(spark, folder):
    want = {}
    for (key, w, h), poly, (x0, y0, x1, y1) in boxes(views.boxes(spark, folder), "instance_id", "parent_width", "parent_height"):
        corners = [((x0 + x1) / 2 - 512, (y0 + y1) / 2 - 512), (x0, y0), (x1 - 1024, y0), (x0, y1 - 1024), (x1 - 1024, y1 - 1024)]
        places = [(max(0, min(round(x), w - 1024)), max(0, min(round(y), h - 1024))) for x, y in corners]
        most = max(clip(poly, [(x, y), (x + 1024, y), (x + 1024, y + 1024), (x, y + 1024)]) / area(poly) for x, y in places)
        if most >= 0.25:
            want[key] = most
    near({r.instance_id: r.retained for r in audit_queries.recovery_origin(spark, folder).collect()}, want)


def test_redundant_windows_see_all_boxes(spark, folder):
    held = [(k, e) for k, _, e in boxes(views.boxes(spark, folder), "instance_id", "group_key")]
    windows = [(t.group_key, f"{t.tile_key}_{k}", t.tile_x + 8 * k, t.tile_y) for t in views.all_tiles(spark, folder).collect() for k in (0, 1) if t.tile_x + 8 * k + 1024 <= t.width]
    inside = {w: {k[0] for k, e in held if k[1] == w[0] and e[0] >= w[2] and e[2] <= w[2] + 1024 and e[1] >= w[3] and e[3] <= w[3] + 1024} for w in windows}
    want = set()
    for a, b in combinations(sorted(windows, key=lambda w: w[1]), 2):
        both = max(0, 1024 - abs(a[2] - b[2])) * max(0, 1024 - abs(a[3] - b[3]))
        if a[0] == b[0] and both / (2 * 1024**2 - both) >= 0.7 and (inside[a] <= inside[b] or inside[b] <= inside[a]):
            want.add((a[0], a[1], b[1]))
    assert {(r.group_key, r.first, r.second) for r in audit_queries.redundant_windows(spark, folder).collect()} == want


def test_stems_of_all_lines(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").collect()
    found = report_queries.unique_stems(spark, folder).collect()
    assert len(found) == len(lines) and len({r.unique_stem for r in found}) == len(lines)
    counts = {}
    for r in lines:
        stem = f"{r.l_returnflag}__im{r.l_partkey % 40}"
        counts[stem] = counts.get(stem, 0) + 1
    want = {stem if k == 0 else f"{stem}__{k + 1}" for stem, n in counts.items() for k in range(n)}
    assert {r.unique_stem for r in found} == want


def test_recovery_of_all_boxes(spark, folder):
    all_boxes = views.boxes(spark, folder).select("s", "p").collect()
    n = sum(2 if r.p % 4 == 0 else 1 for r in all_boxes)
    scored = recovery.with_score(report_queries._candidates(spark, folder)).collect()
    assert len(scored) == n == len({(r.parent, r.seq) for r in scored})
    clusters = report_queries.candidate_clusters(spark, folder).collect()
    assert sorted((r.parent, r.seq) for r in clusters) == sorted((r.parent, r.seq) for r in scored)
    links = recovery.cluster_links(recovery.with_score(report_queries._candidates(spark, folder))).collect()
    root = {(r.parent, r.seq): r.seq for r in scored}
    moved = True
    while moved:
        moved = False
        for r in links:
            least = min(root[r.parent, r.a], root[r.parent, r.b])
            for k in (r.a, r.b):
                moved |= root[r.parent, k] != least
                root[r.parent, k] = least
    assert {(r.parent, r.seq): r.cluster for r in clusters} == root and len(set(root.values())) < n
    recovered = report_queries.recovered_annotations(spark, folder).collect()
    assert len(recovered) == len(set((p, c) for (p, _), c in root.items())) and sum(r.cluster_size for r in recovered) == n
    groups = {}
    for r in scored:
        groups.setdefault((r.parent, r.seq % 40), []).append((-r.score, r.seq, r.source_kind))
    want = {}
    for (parent, _), members in groups.items():
        if len(members) > 1:
            a, b = sorted(members)[:2]
            want[parent, a[1]] = (a[2], b[0] - a[0] < 15)
    assert {(r.parent, r.seq): (r.source_kind, r.ambiguous) for r in report_queries.best_candidate(spark, folder).collect()} == want


def test_repair_of_all_boxes(spark, folder):
    seen = spatial.visible_tiles(views.boxes(spark, folder), views.all_tiles(spark, folder)).count()
    cases = repair_queries._cases(spark, folder)
    assert cases.count() == seen == cases.select("tile_key", "seq").distinct().count()
    assert repair_queries._local_labels(spark, folder).count() == views.labels(spark, folder).count()
    assert repair_queries.projection_decisions(spark, folder).agg(F.sum("n")).first()[0] == seen
    counts = repair_queries.patch_counters(spark, folder).first()
    assert counts.projection_additions + counts.projection_skips == seen and counts.projection_skips == counts.filter_removals + counts.other_skips
    assert repair_queries.residual_decisions(spark, folder).agg(F.sum("n")).first()[0] == seen


def test_long_copies_are_compared_whole(spark, tmp_path):
    long = "x" * 9000
    texts = [long, long, long[:-1] + "y", "z" * 50, "z" * 50]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in enumerate(texts)], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(report_queries.dup_candidates(spark, str(tmp_path))) == [(50, "web", 2, 1), (9000, "web", 3, 2)]


def test_near_labels_of_different_cells(spark):
    """Two flat labels on both sides of a cell's border whose centres are near, and equal rows counted each."""
    flat = lambda y, x=10.0: [(x, y), (x + 10, y), (x + 10, y + 4), (x, y + 4)]
    labels = [("t", 1, flat(59.0)), ("t", 2, flat(65.0))] + [("t", k, flat(200.0 + 20 * k, 400.0)) for k in range(3, 11)] + [("u", 1, flat(0.0)), ("u", 2, flat(0.0)), ("u", 2, flat(0.0))]
    found = spatial.label_pairs(spark.createDataFrame(labels, "tile_key string, line long, poly array<struct<x:double,y:double>>"))
    assert rows(found.select("tile_key", "first", "second", "iou")) == [("t", 1, 2, 0.0), ("u", 1, 2, 1.0), ("u", 1, 2, 1.0)]


def test_parents_past_9999_share_names(spark, tmp_path):
    """Names hold four digits of a key, so tiles of several parents have one name: as the SQL counts them."""
    duckdb = pytest.importorskip("duckdb")
    rng, keys = random.Random(6), [1234, *range(12340, 12350)]
    lines = [(k + 1, rng.randrange(1, 240), rng.choice(keys), k % 3 + 1, float(rng.randint(20, 50)), 1000.0 + k, "ANR"[k % 3]) for k in range(400)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    spark.createDataFrame(lines, schema).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, f"S{k}", k % 25) for k in keys], "s_suppkey long, s_name string, s_nationkey int").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    db = duckdb.connect()
    for name in ("lineitem", "supplier"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name, module in (("roi_coverage", audit_queries), ("tile_area_stats", operation_queries), ("recovery_effectiveness", audit_queries), ("coverage_cascade", audit_queries)):
        found = module.QUERIES[name](spark, str(tmp_path))
        # The SQL takes any group_key of the first tile.
        columns = ", ".join("CASE WHEN issue_type NOT LIKE '%multiple%' THEN group_key END AS group_key" if c == "group_key" else c for c in found.columns)
        want = sorted(db.execute(f"SELECT {columns} FROM ({module.SQL[name]})").fetchall(), key=repr)
        assert rows(found.selectExpr(*columns.replace("%multiple%'", "%multiple%'").split(", "))) == want, name
