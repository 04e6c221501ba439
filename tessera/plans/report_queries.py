"""Queries of counts, detections, tracks, recovery and release reports, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import parsing as p
from ..operators import detections, greedy, recovery, reports, spatial, tracks
from ..policy import Policy
from . import check_sql as q
from . import views as v
from .testbed import ctes, table, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


_INDEX = "CASE o_orderstatus WHEN 'F' THEN 'dota' WHEN 'O' THEN 'xview' ELSE 'hrsc' END"
_SPLIT = "CASE WHEN o_orderkey % 7 = 0 THEN 'val' ELSE 'train' END"


def _index(spark, d):
    """Training index: one row per order."""
    o = table(spark, d, "orders")
    return o.select(F.expr(_INDEX).alias("dataset"), F.expr(_SPLIT).alias("split"), F.col("o_custkey").alias("group_key"), F.col("o_orderkey").alias("image"), (F.col("o_orderkey") % 9).alias("labels"), F.col("o_orderpriority").alias("priority"))


@query("""SELECT source, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS total, min(n) AS least, max(n) AS most, list_sort(list(n))[count(*) // 2 + 1] AS median FROM (SELECT source, n_chars % 97 AS n FROM documents) GROUP BY source""")
def inventory_summary(spark, d):
    return reports.inventory(table(spark, d, "documents").select("source", (F.col("n_chars") % 97).alias("n")), ["source"], "n")


_COUNTS = f"counts AS (SELECT {_INDEX} AS dataset, {_SPLIT} AS split, count(*) AS tiles, count(*) FILTER (o_orderkey % 9 > 0) AS annotated, CAST(sum(o_orderkey % 9) AS BIGINT) AS labels, count(DISTINCT o_custkey) AS parents FROM orders GROUP BY 1, 2)"


@query(f"WITH {_COUNTS} SELECT * FROM counts UNION ALL SELECT dataset, 'all', CAST(sum(tiles) AS BIGINT), CAST(sum(annotated) AS BIGINT), CAST(sum(labels) AS BIGINT), CAST(sum(parents) AS BIGINT) FROM counts GROUP BY dataset")
def lineage_counts(spark, d):
    return reports.lineage_counts(_index(spark, d), ["dataset", "split"], "group_key", "labels")


@query(f"WITH {_COUNTS}, expected(dataset, split, expected) AS (SELECT * FROM (VALUES ('dota', 'train', CAST(1 AS BIGINT)), ('xview', 'val', 2), ('none', 'train', 3)) UNION ALL SELECT 'hrsc', 'train', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 7 <> 0) SELECT e.dataset, e.split, expected, tiles AS found, expected IS NOT DISTINCT FROM tiles AS passed FROM expected e LEFT JOIN counts USING (dataset, split)")
def expected_checks(spark, d):
    expected = spark.createDataFrame([("dota", "train", 1), ("xview", "val", 2), ("none", "train", 3)], "dataset string, split string, tiles long")
    known = table(spark, d, "orders").filter("o_orderstatus = 'P' AND o_orderkey % 7 <> 0").agg(F.lit("hrsc").alias("dataset"), F.lit("train").alias("split"), F.count("*").alias("tiles"))
    expected = expected.unionByName(known)  # one that must pass
    return reports.expected_checks(reports.lineage_counts(_index(spark, d), ["dataset", "split"], "group_key", "labels"), expected, ["dataset", "split"], "tiles")


@query(f"SELECT {_SPLIT} AS split, {_INDEX} AS dataset, count(*) AS total, count(*) FILTER (o_orderkey % 9 > 0) AS positive, count(*) FILTER (o_orderkey % 9 = 0) AS empty, {q.half_up('count(*) FILTER (o_orderkey % 9 = 0) / count(*)', 6)} AS empty_ratio FROM orders GROUP BY 1, 2")
def training_report(spark, d):
    return reports.training_report(_index(spark, d), ["split", "dataset"], F.col("labels") == 0)


@query(f"SELECT o_custkey AS group_key, count(DISTINCT {_SPLIT}) AS splits, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT {_SPLIT}) > 1")
def group_leakage(spark, d):
    return reports.leaking_groups(_index(spark, d), "group_key", "split")


@query("SELECT source, n FROM (SELECT source, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1) ORDER BY n DESC, f LIMIT 5")
def top_sources(spark, d):
    return reports.most_common(table(spark, d, "documents"), "source", "doc_id", 5)


@query(f"WITH {ctes('boxes')} SELECT CASE WHEN c < 0.01 THEN '<0.01' WHEN c < 0.025 THEN '0.01-0.025' WHEN c < 0.05 THEN '0.025-0.05' WHEN c < 0.10 THEN '0.05-0.10' WHEN c < 0.25 THEN '0.10-0.25' ELSE '>=0.25' END AS bucket, count(*) AS n FROM (SELECT conf * conf * conf AS c FROM boxes) GROUP BY 1")
def confidence_hist(spark, d):
    c = F.col("conf")
    return view(spark, d, "boxes").select(p.confidence_bucket(c * c * c).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


@query(f"""SELECT run, first(epoch ORDER BY m95 DESC, epoch) AS best_epoch, {q.half_up('0.1 * first(m50 ORDER BY m95 DESC, epoch) + 0.9 * max(m95)', 6)} AS fitness, max(t) AS last_time
    FROM (SELECT l_suppkey AS run, l_orderkey * 10 + l_linenumber AS epoch, CAST(l_partkey % 100 AS DOUBLE) / 100 AS m50, floor(l_extendedprice / 1000) / 110 AS m95, l_orderkey * 10 + l_linenumber + 0.5::DOUBLE AS t FROM (SELECT l_suppkey, l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL)) GROUP BY run""")
def best_epoch(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_extendedprice").alias("l_extendedprice"))
    epoch = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = rows.select(F.col("l_suppkey").alias("run"), epoch.alias("epoch"), (F.col("l_partkey") % 100 / 100.0).alias("m50"), (F.floor(F.col("l_extendedprice") / 1000) / 110).alias("m95"), (epoch + F.lit(0.5)).alias("t"))
    return reports.best_epochs(rows, "run", "epoch", "m50", "m95", "t")


_PATH = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"


@query(f"""SELECT folder, count(*) AS files, CAST(sum(n) AS BIGINT) AS bytes FROM (SELECT unnest(list_transform(range(0, least(len(parts) - 1, 3) + 1), lambda k: CASE WHEN k = 0 THEN '.' ELSE array_to_string(parts[1:k], '/') END)) AS folder, n FROM (SELECT string_split({_PATH}, '/') AS parts, length(html) AS n FROM pages)) GROUP BY 1""")
def dir_rollup(spark, d):
    files = table(spark, d, "pages").select(F.expr(_PATH).alias("path"), F.length("html").alias("size"))
    return reports.path_rollup(files, "path", "size")


@query("SELECT n_chars, source, count(*) AS copies, count(DISTINCT CASE WHEN strlen(text) <= 10485760 THEN sha256(text) END) AS contents FROM documents GROUP BY ALL HAVING count(*) > 1")
def dup_candidates(spark, d):
    return reports.duplicate_files(table(spark, d, "documents"), ["n_chars", "source"], "text", 10 * 1024 * 1024)


@query(r"""SELECT doc_id AS source, line, kind FROM (SELECT doc_id, line, unnest(list_filter([CASE WHEN regexp_matches(t, '\bhf_[A-Za-z0-9]{24,}\b') THEN 'huggingface_token' END, CASE WHEN regexp_matches(t, '\bgh[pousr]_[A-Za-z0-9]{20,}\b') THEN 'github_token' END,
    CASE WHEN regexp_matches(t, '(?i)\b(?:token|secret|api[_-]?key|password)\b\s*[:=]\s*(?:[''"][^''"]{8,}[''"]|[A-Za-z0-9_-]{20,})') THEN 'generic_secret_assignment' END, CASE WHEN regexp_matches(t, '/home/|[A-Za-z]:\\\\Users\\') THEN 'absolute_local_path' END], lambda k: k IS NOT NULL)) AS kind
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents))""")
def secret_scan(spark, d):
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("source"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return p.secret_findings(lines.withColumn("line", F.col("line").cast("long")))


_STEM = "'im' || (l_partkey % 40)"


@query(f"SELECT l_returnflag AS dataset, k, 'x' || l_returnflag AS u0, CASE WHEN rn = 1 THEN l_returnflag || '__' || stem ELSE l_returnflag || '__' || stem || '__' || rn END AS unique_stem FROM (SELECT l_returnflag, {_STEM} AS stem, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS k, row_number() OVER (PARTITION BY l_returnflag, {_STEM} ORDER BY l_orderkey * 1000000 + l_partkey * 10 + l_linenumber, l_suppkey, l_extendedprice) AS rn FROM lineitem)")
def unique_stems(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.expr(_STEM.replace("(l_partkey % 40)", "CAST(l_partkey % 40 AS STRING)")).alias("stem"), F.expr("l_orderkey * 1000000 + l_partkey * 10 + l_linenumber").alias("k"), F.struct(F.expr("l_orderkey * 1000000 + l_partkey * 10 + l_linenumber"), "l_suppkey", "l_extendedprice").alias("order"))
    return reports.unique_stems(rows, "dataset", "stem", "order").select("dataset", "k", F.concat(F.lit("x"), "dataset").alias("u0"), "unique_stem")


@query("SELECT split, image, bool_or(l) AS in_left, bool_or(r) AS in_right FROM (SELECT o_orderkey % 2 AS split, o_orderkey % 500 AS image, true AS l, false AS r FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey % 2, o_orderkey % 500, false, true FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY ALL")
def file_parity(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_orderkey") % 2).alias("split"), (F.col("o_orderkey") % 500).alias("image"), "o_orderkey")
    return spatial.presence(rows.filter("o_orderkey % 3 <> 0"), rows.filter("o_orderkey % 5 <> 0"), ["split", "image"])


@query("SELECT DISTINCT c_custkey AS parent FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def stale_missing_ids(spark, d):
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    return spatial.left_miss(table(spark, d, "customer").select(F.col("c_custkey").alias("parent")), urgent.select(F.col("o_custkey").alias("parent")), ["parent"])


@query("SELECT s_suppkey, s_name, s_suppkey % 4 <> 0 AS in_index, CASE WHEN s_suppkey % 4 = 0 THEN 'tile_missing_from_training_index' END AS issue_type FROM supplier")
def missing_index_rows(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    index = s.filter("s_suppkey % 4 <> 0").select("s_suppkey", F.lit(True).alias("hit"))
    joined = s.join(index, "s_suppkey", "left").withColumn("in_index", F.coalesce("hit", F.lit(False)))
    return joined.select("s_suppkey", "s_name", "in_index", F.when(~F.col("in_index"), "tile_missing_from_training_index").alias("issue_type"))


@query("SELECT coalesce(a.s, b.s) AS status, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT o_orderpriority AS s, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 AND o_orderpriority <> '1-URGENT' GROUP BY 1) a FULL JOIN (SELECT o_orderpriority AS s, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 AND o_orderpriority <> '5-LOW' GROUP BY 1) b ON a.s = b.s")
def before_after(spark, d):
    o = table(spark, d, "orders").withColumn("status", F.col("o_orderpriority"))
    count = lambda df: df.groupBy("status").agg(F.count("*").alias("n"))
    return spatial.before_after(count(o.filter("o_orderkey % 2 = 0 AND status <> '1-URGENT'")), count(o.filter("o_orderkey % 2 = 1 AND status <> '5-LOW'")), "status")


# Detections

_UNIQUE = "det AS (SELECT s, cls, k, min(conf) AS conf, min(x0) AS x0, min(y0) AS y0, min(x0) + 40 AS x1, min(y0) + 40 AS y1 FROM boxes GROUP BY s, cls, k)"


def _boxes(spark, d):
    b = view(spark, d, "boxes").groupBy("s", "cls", "k").agg(F.min("conf").alias("conf"), F.min("x0").alias("x0"), F.min("y0").alias("y0"))
    return b.withColumns({"x1": F.col("x0") + 40, "y1": F.col("y0") + 40})


@query(f"""WITH {ctes('boxes')}, {_UNIQUE}, sorted AS (SELECT s, cls, list({{'k': k, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} ORDER BY conf DESC, k) AS l FROM det GROUP BY ALL),
    kept AS (SELECT s, cls, list_reduce(list_transform(l, lambda e: [e]), lambda a, e: CASE WHEN len(list_filter(a, lambda o: {q.box_iou('o', 'e[1]')} > 0.5)) = 0 THEN list_concat(a, e) ELSE a END) AS l FROM sorted)
    SELECT s, cls, unnest(list_transform(l, lambda e: e.k)) AS k FROM kept""")
def nms_axis(spark, d):
    return greedy.nms(_boxes(spark, d), ["s", "cls"], "conf", ("x0", "y0", "x1", "y1"), "k", 0.5).select("s", "cls", "k")


@query()
def nms_rotated(spark, d):
    b = g.once(_boxes(spark, d), "poly", g.corners(F.col("x0"), F.col("y0"), F.lit(60.0), F.lit(20.0), F.radians(F.col("k") % 180)))
    return greedy.rotated_nms(b, ["s", "cls"], "conf", "poly", "k").select("s", "cls", "k")


@query(f"WITH {ctes('boxes')}, {_UNIQUE} SELECT s, k, det_id FROM (SELECT s, k, printf('det_%03d', rn) AS det_id, rn FROM (SELECT s, k, row_number() OVER (PARTITION BY s ORDER BY conf DESC, k) AS rn FROM det)) WHERE rn <= 20")
def topk_detections(spark, d):
    return greedy.top_detections(_boxes(spark, d), ["s"], "conf", "k", 20).select("s", "k", "det_id")


_GT = f"""gt AS (SELECT * FROM det WHERE k % 3 = 0), pr AS (SELECT s, k, conf, x0 + 5 AS x0, y0 + 3 AS y0, x1 + 5 AS x1, y1 + 3 AS y1 FROM det WHERE k % 2 = 0),
    pairs AS (SELECT p.s, p.k AS pred, p.conf, t.k AS gt, {q.half_up(q.box_iou('p', 't'), 6)} AS iou FROM pr p JOIN gt t ON p.s = t.s AND p.x0 < t.x1 AND t.x0 < p.x1 AND p.y0 < t.y1 AND t.y0 < p.y1)"""


@query(f"""WITH {ctes('boxes')}, {_UNIQUE}, {_GT}, options AS (SELECT s, pred, conf, list({{'gt': gt, 'iou': iou}} ORDER BY iou DESC, gt) AS o FROM pairs GROUP BY ALL),
    items AS (SELECT s, list([{{'pred': CAST(-1 AS BIGINT), 'gt': CAST(-1 AS BIGINT), 'iou': 0.0::DOUBLE, 'o': o, 'id': pred}}] ORDER BY conf DESC, pred) AS l FROM options GROUP BY s),
    done AS (SELECT s, list_reduce(list_concat([[{{'pred': CAST(-1 AS BIGINT), 'gt': CAST(-1 AS BIGINT), 'iou': 0.0::DOUBLE, 'o': l[1][1].o, 'id': CAST(-1 AS BIGINT)}}]], l), lambda a, e: list_concat(a, list_transform(list_filter(list_filter(e[1].o, lambda c: NOT list_contains(list_transform(a, lambda m: m.gt), c.gt))[1:1], lambda c: c.iou >= 0.5), lambda c: {{'pred': e[1].id, 'gt': c.gt, 'iou': c.iou, 'o': e[1].o, 'id': e[1].id}}))) AS l FROM items)
    SELECT s, m.pred AS pred, m.gt AS gt, m.iou AS iou FROM (SELECT s, unnest(l) AS m FROM done) WHERE m.pred >= 0""")
def greedy_gt_match(spark, d):
    b = _boxes(spark, d)
    gt = b.filter("k % 3 = 0").select(F.col("s").alias("_s"), F.col("k").alias("gt"), *[F.col(c).alias(f"g{c}") for c in ("x0", "y0", "x1", "y1")])
    pr = b.filter("k % 2 = 0").select("s", F.col("k").alias("pred"), "conf", (F.col("x0") + 5).alias("x0"), (F.col("y0") + 3).alias("y0"), (F.col("x1") + 5).alias("x1"), (F.col("y1") + 3).alias("y1"))
    meet = (F.col("x0") < F.col("gx1")) & (F.col("gx0") < F.col("x1")) & (F.col("y0") < F.col("gy1")) & (F.col("gy0") < F.col("y1"))
    rect = lambda z: tuple(F.col(f"{z}{c}") for c in ("x0", "y0", "x1", "y1"))
    pairs = pr.join(gt, (F.col("s") == F.col("_s")) & meet).withColumn("iou", g.round_half_up(g.rect_iou(rect(""), rect("g")), 6))
    return greedy.greedy_match(pairs.select("s", "pred", "conf", "gt", "iou"), "s", 0.5)


@query(f"""SELECT vec_id, CAST(list_position(e[5:63], list_max(e[5:63])) - 1 AS INT) AS class_id, {q.half_up('CAST(list_max(e[5:63]) AS DOUBLE)', 4)} AS conf, {q.half_up('CAST(e[64] AS DOUBLE)', 4)} AS rot
    FROM (SELECT vec_id, list_concat([abs(embedding[1]), abs(embedding[2]), abs(embedding[3]), abs(embedding[4])], embedding[5:64]) AS e FROM embeddings) WHERE list_max(e[5:63]) >= 0.25 AND e[3] > 0 AND e[4] > 0""")
def tensor_decode(spark, d):
    vector = F.transform("embedding", lambda x, i: F.when(i < 4, F.abs(x)).otherwise(x))
    rows = detections.decode_rows(table(spark, d, "embeddings").select("vec_id", vector.alias("vector")), "vector", 0.25)
    return rows.select("vec_id", "class_id", g.round_half_up(F.col("conf"), 4).alias("conf"), g.round_half_up(F.col("rot"), 4).alias("rot"))


_FIT = "least(640.0 / width, 640.0 / height)"


@query(f"""WITH {ctes('parents')} SELECT s, {q.half_up(_FIT, 6)} AS scale, CAST(round_even((640 - greatest(round_even(width * {_FIT}, 0), 1)) / 2 - 0.1, 0) AS INT) AS pad_x, CAST(round_even((640 - greatest(round_even(height * {_FIT}, 0), 1)) / 2 - 0.1, 0) AS INT) AS pad_y FROM parents""")
def letterbox_params(spark, d):
    b = g.letterbox(F.col("width"), F.col("height"), 640)
    return v.parents(spark, d).withColumn("b", b).select("s", g.round_half_up(F.col("b.scale"), 6).alias("scale"), "b.pad_x", "b.pad_y")


@query(f"WITH {ctes('boxes')} SELECT s, cls, count(*) AS detections, max(conf) AS top, {q.half_up('avg(conf)', 6)} AS mean FROM boxes GROUP BY ALL")
def detection_summary(spark, d):
    return detections.summary(view(spark, d, "boxes"), ["s", "cls"], "conf")


# Tracks

_OBS = "obs AS (SELECT user_id, frame, min(conf) AS conf, min(cx) AS cx, min(cy) AS cy FROM frames GROUP BY ALL)"


def _observations(spark, d):
    o = view(spark, d, "frames").groupBy("user_id", "frame").agg(*[F.min(c).alias(c) for c in ("conf", "cx", "cy")])
    return o.withColumn("poly", g.rect_polygon(F.col("cx") - 20, F.col("cy") - 10, F.col("cx") + 20, F.col("cy") + 10))


_WIDE = "20"


@query(f"""WITH {ctes('frames')}, {_OBS}, steps AS (SELECT *, lead(frame) OVER w AS f2, lead(conf) OVER w AS c2, lead(cx) OVER w AS x2, lead(cy) OVER w AS y2 FROM obs WINDOW w AS (PARTITION BY user_id ORDER BY frame)),
    holes AS (SELECT *, unnest(range(1, f2 - frame)) AS k FROM steps WHERE f2 - frame - 1 BETWEEN 1 AND {_WIDE})
    SELECT user_id, frame, {q.half_up('conf', 6)} AS conf, {q.half_up('cx - 20', 4)} AS x, {q.half_up('cy - 10', 4)} AS y, false AS interpolated FROM obs
    UNION ALL SELECT user_id, frame + k, {q.half_up('least(conf, c2)', 6)}, {q.half_up('cx - 20 + (x2 - cx) * (k / (f2 - frame))', 4)}, {q.half_up('cy - 10 + (y2 - cy) * (k / (f2 - frame))', 4)}, true FROM holes""")
def gap_interpolation(spark, d):
    out = tracks.fill_gaps(_observations(spark, d).select("user_id", "frame", "conf", "poly"), ["user_id"], Policy(track_gap=int(_WIDE)))
    return out.select("user_id", "frame", g.round_half_up(F.col("conf"), 6).alias("conf"), g.round_half_up(F.col("poly")[0]["x"], 4).alias("x"), g.round_half_up(F.col("poly")[0]["y"], 4).alias("y"), "interpolated")


@query(f"""WITH {ctes('frames')}, {_OBS}, runs AS (SELECT *, frame - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS run FROM obs)
    SELECT user_id, frame, {q.half_up('avg(cx - 20) OVER w', 4)} AS x, {q.half_up('avg(cy - 10) OVER w', 4)} AS y FROM runs WINDOW w AS (PARTITION BY user_id, run ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def smooth_tracks(spark, d):
    out = tracks.smooth(_observations(spark, d).select("user_id", "frame", "poly"), ["user_id"])
    return out.select("user_id", "frame", g.round_half_up(F.col("poly")[0]["x"], 4).alias("x"), g.round_half_up(F.col("poly")[0]["y"], 4).alias("y"))


def _video(spark, d):
    f = view(spark, d, "frames")
    return f.select((F.col("user_id") % 8).cast("string").alias("video"), "frame", F.col("event_id").alias("det"), "cls", "conf", g.rect_polygon(F.col("cx") - 40, F.col("cy") - 20, F.col("cx") + 40, F.col("cy") + 20).alias("poly"))


@query()
def track_assign(spark, d):
    return tracks.assign_tracks(_video(spark, d)).select("video", "frame", "det", "cls", "track_id")


@query()
def track_lengths(spark, d):
    return tracks.track_lengths(tracks.assign_tracks(_video(spark, d)), ["video"])


@query(f"""WITH {ctes('frames')}, f AS (SELECT CAST(user_id % 8 AS VARCHAR) AS video, frame FROM frames), spine AS (SELECT video, unnest(range(min(frame), max(frame) + 1)) AS frame FROM f GROUP BY video)
    SELECT video, frame, count(f.frame) AS n FROM spine LEFT JOIN f USING (video, frame) GROUP BY ALL""")
def frame_counts(spark, d):
    return tracks.frame_counts(_video(spark, d), "video", F.min("frame"), F.max("frame"))


# Recovery

def _candidates(spark, d):
    """Candidates of parents: all boxes and shifted copies of some of them."""
    again = F.row_number().over(Window.partitionBy("s", "o", "p", "n").orderBy("instance_id")) - 1  # rows that repeat a line get a seq of their own
    o = view(spark, d, "obbs").repartition("s")  # a parent's rows move once, before they have polygons
    b = v.boxed(o.withColumn("again", again))
    rows = b.withColumn("copy", F.explode(F.when(F.col("p") % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    kinds = F.array(*[F.lit(k) for k in ("cleaned", "second_pass", "raw")])
    poly = F.transform("poly", lambda a: g.point(a["x"] + 3 * F.col("copy"), a["y"] + 2 * F.col("copy")))
    seq = F.col("o") * 10000000 + F.col("p") * 100 + F.col("n") * 2 + F.col("copy") + 16 * F.col("again")
    return rows.select(F.col("s").alias("parent"), seq.alias("seq"), F.explode(F.array(poly)).alias("poly"), F.pmod(F.col("rot"), F.lit(180.0)).alias("angle"), F.get(kinds, ((F.col("p") + F.col("copy")) % 3).cast("int")).alias("source_kind"), "parent_width", "parent_height", F.col("parent_width").alias("tile_width"), F.col("parent_height").alias("tile_height"), F.lit(0).alias("tile_x"), F.lit(0).alias("tile_y")).withColumn("local", F.col("poly"))


@query()
def recovered_annotations(spark, d):
    return recovery.recover(_candidates(spark, d)).select("parent", "cluster", "cluster_size", "source_kind", "ambiguous", g.round_half_up(F.col("score"), 3).alias("score"), p.points_to_text(F.col("points")).alias("points"))


_CAND = """cand AS (SELECT s AS parent, o * 10000000 + p * 100 + n * 2 + copy + 16 * again AS seq, parent_width, parent_height, ['cleaned', 'second_pass', 'raw'][CAST((p + copy) % 3 + 1 AS INT)] AS kind, x0 + 3 * copy AS x0, y0 + 2 * copy AS y0, x1 + 3 * copy AS x1, y1 + 2 * copy AS y1
    FROM (SELECT *, unnest(CASE WHEN p % 4 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM (SELECT *, row_number() OVER (PARTITION BY s, o, p, n ORDER BY instance_id) - 1 AS again FROM bounded)))"""


@query(f"""{v.base('boxes')}, {_CAND}, m AS (SELECT *, greatest(0, least(x0, y0, parent_width - 1 - x1, parent_height - 1 - y1)) AS margin FROM cand),
    scored AS (SELECT *, CASE kind WHEN 'second_pass' THEN 2000 WHEN 'cleaned' THEN 1000 ELSE 100 END + least(margin, 100) + CASE WHEN margin <= 2.5 THEN 0 ELSE 10 END AS score FROM m)
    SELECT parent, seq, kind AS source_kind, {q.half_up('score', 3)} AS score, lead_gap < 15 AS ambiguous FROM (SELECT *, row_number() OVER w AS rn, score - lead(score) OVER w AS lead_gap FROM scored WINDOW w AS (PARTITION BY parent, seq % 40 ORDER BY score DESC, seq)) WHERE rn = 1 AND lead_gap IS NOT NULL""")
def best_candidate(spark, d):
    c = recovery.with_score(_candidates(spark, d)).withColumn("cluster", F.col("seq") % 40)
    best = recovery.best_candidates(c).filter("runner_up IS NOT NULL")
    return best.select("parent", "seq", "source_kind", g.round_half_up(F.col("score"), 3).alias("score"), "ambiguous")


@query()
def candidate_clusters(spark, d):
    c = recovery.with_score(_candidates(spark, d)).select("parent", "seq", "poly", "angle", "edge_touch")
    return recovery.with_clusters(c).select("parent", "seq", "cluster")
