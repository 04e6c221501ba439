"""Recovery of parent annotations from tile annotations: clusters of compatible candidates."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as g
from ..functions import kernels
from ..policy import DEFAULT, SOURCE_PRIORITY, Policy


def source_priority(kind: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for name, value in SOURCE_PRIORITY.items():
        out = out.when(kind.startswith(name), value)
    return out.otherwise(100)


def with_score(candidates: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Adds margin, edge_touch and score: the source's priority, up to 100 of the margin to the tile's
    border, and 10 for a candidate that doesn't touch it. Candidates: source_kind, local (tile
    polygon), tile_width, tile_height."""
    margin = g.tile_margin(F.col("local"), F.col("tile_width"), F.col("tile_height"))
    scored = g.once(candidates, "margin", margin).withColumn("edge_touch", F.col("margin") <= policy.edge_touch)
    return scored.withColumn("score", source_priority(F.col("source_kind")) + F.least("margin", F.lit(100.0)) + F.when(F.col("edge_touch"), 0.0).otherwise(10.0))


def compatible(a: dict[str, Column], b: dict[str, Column], policy: Policy = DEFAULT) -> Column:
    """Whether two candidates may show one object, seen along the first one's angle. a and b: poly,
    angle, edge_touch."""

    def judged(w: Column) -> Column:
        spans = {k: F.greatest(w["a"][f"{k}1"] - w["a"][f"{k}0"], w["b"][f"{k}1"] - w["b"][f"{k}0"]) for k in "uv"}

        def by(o: Column) -> Column:
            near = [o[f"gap_{k}"] <= F.greatest(F.lit(policy.gap_floor), policy.gap_ratio * spans[k]) for k in "uv"]
            return (o["hull_iou"] >= policy.hull_iou) | ((a["edge_touch"] | b["edge_touch"]) & near[0] & near[1]) | ((o["inter_u"] > 0) & (o["inter_v"] > 0))

        return g.let(g.hull_overlap(w["a"], w["b"]), by)

    both = F.struct(g.extents(a["poly"], a["angle"]).alias("a"), g.extents(b["poly"], a["angle"]).alias("b"))
    return F.when(g.angle_difference(a["angle"], b["angle"]) <= policy.cluster_angle, g.let(both, judged)).otherwise(False)


def cluster_links(candidates: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Pairs (parent, a, b) of compatible candidates, a before b in `seq`. Candidates: parent, seq,
    poly, angle, edge_touch. Only pairs whose envelopes, widened by the largest gap allowed, meet are
    compared: both are in a cell of the parent's plane then, and the first such cell compares them."""
    from .spatial import with_bounds

    boxed = with_bounds(candidates.select("parent", "seq", "poly", "angle", "edge_touch"))
    long = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    wide = boxed.withColumn("reach", F.greatest(F.lit(policy.gap_floor), policy.gap_ratio * 1.5 * long))
    wide = g.once(wide, "turn", F.struct(F.cos(F.radians("angle")).alias("c"), F.sin(F.radians("angle")).alias("s"))).select("*", "turn.c", "turn.s").drop("turn")
    spans = lambda poly, degrees: F.when(F.size(poly) == 4, g.quad_extents(poly, F.col("c"), F.col("s"))).otherwise(g.extents(poly, degrees))
    wide = g.once(wide, "own", spans(F.col("poly"), F.col("angle")))
    cell = lambda v: F.floor(v / policy.link_cell)
    low = {k: F.col(f"{k}0") - 2 * F.col("reach") for k in "xy"}
    cells = {k: F.sequence(cell(low[k]), cell(F.col(f"{k}1") + 2 * F.col("reach"))) for k in "xy"}
    wide = wide.withColumns({f"c{k}": cell(low[k]) for k in "xy"}).withColumn("at_x", F.explode(cells["x"])).withColumn("at_y", F.explode(cells["y"]))
    right = wide.select(*[F.col(c).alias(f"r_{c}") for c in ("parent", "seq", "poly", "angle", "edge_touch", "x0", "y0", "x1", "y1", "reach", "cx", "cy", "at_x", "at_y")])
    reach = 2 * F.greatest("reach", "r_reach")
    meet = (F.col("x0") - reach <= F.col("r_x1")) & (F.col("r_x0") - reach <= F.col("x1")) & (F.col("y0") - reach <= F.col("r_y1")) & (F.col("r_y0") - reach <= F.col("y1"))
    same = (F.col("parent") == F.col("r_parent")) & (F.col("at_x") == F.col("r_at_x")) & (F.col("at_y") == F.col("r_at_y"))
    first = (F.col("at_x") == F.greatest("cx", "r_cx")) & (F.col("at_y") == F.greatest("cy", "r_cy"))
    turned = g.angle_difference(F.col("angle"), F.col("r_angle")) <= policy.cluster_angle
    pairs = wide.join(right, same & first & (F.col("seq") < F.col("r_seq")) & meet & turned)
    pairs = g.once(pairs, "other", spans(F.col("r_poly"), F.col("angle")))
    pairs = g.once(pairs, "o", g.hull_overlap(F.col("own"), F.col("other")))
    span = lambda k: F.greatest(F.col(f"own.{k}1") - F.col(f"own.{k}0"), F.col(f"other.{k}1") - F.col(f"other.{k}0"))
    near = [F.col(f"o.gap_{k}") <= F.greatest(F.lit(policy.gap_floor), policy.gap_ratio * span(k)) for k in "uv"]
    linked = (F.col("o.hull_iou") >= policy.hull_iou) | ((F.col("edge_touch") | F.col("r_edge_touch")) & near[0] & near[1]) | ((F.col("o.inter_u") > 0) & (F.col("o.inter_v") > 0))
    return pairs.filter(linked).select("parent", F.col("seq").alias("a"), F.col("r_seq").alias("b"))


def clusters(candidates: DataFrame, links: DataFrame) -> DataFrame:
    """parent, seq, cluster (the least seq linked to it). Links never leave a parent, so each parent's
    are joined by union-find in one task; candidates without links are their own clusters."""

    def united(frame: pd.DataFrame) -> pd.DataFrame:
        root = {int(x): int(x) for x in pd.concat([frame["a"], frame["b"]])}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(frame["a"], frame["b"], strict=True):
            a, b = find(int(a)), find(int(b))
            root[max(a, b)] = min(a, b)
        return pd.DataFrame({"parent": frame["parent"].iloc[0], "seq": list(root), "cluster": [find(x) for x in root]})

    kind = candidates.schema["parent"].dataType.simpleString()
    found = links.groupBy("parent").applyInPandas(united, f"parent {kind}, seq long, cluster long")
    return candidates.select("parent", "seq").join(found, ["parent", "seq"], "left").withColumn("cluster", F.coalesce("cluster", "seq"))


def with_clusters(candidates: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Candidates (as of `cluster_links`, with any other columns) and their cluster: what `cluster_links` and
    `clusters` give, in one pass over each parent's rows, which move once. Rows without a parent or seq
    are linked with nothing."""

    def united(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids = np.asarray(rows["seq"].fill_null(0), np.int64)
        at = np.flatnonzero(np.asarray(rows["parent"].is_valid()) & np.asarray(rows["seq"].is_valid()))
        some = rows.take(pa.array(at))
        number = lambda k: np.asarray(some[k].to_numpy(), np.float64)
        p = kernels.Polygons.of(some["poly"].combine_chunks() if some["poly"].num_chunks != 1 else some["poly"].chunk(0))
        edge = np.asarray(some["edge_touch"].fill_null(False))
        pairs = kernels.compatible_pairs(p, ids[at], number("angle"), edge, number("_c"), number("_s"), policy)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        for a, b in zip(*(ids[at[k]].tolist() for k in pairs), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        cluster = np.array([find(x) if x in root else x for x in ids.tolist()], np.int64)
        return rows.drop_columns(["_c", "_s"]).append_column("cluster", pa.array(cluster, mask=~np.asarray(rows["seq"].is_valid())))

    turned = candidates.withColumns({"_c": F.cos(F.radians("angle")), "_s": F.sin(F.radians("angle"))})
    return turned.groupBy("parent").applyInArrow(united, T.StructType([*candidates.schema.fields, T.StructField("cluster", T.LongType())]))


def best_candidates(members: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Of each cluster the candidate of the greatest score, then larger parent, then upper, then left
    tile, then first; with cluster_size, runner_up and ambiguous (the scores are close)."""
    by = Window.partitionBy("parent", "cluster")
    order = by.orderBy(F.desc("score"), F.desc(F.col("parent_width") * F.col("parent_height")), "tile_y", "tile_x", "seq")
    ranked = members.withColumns({"_n": F.row_number().over(order), "runner_up": F.lead("score").over(order), "cluster_size": F.count("*").over(by)})
    gap = F.col("score") - F.col("runner_up") < policy.winner_gap
    return ranked.filter("_n = 1").drop("_n").withColumn("ambiguous", F.coalesce(gap, F.lit(False)))


def merged_boxes(members: DataFrame, best: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Clusters of two or three candidates of like angle as one rectangle in the best one's frame:
    parent, cluster, box, points; only those that lie in the parent and can be fitted to it."""
    ref = best.select("parent", "cluster", "cluster_size", F.col("angle").alias("ref"), F.col("parent_width").alias("_w"), F.col("parent_height").alias("_h"))
    rows = members.select("parent", "cluster", "angle", "poly").join(ref, ["parent", "cluster"]).filter(F.col("cluster_size").between(2, 3))
    spans = g.once(rows, "e", g.extents(F.col("poly"), F.col("ref")))
    agg = spans.groupBy("parent", "cluster", "ref", "_w", "_h").agg(F.max(g.angle_difference(F.col("angle"), F.col("ref"))).alias("turn"), *[f(F.col(f"e.{k}")).alias(k) for f, k in ((F.min, "u0"), (F.max, "u1"), (F.min, "v0"), (F.max, "v1"))])
    return _as_one(agg, policy).filter("box IS NOT NULL").select("parent", "cluster", "box", "points")


def _as_one(spans: DataFrame, policy: Policy) -> DataFrame:
    """Adds box and points in the parent's _w and _h to spans u0, u1, v0, v1, in a frame turned by ref, of candidates
    that differ by `turn` from it at most; both null if they can't be one box."""
    able = (F.col("turn") <= policy.cluster_angle) & (F.col("u1") > F.col("u0")) & (F.col("v1") > F.col("v0"))
    c, s = F.cos(F.radians("ref")), F.sin(F.radians("ref"))
    corner = lambda u, v: g.point(F.col(u) * c - F.col(v) * s, F.col(u) * s + F.col(v) * c)
    out = g.once(spans, "raw", F.when(able, F.array(corner("u0", "v0"), corner("u1", "v0"), corner("u1", "v1"), corner("u0", "v1"))))
    fits = g.inside_pixels(F.col("raw"), F.col("_w"), F.col("_h"), policy.edge_touch)
    out = g.once(out, "points", F.when(F.col("raw").isNotNull() & fits, g.truncate_box(g.rotated_box(F.col("raw")), F.col("_w"), F.col("_h"))))
    out = g.once(out, "box", F.when(F.col("points").isNotNull(), g.rotated_box(F.col("points"))))
    return out.withColumn("points", F.when(F.col("box").isNotNull(), F.col("points"))).drop("raw")


def recover(candidates: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The recovered annotations of parents: merged clusters, else the best candidate of each. Columns
    parent, cluster, cluster_size, source_kind, ambiguous, score, points."""
    held = ["parent", "seq", "poly", "angle", "edge_touch", "source_kind", "score", "parent_width", "parent_height", "tile_x", "tile_y"]
    members = with_clusters(with_score(candidates, policy).select(*held), policy).drop("edge_touch")
    by = Window.partitionBy("parent", "cluster")
    order = by.orderBy(F.desc("score"), F.desc(F.col("parent_width") * F.col("parent_height")), "tile_y", "tile_x", "seq")
    ranked = members.withColumns({"_n": F.row_number().over(order), "runner_up": F.lead("score").over(order), "cluster_size": F.count("*").over(by), "ref": F.first("angle").over(order)})
    # A cluster's spans are windows too, so that its members move once more and not again for the merged box.
    few = ranked.withColumn("_few", F.when(F.col("cluster_size").between(2, 3) & F.col("parent").isNotNull(), F.col("poly")))
    few = g.once(few, "e", F.when(F.col("_few").isNotNull(), g.extents(F.col("_few"), F.col("ref")))).drop("_few")
    spans = {k: f(F.col(f"e.{k}")).over(by) for f, k in ((F.min, "u0"), (F.max, "u1"), (F.min, "v0"), (F.max, "v1"))}
    best = few.withColumns({"turn": F.max(g.angle_difference(F.col("angle"), F.col("ref"))).over(by), **spans}).filter("_n = 1")
    gap = F.coalesce(F.col("score") - F.col("runner_up") < policy.winner_gap, F.lit(False))
    best = best.withColumn("ambiguous", gap).drop("_n", "runner_up", "e", "seq", "angle", "tile_x", "tile_y")
    merged = _as_one(best.withColumns({"_w": F.col("parent_width"), "_h": F.col("parent_height")}), policy).withColumnRenamed("points", "merged")
    kind = F.when(F.col("merged").isNotNull(), "merged").otherwise(F.col("source_kind"))
    ambiguous = F.col("ambiguous") & F.col("merged").isNull()
    return merged.select("parent", "cluster", "cluster_size", kind.alias("source_kind"), ambiguous.alias("ambiguous"), "score", F.coalesce("merged", "poly").alias("points"))


def cluster_order(members: DataFrame) -> DataFrame:
    """parent, cluster, cluster_size, cluster_index: a parent's clusters by their uppermost, then leftmost
    tile, then by size, then by their first candidate."""
    found = members.groupBy("parent", "cluster").agg(F.min("tile_y").alias("_y"), F.min("tile_x").alias("_x"), F.count("*").alias("cluster_size"))
    order = Window.partitionBy("parent").orderBy("_y", "_x", "cluster_size", "cluster")
    return found.withColumn("cluster_index", F.row_number().over(order) - 1).drop("_y", "_x")


def review_entries(members: DataFrame, recovered: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """One row per cluster whose winner is unclear: parent, cluster, candidate_count, score_gap and its
    candidates by falling score."""
    listed = F.sort_array(F.collect_list(F.struct("score", "seq", "source_kind", "edge_touch", "margin")), asc=False)
    unclear = recovered.filter("ambiguous").select("parent", "cluster")
    out = members.join(unclear, ["parent", "cluster"]).groupBy("parent", "cluster").agg(F.count("*").alias("candidate_count"), listed.alias("candidates"))
    return out.withColumn("score_gap", g.round_half_up(F.col("candidates")[0]["score"] - F.col("candidates")[1]["score"], 3))


def parent_summary(parents: DataFrame, candidates: DataFrame, recovered: DataFrame) -> DataFrame:
    """One row per parent: candidates, annotation_count, merged_count, review_cluster_count,
    raw_fallback_used and source_kind (merged before cleaned before raw_fallback, empty without any)."""
    held = candidates.groupBy("parent").agg(F.count("*").alias("candidates"), F.max(F.col("source_kind") == "raw_fallback").alias("raw_fallback_used"))
    made = recovered.groupBy("parent").agg(
        F.count("*").alias("annotation_count"), F.count_if(F.col("source_kind") == "merged").alias("merged_count"), F.count_if("ambiguous").alias("review_cluster_count"),
        F.max(F.col("source_kind") == "cleaned").alias("_cleaned"),
    )
    out = parents.select("parent").distinct().join(held, "parent", "left").join(made, "parent", "left")
    out = out.fillna(0, ["candidates", "annotation_count", "merged_count", "review_cluster_count"]).fillna(False, ["raw_fallback_used", "_cleaned"])
    kind = F.when(F.col("annotation_count") == 0, "empty").when(F.col("merged_count") > 0, "merged").when(F.col("_cleaned"), "cleaned").otherwise("raw_fallback")
    return out.withColumn("source_kind", kind).drop("_cleaned")


def recovery_summary(parents: DataFrame, cleaned: DataFrame, summary: DataFrame) -> DataFrame:
    """One row: parents of the membership, cleaned ones, stale ones (cleaned but no member), members
    without a cleaned file, those that fell back on raw labels, empty ones; candidates, clusters, merged
    and unclear clusters. parents and cleaned: parent; summary: that of `parent_summary`."""
    both = parents.select("parent").distinct().withColumn("_in", F.lit(True)).join(cleaned.select("parent").distinct().withColumn("_clean", F.lit(True)), "parent", "full_outer")
    counts = both.agg(
        F.count("_in").alias("membership_parent_count"), F.count_if(F.col("_in") & F.col("_clean")).alias("cleaned_parent_count"),
        F.count_if(F.col("_in").isNull()).alias("stale_cleaned_parent_count"), F.count_if(F.col("_clean").isNull()).alias("missing_current_parent_count"),
    )
    made = summary.agg(
        F.count_if("raw_fallback_used").alias("raw_fallback_parents"), F.count_if(F.col("source_kind") == "empty").alias("empty_parent_count"), F.coalesce(F.sum("candidates"), F.lit(0)).alias("lifted_candidate_count"),
        F.coalesce(F.sum("annotation_count"), F.lit(0)).alias("cluster_count"), F.coalesce(F.sum("merged_count"), F.lit(0)).alias("merged_cluster_count"), F.coalesce(F.sum("review_cluster_count"), F.lit(0)).alias("ambiguous_cluster_count"),
    )
    return counts.crossJoin(made)  # one row each
