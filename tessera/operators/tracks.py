"""Tracks of polygons over video frames: assignment, gap filling, smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.kernels import Polygons
from ..policy import DEFAULT, Policy

OBSERVATION = "video string, frame long, det long, cls string, conf double, poly array<struct<x:double,y:double>>, track_id long"


def aligned(poly: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The cyclic shift of four corners nearest to the reference's, the first on ties."""
    shifts = [np.roll(poly, -k, 0) for k in range(4)]
    return shifts[int(np.argmin([((s - reference) ** 2).sum() for s in shifts]))]


def _spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of quadrilaterals (n, 4, 2): least and greatest corner, vertex mean, and diagonal of the envelope."""
    low, high = x.min(1), x.max(1)
    return low, high, x.sum(1) / 4, np.sqrt(((high - low) ** 2).sum(1))


def scores(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of pairs of quadrilaterals (n, 4, 2): 0.7 of the IoU and 0.3 of the nearness of the vertex means.
    Only pairs whose envelopes meet are clipped."""
    (a0, a1, ma, da), (b0, b1, mb, db) = _spread(first), _spread(second)
    apart = np.sqrt(((ma - mb) ** 2).sum(1))
    out = 0.3 * np.maximum(0.0, 1 - apart / np.maximum(64.0, 2.5 * np.maximum(da, db)))
    meet = np.flatnonzero(((a0 < b1) & (b0 < a1)).all(1))
    if len(meet):
        four = np.full(len(meet), 4)
        p, q = (Polygons(x[meet, :, 0], x[meet, :, 1], four) for x in (first, second))
        inter = p.within(q).area()
        union = p.area() + q.area() - inter
        out[meet] += 0.7 * np.divide(inter, union, out=np.zeros_like(inter), where=union >= 1)
    return out


class Tracker:
    """Greedy assignment of one video's detections, frame by frame. Tracks unseen for more than the
    gap are forgotten; the state is their last frame, class and polygon. A detection that goes on a
    track gets its corners in the order of the track's last polygon."""

    def __init__(self, policy: Policy = DEFAULT, next_id: int = 1, active: list | None = None):
        self.policy, self.next_id, self.active = policy, next_id, {t[0]: (t[1], t[2], np.array(t[3])) for t in active or []}

    def update(self, frame: int, detections: list[tuple[str, np.ndarray]]) -> tuple[list[int], list[np.ndarray]]:
        """Track ids and aligned polygons of a frame's detections."""
        reach = self.policy.track_gap + 1
        self.active = {t: v for t, v in self.active.items() if frame - v[0] <= reach}
        ids, polys, used = [0] * len(detections), [poly for _, poly in detections], set()
        if self.active and detections:
            tracks = list(self.active)
            last, new = np.array([self.active[t][2] for t in tracks]), np.array(polys)
            classes = {c: k for k, c in enumerate({v[1] for v in self.active.values()} | {c for c, _ in detections})}
            same = np.array([classes[self.active[t][1]] for t in tracks])[:, None] == np.array([classes[c] for c, _ in detections])
            # Beyond the reach of nearness polygons don't overlap either, and the score is 0.
            (*_, middle, size), (*_, others, sizes) = _spread(last), _spread(new)
            apart = np.sqrt(((middle[:, None] - others) ** 2).sum(2))
            at, d = np.nonzero(same & (apart < np.maximum(64.0, 2.5 * np.maximum(size[:, None], sizes))))
            found = scores(last[at], new[d])
            good = found >= self.policy.track_match
            for _, t, k in sorted(zip((-found[good]).tolist(), (tracks[i] for i in at[good]), d[good].tolist(), strict=True)):
                if not ids[k] and t not in used:
                    ids[k], polys[k] = t, aligned(polys[k], self.active[t][2])
                    used.add(t)
        for k, (name, _) in enumerate(detections):
            if not ids[k]:
                ids[k], self.next_id = self.next_id, self.next_id + 1
            self.active[ids[k]] = (frame, name, polys[k])
        return ids, polys

    def state(self) -> list:
        return [(t, f, c, p.tolist()) for t, (f, c, p) in self.active.items()]


def _polygon(points) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points], dtype=float)


def run_frames(tracker: Tracker, rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of one video, sorted here by frame and detection, with their track ids, and polygons whose
    corners go in the track's order."""
    rows = rows.sort_values(["frame", "det"], kind="stable")
    frames, classes, given = rows["frame"].to_numpy(), rows["cls"].tolist(), [_polygon(p) for p in rows["poly"]]
    ids: list[int] = []
    polys: list[list[dict]] = []
    cuts = [0, *(np.flatnonzero(np.diff(frames)) + 1).tolist(), len(rows)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        found, placed = tracker.update(int(frames[a]), list(zip(classes[a:b], given[a:b], strict=True))) if b > a else ([], [])
        ids += found
        polys += [[{"x": float(x), "y": float(y)} for x, y in p] for p in placed]
    return rows.assign(track_id=ids, poly=pd.Series(polys, index=rows.index, dtype=object))


def track_batches(batches: Iterator[pa.RecordBatch], policy: Policy = DEFAULT) -> Iterator[pa.RecordBatch]:
    """Batches of observations (video, stretch, frame, det, cls, conf, poly) in that order with their track ids
    and aligned polygons. Frames, which may go on in the next batch, are taken one by one: only a batch, a
    frame and the tracks in reach are held, however long a video is."""
    tracker, at, held = Tracker(policy), None, None

    def placed(rows: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
        nonlocal tracker, at
        videos, stretches, frames, classes = (rows.column(c).to_pylist() for c in ("video", "stretch", "frame", "cls"))
        points = rows.column("poly").flatten()
        given = np.stack([points.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1).reshape(-1, 4, 2)
        ids, polys = [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if at != (videos[a], stretches[a]):
                at, tracker = (videos[a], stretches[a]), Tracker(policy)
            found, shown = tracker.update(frames[a], list(zip(classes[a:b], given[a:b], strict=True)))
            ids += found
            polys += shown
        flat = np.array(polys).reshape(-1, 2)
        rings = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
        poly = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 4), pa.int32()), rings)
        names = ["video", "stretch", "frame", "det", "cls", "conf"]
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), poly, pa.array(ids, pa.int64())], [*names, "poly", "track_id"])

    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        videos = rows.column("video").dictionary_encode().indices.fill_null(-1).to_numpy()
        new = np.diff(videos) != 0
        for name in ("stretch", "frame"):
            new |= np.diff(rows.column(name).to_numpy()) != 0
        cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
        if len(cuts) > 1:
            yield placed(rows.slice(0, int(cuts[-1])), cuts)
        held = rows.slice(int(cuts[-1]))
    if held is not None:
        yield placed(held, np.array([0, held.num_rows]))


def assign_tracks(detections: DataFrame, policy: Policy = DEFAULT, stretches: int = 256) -> DataFrame:
    """Adds track_id to detections (video, frame, det, cls, conf, poly of four corners). No track goes
    over more than `track_gap` frames without a detection, so a video is cut there: each `stretches` of them
    are one ordered group, and its ids go on from those of the groups before it. A group streams through its
    task in the order of frames, so that its length doesn't bound memory."""

    rows = detections.select("video", F.col("frame").cast("long").alias("frame"), F.col("det").cast("long").alias("det"), "cls", F.col("conf").cast("double").alias("conf"), "poly")
    frames = rows.select("video", "frame").distinct()
    order = Window.partitionBy("video").orderBy("frame")
    starts = (F.col("frame") - F.lag("frame").over(order) > policy.track_gap + 1).cast("int")
    frames = frames.withColumn("_new", F.coalesce(starts, F.lit(0))).withColumn("stretch", F.floor(F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)) / stretches)).drop("_new")
    ordered = rows.join(frames, ["video", "frame"]).select("video", "stretch", "frame", "det", "cls", "conf", "poly").repartition("video", "stretch").sortWithinPartitions("video", "stretch", "frame", "det")
    found = ordered.mapInArrow(lambda batches: track_batches(batches, policy), f"video string, stretch long, {OBSERVATION.removeprefix('video string, ')}")
    made = found.groupBy("video", "stretch").agg(F.max("track_id").alias("_made"))
    before = Window.partitionBy("video").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumn("_before", F.coalesce(F.sum("_made").over(before), F.lit(0))).drop("_made")
    return found.join(made, ["video", "stretch"]).withColumn("track_id", F.col("track_id") + F.col("_before")).drop("_before", "stretch").select("video", "frame", "det", "cls", "conf", "poly", "track_id")


def fill_gaps(tracks: DataFrame, by: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """Observations (by, frame, conf, poly) and, in gaps of at most `track_gap` frames, polygons
    interpolated between both ends with the lesser confidence; interpolated tells them apart."""
    following = Window.partitionBy(*by).orderBy("frame")
    step = tracks.withColumns({"_f": F.lead("frame").over(following), "_p": F.lead("poly").over(following), "_c": F.lead("conf").over(following)})
    gap = F.col("_f") - F.col("frame") - 1
    holes = step.filter((gap >= 1) & (gap <= policy.track_gap)).withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), gap)))
    share = F.col("_k") / (F.col("_f") - F.col("frame"))
    between = F.zip_with("poly", "_p", lambda p, q: g.point(p["x"] + (q["x"] - p["x"]) * share, p["y"] + (q["y"] - p["y"]) * share))
    # One after another: an expression inside a lambda would see a `frame` that is set beside it.
    made = holes.withColumn("poly", between).withColumn("conf", F.least("conf", "_c")).withColumn("frame", F.col("frame") + F.col("_k")).select(*tracks.columns).withColumn("interpolated", F.lit(True))
    return tracks.withColumn("interpolated", F.lit(False)).unionByName(made)


def smooth(tracks: DataFrame, by: list[str], policy: Policy = DEFAULT) -> DataFrame:
    """Mean of each corner over window // 2 frames on both sides, within runs of consecutive frames;
    then the cyclic shift nearest to the row's own polygon. A window of 1 or less changes nothing."""
    if policy.track_window <= 1:
        return tracks
    reach = policy.track_window // 2
    order = Window.partitionBy(*by).orderBy("frame")
    runs = tracks.withColumn("_run", F.col("frame") - F.row_number().over(order))
    around = Window.partitionBy(*by, "_run").orderBy("frame").rowsBetween(-reach, reach)
    mean = lambda k, axis: F.avg(F.get("poly", F.lit(k))[axis]).over(around)
    corners = runs.withColumns({f"_{axis}{k}": mean(k, axis) for k in range(4) for axis in "xy"})
    poly = F.array(*[g.point(F.col(f"_x{k}"), F.col(f"_y{k}")) for k in range(4)])
    return corners.withColumn("poly", g.align_polygon(poly, F.col("poly"))).select(*tracks.columns)


def frame_counts(tracks: DataFrame, video: str, first: Column, last: Column) -> DataFrame:
    """Detections of every frame of each video, those without any too."""
    spine = tracks.groupBy(video).agg(first.alias("_a"), last.alias("_b")).select(video, F.explode(F.sequence("_a", "_b")).alias("frame"))
    counts = tracks.groupBy(video, "frame").agg(F.count("*").alias("n"))
    return spine.join(counts, [video, "frame"], "left").fillna(0, ["n"])


def track_lengths(tracks: DataFrame, by: list[str]) -> DataFrame:
    """tracks, shortest, mean and longest number of observations of a track, for each group."""
    lengths = tracks.groupBy(*by, "track_id").agg(F.count("*").alias("n"))
    return lengths.groupBy(*by).agg(F.count("*").alias("tracks"), F.min("n").alias("shortest"), g.round_half_up(F.avg("n"), 4).alias("mean_length"), F.max("n").alias("longest"))



def final_by_frame(tracks: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """What a video shows in the end: gaps filled, polygons smoothed, and place, the order of a frame's
    detections by track, class and falling confidence. tracks: video, track_id, frame, cls, conf, poly."""
    by = ["video", "track_id"]
    done = smooth(fill_gaps(tracks.select(*by, "frame", "cls", "conf", "poly"), by, policy), by, policy)
    order = Window.partitionBy("video", "frame").orderBy("track_id", "cls", F.desc("conf"))
    return done.withColumn("place", F.row_number().over(order))
