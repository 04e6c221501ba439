"""The frame tracker over a stream: state per video, rows in append mode."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..operators.tracks import OBSERVATION, Tracker, run_frames
from ..policy import DEFAULT, Policy

STATE = "next_id long, last_frame long, active string"


def track_stream(detections: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Adds track_id to a stream of detections (video, frame, det, cls, conf, poly).

    A video's state is its next id, its last frame and the last polygon of tracks that are still within
    the gap, so it stays small however long the stream runs. Frames of a video must come in order
    from one micro-batch to the next: rows of frames up to the last one processed are late and left
    out. Gap filling and smoothing need later frames and are batch steps over what this writes.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        next_id, last, active = state.get if state.exists else (1, -1, "[]")
        tracker = Tracker(policy, next_id, [tuple(t) for t in json.loads(active)])
        rows = pd.concat(list(frames), ignore_index=True)
        rows = rows[rows["frame"] > last]
        if len(rows):
            out = run_frames(tracker, rows)
            state.update((tracker.next_id, int(rows["frame"].max()), json.dumps(tracker.state())))
            yield out[["video", "frame", "det", "cls", "conf", "poly", "track_id"]]

    rows = detections.select("video", "frame", "det", "cls", "conf", "poly")
    return rows.groupBy("video").applyInPandasWithState(advance, OBSERVATION, STATE, "append", "NoTimeout")
