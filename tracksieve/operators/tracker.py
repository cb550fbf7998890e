"""Greedy overlap tracking, one video at a time, with the state kept between frames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stages import ship

MATCH, MAX_AGE = 0.3, 10  # least overlap of a match; a track this old is dropped


class Tracker:
    """Boxes in order take the free track they overlap most (strictly); else they open one, which stays free in this
    call and leaves it with age 1. Calls without boxes age the tracks as well."""

    def __init__(self, tracks: list | None = None, last: int = 0):
        self.tracks, self.last = tracks or [], last  # [id, box, age]

    def update(self, boxes: list[tuple[float, float, float, float]]) -> list[int]:
        self.tracks = [t for t in self.tracks if t[2] < MAX_AGE]
        taken: set[int] = set()
        out = []
        for box in boxes:
            best, score = None, 0.0
            for track in self.tracks:
                if track[0] not in taken and (over := overlap(track[1], box)) > score:
                    best, score = track, over
            if best is not None and score >= MATCH:
                best[1], best[2] = box, 0
                taken.add(best[0])
                out.append(best[0])
            else:
                self.last += 1
                self.tracks.append([self.last, box, 0])
                out.append(self.last)
        for track in self.tracks:
            if track[0] not in taken:
                track[2] += 1
        return out


def overlap(a, b) -> float:
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter + 1e-9)


def run_frames(tracker: Tracker, rows: pd.DataFrame) -> pd.DataFrame:
    """Track ids for rows (frame_idx, seq, entity_type, x1..y2; null seq: a frame without boxes), logos before faces."""
    found = []
    for _, frame in rows.sort_values(["frame_idx", "seq"]).groupby("frame_idx", sort=True):
        for kind in ("logo", "face"):
            own = frame[(frame.entity_type == kind) & frame.seq.notna()]
            found += zip(own.seq, tracker.update(list(own[["x1", "y1", "x2", "y2"]].itertuples(index=False, name=None))))
    return pd.DataFrame(found, columns=["seq", "assigned"]).astype("int64")


def track(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """(video_path, seq, assigned): driven by the frames (video_path, frame_idx), so that empty ones age the tracks."""
    ship(frames.sparkSession)
    rows = frames.join(boxes, ["video_path", "frame_idx"], "left")

    def one(video: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return run_frames(Tracker(), pdf).assign(video_path=video[0])[["video_path", "seq", "assigned"]]

    cols = ("video_path", "frame_idx", "seq", "entity_type", "x1", "y1", "x2", "y2")
    return rows.select(*cols).groupBy("video_path").applyInPandas(one, "video_path string, seq long, assigned long").withColumn(
        "display_track", F.col("assigned")
    )
