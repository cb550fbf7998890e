"""Structured Streaming forms: tracking with state per video, daily snapshots with a watermark."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracker import Tracker, run_frames
from ..plans.stages import shared_dir, ship


def tracked(boxes: DataFrame) -> DataFrame:
    """(video_path, seq, assigned) of a stream of boxes; the tracker's state is kept per video across batches.
    Frames are taken in order within a batch; boxes of a frame that comes after a later one was tracked come out
    unassigned, as what was tracked can't be tracked again."""

    def one(video: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracks, last, frame = pickle.loads(state.get[0]) if state.exists else ([], 0, -1)
        rows = pd.concat(list(parts))
        late = rows[rows.frame_idx <= frame]
        if len(late):
            yield pd.DataFrame({"video_path": video[0], "seq": late.seq.to_numpy(), "assigned": pd.array([None] * len(late), "Int64")})
        rows = rows[rows.frame_idx > frame]
        tracker = Tracker(tracks, last)
        if len(rows):
            yield run_frames(tracker, rows).assign(video_path=video[0])[["video_path", "seq", "assigned"]]
            frame = int(rows.frame_idx.max())
        state.update((pickle.dumps((tracker.tracks, tracker.last, frame)),))

    cols = ("video_path", "frame_idx", "seq", "entity_type", "x1", "y1", "x2", "y2")
    return boxes.select(*cols).groupBy("video_path").applyInPandasWithState(one, "video_path string, seq long, assigned long", "state binary", "append", GroupStateTimeout.NoTimeout)


def _finish(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Runs a stream over all that is there and returns what it wrote."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if mode == "append":
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    else:  # the last batch has the whole result
        stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/out")).option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def tracked_once(spark: SparkSession, boxes: DataFrame) -> DataFrame:
    ship(spark)
    base = f"{shared_dir(spark)}/boxes-{uuid.uuid4().hex}"
    boxes.write.parquet(base)
    return _finish(tracked(spark.readStream.schema(boxes.schema).parquet(base)), "append", "tracked")


def snapshots(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Counts per day and video. In append mode a day comes out, and its state goes, once the watermark has passed it; in
    complete mode, as snapshots_once() runs it, all days stay, a row a day and video."""
    at = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    day = at.groupBy(F.window("at", "1 day"), (F.col("user_id") % 4).alias("video")).agg(F.count("*").alias("total_crops"), F.count_if(F.col("value") / 100 >= 0.85).alias("auto_accept"))
    return day.select(F.date_format("window.start", "yyyy-MM-dd").alias("date_str"), "video", "total_crops", "auto_accept")


def snapshots_once(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    events = spark.readStream.schema(schema).option("pathGlobFilter", name if name.endswith(".parquet") else "*.parquet").parquet(folder)
    return _finish(snapshots(events), "complete", "snapshots")
