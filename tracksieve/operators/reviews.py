"""The review queue's counts and lists, a reviewer's session, and what a reviewer is shown."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranks import ranked


def counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("state").agg(F.count("*").alias("n"))


def lists(queue: DataFrame) -> DataFrame:
    """The queue with each entry's place in the list of its state."""
    return ranked(queue, ["enqueued", "cluster_id"], ("state",), "place")


def session(pending: DataFrame, said: DataFrame, keys: list[str]) -> DataFrame:
    """pending (keys, clip_label) with `outcome` and `hitl_label`, from what was said (keys, action, typed): an action
    that confirms without a suggestion asks for a label, an empty label skips, and what wasn't spoken of is skipped."""
    out = pending.join(said, keys, "left")
    action = F.when((F.col("action") == "confirm") & F.col("clip_label").isNull(), "label").otherwise(F.coalesce("action", F.lit("skip")))
    label = F.when(action == "confirm", F.col("clip_label")).when(action == "label", F.nullif(F.lower(F.trim("typed")), F.lit("")))
    outcome = F.when(action == "reject", "rejected").when(label.isNotNull(), "hitl_confirmed").otherwise("skipped")
    return out.withColumn("outcome", outcome).withColumn("hitl_label", label)


def session_totals(done: DataFrame) -> DataFrame:
    skipped = F.count_if(F.col("outcome") == "skipped")
    return done.agg(F.count("*").alias("pending"), (F.count("*") - skipped).alias("reviewed"), F.count_if(F.col("outcome") == "hitl_confirmed").alias("confirmed"), skipped.alias("skipped"))


def sample_frames(members: DataFrame, crops: DataFrame, tracks: int = 3, each: int = 2, most: int = 5) -> DataFrame:
    """(video_path, component, sample_frames): the first crops of a cluster's first tracklets, as a reviewer reads them."""
    w = Window.partitionBy("video_path", "component")
    first = members.withColumn("t", F.row_number().over(w.orderBy("node"))).where(F.col("t") <= tracks)
    own = crops.join(first.select("video_path", "entity_type", "track_id", "component", "t"), ["video_path", "entity_type", "track_id"])
    own = own.withColumn("c", F.row_number().over(Window.partitionBy("video_path", "component", "t").orderBy("seq"))).where(F.col("c") <= each)
    own = own.withColumn("rn", F.row_number().over(w.orderBy("t", "c"))).where(F.col("rn") <= most)
    told = F.format_string("frame %d @ %.1fs", "frame_idx", F.col("timestamp_ms") / 1000)
    listed = F.array_sort(F.collect_list(F.struct("rn", told.alias("told"))))
    return own.groupBy("video_path", "component").agg(F.array_join(F.transform(listed, lambda x: x["told"]), ", ").alias("sample_frames"))
