"""From boxes to dataset records, phase by phase; each a function of DataFrames, none of which collects rows.

Crops have video_path, entity_type, track_id, frame_idx, seq (arrival order), x1..y2, det_score, embedding, frame_label.
A tracklet is keyed by (video_path, entity_type, track_id); its node is the seq of its first crop.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import geometry, scores, vectors
from . import funnel, graph, tracker
from .ranks import ranked

TRACK = ["video_path", "entity_type", "track_id"]
CLUSTER = ["video_path", "component"]

# The labels that a simulated reviewer gives.
LOGO_LABELS = ("nike", "adidas", "puma", "lululemon", "champion", "under_armour")
FACE_LABELS = ("athlete_unknown", "coach_unknown", "referee")


def scenes_or_default(videos: DataFrame, scenes: DataFrame) -> DataFrame:
    """(video_path, scene, first_frame, end_frame): half-open ranges; a video without any is one scene of all its frames."""
    own = videos.join(scenes, "video_path", "left")
    return own.select("video_path", F.coalesce("scene", F.lit(0)).alias("scene"), F.coalesce("first_frame", F.lit(0)).alias("first_frame"), F.coalesce("end_frame", "frame_count").alias("end_frame"))


def keyframes(scenes: DataFrame, share: float, order: Column, seed: str = "scene") -> DataFrame:
    """(video_path, scene, frame_idx): max(1, floor(share * n)) frames of each scene, the first by `order` of the frame."""
    frames = scenes.where("end_frame > first_frame").select("video_path", "scene", F.explode(F.sequence(F.col("first_frame"), F.col("end_frame") - 1)).alias("frame_idx"), (F.col("end_frame") - F.col("first_frame")).alias("n"))
    own = ranked(frames.withColumn("_o", order), ["_o", "frame_idx"], ("video_path", "scene"), "_rank")
    return own.where(F.col("_rank") < F.greatest(F.lit(1), F.floor(F.lit(share) * F.col("n")))).select("video_path", "scene", "frame_idx")


def seeded(*parts: str) -> Column:
    """An order that depends on values alone, the same in every process."""
    return F.xxhash64(*parts)


def phase1(frames: DataFrame, boxes: DataFrame, config: Config) -> DataFrame:
    """Boxes tracked over the given frames, as crops: small or unsure faces go before tracking, narrow logos after it."""
    kept = boxes.where((F.col("entity_type") == "logo") | geometry.keep_detection(config.min_logo_px, config.min_face_px, config.face_det_score))
    found = tracker.track(frames, kept.select("video_path", "frame_idx", "seq", "entity_type", "x1", "y1", "x2", "y2"))
    out = kept.join(found.select("video_path", "seq", F.col("assigned").alias("track_id")), ["video_path", "seq"])
    return named(out.where(geometry.keep_detection(config.min_logo_px, config.min_face_px, config.face_det_score)), config)


def named(boxes: DataFrame, config: Config) -> DataFrame:
    """boxes with crop_id, display_track and timestamp_ms."""
    crop = F.concat_ws("_", "entity_type", F.conv(F.substring(F.md5("video_path"), 1, 8), 16, 10), "frame_idx", "track_id")
    return boxes.withColumn("crop_id", crop).withColumn("display_track", F.when(F.col("entity_type") == "face", F.col("track_id") + 10000).otherwise(F.col("track_id"))).withColumn("timestamp_ms", F.col("frame_idx") * F.lit(config.frame_ms))


def size_counts(boxes: DataFrame, config: Config) -> DataFrame:
    """Per video: what detection found, and what the size filters dropped, by kind."""
    kept, logo = geometry.keep_detection(config.min_logo_px, config.min_face_px, config.face_det_score), F.col("entity_type") == "logo"
    return boxes.groupBy("video_path").agg(F.count("*").alias("boxes"), F.count_if(kept & logo).alias("logos"), F.count_if(kept & ~logo).alias("faces"), F.count_if(~kept & logo).alias("small_logos"), F.count_if(~kept & ~logo).alias("small_faces"))


def same_size(crops: DataFrame, keys: list[str], order: str, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is as long as their group's first by `order`."""
    first = crops.groupBy(*keys).agg(F.min_by(F.size(vector), order).alias("_size"))
    return crops.join(first, keys).where(F.size(vector) == F.col("_size")).drop("_size")


def mean_vectors(df: DataFrame, keys: list[str], vector: str = "embedding", weight: str | None = None, guard: float = 0.0) -> DataFrame:
    """(keys, mean_embedding): the mean, partially summed in each task, made a unit vector unless it is zero."""
    x = array_to_vector(F.col(vector).cast("array<double>"))
    mean = Summarizer.mean(x) if weight is None else Summarizer.mean(x, F.col(weight).cast("double"))
    return df.groupBy(*keys).agg(vector_to_array(mean).alias("_m")).select(*keys, vectors.unit(F.col("_m"), guard).alias("mean_embedding"))


def phase3(crops: DataFrame) -> DataFrame:
    """(video_path, entity_type, track_id, node, frame_count, mean_embedding) of each tracklet."""
    sizes = crops.groupBy(*TRACK).agg(F.count("*").alias("frame_count"), F.min("seq").alias("node"))
    return sizes.join(mean_vectors(same_size(crops, TRACK, "seq"), TRACK), TRACK)


def forced_links(tracklets: DataFrame) -> DataFrame:
    """(src, dst): nodes of one track and video are linked to the first of them, whatever their vectors."""
    first = tracklets.groupBy("video_path", "track_id").agg(F.min("node").alias("src"))
    return tracklets.join(first, ["video_path", "track_id"]).where("node > src").select("src", F.col("node").alias("dst"))


def clustered(tracklets: DataFrame, cut: float, forced: bool = False) -> DataFrame:
    """tracklets with `component`, the smallest node of their cluster; only one video's and one type's are compared."""
    group = F.concat_ws("|", "video_path", "entity_type")
    links = graph.similar_links(tracklets.select("node", F.col("mean_embedding").alias("embedding"), group.alias("entity")), cut, "node")
    if forced:
        links = links.unionByName(forced_links(tracklets))
    return tracklets.join(graph.components(links, tracklets, "node"), "node")


def assembled(members: DataFrame) -> DataFrame:
    """(video_path, component, entity_type, tracklets, sample_count, tss, cluster_idx): logos before faces in a video."""
    n = F.count("*")
    x = array_to_vector(F.col("mean_embedding"))
    total, squares = vector_to_array(Summarizer.sum(x)), vector_to_array(Summarizer.normL2(x))
    each = members.groupBy(*CLUSTER, "entity_type").agg(n.alias("tracklets"), F.sum("frame_count").alias("sample_count"), total.alias("_s"), squares.alias("_q"))
    pairs = F.col("tracklets") * (F.col("tracklets") - 1)
    raw = (vectors.dot("_s", "_s") - vectors.dot("_q", "_q")) / F.nullif(pairs, F.lit(0))
    each = each.withColumn("tss", F.when(F.col("tracklets") < 2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))).drop("_s", "_q")
    return ranked(each.withColumn("_o", F.when(F.col("entity_type") == "logo", 0).otherwise(1)), ["_o", "component"], ("video_path",), "cluster_idx").drop("_o")


def representatives(members: DataFrame, crops: DataFrame, n: int = 5) -> DataFrame:
    """(video_path, component, seq, embedding): of each cluster the n crops nearest its mean; all if there are no more.
    Crops count as unit vectors in double: as floats they are that only nearly, and two tracklets of one size, which tie by
    their distance from the mean of both, would be told apart by what their norms lack, not by seq."""
    own = crops.join(members.select(*TRACK, "component"), TRACK).select("video_path", "component", "seq", vectors.unit("embedding").alias("embedding"))
    means = mean_vectors(own, CLUSTER, guard=1e-9)
    near = own.join(means, CLUSTER).withColumn("sim", F.round(vectors.dot("embedding", "mean_embedding"), 9))
    return funnel.capped(near, CLUSTER, [F.desc("sim"), F.col("seq")], n).select(*CLUSTER, "seq", "embedding")


def labelled(clusters: DataFrame, reps: DataFrame, entities: DataFrame, config: Config) -> DataFrame:
    """clusters with clip_label, clip_score, status and cluster_id. entities: (entity_type, name, idx, vector), the known
    ones, a list kept by hand: each cluster's mean over its representatives is held against those of its type, the
    first of the nearest counts. Unknown clusters are numbered by type over all videos."""
    mean = mean_vectors(reps, CLUSTER, guard=1e-9)
    own = clusters.select(*CLUSTER, "entity_type").join(mean, CLUSTER).join(entities, "entity_type")
    sim = F.round(vectors.dot("mean_embedding", "vector"), 9)
    best = own.groupBy(*CLUSTER).agg(F.max_by(F.struct("name", sim.alias("sim")), F.struct(sim.alias("s"), (-F.col("idx")).alias("i"))).alias("b"))
    out = clusters.join(best, CLUSTER, "left").withColumn("clip_score", F.coalesce("b.sim", F.lit(0.0)))
    out = out.withColumn("status", scores.status(F.col("clip_score"), config)).withColumn("clip_label", F.when(F.col("status") == "known", F.replace(F.col("b.name"), F.lit(" "), F.lit("_")))).drop("b")
    known = out.where("status = 'known'").withColumn("cluster_id", F.format_string("cluster_%04d", "cluster_idx"))
    lost = ranked(out.where("status = 'unknown'"), ["video_path", "cluster_idx"], ("entity_type",), "_rank")
    kind = F.when(F.col("entity_type") == "logo", "brand").otherwise("face")
    return known.unionByName(lost.withColumn("cluster_id", F.format_string("%s_unknown_%03d", kind, F.col("_rank") + 1)).drop("_rank"))


def phase4(tracklets: DataFrame, crops: DataFrame, entities: DataFrame, config: Config, cut: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(clusters, members): tracklets to clusters to labels. No tracklets give no clusters."""
    members = graph.written(clustered(tracklets, config.edge_threshold if cut is None else cut), "members")
    return labelled(assembled(members), representatives(members, crops), entities, config), members


def voted(crops: DataFrame, config: Config, tracklets: DataFrame | None = None) -> DataFrame:
    """Votes of tracklets over their crops' frame_label; tracklets without crops are ('discard', '', 0.0)."""
    out = funnel.track_vote(crops, TRACK, "frame_label", "seq", "det_score", config.track_vote_threshold)
    if tracklets is None:
        return out
    out = tracklets.select(*TRACK).join(out, TRACK, "left")
    return out.select(*TRACK, F.coalesce("voted_label", F.lit("")).alias("voted_label"), F.coalesce("vote_fraction", F.lit(0.0)).alias("vote_fraction"), F.coalesce("mean_score", F.lit(0.0)).alias("mean_score"), F.coalesce("result", F.lit("discard")).alias("result"))


def routed(clusters: DataFrame, config: Config) -> DataFrame:
    out = clusters.withColumn("gate", scores.gate(F.col("clip_score"), config.auto_accept_score, config.hitl_low_score))
    return out.withColumn("route", scores.route(F.col("gate"), F.col("status")))


def simulated_review(queued: DataFrame, accepted: int = 85) -> DataFrame:
    """(video_path, component, event, label): of a hundred clusters `accepted` are confirmed, with a label of their type;
    which, and with what, follows from the cluster's number alone."""
    pick = lambda names: F.element_at(F.array(*map(F.lit, names)), (F.col("component") % len(names) + 1).cast("int"))
    yes = (F.col("component") * 37) % 100 < accepted
    label = F.when(F.col("entity_type") == "logo", pick(LOGO_LABELS)).otherwise(pick(FACE_LABELS))
    return queued.select(*CLUSTER, F.when(yes, "confirm").otherwise("reject").alias("event"), F.when(yes, label).alias("label"))


def decided(clusters: DataFrame, decisions: DataFrame) -> DataFrame:
    """Routed clusters with hitl_label and the state that a review leaves: decisions (video_path, component, event, label)
    apply to queued clusters only; what has no decision stays pending."""
    out = clusters.join(decisions, CLUSTER, "left")
    queued = F.col("route") == "queue"
    state = F.when(~queued, F.col("status")).when(F.col("event") == "confirm", "hitl_confirmed").when(F.col("event") == "reject", "rejected").otherwise("hitl_pending")
    return out.withColumn("state", state).withColumn("hitl_label", F.when(state == "hitl_confirmed", F.col("label"))).drop("event", "label")


def records(clusters: DataFrame, members: DataFrame, crops: DataFrame, config: Config) -> DataFrame:
    """The 14 columns of a dataset record for the crops of emitted and confirmed clusters that have a label, at most
    samples_per_track_cap of a cluster and track."""
    out = clusters.where("route = 'emit' or state = 'hitl_confirmed'").withColumn("label", scores.final_label("state")).where("label is not null")
    out = out.withColumn("label_source", F.when(F.col("route") == "emit", "auto_accept").otherwise("hitl_confirmed"))
    own = members.select(*TRACK, "component").join(out.select(*CLUSTER, "cluster_id", "label", "clip_score", "label_source"), CLUSTER)
    kept = funnel.capped(crops.drop("embedding").join(own, TRACK), [*CLUSTER, "track_id"], ["seq"], config.samples_per_track_cap)
    return kept.select(
        F.sha2(F.concat_ws("|", "video_path", "entity_type", "track_id", "seq"), 256).alias("record_id"), "cluster_id", "label", "entity_type", "video_path", "frame_idx", "timestamp_ms", "track_id",
        *[F.col(c).alias(f"bbox_{c}") for c in ("x1", "y1", "x2", "y2")], F.col("clip_score").alias("confidence"), "label_source",
    )


def run_stats(clusters: DataFrame, members: DataFrame, votes: DataFrame, found: DataFrame, config: Config) -> DataFrame:
    """A row a video. `discarded` counts as the reference does (crops of ambiguous tracks, and of discarded clusters,
    some twice); `discarded_crops` has each crop of a discarded or rejected cluster once. `clusters_unknown` has queued
    clusters that were unknown when they were routed; the reference counts all queued ones as `clusters_hitl`."""
    tracks = members.join(votes, TRACK).groupBy("video_path").agg(
        F.sum("frame_count").alias("total_crops"), F.coalesce(F.sum(F.when(F.col("result") == "auto_accept", F.col("frame_count"))), F.lit(0)).alias("after_track_vote"), F.coalesce(F.sum(F.when(F.col("result") == "ambiguous", F.col("frame_count"))), F.lit(0)).alias("ambiguous_crops")
    )
    size = lambda test: F.coalesce(F.sum(F.when(test, F.col("sample_count"))), F.lit(0))
    emit, queue, discard = (F.col("route") == r for r in ("emit", "queue", "discard"))
    unknown = F.col("status") == "unknown"
    each = clusters.groupBy("video_path").agg(
        F.count("*").alias("clusters_total"), F.count_if(emit).alias("clusters_known"), F.count_if(queue & unknown).alias("clusters_unknown"), F.count_if(queue & ~unknown).alias("clusters_hitl"), F.count_if(queue).alias("clusters_hitl_as_coded"),
        F.count_if(F.col("state") == "hitl_pending").alias("hitl_queue_pending"), size(emit).alias("after_conf_gate"), size(discard).alias("gone"), size(discard | (F.col("state") == "rejected")).alias("discarded_crops"),
    )
    made = found.groupBy("video_path").agg(F.count("*").alias("final_records"), F.count_if(F.col("label_source") == "hitl_confirmed").alias("after_hitl"))
    out = tracks.join(each, "video_path").join(made, "video_path", "left").fillna(0, ["final_records", "after_hitl"])
    pure = scores.purity(F.col("final_records") - F.col("after_hitl"), F.col("after_hitl"), config)
    out = out.withColumn("discarded", F.col("ambiguous_crops") + F.col("gone")).withColumn("estimated_purity", pure).withColumn("pass_rate", scores.guarded(F.col("final_records"), F.col("total_crops")))
    return out.withColumn("hitl_rate", scores.guarded(F.col("clusters_hitl"), F.col("total_crops"))).withColumn("target_purity_met", pure >= config.target_label_purity).drop("gone")


def summary(stats: DataFrame, elapsed: float = 0.0) -> DataFrame:
    """The 14 keys of a run's summary, a row a video; percentages to one place."""
    percent = lambda c, name: F.round(F.col(c) * 100, 1).alias(name)
    return stats.select(
        F.col("video_path").alias("video"), F.lit(round(elapsed, 2)).alias("elapsed_s"), "total_crops", "after_track_vote", F.col("final_records").alias("final_dataset_records"), percent("pass_rate", "pass_rate_pct"), percent("estimated_purity", "estimated_purity_pct"),
        "clusters_total", "clusters_known", "clusters_unknown", "clusters_hitl", "hitl_queue_pending", "discarded", "target_purity_met",
    )


def totals(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.sum("final_dataset_records").cast("bigint").alias("total_records"), F.bool_and("target_purity_met").alias("all_met"))


def snapshots(stats: DataFrame, date: Column) -> DataFrame:
    return stats.select(date.alias("date_str"), "video_path", "total_crops", F.col("after_conf_gate").alias("auto_accept"), (F.col("clusters_hitl") + F.col("clusters_unknown")).alias("hitl_routed"), "discarded", F.col("clusters_unknown").alias("unknown_clusters"), F.col("clusters_total").alias("total_clusters"))


def pooled(found: DataFrame, config: Config) -> DataFrame:
    """What records add to the label pool: confirmed ones weigh more and count as sure; accepted ones need their score."""
    human = F.col("label_source") == "hitl_confirmed"
    kept = found.where(human | (F.col("confidence") >= config.auto_accept_score))
    return kept.select("record_id", "label", F.when(human, 1.0).otherwise(F.col("confidence")).alias("confidence"), F.when(human, config.hitl_label_weight).otherwise(config.pseudo_label_weight).alias("weight"))


class Flow:
    """The runner: from crops with vectors to everything a run leaves. Attributes are DataFrames; nothing is collected.

    reviews: a function from queued clusters to decisions (video_path, component, event, label)."""

    def __init__(self, crops: DataFrame, entities: DataFrame, config: Config, cut: float | None = None, reviews=simulated_review):
        self.config, self.crops, self.tracklets = config, crops, graph.written(phase3(crops), "tracklets")
        clusters, self.members = phase4(self.tracklets, crops, entities, config, cut)
        clusters = graph.written(routed(clusters, config), "clusters")
        self.clusters = decided(clusters, reviews(clusters.where("route = 'queue'")))
        self.votes = voted(crops, config, self.tracklets)
        self.records = records(self.clusters, self.members, crops, config)
        self.stats = run_stats(self.clusters, self.members, self.votes, self.records, config)

    def summary(self, elapsed: float = 0.0) -> DataFrame:
        return summary(self.stats, elapsed)

    def pool(self) -> DataFrame:
        return pooled(self.records, self.config)


def run(frames: DataFrame, boxes: DataFrame, embed, entities: DataFrame, config: Config, cut: float | None = None, reviews=simulated_review) -> Flow:
    """Boxes on frames to a Flow: tracking, then `embed` (crops to crops with embedding and quality_score), then the rest."""
    return Flow(embed(phase1(frames, boxes, config)), entities, config, cut, reviews)
