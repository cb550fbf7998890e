"""Queries of the whole flow, from detections to records and reports, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CONFIG, DOCUMENTED
from ..functions import scores
from ..operators import funnel, graph, monitor, phases, reviews, udfs
from ..sources import fixtures
from ..sources.tables import DETECTIONS_SQL, detections, review_log, table
from .catalogue import CUT, GOLD, PRF, embeddings, gated, gold, pool, query, r6

DAY = "2024-01-30"

# The flow's inputs: crops with a label a frame, and the vector of their track; the known entities are the means of labels.
LABEL_SQL = "CASE WHEN (seq * 7 + track_id) % 10 < 5 + track_id % 5 THEN 'x' ELSE 'y' END"
CROPS_SQL = f"""d AS ({DETECTIONS_SQL}), k AS (SELECT *, {LABEL_SQL} AS frame_label FROM d WHERE CASE WHEN entity_type = 'logo' THEN x2 - x1 >= 32 ELSE x2 - x1 >= 80 AND y2 - y1 >= 80 AND det_score >= 0.5 END),
u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS x FROM embeddings)"""
TRACKLETS_SQL = CROPS_SQL + """, t AS (SELECT k.video_path, entity_type, track_id, count(*) AS frame_count, min(seq) AS node FROM k GROUP BY ALL), v AS (SELECT t.*, u.x FROM t JOIN u ON u.vec_id = t.track_id % (SELECT count(*) FROM embeddings))"""
CLUSTERS_SQL = TRACKLETS_SQL + f""", e AS (SELECT a.node AS a, b.node AS b FROM v a JOIN v b ON a.video_path = b.video_path AND a.entity_type = b.entity_type AND a.node < b.node AND list_dot_product(a.x, b.x) >= {CUT}),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r(n, c) AS (SELECT node, node FROM v UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.n), m AS (SELECT v.*, c.component FROM v JOIN (SELECT n, min(c) AS component FROM r GROUP BY n) c ON c.n = v.node),
p AS (SELECT video_path, component, i, frame_count, x[i] AS x FROM m, range(1, 65) q(i)),
s AS (SELECT video_path, component, sum(s * s) AS ss, sum(q) AS qq FROM (SELECT video_path, component, i, sum(x) AS s, sum(x * x) AS q FROM p GROUP BY ALL) GROUP BY ALL),
z AS (SELECT *, row_number() OVER (PARTITION BY video_path ORDER BY entity_type = 'face', component) - 1 AS cluster_idx FROM (SELECT video_path, component, entity_type, count(*) AS tracklets, CAST(sum(frame_count) AS BIGINT) AS sample_count FROM m GROUP BY ALL)),
y AS (SELECT z.*, CASE WHEN tracklets < 2 THEN 1.0 ELSE least(1.0, greatest(0.0, (ss - qq) / (tracklets * (tracklets - 1)))) END AS tss FROM z JOIN s USING (video_path, component)),
ce AS (SELECT video_path, component, list(w ORDER BY i) AS c FROM (SELECT video_path, component, i, sum(frame_count * x) / sum(frame_count) AS w FROM p GROUP BY ALL) GROUP BY ALL),
cr AS (SELECT m.video_path, m.component, k.seq, m.x, row_number() OVER (PARTITION BY m.video_path, m.component ORDER BY round(list_dot_product(m.x, ce.c) / (sqrt(list_dot_product(ce.c, ce.c)) + 1e-9), 9) DESC, k.seq) AS rn FROM k JOIN m USING (video_path, entity_type, track_id) JOIN ce ON ce.video_path = m.video_path AND ce.component = m.component),
rp AS (SELECT video_path, component, list(w ORDER BY i) AS c FROM (SELECT video_path, component, i, avg(x[i]) AS w FROM cr, range(1, 65) q(i) WHERE rn <= 5 GROUP BY ALL) GROUP BY ALL),
ku AS (SELECT label, list(w ORDER BY i) AS c FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS w FROM embeddings, range(1, 65) q(i) GROUP BY ALL) GROUP BY ALL),
lb AS (SELECT video_path, component, ku.label, round(list_dot_product(rp.c, ku.c) / (sqrt(list_dot_product(rp.c, rp.c)) + 1e-9) / sqrt(list_dot_product(ku.c, ku.c)), 9) AS sim FROM rp, ku),
bl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_path, component ORDER BY sim DESC, label) AS rn FROM lb) WHERE rn = 1),
cl AS (SELECT y.*, sim AS clip_score, CASE WHEN sim >= 0.15 THEN 'known' ELSE 'unknown' END AS status, CASE WHEN sim >= 0.15 THEN y.entity_type || '_' || label END AS clip_label FROM y JOIN bl USING (video_path, component)),
ci AS (SELECT *, CASE WHEN status = 'known' THEN format('cluster_{{:04d}}', cluster_idx) ELSE (CASE WHEN entity_type = 'logo' THEN 'brand' ELSE 'face' END) || '_unknown_' || printf('%03d', row_number() OVER (PARTITION BY entity_type, status ORDER BY video_path, cluster_idx)) END AS cluster_id FROM cl),
ro AS (SELECT *, CASE WHEN clip_score >= 0.20 AND status = 'known' THEN 'emit' WHEN (clip_score >= 0.13 AND clip_score < 0.20) OR status = 'unknown' THEN 'queue' ELSE 'discard' END AS route FROM ci),
de AS (SELECT *, CASE WHEN route <> 'queue' THEN status WHEN (component * 37) % 100 < 85 THEN 'hitl_confirmed' ELSE 'rejected' END AS state,
 CASE WHEN route = 'queue' AND (component * 37) % 100 < 85 THEN CASE WHEN entity_type = 'logo' THEN (['nike','adidas','puma','lululemon','champion','under_armour'])[component % 6 + 1] ELSE (['athlete_unknown','coach_unknown','referee'])[component % 3 + 1] END END AS hitl_label FROM ro),
em AS (SELECT *, coalesce(nullif(hitl_label, ''), CASE WHEN state = 'known' THEN clip_label END) AS label, CASE WHEN route = 'emit' THEN 'auto_accept' ELSE 'hitl_confirmed' END AS label_source FROM de WHERE route = 'emit' OR state = 'hitl_confirmed'),
rc AS (SELECT k.*, em.cluster_id, em.component, em.label, em.clip_score, em.label_source, row_number() OVER (PARTITION BY m.video_path, em.component, k.track_id ORDER BY k.seq) AS rn FROM k JOIN m USING (video_path, entity_type, track_id) JOIN em ON em.video_path = m.video_path AND em.component = m.component WHERE em.label IS NOT NULL),
vc AS (SELECT video_path, entity_type, track_id, frame_label, count(*) AS c, min(seq) AS f, sum(det_score) AS s FROM k GROUP BY ALL),
vo AS (SELECT video_path, entity_type, track_id, frame_label AS voted_label, c / sum(c) OVER w AS fraction, sum(s) OVER w / sum(c) OVER w AS mean_score, row_number() OVER (PARTITION BY video_path, entity_type, track_id ORDER BY c DESC, f, frame_label) AS rn FROM vc WINDOW w AS (PARTITION BY video_path, entity_type, track_id))"""
STATS_SQL = CLUSTERS_SQL + """, ts AS (SELECT m.video_path, sum(frame_count) AS total_crops, coalesce(sum(frame_count) FILTER (WHERE fraction >= 0.7::DOUBLE), 0) AS after_track_vote, coalesce(sum(frame_count) FILTER (WHERE fraction < 0.7::DOUBLE), 0) AS ambiguous FROM m JOIN vo USING (video_path, entity_type, track_id) WHERE vo.rn = 1 GROUP BY 1),
cs AS (SELECT video_path, count(*) AS clusters_total, count(*) FILTER (WHERE route = 'emit') AS clusters_known, count(*) FILTER (WHERE route = 'queue' AND status = 'unknown') AS clusters_unknown, count(*) FILTER (WHERE route = 'queue' AND status = 'known') AS clusters_hitl, count(*) FILTER (WHERE route = 'queue') AS clusters_hitl_as_coded, count(*) FILTER (WHERE state = 'hitl_pending') AS hitl_queue_pending,
 coalesce(sum(sample_count) FILTER (WHERE route = 'emit'), 0) AS after_conf_gate, coalesce(sum(sample_count) FILTER (WHERE route = 'discard'), 0) AS gone, coalesce(sum(sample_count) FILTER (WHERE route = 'discard' OR state = 'rejected'), 0) AS discarded_crops FROM de GROUP BY 1),
rs AS (SELECT video_path, count(*) AS final_records, count(*) FILTER (WHERE label_source = 'hitl_confirmed') AS after_hitl FROM rc WHERE rn <= 500 GROUP BY 1),
st AS (SELECT *, CASE WHEN final_records = 0 THEN 0.0 ELSE ((final_records - after_hitl) * 0.974::DOUBLE + after_hitl * 0.998::DOUBLE) / final_records END AS purity FROM (SELECT ts.*, cs.* EXCLUDE (video_path), coalesce(final_records, 0) AS final_records, coalesce(after_hitl, 0) AS after_hitl FROM ts JOIN cs USING (video_path) LEFT JOIN rs USING (video_path)))"""


def rec(sql: str) -> str:
    return "WITH RECURSIVE " + sql


def crops(spark: SparkSession, d: str) -> DataFrame:
    """Detections that pass the size filters, with a simulated label a frame and their track's vector."""
    b = phases.named(detections(spark, d), CONFIG).where(phases.geometry.keep_detection())
    e = table(spark, d, "embeddings")
    n = e.agg(F.count("*").alias("n"))  # one row
    label = F.when((F.col("seq") * 7 + F.col("track_id")) % 10 < 5 + F.col("track_id") % 5, "x").otherwise("y")
    own = b.withColumn("frame_label", label).crossJoin(F.broadcast(n)).withColumn("vec_id", F.col("track_id") % F.col("n"))
    return own.join(e.select("vec_id", "embedding"), "vec_id").drop("vec_id", "n")


def entities(spark: SparkSession, d: str) -> DataFrame:
    """The known entities: a row for each label and type, its mean as vector."""
    mean = phases.mean_vectors(table(spark, d, "embeddings"), ["label"]).withColumnRenamed("mean_embedding", "vector")
    kinds = F.explode(F.array(F.lit("logo"), F.lit("face"))).alias("entity_type")
    return mean.select(kinds, "label", "vector").select("entity_type", F.concat_ws(" ", "entity_type", "label").alias("name"), F.col("label").alias("idx"), "vector")


def flow(spark: SparkSession, d: str) -> phases.Flow:
    return phases.Flow(crops(spark, d), entities(spark, d), CONFIG, CUT)


@query(rec(TRACKLETS_SQL) + " SELECT video_path, entity_type, track_id, node, frame_count, len(x) AS dim, round(x[1], 6) AS first_value FROM v")
def q_flow_tracklets(spark, d):
    t = phases.phase3(crops(spark, d))
    return t.select(*phases.TRACK, "node", "frame_count", F.size("mean_embedding").alias("dim"), r6(F.col("mean_embedding")[0]).alias("first_value"))


@query(rec(TRACKLETS_SQL) + " SELECT video_path, count(*) FILTER (WHERE entity_type = 'logo') AS logos, count(*) FILTER (WHERE entity_type = 'face') AS faces FROM v GROUP BY 1")
def q_tracklet_counts(spark, d):
    t = phases.phase3(crops(spark, d))
    return t.groupBy("video_path").agg(F.count_if(F.col("entity_type") == "logo").alias("logos"), F.count_if(F.col("entity_type") == "face").alias("faces"))


@query(rec(CLUSTERS_SQL) + " SELECT video_path, entity_type, cluster_idx, cluster_id, component, tracklets, sample_count, round(tss, 6) AS tss, round(clip_score, 6) AS clip_score, status, clip_label FROM ci")
def q_flow_clusters(spark, d):
    """Phase 4: tracklets to clusters (logos before faces), labels, and numbers of unknown ones that run on over videos."""
    found = flow(spark, d).clusters
    return found.select("video_path", "entity_type", "cluster_idx", "cluster_id", "component", "tracklets", "sample_count", r6("tss").alias("tss"), r6("clip_score").alias("clip_score"), "status", "clip_label")


@query(rec(CLUSTERS_SQL) + " SELECT video_path, entity_type, max(cluster_idx) + 1 AS next_idx, count(*) FILTER (WHERE status = 'known') AS known, count(*) FILTER (WHERE status = 'unknown') AS unknown, round(count(*) FILTER (WHERE status = 'unknown') / (count(*) + 1e-9) * 100, 1) AS unlabeled_pct FROM ci GROUP BY ALL")
def q_cluster_summary(spark, d):
    found = flow(spark, d).clusters
    lost = F.count_if(F.col("status") == "unknown")
    return found.groupBy("video_path", "entity_type").agg((F.max("cluster_idx") + 1).alias("next_idx"), F.count_if(F.col("status") == "known").alias("known"), lost.alias("unknown"), F.round(scores.rate(lost, F.count("*")) * 100, 1).alias("unlabeled_pct"))


@query(rec(CLUSTERS_SQL) + " SELECT video_path, entity_type, track_id, voted_label, round(fraction, 6) AS vote_fraction, round(mean_score, 6) AS mean_score, CASE WHEN fraction >= 0.7::DOUBLE THEN 'auto_accept' ELSE 'ambiguous' END AS result FROM vo WHERE rn = 1")
def q_flow_votes(spark, d):
    c = crops(spark, d)
    v = phases.voted(c, CONFIG, phases.phase3(c))
    return v.select(*phases.TRACK, "voted_label", r6("vote_fraction").alias("vote_fraction"), r6("mean_score").alias("mean_score"), "result")


@query("SELECT 'discard' AS result, '' AS voted_label, 0.0 AS mean_score, count(*) AS tracks FROM region")
def q_empty_track_vote(spark, d):
    """Tracklets without crops are discarded, with no label and no score."""
    empty = table(spark, d, "region").select(F.lit("v").alias("video_path"), F.lit("logo").alias("entity_type"), F.col("r_regionkey").cast("bigint").alias("track_id"))
    none = crops(spark, d).where("false")
    return phases.voted(none, CONFIG, empty).groupBy("result", "voted_label", "mean_score").agg(F.count("*").alias("tracks"))


@query(rec(CLUSTERS_SQL) + " SELECT video_path, component, route, state, hitl_label FROM de")
def q_flow_routes(spark, d):
    return flow(spark, d).clusters.select("video_path", "component", "route", "state", "hitl_label")


@query(rec(CLUSTERS_SQL) + " SELECT sha256(concat_ws('|', video_path, entity_type, CAST(track_id AS VARCHAR), CAST(seq AS VARCHAR))) AS record_id, cluster_id, label, entity_type, video_path, frame_idx, frame_idx * 40.0::DOUBLE AS timestamp_ms, track_id, x1 AS bbox_x1, y1 AS bbox_y1, x2 AS bbox_x2, y2 AS bbox_y2, round(clip_score, 6) AS confidence, label_source FROM rc WHERE rn <= 500")
def q_flow_records(spark, d):
    """The whole flow's records: the label and the confidence are the cluster's; clusters without a label give none."""
    return flow(spark, d).records.withColumn("confidence", r6("confidence"))


@query(rec(STATS_SQL) + " SELECT video_path, CAST(total_crops AS BIGINT) AS total_crops, CAST(after_track_vote AS BIGINT) AS after_track_vote, CAST(after_conf_gate AS BIGINT) AS after_conf_gate, after_hitl, final_records, clusters_total, clusters_known, clusters_unknown, clusters_hitl, clusters_hitl_as_coded, CAST(ambiguous + gone AS BIGINT) AS discarded, CAST(discarded_crops AS BIGINT) AS discarded_crops, round(purity, 6) AS purity, round(final_records / total_crops, 6) AS pass_rate, round(clusters_hitl / total_crops, 6) AS hitl_rate FROM st")
def q_run_stats(spark, d):
    s = flow(spark, d).stats
    return s.select("video_path", "total_crops", "after_track_vote", "after_conf_gate", "after_hitl", "final_records", "clusters_total", "clusters_known", "clusters_unknown", "clusters_hitl", "clusters_hitl_as_coded", "discarded", "discarded_crops", r6("estimated_purity").alias("purity"), r6("pass_rate").alias("pass_rate"), r6("hitl_rate").alias("hitl_rate"))


SUMMARY_SQL = "SELECT video_path AS video, 0.0 AS elapsed_s, CAST(total_crops AS BIGINT) AS total_crops, CAST(after_track_vote AS BIGINT) AS after_track_vote, final_records AS final_dataset_records, round(final_records / total_crops * 100, 1) AS pass_rate_pct, round(purity * 100, 1) AS estimated_purity_pct, clusters_total, clusters_known, clusters_unknown, clusters_hitl, hitl_queue_pending, CAST(ambiguous + gone AS BIGINT) AS discarded, purity >= 0.95::DOUBLE AS target_purity_met FROM st"


@query(rec(STATS_SQL) + " " + SUMMARY_SQL)
def q_run_summary(spark, d):
    return flow(spark, d).summary()


@query(rec(STATS_SQL) + f" SELECT CAST(sum(final_dataset_records) AS BIGINT) AS total_records, bool_and(target_purity_met) AS all_met FROM ({SUMMARY_SQL})")
def q_run_totals(spark, d):
    return phases.totals(flow(spark, d).summary())


@query(rec(STATS_SQL) + f" SELECT '{DAY}' AS date_str, video_path, CAST(total_crops AS BIGINT) AS total_crops, CAST(after_conf_gate AS BIGINT) AS auto_accept, clusters_hitl + clusters_unknown AS hitl_routed, CAST(ambiguous + gone AS BIGINT) AS discarded, clusters_unknown AS unknown_clusters, clusters_total AS total_clusters FROM st")
def q_run_snapshots(spark, d):
    """The day is a parameter; a run's is date_format(current_date(), 'yyyy-MM-dd')."""
    return phases.snapshots(flow(spark, d).stats, F.lit(DAY))


@query(rec(CLUSTERS_SQL) + " SELECT label, label_source = 'hitl_confirmed' AS human, count(*) AS n, CAST(sum(CASE WHEN label_source = 'hitl_confirmed' THEN 2 ELSE 1 END) AS DOUBLE) AS weight FROM rc WHERE rn <= 500 AND (label_source = 'hitl_confirmed' OR clip_score >= 0.2) GROUP BY ALL")
def q_flow_pool(spark, d):
    p = flow(spark, d).pool()
    return p.groupBy("label", (F.col("weight") > CONFIG.pseudo_label_weight).alias("human")).agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


@query(rec(CLUSTERS_SQL) + """, f AS (SELECT m.video_path, m.component, m.node, k.frame_idx, k.seq, dense_rank() OVER (PARTITION BY m.video_path, m.component ORDER BY m.node) AS t, row_number() OVER (PARTITION BY m.video_path, m.component, m.node ORDER BY k.seq) AS c FROM k JOIN m USING (video_path, entity_type, track_id)),
h AS (SELECT *, row_number() OVER (PARTITION BY video_path, component ORDER BY t, c) AS rn FROM f WHERE t <= 3 AND c <= 2)
SELECT video_path, component, string_agg(format('frame {} @ {:.1f}s', frame_idx, frame_idx * 40.0 / 1000), ', ' ORDER BY rn) AS sample_frames FROM h WHERE rn <= 5 GROUP BY ALL""")
def q_sample_frames(spark, d):
    """What a reviewer is shown: two crops of each of the first three tracklets, five at most."""
    c = crops(spark, d)
    members = phases.clustered(phases.phase3(c), CUT)
    return reviews.sample_frames(members, c)


FORCED_SQL = "t AS (SELECT 'v' || user_id % 4 AS video_path, user_id AS track_id, event_type, min(event_id) AS node FROM events GROUP BY ALL)"


@query(f"WITH {FORCED_SQL} SELECT node, min(node) OVER (PARTITION BY video_path, track_id) AS component FROM t")
def q_forced_merge(spark, d):
    """Nodes of one track and video are one cluster, whatever their vectors."""
    e = table(spark, d, "events")
    t = e.groupBy(F.concat(F.lit("v"), F.col("user_id") % 4).alias("video_path"), F.col("user_id").alias("track_id"), "event_type").agg(F.min("event_id").alias("node"))
    return graph.components(phases.forced_links(t), t, "node")


@query("WITH e AS (SELECT vec_id, label, CASE WHEN vec_id % 7 = 3 THEN embedding[1:32] ELSE embedding END AS x FROM embeddings), f AS (SELECT label, arg_min(len(x), vec_id) AS n FROM e GROUP BY label) SELECT label, count(*) AS kept, any_value(n) AS dim FROM e JOIN f USING (label) WHERE len(x) = n GROUP BY label")
def q_dim_guard(spark, d):
    """Vectors of another length than their group's first are left out."""
    e = embeddings(spark, d).withColumn("embedding", F.when(F.col("vec_id") % 7 == 3, F.slice("embedding", 1, 32)).otherwise(F.col("embedding")))
    return phases.same_size(e, ["label"], "vec_id").groupBy("label").agg(F.count("*").alias("kept"), F.max(F.size("embedding")).cast("bigint").alias("dim"))


@query(f"WITH d AS ({DETECTIONS_SQL}), b AS (SELECT *, entity_type = 'logo' AS l, CASE WHEN entity_type = 'logo' THEN x2 - x1 >= 32 ELSE x2 - x1 >= 80 AND y2 - y1 >= 80 AND det_score >= 0.5 END AS keep FROM d) SELECT video_path, count(*) AS boxes, count(*) FILTER (WHERE keep AND l) AS logos, count(*) FILTER (WHERE keep AND NOT l) AS faces, count(*) FILTER (WHERE NOT keep AND l) AS small_logos, count(*) FILTER (WHERE NOT keep AND NOT l) AS small_faces FROM b GROUP BY 1")
def q_detection_counts(spark, d):
    return phases.size_counts(detections(spark, d), CONFIG)


@query(f"WITH d AS ({DETECTIONS_SQL}) SELECT seq, greatest(0.0, x1 - 50) AS x1, greatest(0.0, y1 - 50) AS y1, x2, y2, ('0x' || md5(video_path)[1:8])::BIGINT AS seed FROM d WHERE det_score >= 0.30::DOUBLE")
def q_face_clamp(spark, d):
    """Face boxes are clamped from below only; the detector's threshold; a video's seed as a number."""
    b = detections(spark, d).where(F.col("det_score") >= CONFIG.logo_det_threshold)
    zero = F.lit(0.0)
    return b.select("seq", F.greatest(zero, F.col("x1") - 50).alias("x1"), F.greatest(zero, F.col("y1") - 50).alias("y1"), "x2", "y2", F.conv(F.substring(F.md5("video_path"), 1, 8), 16, 10).cast("bigint").alias("seed"))


@query("""WITH v AS (SELECT 'v' || u % 4 AS video_path, u FROM range(0, 4) r(u)), s AS (SELECT 'v' || u AS video_path, g AS scene, g * 100 AS a, g * 100 + 100 AS b FROM range(0, 2) r(u), range(0, 3) q(g)),
a AS (SELECT v.video_path, coalesce(scene, 0) AS scene, coalesce(a, 0) AS first_frame, coalesce(b, 50 + 10 * u) AS end_frame FROM v LEFT JOIN s USING (video_path)),
f AS (SELECT video_path, scene, unnest(range(first_frame, end_frame)) AS frame_idx FROM a), o AS (SELECT *, count(*) OVER (PARTITION BY video_path, scene) AS n, row_number() OVER (PARTITION BY video_path, scene ORDER BY (frame_idx * 7919) % 10007, frame_idx) AS rn FROM f)
SELECT video_path, scene, frame_idx FROM o WHERE rn <= greatest(1, floor(0.30::DOUBLE * n)) ORDER BY ALL""")
def q_scene_keyframes(spark, d):
    """Scenes as half-open ranges of frames, a video without cuts as one; the keyframes of each, sorted."""
    videos = spark.range(4).select(F.concat(F.lit("v"), F.col("id") % 4).alias("video_path"), (F.col("id") * 10 + 50).alias("frame_count"))
    cuts = spark.range(6).select(F.concat(F.lit("v"), (F.col("id") / 3).cast("int")).alias("video_path"), (F.col("id") % 3).alias("scene"))
    cuts = cuts.withColumn("first_frame", F.col("scene") * 100).withColumn("end_frame", F.col("scene") * 100 + 100)
    found = phases.keyframes(phases.scenes_or_default(videos, cuts), CONFIG.keyframe_share, (F.col("frame_idx") * 7919) % 10007)
    return found.orderBy("video_path", "scene", "frame_idx")


@query()
def q_seeded_sample(spark, d):
    """Keyframes in an order hashed from video, scene and frame: the same ones in every process."""
    f = detections(spark, d).groupBy("video_path").agg((F.max("frame_idx") + 1).alias("frame_count"))
    one = phases.scenes_or_default(f, spark.createDataFrame([], "video_path string, scene int, first_frame int, end_frame int"))
    return phases.keyframes(one, CONFIG.keyframe_share, phases.seeded("video_path", "scene", "frame_idx"))


# Review.

QUEUE_SQL = "l AS (SELECT event_id AS seq, format('cluster_{:04d}', user_id) AS cluster_id, event_id % 5 AS k FROM events), b AS (SELECT cluster_id, max(seq) FILTER (WHERE k < 3) AS added, min(seq) FILTER (WHERE k < 3) AS enqueued FROM l GROUP BY 1), n AS (SELECT b.cluster_id, enqueued, min(l.seq) AS decided FROM b LEFT JOIN l ON l.cluster_id = b.cluster_id AND l.k >= 3 AND l.seq > b.added WHERE b.added IS NOT NULL GROUP BY ALL), q AS (SELECT n.cluster_id, enqueued, CASE WHEN decided IS NULL THEN 'hitl_pending' WHEN decided % 5 = 3 THEN 'hitl_confirmed' ELSE 'rejected' END AS state FROM n)"


def queue(spark, d):
    return funnel.folded_reviews(review_log(spark, d), ["cluster_id"])


@query(f"WITH {QUEUE_SQL} SELECT state, count(*) AS n FROM q GROUP BY state")
def q_queue_counts(spark, d):
    return reviews.counts(queue(spark, d))


@query(f"WITH {QUEUE_SQL} SELECT state, cluster_id, row_number() OVER (PARTITION BY state ORDER BY enqueued, cluster_id) - 1 AS place FROM q")
def q_queue_lists(spark, d):
    """The pending, confirmed and rejected lists, in the order in which clusters came."""
    return reviews.lists(queue(spark, d)).select("state", "cluster_id", "place")


CLI_SQL = """c AS (SELECT event_id, user_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'brand_' || user_id % 3 END AS clip_label, (['confirm','label','reject','skip'])[event_id % 4 + 1] AS action, CASE WHEN event_id % 6 = 1 THEN '   ' ELSE '  ' || upper(event_type) || ' ' END AS typed FROM events),
x AS (SELECT *, CASE WHEN action = 'confirm' AND clip_label IS NULL THEN 'label' ELSE action END AS act, lower(trim(typed)) AS t FROM c),
o AS (SELECT event_id, CASE act WHEN 'reject' THEN 'rejected' WHEN 'confirm' THEN 'hitl_confirmed' WHEN 'skip' THEN 'skipped' ELSE CASE WHEN t = '' THEN 'skipped' ELSE 'hitl_confirmed' END END AS outcome, CASE act WHEN 'confirm' THEN clip_label WHEN 'label' THEN nullif(t, '') END AS hitl_label FROM x)"""


def cli(spark, d):
    e, at = table(spark, d, "events"), F.col("event_id")
    pending = e.select("event_id", F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("brand_"), F.col("user_id") % 3)).alias("clip_label"))
    action = F.element_at(F.array(*map(F.lit, ("confirm", "label", "reject", "skip"))), (at % 4 + 1).cast("int"))
    said = e.select("event_id", action.alias("action"), F.when(at % 6 == 1, "   ").otherwise(F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))).alias("typed"))
    return reviews.session(pending, said, ["event_id"])


@query(f"WITH {CLI_SQL} SELECT event_id, outcome, hitl_label FROM o")
def q_cli_review(spark, d):
    """A reviewer's session: confirm, label, reject or skip; confirming without a suggestion asks for a label."""
    return cli(spark, d).select("event_id", "outcome", "hitl_label")


@query(f"WITH {CLI_SQL} SELECT count(*) AS pending, count(*) FILTER (WHERE outcome <> 'skipped') AS reviewed, count(*) FILTER (WHERE outcome = 'hitl_confirmed') AS confirmed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped FROM o")
def q_cli_totals(spark, d):
    return reviews.session_totals(cli(spark, d))


# Monitoring.


@query(f"WITH {GOLD}, z AS (SELECT run, t AS label, CAST(t = p AS INT) AS tp, CAST(t <> p AS INT) AS fp, 0 AS fn FROM g UNION ALL SELECT run, p, 0, 0, CAST(t <> p AS INT) FROM g) SELECT label, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM z GROUP BY label")
def q_gold_confusion_swapped(spark, d):
    """The reference's own counts: a miss adds fp to the true label and fn to the predicted one."""
    return monitor.swapped(monitor.confusion(gold(spark, d)))


RUNS = "g AS (SELECT toxic AS t, CASE WHEN n_chars % 5 = 0 THEN 1 ELSE 0 END AS p, doc_id % 4 AS run FROM labels JOIN documents USING (doc_id)), s AS (SELECT run, t AS label, CAST(t = p AS INT) AS tp, 0 AS fp, CAST(t <> p AS INT) AS fn FROM g UNION ALL SELECT run, p, 0, CAST(t <> p AS INT), 0 FROM g)"
HISTORY = f"{RUNS}, {PRF.format(k='run,')}, h AS (SELECT run, label, f1, round(f1, 3) AS r, lag(round(f1, 3)) OVER (PARTITION BY label ORDER BY run) AS before, lag(run) OVER (PARTITION BY label ORDER BY run) AS prior FROM f)"


def runs(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return monitor.history(j.select((F.col("doc_id") % 4).alias("run"), F.col("toxic").alias("true_label"), F.when(F.col("n_chars") % 5 == 0, 1).otherwise(0).alias("pred_label")))


@query(f"WITH {HISTORY} SELECT run, label, round(f1, 6) AS f1, CASE WHEN prior = run - 1 THEN round(r - before, 3) END AS delta FROM h")
def q_gold_history(spark, d):
    """F1 of each run and label, and the change against the run before."""
    return runs(spark, d).select("run", "label", r6("f1").alias("f1"), F.round("delta", 3).alias("delta"))


@query(f"""WITH {HISTORY}, al AS (SELECT run, list_filter([CASE WHEN f1 < 0.85::DOUBLE THEN format('{{}} below floor', label) END, CASE WHEN prior = run - 1 AND r - before < -0.02::DOUBLE THEN format('{{}} regressed', label) END], lambda x: x IS NOT NULL) AS alerts, label FROM h),
m AS (SELECT run, round(avg(f1), 6) AS macro_f1 FROM f GROUP BY run) SELECT run, macro_f1, coalesce((SELECT string_agg(x, '; ' ORDER BY label, i) FROM (SELECT label, unnest(alerts) AS x, generate_subscripts(alerts, 1) AS i FROM al WHERE al.run = m.run)), '') AS alerts FROM m""")
def q_gold_report(spark, d):
    """A row a run: macro F1, and the alerts of all labels: below the floor (unrounded), or worse than the run before."""
    out = monitor.report(runs(spark, d), CONFIG)
    return out.select("run", r6("macro_f1").alias("macro_f1"), F.array_join("alerts", "; ").alias("alerts"))


@query("SELECT true_label, entity_type, count(*) AS n, min(sample_id) AS first_id, max(sample_id) AS last_id FROM (SELECT format('gold_{}_{:03d}', l, i) AS sample_id, l AS true_label, CASE WHEN l IN ('lebron_james','stephen_curry','kevin_durant') THEN 'face' ELSE 'logo' END AS entity_type FROM (SELECT unnest(['nike','adidas','under_armour','puma','jordan','reebok','new_balance','gatorade','espn','lebron_james','stephen_curry','kevin_durant']) AS l), range(0, 50) r(i)) GROUP BY ALL")
def q_gold_samples(spark, d):
    g = fixtures.gold_samples(spark)
    return g.groupBy("true_label", "entity_type").agg(F.count("*").alias("n"), F.min("sample_id").alias("first_id"), F.max("sample_id").alias("last_id"))


@query("SELECT a.label AS true_label, b.label AS pred_label, count(*) AS n FROM (SELECT DISTINCT label FROM embeddings) a JOIN embeddings b ON a.label <> b.label GROUP BY ALL")
def q_wrong_labels(spark, d):
    """The wrong labels that a sample may be given: those of all other rows, counted by label first."""
    e = embeddings(spark, d).groupBy("label").agg(F.count("*").alias("n"))
    return monitor.wrong_labels(e)


@query("""WITH r AS (SELECT vec_id % 4 + 1 AS week, CASE WHEN label % 2 = 0 THEN 'logo' ELSE 'face' END AS entity_type, list_sum(embedding::DOUBLE[]) / len(embedding) + CASE WHEN vec_id % 4 = 3 THEN 0.05 ELSE 0 END AS value FROM embeddings),
q AS (SELECT entity_type, list_transform(quantile_cont(value, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]), lambda x: round(x, 6)) AS e, count(*) AS nx FROM r WHERE week = 2 GROUP BY 1),
b AS (SELECT week, entity_type, k, count(*) FILTER (WHERE value >= e[k] - CASE WHEN k = 1 THEN 1e-9 ELSE 0 END AND (value < e[k + 1] OR (k = 10 AND value <= e[11] + 1e-9))) AS y, count(*) AS n FROM r JOIN q USING (entity_type), range(1, 11) s(k) GROUP BY ALL),
z AS (SELECT c.week, c.entity_type, greatest(x.y / x.n, 1e-9) AS e, greatest(c.y / c.n, 1e-9) AS a FROM b c JOIN b x ON x.week = 2 AND x.entity_type = c.entity_type AND x.k = c.k WHERE c.week > 2)
SELECT week, entity_type, round(sum((a - e) * ln(a / e)), 6) AS psi, CASE WHEN sum((a - e) * ln(a / e)) > 0.35 THEN 'severe' WHEN sum((a - e) * ln(a / e)) > 0.25 THEN 'warn' ELSE 'ok' END AS alert FROM z GROUP BY ALL""")
def q_weekly_drift(spark, d):
    """Drift of vectors' means by week and type, against week 2, which replaces week 1 as the baseline."""
    week = F.col("vec_id") % 4 + 1
    e = table(spark, d, "embeddings").select(week.alias("week"), F.when(F.col("label") % 2 == 0, "logo").otherwise("face").alias("entity_type"), "embedding")
    mean = monitor.row_mean("embedding") + F.when(F.col("week") == 4, 0.05).otherwise(0.0)
    out = monitor.weekly_drift(e.select("week", "entity_type", mean.alias("value")), CONFIG)
    return out.select("week", "entity_type", r6("psi").alias("psi"), "alert")


WEEK7 = "WITH g AS (SELECT strftime(ts, '%Y-%m-%d') AS date_str, CASE WHEN value / 100 >= 0.85::DOUBLE THEN 'a' WHEN value / 100 >= 0.60::DOUBLE THEN 'h' END AS k, value FROM events), y AS (SELECT date_str, count(*) AS n, count(*) FILTER (WHERE k = 'a') AS a, count(*) FILTER (WHERE k = 'h') AS h, count(*) FILTER (WHERE value < 30) AS u FROM g GROUP BY 1), t AS (SELECT *, row_number() OVER (ORDER BY date_str DESC) AS back FROM y)"


@query(WEEK7 + " SELECT round(avg(a / (n + 1e-9)) FILTER (WHERE back <= 7), 3) AS avg_auto_accept_rate, round(avg(h / (n + 1e-9)) FILTER (WHERE back <= 7), 4) AS avg_hitl_rate, round(avg(u / (n + 1e-9)) FILTER (WHERE back <= 7), 3) AS avg_unknown_rate, least(count(*), 90) AS days_tracked FROM t")
def q_proxy_summary(spark, d):
    """The last seven snapshots' mean rates, of the 90 that are kept."""
    e = gated(spark, d, DOCUMENTED)
    day = monitor.daily(e).join(e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date_str")).agg(F.count_if(F.col("value") < 30).alias("unknown_clusters"), F.count("*").alias("total_clusters")), "date_str")
    return monitor.proxy_summary(monitor.last_kept(day, 90))


@query("SELECT event_id AS days, event_id >= 7 AS due FROM events WHERE event_id < 20")
def q_fine_tune_due(spark, d):
    return table(spark, d, "events").where("event_id < 20").select(F.col("event_id").alias("days"), monitor.due(F.col("event_id"), CONFIG).alias("due"))


@query("WITH p AS (SELECT event_type AS label, CASE WHEN event_id % 10 = 0 THEN 2.0 ELSE 1.0 END AS weight FROM events WHERE event_id % 10 = 0 OR value / 100 >= 0.20::DOUBLE) SELECT CASE WHEN count(*) = 0 THEN 'skipped' ELSE 'completed' END AS status, count(*) AS total_samples, count(*) FILTER (WHERE weight > 1) AS hitl_confirmed, count(*) FILTER (WHERE weight <= 1) AS auto_accept, least(count(*), 10000) AS replay_buffer_size, (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM (SELECT label, count(*) AS n FROM p GROUP BY label)) AS label_distribution FROM p")
def q_fine_tune(spark, d):
    """One learning step: what the pool held, label by label, before it moves to the replay buffer."""
    out = monitor.fine_tune(pool(spark, d), CONFIG)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("label_distribution")), lambda x: F.concat_ws("=", x["key"], x["value"])), ",")
    return out.withColumn("label_distribution", shown)


@query("SELECT '{' || string_agg('\"' || k || '\":' || v, ',' ORDER BY o) || '}' AS config_json FROM (VALUES " + ", ".join(f"({o}, '{k}', '{v}')" for o, (k, v) in enumerate(CONFIG.items())) + ") t(o, k, v)")
def q_config_json(spark, d):
    """The settings as JSON, built by Spark from columns."""
    return spark.range(1).select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in CONFIG.__dict__.items()])).alias("config_json"))


@query("SELECT source, regexp_extract(source, '([^/]*?)(\\.[^./]*)?$', 1) AS stem, NOT starts_with(source, '_') AS shown FROM (VALUES ('a/b/sports_broadcast_2024_q1.mp4'), ('nba_highlights_jan_15.mp4'), ('soccer_match_copa.mp4'), ('_alerts'), ('x.y/z.tar.gz')) t(source)")
def q_sources(spark, d):
    """The list of sources, their stems, and whether a key is shown."""
    own = fixtures.sources(spark, ["a/b/sports_broadcast_2024_q1.mp4", "nba_highlights_jan_15.mp4", "soccer_match_copa.mp4", "_alerts", "x.y/z.tar.gz"])
    return own.select("source", fixtures.stem("source").alias("stem"), (~F.startswith("source", F.lit("_"))).alias("shown"))


@query("SELECT event_id, user_id % 3 AS n_boxes FROM events WHERE event_id < 500 AND user_id % 3 > 0")
def q_detector_slot(spark, d):
    """A detector: none to many boxes for each frame, in Arrow batches; counted here."""
    frames = table(spark, d, "events").where("event_id < 500").select("event_id", "user_id")
    boxes = udfs.detect(frames, lambda user: [(float(k), 0.0, k + 10.0, 10.0, 0.9) for k in range(user % 3)], "event_id", "user_id")
    return boxes.groupBy("event_id").agg(F.count("*").alias("n_boxes"))


@query("SELECT vec_id, CASE WHEN label % 2 = 0 THEN 16 ELSE 8 END AS dim, CASE WHEN label % 2 = 0 THEN 1.0 ELSE 0.5 END AS quality FROM embeddings")
def q_embed_by_type(spark, d):
    """Crops to the embedder of their type; faces come with a quality."""
    c = embeddings(spark, d).select("vec_id", F.col("vec_id").cast("string").alias("crop_id"), F.when(F.col("entity") == 0, "logo").otherwise("face").alias("entity_type"))
    out = udfs.embed(c, {"logo": lambda i: (udfs.stand_in_vector(i, 16), 1.0), "face": lambda i: (udfs.stand_in_vector(i, 8), 0.5)})
    return out.select("vec_id", F.size("embedding").cast("bigint").alias("dim"), "quality_score").withColumnRenamed("quality_score", "quality")
