"""Named queries over the test tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import CONFIG, DOCUMENTED
from ..functions import geometry, scores, vectors
from ..operators import funnel, graph, monitor, tracker, udfs
from ..operators.ranks import ranked
from ..sources.tables import DETECTIONS_SQL, cache_key, detections, review_log, table
from ..streaming import stream

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CUT = 0.40  # similarity of edges in the test vectors
DET = f"WITH d AS ({DETECTIONS_SQL}) "


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def r6(c) -> F.Column:
    return scores.rounded(c, 6)


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").withColumn("entity", F.col("label") % 2)


# Projections and filters.


@query(DET + "SELECT seq, x2 - x1 AS w, y2 - y1 AS h, (x2 - x1) * (y2 - y1) AS area, least(greatest((x2 - x1) * (y2 - y1) / 40000.0, 0.1), 1.0) AS quality FROM d")
def q_bbox_geometry(spark, d):
    return detections(spark, d).select("seq", geometry.width().alias("w"), geometry.height().alias("h"), geometry.area().alias("area"), geometry.face_quality().alias("quality"))


@query(DET + """SELECT seq, round(greatest(0.0, ((x1 + x2) / 2400 - (x2 - x1) / 2400) * 1200), 6) AS x1, round(greatest(0.0, ((y1 + y2) / 1300 - (y2 - y1) / 1300) * 650), 6) AS y1,
 round(least(1200.0, ((x1 + x2) / 2400 + (x2 - x1) / 2400) * 1200), 6) AS x2, round(least(650.0, ((y1 + y2) / 1300 + (y2 - y1) / 1300) * 650), 6) AS y2 FROM d""")
def q_box_clamp(spark, d):
    b, w, h = detections(spark, d), F.lit(1200.0), F.lit(650.0)
    cx, cy = (F.col("x1") + F.col("x2")) / 2400, (F.col("y1") + F.col("y2")) / 1300
    out = b.select("seq", *geometry.corners(cx, cy, geometry.width() / 1200, geometry.height() / 650, w, h))
    return out.select("seq", *[r6(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(DET + """SELECT seq, CAST(greatest(0, floor(x1)) AS INT) AS wx1, CAST(greatest(0, floor(y1)) AS INT) AS wy1, CAST(least(1100, floor(x2)) AS INT) AS wx2, CAST(least(600, floor(y2)) AS INT) AS wy2,
 (least(1100, floor(x2)) <= floor(x1) OR least(600, floor(y2)) <= floor(y1)) AS is_empty, greatest(x2 - x1, 32) AS min_w, greatest(y2 - y1, 32) AS min_h FROM d""")
def q_crop_window(spark, d):
    b = detections(spark, d)
    return b.select("seq", *geometry.crop_window(F.lit(1100), F.lit(600)), F.greatest(geometry.width(), F.lit(32.0)).alias("min_w"), F.greatest(geometry.height(), F.lit(32.0)).alias("min_h"))


@query(DET + "SELECT seq, entity_type, det_score FROM d WHERE CASE WHEN entity_type = 'logo' THEN x2 - x1 >= 32 ELSE x2 - x1 >= 80 AND y2 - y1 >= 80 AND det_score >= 0.5 END")
def q_size_filter(spark, d):
    return detections(spark, d).where(geometry.keep_detection()).select("seq", "entity_type", "det_score")


@query(DET + """SELECT seq, concat(entity_type, '_', md5(video_path)[1:8], '_', frame_idx, '_', track_id) AS crop_id, CASE WHEN entity_type = 'face' THEN track_id + 10000 ELSE track_id END AS display_track, frame_idx * 40.0::DOUBLE AS timestamp_ms,
 md5(concat_ws('_', video_path, CAST(seq AS VARCHAR), CAST(frame_idx AS VARCHAR)))[1:12] AS cache_key, replace('new ' || entity_type || ' label', ' ', '_') AS label, format('cluster_{:04d}', track_id) AS cluster_id FROM d""")
def q_ids_and_hash(spark, d):
    b = detections(spark, d)
    return b.select(
        "seq", F.concat_ws("_", "entity_type", F.substring(F.md5("video_path"), 1, 8), "frame_idx", "track_id").alias("crop_id"), F.when(F.col("entity_type") == "face", F.col("track_id") + 10000).otherwise(F.col("track_id")).alias("display_track"),
        (F.col("frame_idx") * F.lit(CONFIG.frame_ms)).alias("timestamp_ms"), cache_key("video_path", "seq", "frame_idx").alias("cache_key"),
        F.replace(F.concat(F.lit("new "), "entity_type", F.lit(" label")), F.lit(" "), F.lit("_")).alias("label"), F.format_string("cluster_%04d", "track_id").alias("cluster_id"),
    )


# Joins on overlap, frames.

PAIRS = DET + """, p AS (SELECT a.seq AS a_seq, b.seq AS b_seq, a.video_path AS video_path, a.frame_idx // 50 AS bucket,
 greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i,
 (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS u
 FROM d a JOIN d b ON a.video_path = b.video_path AND a.frame_idx // 50 = b.frame_idx // 50 AND a.seq < b.seq), q AS (SELECT *, i / (u - i + 1e-9) AS iou FROM p) """


def iou_pairs(spark, d):
    """Boxes of one video and frame bucket: an equi-join on both, so overlap is only computed within a bucket."""
    b = detections(spark, d).withColumn("bucket", F.floor(F.col("frame_idx") / 50))
    side = lambda p: b.select("video_path", "bucket", *[F.col(c).alias(f"{p}{c}") for c in ("seq", "x1", "y1", "x2", "y2")])
    return side("a_").join(side("b_"), ["video_path", "bucket"]).where("a_seq < b_seq").withColumn("iou", geometry.iou())


@query(PAIRS + "SELECT a_seq, b_seq, round(iou, 6) AS iou FROM q WHERE iou >= 0.3")
def q_iou_pairs(spark, d):
    return iou_pairs(spark, d).where("iou >= 0.3").select("a_seq", "b_seq", r6("iou").alias("iou"))


@query(PAIRS + "SELECT a_seq, b_seq, iou FROM (SELECT a_seq, b_seq, round(iou, 6) AS iou, row_number() OVER (PARTITION BY a_seq ORDER BY round(iou, 6) DESC, b_seq) AS rn FROM q WHERE iou > 0) WHERE rn = 1")
def q_best_iou(spark, d):
    best = F.max_by("b_seq", F.struct(r6("iou").alias("i"), (-F.col("b_seq")).alias("s")))
    return iou_pairs(spark, d).where("iou > 0").groupBy("a_seq").agg(best.alias("b_seq"), F.max(r6("iou")).alias("iou"))


@query(DET + """, f AS (SELECT DISTINCT video_path, CAST(frame_idx // 250 AS BIGINT) AS scene, frame_idx FROM d), n AS (SELECT *, count(*) OVER (PARTITION BY video_path, scene) AS n, row_number() OVER (PARTITION BY video_path, scene ORDER BY (frame_idx * 7919) % 10007, frame_idx) AS rn FROM f)
SELECT video_path, scene, frame_idx FROM n WHERE rn <= greatest(1, floor(0.30::DOUBLE * n))""")
def q_keyframe_sample(spark, d):
    f = detections(spark, d).select("video_path", F.floor(F.col("frame_idx") / 250).alias("scene"), "frame_idx").distinct()
    w = Window.partitionBy("video_path", "scene")
    n = f.withColumn("n", F.count("*").over(w)).withColumn("rn", F.row_number().over(w.orderBy((F.col("frame_idx") * 7919) % 10007, "frame_idx")))
    return n.where(F.col("rn") <= F.greatest(F.lit(1), F.floor(F.lit(CONFIG.keyframe_share) * F.col("n")))).select("video_path", "scene", "frame_idx")


@query("""WITH l AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS cut FROM events),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS scene FROM l)
SELECT user_id, CAST(scene AS BIGINT) AS scene, any_value(event_type) AS event_type, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY user_id, scene""")
def q_scene_islands(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    cut = F.when(F.col("event_type").eqNullSafe(F.lag("event_type").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    s = table(spark, d, "events").withColumn("cut", cut).withColumn("scene", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy("user_id", "scene").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"))


# Tracklets, vectors.


@query(DET + "SELECT video_path, entity_type, track_id, count(*) AS frame_count, min(seq) AS first_seq, round(avg(det_score), 6) AS mean_score FROM d GROUP BY ALL")
def q_tracklets(spark, d):
    return detections(spark, d).groupBy("video_path", "entity_type", "track_id").agg(F.count("*").alias("frame_count"), F.min("seq").alias("first_seq"), r6(F.avg("det_score")).alias("mean_score"))


@query("SELECT label, pos - 1 AS pos, round(avg(CAST(embedding[pos] AS DOUBLE)), 6) AS mean FROM embeddings, range(1, 65) r(pos) GROUP BY label, pos")
def q_mean_embedding(spark, d):
    return vectors.sums(embeddings(spark, d), ["label"]).select("label", F.col("pos").cast("bigint").alias("pos"), r6(F.col("s") / F.col("c")).alias("mean"))


MEANS = "m AS (SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(pos) GROUP BY label, pos), u AS (SELECT label, pos, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m)"


@query(f"WITH {MEANS} SELECT label, round(sqrt(sum(x * x)), 6) AS norm FROM u GROUP BY label")
def q_mean_norm(spark, d):
    return vectors.means(embeddings(spark, d), ["label"]).select("label", r6(vectors.norm("mean_embedding")).alias("norm"))


@query(f"WITH {MEANS}, s AS (SELECT vec_id, u.label AS proto, round(sum(CAST(embedding[pos] AS DOUBLE) * x), 9) AS sim FROM embeddings, u GROUP BY vec_id, u.label), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, proto) AS rn FROM s) SELECT vec_id, proto, round(sim, 6) AS sim, CASE WHEN sim >= 0.15 THEN 'known' ELSE 'unknown' END AS status FROM k WHERE rn = 1")
def q_nearest_prototype(spark, d):
    """Prototypes are a dimension: a row a label, sent to the workers as one matrix that must stay under a bound."""
    e = embeddings(spark, d)
    best = graph.nearest(e, vectors.means(e, ["label"]), "label")
    return best.select("vec_id", "proto", r6("sim").alias("sim"), scores.status(F.col("sim"), CONFIG).alias("status"))


@query(f"WITH {MEANS}, s AS (SELECT vec_id, e.label AS label, round(sum(CAST(embedding[pos] AS DOUBLE) * x), 9) AS sim FROM embeddings e JOIN u ON u.label = e.label GROUP BY vec_id, e.label) SELECT label, vec_id, round(sim, 6) AS sim, rn FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY sim DESC, vec_id) AS rn FROM s) WHERE rn <= 5")
def q_representatives(spark, d):
    e = embeddings(spark, d)
    return funnel.representatives(e, vectors.means(e, ["label"]), ["label"]).select("label", "vec_id", r6("sim").alias("sim"), F.col("rn").cast("bigint").alias("rn"))


TSS = "WITH s AS (SELECT label, pos, sum(CAST(embedding[pos] AS DOUBLE)) AS s, sum(CAST(embedding[pos] AS DOUBLE) ** 2) AS q, count(*) AS n FROM embeddings, range(1, 65) r(pos) GROUP BY label, pos) SELECT label, CASE WHEN max(n) < 2 THEN 1.0 ELSE round(least(1.0, greatest(0.0, (sum(s * s) - sum(q)) / (max(n) * (max(n) - 1)))), 6) END AS tss FROM s GROUP BY label"


@query(TSS)
def q_tss(spark, d):
    n = F.max("c")
    raw = (F.sum(F.col("s") * F.col("s")) - F.sum("q")) / F.nullif(n * (n - 1), F.lit(0))
    return vectors.sums(embeddings(spark, d), ["label"]).groupBy("label").agg(F.when(n < 2, 1.0).otherwise(r6(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)))).alias("tss"))


EDGES = f"e AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS w FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND a.label % 2 = b.label % 2 WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {CUT})"
COMP = f"WITH RECURSIVE {EDGES}, g AS (SELECT src AS x, dst AS y FROM e UNION ALL SELECT dst, src FROM e), r(v, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT g.y, r.c FROM r JOIN g ON g.x = r.v), c AS (SELECT v AS vec_id, min(c) AS component FROM r GROUP BY v)"


@query(f"WITH {EDGES} SELECT src, dst, round(w, 6) AS weight FROM e")
def q_sim_edges(spark, d):
    return graph.similarity_edges(embeddings(spark, d), CUT).select("src", "dst", r6("weight").alias("weight"))


def clusters(spark, d):
    e = embeddings(spark, d)
    return graph.components(graph.similar_links(e, CUT), e).join(e.select("vec_id", "entity"), "vec_id")


@query(COMP + " SELECT vec_id, component FROM c")
def q_components(spark, d):
    return clusters(spark, d).select("vec_id", "component")


@query(COMP + " SELECT vec_id, dense_rank() OVER (ORDER BY component) - 1 AS cluster_idx, format('cluster_{:04d}', dense_rank() OVER (ORDER BY component) - 1) AS cluster_id FROM c")
def q_dense_cluster_ids(spark, d):
    c = clusters(spark, d)
    ids = ranked(c.select("component").distinct(), ["component"])
    return c.join(ids, "component").select("vec_id", F.col("rank").alias("cluster_idx"), F.format_string("cluster_%04d", "rank").alias("cluster_id"))


@query(COMP + ", z AS (SELECT component, count(*) AS n, min(component % 2) AS x FROM c GROUP BY component), k AS (SELECT z.*, e.label % 2 AS entity FROM z JOIN embeddings e ON e.vec_id = z.component) SELECT component, CASE WHEN entity = 0 THEN 'brand_unknown_' ELSE 'face_unknown_' END || lpad(CAST(row_number() OVER (PARTITION BY entity ORDER BY component) AS VARCHAR), CAST(greatest(3, length(CAST(row_number() OVER (PARTITION BY entity ORDER BY component) AS VARCHAR))) AS INT), '0') AS unknown_id FROM k WHERE n = 1")
def q_unknown_ids(spark, d):
    z = clusters(spark, d).groupBy("component").agg(F.count("*").alias("n"), F.min("entity").alias("entity")).where("n = 1")
    return ranked(z, ["component"], ("entity",), "rn").withColumn("rn", F.col("rn") + 1).select("component", F.format_string("%s_unknown_%03d", F.when(F.col("entity") == 0, "brand").otherwise("face"), F.col("rn")).alias("unknown_id"))


# Funnel.

VOTE = "WITH e AS (SELECT l_orderkey, l_linestatus, count(*) AS c, min(l_linenumber) AS f, sum(l_discount) AS s FROM lineitem GROUP BY ALL), v AS (SELECT l_orderkey, l_linestatus AS voted_label, c / sum(c) OVER (PARTITION BY l_orderkey) AS frac, sum(s) OVER (PARTITION BY l_orderkey) / sum(c) OVER (PARTITION BY l_orderkey) AS m, row_number() OVER (PARTITION BY l_orderkey ORDER BY c DESC, f, l_linestatus) AS rn FROM e)"


def votes(spark, d):
    return funnel.track_vote(table(spark, d, "lineitem"), ["l_orderkey"], "l_linestatus", "l_linenumber", "l_discount", CONFIG.track_vote_threshold)


@query(VOTE + " SELECT l_orderkey, voted_label, round(frac, 6) AS vote_fraction, round(m, 6) AS mean_score, CASE WHEN frac >= 0.70::DOUBLE THEN 'auto_accept' ELSE 'ambiguous' END AS result FROM v WHERE rn = 1")
def q_track_vote(spark, d):
    return votes(spark, d).select("l_orderkey", "voted_label", r6("vote_fraction").alias("vote_fraction"), r6("mean_score").alias("mean_score"), "result")


@query(VOTE + " SELECT CASE WHEN frac >= 0.70::DOUBLE THEN 'auto_accept' ELSE 'ambiguous' END AS result, count(*) AS tracks FROM v WHERE rn = 1 GROUP BY 1")
def q_vote_stats(spark, d):
    return votes(spark, d).groupBy("result").agg(F.count("*").alias("tracks"))


def gate_sql(auto: float, low: float) -> str:
    return f"CASE WHEN value / 100 >= {auto}::DOUBLE THEN 'auto_accept' WHEN value / 100 >= {low}::DOUBLE THEN 'hitl' ELSE 'discard' END"


def gated(spark, d, config):
    return funnel.gated(table(spark, d, "events"), F.col("value") / 100, config)


@query(f"SELECT {gate_sql(0.20, 0.13)} AS gate, count(*) AS n FROM events GROUP BY 1")
def q_gate_config(spark, d):
    return gated(spark, d, CONFIG).groupBy("gate").agg(F.count("*").alias("n"))


@query(f"SELECT event_id, {gate_sql(0.85, 0.60)} AS gate FROM events")
def q_gate_documented(spark, d):
    return gated(spark, d, DOCUMENTED).select("event_id", "gate")


ROUTED = f"r AS (SELECT *, {gate_sql(0.85, 0.60)} AS gate, CASE WHEN value / 100 >= 0.60::DOUBLE THEN 'known' ELSE 'unknown' END AS known FROM events), t AS (SELECT *, CASE WHEN gate = 'auto_accept' AND known = 'known' THEN 'emit' WHEN gate = 'hitl' OR known = 'unknown' THEN 'queue' ELSE 'discard' END AS route FROM r)"


@query(f"WITH {ROUTED} SELECT event_type, route, count(*) AS n FROM t GROUP BY ALL")
def q_route(spark, d):
    return gated(spark, d, DOCUMENTED).groupBy("event_type", "route").agg(F.count("*").alias("n"))


@query(f"WITH {ROUTED}, s AS (SELECT event_type, count(*) AS total, count(*) FILTER (WHERE route = 'emit') AS emitted, count(*) FILTER (WHERE route = 'queue') AS queued, count(*) FILTER (WHERE gate = 'hitl') AS hitl, count(*) FILTER (WHERE known = 'unknown') AS unknown_clusters FROM t GROUP BY 1) SELECT *, round(CASE WHEN total = 0 THEN 0 ELSE emitted / total END, 6) AS pass_rate, round(hitl / (total + 1e-9), 6) AS hitl_rate, round(CASE WHEN emitted + hitl = 0 THEN 0 ELSE (emitted * 0.974::DOUBLE + hitl * 0.998::DOUBLE) / (emitted + hitl) END, 6) AS purity, CASE WHEN emitted + hitl = 0 THEN FALSE ELSE (emitted * 0.974::DOUBLE + hitl * 0.998::DOUBLE) / (emitted + hitl) >= 0.95 END AS target_met FROM s")
def q_funnel_stats(spark, d):
    s = gated(spark, d, DOCUMENTED).groupBy("event_type").agg(F.count("*").alias("total"), F.count_if(F.col("route") == "emit").alias("emitted"), F.count_if(F.col("route") == "queue").alias("queued"), F.count_if(F.col("gate") == "hitl").alias("hitl"), F.count_if(F.col("known") == "unknown").alias("unknown_clusters"))
    pure = scores.purity(F.col("emitted"), F.col("hitl"), CONFIG)
    return s.select("*", r6(scores.guarded(F.col("emitted"), F.col("total"))).alias("pass_rate"), r6(scores.rate(F.col("hitl"), F.col("total"))).alias("hitl_rate"), r6(pure).alias("purity"), (pure >= CONFIG.target_label_purity).alias("target_met"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, rn FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn <= 500")
def q_track_cap(spark, d):
    return funnel.capped(table(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"], CONFIG.samples_per_track_cap).select("l_suppkey", "l_orderkey", "l_linenumber", F.col("rn").cast("bigint").alias("rn"))


@query(DET + """, g AS (SELECT *, row_number() OVER (PARTITION BY video_path, entity_type, track_id ORDER BY seq) AS rn FROM d WHERE det_score >= 0.20::DOUBLE)
SELECT sha256(concat_ws('|', video_path, entity_type, CAST(track_id AS VARCHAR), CAST(seq AS VARCHAR))) AS record_id, format('cluster_{:04d}', track_id) AS cluster_id, entity_type || '_' || track_id % 7 AS label, entity_type, video_path, frame_idx, frame_idx * 40.0::DOUBLE AS timestamp_ms, track_id, x1 AS bbox_x1, y1 AS bbox_y1, x2 AS bbox_x2, y2 AS bbox_y2, det_score AS confidence, 'auto_accept' AS label_source FROM g WHERE rn <= 500""")
def q_emit_records(spark, d):
    """Detections through the gate, capped per track, as the 14 columns of a dataset record."""
    kept = funnel.gated(detections(spark, d), F.col("det_score"), CONFIG).where("route = 'emit'")
    kept = funnel.capped(kept, ["video_path", "entity_type", "track_id"], ["seq"], CONFIG.samples_per_track_cap)
    return kept.select(
        F.sha2(F.concat_ws("|", "video_path", "entity_type", "track_id", "seq"), 256).alias("record_id"), F.format_string("cluster_%04d", "track_id").alias("cluster_id"), F.concat_ws("_", "entity_type", F.col("track_id") % 7).alias("label"), "entity_type", "video_path", "frame_idx",
        (F.col("frame_idx") * F.lit(CONFIG.frame_ms)).alias("timestamp_ms"), "track_id", *[F.col(c).alias(f"bbox_{c}") for c in ("x1", "y1", "x2", "y2")], F.col("det_score").alias("confidence"), F.lit("auto_accept").alias("label_source"),
    )


@query("""WITH l AS (SELECT event_id AS seq, 'v' || user_id % 4 AS video_path, format('cluster_{:04d}', user_id) AS cluster_id, CASE WHEN event_id % 5 < 3 THEN 'add' WHEN event_id % 5 = 3 THEN 'confirm' ELSE 'reject' END AS event, event_type FROM events),
b AS (SELECT video_path, cluster_id, max(seq) FILTER (WHERE event = 'add') AS added, min(seq) FILTER (WHERE event = 'add') AS enqueued FROM l GROUP BY ALL HAVING max(seq) FILTER (WHERE event = 'add') IS NOT NULL),
n AS (SELECT l.*, row_number() OVER (PARTITION BY l.video_path, l.cluster_id ORDER BY l.seq) AS rn FROM l JOIN b USING (video_path, cluster_id) WHERE l.event <> 'add' AND l.seq > b.added)
SELECT b.video_path, b.cluster_id, b.enqueued, CASE n.event WHEN 'confirm' THEN 'hitl_confirmed' WHEN 'reject' THEN 'rejected' ELSE 'hitl_pending' END AS state, CASE WHEN n.event = 'confirm' THEN n.event_type END AS hitl_label, CASE WHEN n.event IS NOT NULL THEN 'human' END AS reviewed_by
FROM b LEFT JOIN n ON n.video_path = b.video_path AND n.cluster_id = b.cluster_id AND n.rn = 1""")
def q_review_fold(spark, d):
    return funnel.folded_reviews(review_log(spark, d), ["video_path", "cluster_id"])


@query("""WITH l AS (SELECT event_id AS seq, 'v' || user_id % 4 AS video_path, format('cluster_{:04d}', user_id) AS cluster_id, event_id % 5 AS k FROM events),
b AS (SELECT video_path, cluster_id, max(seq) FILTER (WHERE k < 3) AS added, min(seq) FILTER (WHERE k < 3) AS enqueued, max(seq) FILTER (WHERE k >= 3) AS decided FROM l GROUP BY ALL)
SELECT cluster_id, video_path, enqueued FROM b WHERE added IS NOT NULL AND (decided IS NULL OR decided < added) ORDER BY enqueued LIMIT 1""")
def q_queue_head(spark, d):
    """The oldest pending entry; it stays in the queue."""
    return funnel.folded_reviews(review_log(spark, d), ["video_path", "cluster_id"]).where("state = 'hitl_pending'").orderBy("enqueued").limit(1).select("cluster_id", "video_path", "enqueued")


@query(f"WITH {ROUTED} SELECT event_id, 'auto_accept' AS label_source, value AS confidence, 1.0 AS weight FROM t WHERE route = 'emit' UNION ALL SELECT event_id, 'hitl_confirmed', 100.0, 2.0 FROM t WHERE route = 'queue' AND event_id % 100 < 85")
def q_union_records(spark, d):
    t = gated(spark, d, DOCUMENTED)
    auto = t.where("route = 'emit'").select("event_id", F.lit("auto_accept").alias("label_source"), F.col("value").alias("confidence"), F.lit(CONFIG.pseudo_label_weight).alias("weight"))
    hitl = t.where("route = 'queue' and event_id % 100 < 85").select("event_id", F.lit("hitl_confirmed").alias("label_source"), F.lit(100.0).alias("confidence"), F.lit(CONFIG.hitl_label_weight).alias("weight"))
    return auto.unionByName(hitl)


# Monitoring.

GOLD = "g AS (SELECT toxic AS t, CASE WHEN n_chars % 5 = 0 THEN 1 ELSE 0 END AS p, doc_id % 2 AS run FROM labels JOIN documents USING (doc_id)), s AS (SELECT run, t AS label, CAST(t = p AS INT) AS tp, 0 AS fp, CAST(t <> p AS INT) AS fn FROM g UNION ALL SELECT run, p, 0, CAST(t <> p AS INT), 0 FROM g)"


def gold(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return j.select(F.col("toxic").alias("true_label"), F.when(F.col("n_chars") % 5 == 0, 1).otherwise(0).alias("pred_label"), (F.col("doc_id") % 2).alias("run"))


@query(f"WITH {GOLD} SELECT label, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM s GROUP BY label")
def q_gold_confusion(spark, d):
    return monitor.confusion(gold(spark, d))


PRF = "a AS (SELECT *, tp / (tp + fp + 1e-9) AS p, tp / (tp + fn + 1e-9) AS r FROM (SELECT {k} label, sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp, sum(fn)::DOUBLE AS fn FROM s GROUP BY ALL)), f AS (SELECT *, 2 * p * r / (p + r + 1e-9) AS f1 FROM a)"


@query(f"WITH {GOLD}, {PRF.format(k='')} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, f1 < 0.85 AS below_floor FROM f")
def q_gold_f1(spark, d):
    f = monitor.class_scores(monitor.confusion(gold(spark, d)))
    return f.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), (F.col("f1") < CONFIG.gold_f1_min).alias("below_floor"))


@query(f"WITH {GOLD}, {PRF.format(k='')} SELECT round(avg(f1), 6) AS macro_f1 FROM f")
def q_gold_macro(spark, d):
    return monitor.class_scores(monitor.confusion(gold(spark, d))).agg(r6(F.avg("f1")).alias("macro_f1"))


@query(f"WITH {GOLD}, {PRF.format(k='run,')} SELECT n.label AS label, round(n.f1, 3) - round(o.f1, 3) < -0.02 AS regressed, round(round(n.f1, 3) - round(o.f1, 3), 3) AS delta FROM f n JOIN f o ON n.label = o.label AND n.run = 1 AND o.run = 0")
def q_gold_regression(spark, d):
    g = gold(spark, d)
    one = lambda k: monitor.class_scores(monitor.confusion(g.where(F.col("run") == k))).select("label", F.round("f1", 3).alias(f"f{k}"))
    delta = F.col("f1") - F.col("f0")
    return one(1).join(one(0), "label").select("label", (delta < -CONFIG.gold_f1_drop_alert).alias("regressed"), F.round(delta, 3).alias("delta"))


def psi_sql(rows: str) -> str:
    return f"""WITH v AS ({rows}), q AS (SELECT list_transform(quantile_cont(value, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) FILTER (WHERE side = 'expected'), lambda x: round(x, 6)) AS e FROM v),
c AS (SELECT k, count(*) FILTER (WHERE side = 'expected') AS x, count(*) FILTER (WHERE side = 'actual') AS y FROM v, q, range(1, 11) r(k) WHERE value >= e[k] - CASE WHEN k = 1 THEN 1e-9 ELSE 0 END AND (value < e[k + 1] + CASE WHEN k = 10 THEN 1e-9 ELSE 0 END OR (k = 10 AND value <= e[11] + 1e-9)) GROUP BY k),
n AS (SELECT count(*) FILTER (WHERE side = 'expected') AS nx, count(*) FILTER (WHERE side = 'actual') AS ny FROM v),
z AS (SELECT greatest(coalesce(x, 0) / nx, 1e-9) AS e, greatest(coalesce(y, 0) / ny, 1e-9) AS a FROM range(1, 11) r(k) LEFT JOIN c USING (k), n)
SELECT round(sum((a - e) * ln(a / e)), 6) AS psi, CASE WHEN sum((a - e) * ln(a / e)) > 0.35 THEN 'severe' WHEN sum((a - e) * ln(a / e)) > 0.25 THEN 'warn' ELSE 'ok' END AS alert FROM z"""


def drift(df):
    return monitor.psi(df, "value", "side").select(r6("psi").alias("psi"), monitor.drift_alert(F.col("psi"), CONFIG).alias("alert"))


@query(psi_sql("SELECT value, CASE WHEN event_id % 2 = 0 THEN 'expected' ELSE 'actual' END AS side FROM events"))
def q_psi_value(spark, d):
    return drift(table(spark, d, "events").select("value", F.when(F.col("event_id") % 2 == 0, "expected").otherwise("actual").alias("side")))


@query(psi_sql("SELECT l_extendedprice AS value, CASE WHEN year(l_shipdate) % 2 = 0 THEN 'expected' ELSE 'actual' END AS side FROM lineitem"))
def q_psi_price_year(spark, d):
    return drift(table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("value"), F.when(F.year("l_shipdate") % 2 == 0, "expected").otherwise("actual").alias("side")))


DAYS = f"g AS (SELECT strftime(ts, '%Y-%m-%d') AS date_str, {gate_sql(0.85, 0.60)} AS gate FROM events), y AS (SELECT date_str, count(*) AS total_crops, count(*) FILTER (WHERE gate = 'auto_accept') AS auto_accept, count(*) FILTER (WHERE gate = 'hitl') AS hitl_routed, row_number() OVER (ORDER BY date_str) AS seq FROM g GROUP BY date_str)"


@query(f"""WITH {DAYS}, w AS (SELECT *, auto_accept / (total_crops + 1e-9) AS rate FROM y), a AS (SELECT date_str, seq, sum(hitl_routed) OVER (ORDER BY seq ROWS 6 PRECEDING) AS week, sum(hitl_routed) OVER (ORDER BY seq ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS before,
 avg(rate) OVER (ORDER BY seq ROWS 6 PRECEDING) AS recent, avg(rate) OVER (ORDER BY seq ROWS BETWEEN 29 PRECEDING AND 7 PRECEDING) AS baseline FROM w)
SELECT date_str, CAST(week AS BIGINT) AS week, CAST(before AS BIGINT) AS before, round(recent, 6) AS recent, round(baseline, 6) AS baseline, coalesce(seq >= 8 AND before > 0 AND (week - before) / before >= 0.20::DOUBLE, FALSE) AS hitl_alert, coalesce(baseline > 0 AND baseline - recent > 0.05::DOUBLE, FALSE) AS drop_alert FROM a""")
def q_rolling_alerts(spark, d):
    a = monitor.rolling_alerts(monitor.daily(gated(spark, d, DOCUMENTED)), CONFIG.hitl_growth_alert, CONFIG.auto_drop_alert)
    return a.select("date_str", "week", "before", r6("recent").alias("recent"), r6("baseline").alias("baseline"), "hitl_alert", "drop_alert")


@query(f"WITH {DAYS} SELECT round(avg(auto_accept / (total_crops + 1e-9)), 3) AS auto_accept_rate, round(avg(hitl_routed / (total_crops + 1e-9)), 4) AS hitl_rate, count(*) AS days FROM (SELECT * FROM y ORDER BY seq DESC LIMIT 7)")
def q_rolling_summary(spark, d):
    last = monitor.daily(gated(spark, d, DOCUMENTED)).orderBy(F.desc("seq")).limit(7)
    return last.agg(F.round(F.avg(scores.rate(F.col("auto_accept"), F.col("total_crops"))), 3).alias("auto_accept_rate"), F.round(F.avg(scores.rate(F.col("hitl_routed"), F.col("total_crops"))), 4).alias("hitl_rate"), F.count("*").alias("days"))


POOL = "p AS (SELECT event_id AS seq, event_type AS label, CASE WHEN event_id % 10 = 0 THEN 1.0 ELSE value / 100 END AS confidence, CASE WHEN event_id % 10 = 0 THEN 2.0 ELSE 1.0 END AS weight FROM events WHERE event_id % 10 = 0 OR value / 100 >= 0.20::DOUBLE)"


def pool(spark, d):
    human = F.col("event_id") % 10 == 0
    e = table(spark, d, "events").where(human | (F.col("value") / 100 >= CONFIG.auto_accept_score))
    return e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("label"), F.when(human, 1.0).otherwise(F.col("value") / 100).alias("confidence"), F.when(human, CONFIG.hitl_label_weight).otherwise(CONFIG.pseudo_label_weight).alias("weight"))


@query(f"WITH {POOL} SELECT label, count(*) AS total, count(*) FILTER (WHERE weight > 1) AS hitl, count(*) FILTER (WHERE weight <= 1) AS auto, round(avg(confidence), 6) AS confidence FROM p GROUP BY label")
def q_label_distribution(spark, d):
    return pool(spark, d).groupBy("label").agg(F.count("*").alias("total"), F.count_if(F.col("weight") > 1).alias("hitl"), F.count_if(F.col("weight") <= 1).alias("auto"), r6(F.avg("confidence")).alias("confidence"))


@query(f"WITH {POOL}, a AS (SELECT * FROM p ORDER BY seq LIMIT 3000) SELECT * FROM a ORDER BY seq DESC LIMIT 1000")
def q_replay_buffer(spark, d):
    """The pool's first rows go in; the buffer keeps its last. Sizes are those of the SQL, smaller than the setting."""
    return monitor.replay_buffer(pool(spark, d), 3000, 1000)


@query(f"WITH {POOL}, a AS (SELECT * FROM p ORDER BY seq LIMIT {CONFIG.replay_buffer_size}) SELECT * FROM a ORDER BY seq DESC LIMIT {CONFIG.replay_buffer_size}")
def q_replay_buffer_config(spark, d):
    """The replay buffer at the size that is set, as in the reference: the pool's first N go in, the buffer keeps its last N."""
    return monitor.replay_buffer(pool(spark, d), CONFIG.replay_buffer_size, CONFIG.replay_buffer_size)


# State.


@query()
def q_stream_tracker(spark, d):
    """The tracker over a stream of boxes: the same ids as in batch where frames arrive in order."""
    return stream.tracked_once(spark, detections(spark, d))


@query("SELECT strftime(ts, '%Y-%m-%d') AS date_str, user_id % 4 AS video, count(*) AS total_crops, count(*) FILTER (WHERE value / 100 >= 0.85::DOUBLE) AS auto_accept FROM events GROUP BY ALL")
def q_stream_snapshot(spark, d):
    """Daily snapshots of a stream with a watermark."""
    return stream.snapshots_once(spark, f"{d}/events.parquet")


@query("SELECT vec_id, CAST(label % 2 = 0 AS INT) AS kind, len(embedding) AS dim FROM embeddings")
def q_model_udf_slot(spark, d):
    """A model slot: vectors in, a struct out, in Arrow batches (here a stand-in that tells kind and size)."""
    return udfs.apply_model(embeddings(spark, d), lambda x, extra: {"kind": (extra % 2 == 0).astype("int32"), "dim": [x.shape[1]] * len(x)}, "kind int, dim long", extra="label").select("vec_id", "kind", "dim")


@query()
def q_tracker_batch(spark, d):
    b = detections(spark, d)
    return tracker.track(b.select("video_path", "frame_idx").distinct(), b.select("video_path", "frame_idx", "seq", "entity_type", "x1", "y1", "x2", "y2"))
