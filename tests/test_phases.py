"""The flow from boxes to records on hand-made inputs, reviews, monitors, sinks and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracksieve.config import CONFIG, DOCUMENTED, Config
from tracksieve.functions import scores, vectors
from tracksieve.operators import funnel, graph, monitor, phases, ranks, reviews, tracker, udfs
from tracksieve.sources import fixtures, tables
from tracksieve.streaming import stream

CROP = "video_path string, entity_type string, track_id long, frame_idx int, seq long, x1 double, y1 double, x2 double, y2 double, det_score double, embedding array<double>, frame_label string, timestamp_ms double"


def crop(seq, video, kind, track, vector, label="x"):
    return (video, kind, track, seq % 50, seq, 0.0, 0.0, 100.0, 100.0, 0.9, vector, label, seq % 50 * 40.0)


@pytest.fixture(scope="module")
def flow(spark):
    """Two videos: near-equal logos a and b and an odd one; a face near its name; another in the middle of nowhere."""
    near, far, dim = [1.0, 0.02, 0.0], [0.0, 0.0, 1.0], [0.12, 0.9928, 0.0]
    tracks = [("v1", "logo", 1, [1.0, 0.0, 0.0], 3), ("v1", "logo", 2, near, 600), ("v1", "logo", 3, far, 2), ("v1", "face", 1, [0.0, 1.0, 0.0], 4), ("v2", "logo", 1, far, 5), ("v2", "face", 9, far, 1), ("v2", "logo", 4, dim, 2)]
    rows, seq = [], 0
    for video, kind, track, vector, n in tracks:
        for k in range(n):
            rows.append(crop(seq, video, kind, track, vector, "xy"[k % 2] if track == 3 else "x"))
            seq += 1
    known = spark.createDataFrame([("logo", "big brand", 0, [1.0, 0.0, 0.0]), ("logo", "same brand", 1, [1.0, 0.0, 0.0]), ("face", "some one", 0, [0.0, 1.0, 0.0])], "entity_type string, name string, idx int, vector array<double>")
    return phases.Flow(spark.createDataFrame(rows, CROP), known, CONFIG)


def test_clusters_of_the_flow(flow):
    got = {(r["video_path"], r["component"]): r for r in flow.clusters.collect()}
    assert [got["v1", c]["cluster_id"] for c in (0, 603, 605)] == ["cluster_0000", "brand_unknown_001", "cluster_0002"]
    assert got["v1", 0]["tracklets"] == 2 and got["v1", 0]["sample_count"] == 603 and got["v1", 0]["clip_label"] == "big_brand"
    assert got["v2", 609]["cluster_id"] == "brand_unknown_002" and got["v2", 614]["cluster_id"] == "face_unknown_001" and got["v2", 615]["cluster_id"] == "brand_unknown_003"
    assert got["v1", 603]["tss"] == 1.0 and 0.99 < got["v1", 0]["tss"] <= 1.0
    assert got["v1", 605]["route"] == "emit" and got["v2", 609]["route"] == "queue"


def test_records_stats_and_summary(flow):
    kept = flow.records.collect()
    cap = [r for r in kept if r["cluster_id"] == "cluster_0000"]
    assert len(cap) == 503 and {r["label"] for r in cap} == {"big_brand"} and all(r["confidence"] > 0.99 and r["label_source"] == "auto_accept" for r in cap)
    assert len({r["record_id"] for r in kept}) == len(kept)
    confirmed = {c: (c * 37) % 100 < 85 for c in (603, 609, 614, 615)}
    assert {r["cluster_id"] for r in kept if r["label_source"] == "hitl_confirmed"} == {n for n, c in (("brand_unknown_001", 603), ("brand_unknown_002", 609), ("face_unknown_001", 614), ("brand_unknown_003", 615)) if confirmed[c]}
    stats = {r["video_path"]: r for r in flow.stats.collect()}
    assert stats["v1"]["total_crops"] == 609 and stats["v1"]["after_track_vote"] == 607 and stats["v1"]["discarded"] == 2
    assert stats["v1"]["clusters_known"] == 2 and stats["v1"]["clusters_unknown"] == 1 and stats["v1"]["clusters_hitl_as_coded"] == 1
    told = flow.summary(1.234).collect()
    assert len(told[0]) == 14 and told[0]["elapsed_s"] == 1.23 and all(r["target_purity_met"] for r in told)
    assert {r["weight"] for r in flow.pool().collect()} <= {1.0, 2.0}


def test_representatives_of_equal_tracklets_go_by_seq(spark):
    """Two tracklets of one size tie by their distance from the mean, also if one's norm is off by a float's precision."""
    vectors_of = [[1.0, 0.0], [0.96 * (1 + 1e-6), 0.28 * (1 + 1e-6)]]
    crops = spark.createDataFrame([crop(s, "v", "logo", s % 2, vectors_of[s % 2]) for s in range(12)], CROP)
    members = spark.createDataFrame([("v", "logo", 0, 0, 0), ("v", "logo", 1, 1, 0)], "video_path string, entity_type string, track_id long, node long, component long")
    assert {r["seq"] for r in phases.representatives(members, crops).collect()} == {0, 1, 2, 3, 4}


def test_values_rounded_before_round_as_in_sql(spark):
    """Nine places to six: a tie in decimal, but the double is scaled first."""
    import duckdb

    values = [0.1309425, -0.1309425, 0.0000005, -0.0000015, 0.1234565, 2.5e-7, 1.0, 0.0, 1e300, float("inf")] + [(2 * k + 1) / 2e6 for k in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sql = duckdb.sql(f"SELECT round(unnest({[str(v) for v in values]}::DOUBLE[]), 6)").fetchall()
    assert [r[0] for r in df.select(scores.rounded("v", 6)).collect()] == [r[0] for r in sql]
    assert [r[0] for r in df.select(F.round("v", 6)).collect()] != [r[0] for r in sql]


def test_no_tracklets_give_nothing(spark, flow):
    none = phases.Flow(flow.crops.where("false"), spark.createDataFrame([], "entity_type string, name string, idx int, vector array<double>"), CONFIG)
    assert none.clusters.count() == 0 and none.records.count() == 0 and none.stats.count() == 0


def test_empty_tracklet_vote(spark, flow):
    tracks = spark.createDataFrame([("v9", "logo", 1)], "video_path string, entity_type string, track_id long")
    assert phases.voted(flow.crops, CONFIG, tracks).select("result", "voted_label", "mean_score").collect() == [("discard", "", 0.0)]


def test_runner_from_boxes(spark):
    """Frames with and without boxes; a narrow logo is tracked, then dropped; a small face is not tracked."""
    boxes = [("v", 0, 0, "logo", 0.0, 0.0, 100.0, 50.0, 0.9), ("v", 1, 1, "logo", 2.0, 0.0, 102.0, 50.0, 0.9), ("v", 1, 2, "face", 300.0, 0.0, 400.0, 100.0, 0.9), ("v", 1, 3, "face", 300.0, 0.0, 400.0, 100.0, 0.4), ("v", 2, 4, "logo", 500.0, 0.0, 520.0, 50.0, 0.9), ("v", 20, 5, "logo", 2.0, 0.0, 102.0, 50.0, 0.9)]
    frames = spark.range(21).select(F.lit("v").alias("video_path"), F.col("id").cast("int").alias("frame_idx"))
    df = spark.createDataFrame(boxes, "video_path string, frame_idx int, seq long, entity_type string, x1 double, y1 double, x2 double, y2 double, det_score double")
    crops = {r["seq"]: r for r in phases.phase1(frames, df, CONFIG).collect()}
    assert {s: r["track_id"] for s, r in crops.items()} == {0: 1, 1: 1, 2: 2, 5: 4}  # 3 was the narrow one; the first has aged
    assert crops[2]["display_track"] == 10002 and crops[1]["timestamp_ms"] == 40.0 and crops[0]["crop_id"].startswith("logo_")
    counts = phases.size_counts(df, CONFIG).first()
    assert (counts["logos"], counts["faces"], counts["small_logos"], counts["small_faces"]) == (3, 1, 1, 1)
    embed = lambda c: udfs.embed(c, {"logo": lambda i: ([1.0, 0.0], 1.0), "face": lambda i: ([0.0, 1.0], 0.4)}).withColumn("frame_label", F.lit("x"))
    known = spark.createDataFrame([("logo", "a b", 0, [1.0, 0.0]), ("face", "c", 0, [0.0, 1.0])], "entity_type string, name string, idx int, vector array<double>")
    out = phases.run(frames, df, embed, known, CONFIG)
    assert {(r["label"], r["track_id"]) for r in out.records.collect()} == {("a_b", 1), ("c", 2), ("a_b", 4)}


def test_forced_links_and_similar_links(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, entity int")
    full = {r[0]: r[1] for r in graph.components(graph.similarity_edges(df, 0.85), df).collect()}
    links = graph.similar_links(df, 0.85)
    assert {r[0]: r[1] for r in graph.components(links, df).collect()} == full and links.count() <= 120
    t = spark.createDataFrame([(5, "v", 1), (3, "v", 1), (9, "v", 2), (8, "w", 1)], "node long, video_path string, track_id long")
    assert {(r[0], r[1]) for r in phases.forced_links(t).collect()} == {(3, 5)}


def test_nearest_is_first_on_ties_and_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    protos = spark.createDataFrame([(7, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 2.0])], "label long, mean_embedding array<double>")
    assert {r["vec_id"]: (r["proto"], r["sim"]) for r in graph.nearest(df, protos, "label").collect()} == {1: (3, 1.0), 2: (5, 2.0)}
    monkeypatch.setattr(graph, "MATRIX_BYTES", 8)
    with pytest.raises(ValueError):
        graph.nearest(df, protos, "label")


def test_ranks_and_percentiles(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 3, 500), rng.permutation(500))]
    df = spark.createDataFrame(rows, "k int, v long")
    got = {(r["k"], r["v"]): r["place"] for r in ranks.ranked(df, ["v"], ("k",), "place").collect()}
    assert got == {(k, v): sorted(b for a, b in rows if a == k).index(v) for k, v in rows}
    for values in (rng.integers(0, 20, 333) / 7, rng.normal(size=10), np.array([2.5])):
        one = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
        shares = [k / 10 for k in range(11)]
        assert np.allclose(ranks.percentiles(one, "x", shares).first()[0], np.percentile(values, [10 * k for k in range(11)]))


def test_tss_bounds(spark):
    rng = np.random.default_rng(42)
    unit = lambda n, d: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.normal(size=(n, d)))
    one = unit(1, 128)[0]
    groups = {"same": [one] * 5, "random": list(unit(10, 1024)), "single": [one]}
    rows = [("v", i, f"t{g}", "logo", 1, x.tolist()) for i, (g, xs) in enumerate(groups.items()) for x in xs]
    got = {r["component"]: r["tss"] for r in phases.assembled(spark.createDataFrame(rows, "video_path string, component long, t string, entity_type string, frame_count long, mean_embedding array<double>")).collect()}
    assert got[0] > 0.95 and got[1] < 0.3 and got[2] == 1.0


def test_purity_is_higher_with_stricter_bounds(spark):
    rng = np.random.default_rng(1)
    rows = [("v", i, "logo", i, 20, 1.0, float(s), "puma") for i, s in enumerate(rng.uniform(0.45, 0.99, 40))]
    df = spark.createDataFrame(rows, "video_path string, component long, entity_type string, cluster_idx int, sample_count long, tss double, clip_score double, clip_label string")

    def purity(auto, low):
        config = Config(auto_accept_score=auto, hitl_low_score=low, known_threshold=0.60)
        routes = phases.routed(df.withColumn("status", scores.status(F.col("clip_score"), config)), config)
        done = phases.decided(routes, phases.simulated_review(routes.where("route = 'queue'")))
        n = done.agg(F.sum(F.when(F.col("route") == "emit", F.col("sample_count")).otherwise(0)).alias("a"), F.sum(F.when(F.col("state") == "hitl_confirmed", F.col("sample_count")).otherwise(0)).alias("h"))
        return n.select(scores.purity(F.col("a"), F.col("h"), config)).first()[0]

    assert purity(0.95, 0.70) >= purity(0.60, 0.40) >= 0.95


def test_gate_accepts_fewer_at_a_higher_bound(spark):
    df = spark.createDataFrame([(float(s),) for s in np.linspace(0.60, 0.99, 100)], "s double")
    accepted = lambda b: df.where(scores.gate(F.col("s"), b, 0.60) == "auto_accept").count()
    assert accepted(0.90) < accepted(DOCUMENTED.auto_accept_score)


def test_queue_lists_and_session(spark):
    log = [(1, "a", "add", None, None), (2, "b", "add", None, None), (3, "b", "confirm", "lululemon", "human"), (4, "c", "add", None, None), (5, "c", "reject", None, "human"), (6, "z", "confirm", "x", "human")]
    folded = funnel.folded_reviews(spark.createDataFrame(log, "seq long, cluster_id string, event string, label string, reviewer string"), ["cluster_id"])
    assert {r["state"]: r["n"] for r in reviews.counts(folded).collect()} == {"hitl_pending": 1, "hitl_confirmed": 1, "rejected": 1}
    assert {(r["state"], r["cluster_id"], r["place"]) for r in reviews.lists(folded).collect()} == {("hitl_pending", "a", 0), ("hitl_confirmed", "b", 0), ("rejected", "c", 0)}
    pending = spark.createDataFrame([(1, "nike"), (2, None), (3, None), (4, "puma"), (5, "puma"), (6, None)], "id long, clip_label string")
    said = spark.createDataFrame([(1, "confirm", None), (2, "confirm", "  Mine "), (3, "label", "   "), (4, "reject", None), (5, "skip", None)], "id long, action string, typed string")
    done = reviews.session(pending, said, ["id"])
    assert {r["id"]: (r["outcome"], r["hitl_label"]) for r in done.collect()} == {1: ("hitl_confirmed", "nike"), 2: ("hitl_confirmed", "mine"), 3: ("skipped", None), 4: ("rejected", None), 5: ("skipped", None), 6: ("skipped", None)}
    assert tuple(reviews.session_totals(done).first()) == (6, 3, 2, 3)
    final = spark.createDataFrame([("", "known", "a"), ("b", "unknown", None), (None, "unknown", "c")], "hitl_label string, status string, clip_label string")
    assert [r[0] for r in final.select(scores.final_label()).collect()] == ["a", "b", None]


def test_records_by_video_and_cached_stages(spark, flow, tmp_path):
    path = f"{tmp_path}/dataset"
    kept = flow.records.withColumn("video_path", F.concat(F.lit("dir/"), "video_path", F.lit(".mp4")))
    tables.save_records(kept, path)
    assert {p.name for p in (tmp_path / "dataset").glob("video_stem=*")} == {"video_stem=v1", "video_stem=v2"}
    n = spark.read.parquet(path).where("video_stem = 'v1'").count()
    tables.save_records(kept.where("video_path = 'dir/v2.mp4'").limit(1), path)  # the other video stays
    again = spark.read.parquet(path)
    assert again.where("video_stem = 'v1'").count() == n and again.where("video_stem = 'v2'").count() == 1 and len(again.columns) == 15
    assert tables.cached(spark, f"{tmp_path}/stage") is None
    tables.save_stage(kept.limit(3), f"{tmp_path}/stage")
    assert tables.cached(spark, f"{tmp_path}/stage").count() == 3


def test_monitor_remembers(spark, tmp_path):
    m = monitor.Monitor(CONFIG, str(tmp_path))
    days = lambda lo, hi, hitl: spark.createDataFrame([(i, f"d{i:03}", 100, 50, hitl, 1, 2, 10) for i in range(lo, hi)], "seq long, date_str string, total_crops long, auto_accept long, hitl_routed long, discarded long, unknown_clusters long, total_clusters long")
    assert not any(r["hitl_alert"] for r in m.record_batch(days(1, 8, 10)).collect())
    assert m.record_batch(days(8, 15, 12)).orderBy(F.desc("seq")).first()["hitl_alert"]
    m.record_batch(days(15, 120, 12))
    assert tuple(m.summary(spark).first()) == (0.5, 0.12, 0.2, 90)
    runs = lambda run, good: spark.createDataFrame([(run, "a", "a" if i < good else "b") for i in range(100)], "run int, true_label string, pred_label string")
    assert [r["alerts"] for r in m.gold_eval(runs(1, 99)).where("run = 1").collect()][0] == ["b below floor"]
    assert "a regressed" in m.gold_eval(runs(2, 80)).where("run = 2").first()["alerts"]
    vectors_of = lambda shift: fixtures.drift_vectors(spark, 500, 64, shift).select(monitor.row_mean("embedding").alias("value"))
    weeks = [vectors_of(0.0).select(F.lit(w).alias("week"), F.lit("logo").alias("entity_type"), "value") for w in (1, 2, 3)] + [vectors_of(0.0).select(F.lit(4), F.lit("logo"), F.col("value") + 1.0)]
    got = {r["week"]: r["alert"] for r in m.drift(weeks[0].union(weeks[1]).union(weeks[2]).union(weeks[3])).collect()}
    assert got == {3: "ok", 4: "severe"}
    assert fixtures.gold_samples(spark).count() == 600 and fixtures.gold_samples(spark).select("difficulty").distinct().count() == 4
    pool = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "label string, weight double")
    assert monitor.fine_tune(pool, CONFIG).first().asDict() == {"status": "completed", "total_samples": 2, "hitl_confirmed": 1, "auto_accept": 1, "label_distribution": {"a": 2}, "replay_buffer_size": 2}
    assert monitor.fine_tune(pool.where("false"), CONFIG).first()["status"] == "skipped"


def test_stream_tracks_as_batch_does(spark):
    rows = [("v" + str(i % 2), i // 6, i, "logo" if i % 3 else "face", float(i * 37 % 50), 0.0, float(i * 37 % 50 + 60), 60.0) for i in range(120)]
    boxes = spark.createDataFrame(rows, "video_path string, frame_idx int, seq long, entity_type string, x1 double, y1 double, x2 double, y2 double")
    batch = tracker.track(boxes.select("video_path", "frame_idx").distinct(), boxes)
    shown = lambda df: {r["seq"]: r["assigned"] for r in df.collect()}
    assert shown(stream.tracked_once(spark, boxes)) == shown(batch)


def test_means_by_summary_equal_sums(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i % 3, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 4)))], "k int, embedding array<double>")
    a = {r["k"]: list(r["mean_embedding"]) for r in vectors.means(df, ["k"]).collect()}
    b = {r["k"]: list(r["mean_embedding"]) for r in phases.mean_vectors(df, ["k"]).collect()}
    assert all(np.allclose(a[k], b[k]) for k in a)
