"""Gate bounds, purity, votes, queue, similarity, drift and tracking on small hand-made inputs."""

import numpy as np
from pyspark.sql import functions as F

from tracksieve.config import CONFIG, DOCUMENTED
from tracksieve.functions import scores, vectors
from tracksieve.operators import funnel, graph, monitor
from tracksieve.operators.tracker import Tracker
from tracksieve.plans import catalogue, stages


def test_gate_bounds(spark):
    want = {0.90: "auto_accept", 0.85: "auto_accept", 0.70: "hitl", 0.60: "hitl", 0.84: "hitl", 0.59: "discard", 0.0: "discard", 0.5999: "discard"}
    df = spark.createDataFrame([(s,) for s in want] + [(None,), (float("nan"),)], "s double")
    got = [(r[0], r[1]) for r in df.select("s", scores.gate(F.col("s"), DOCUMENTED.auto_accept_score, DOCUMENTED.hitl_low_score)).collect()]
    assert {s: g for s, g in got if s is not None and s == s} == want
    assert [g for s, g in got if s is None or s != s] == ["discard", "discard"]


def test_vote_takes_first_seen_on_ties(spark):
    df = spark.createDataFrame([(1, "b", 1, 0.5), (1, "a", 2, 0.7), (2, "a", 1, 1.0)], "t long, label string, seq long, score double")
    got = {r["t"]: r for r in funnel.track_vote(df, ["t"], "label", "seq", "score", 0.7).collect()}
    assert got[1]["voted_label"] == "b" and got[1]["result"] == "ambiguous"
    assert got[2]["vote_fraction"] == 1.0 and got[2]["result"] == "auto_accept"


def test_review_queue(spark):
    log = [(1, "a", "add", None, None), (2, "b", "add", None, None), (3, "b", "confirm", "nike", "human"), (4, "c", "confirm", "x", "human"), (5, "d", "add", None, None), (6, "d", "reject", None, "human")]
    df = spark.createDataFrame(log, "seq long, cluster_id string, event string, label string, reviewer string")
    got = {r["cluster_id"]: (r["state"], r["hitl_label"]) for r in funnel.folded_reviews(df, ["cluster_id"]).collect()}
    assert got == {"a": ("hitl_pending", None), "b": ("hitl_confirmed", "nike"), "d": ("rejected", None)}


def test_purity(spark):
    df = spark.createDataFrame([(2250, 0), (0, 0), (50, 50)], "a long, h long")
    got = [round(r[0], 6) for r in df.select(scores.purity(F.col("a"), F.col("h"), CONFIG)).collect()]
    assert got == [0.974, 0.0, 0.986]


def test_edges_and_components_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, entity int")
    edges = graph.similarity_edges(df, 0.9)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if i % 2 == j % 2 and x[i] @ x[j] >= 0.9}
    assert {(r["src"], r["dst"]) for r in edges.collect()} == want
    label = list(range(300))
    for _ in range(300):
        for i, j in want:
            label[i] = label[j] = min(label[i], label[j])
    assert {r["vec_id"]: r["component"] for r in graph.components(edges, df).collect()} == dict(enumerate(label))


def test_empty_components(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>, entity int")
    assert graph.components(graph.similarity_edges(df, 0.5), df).collect() == []


def test_zero_mean_stays(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [3.0, 4.0])], "k long, embedding array<double>")
    got = {r["k"]: list(r["mean_embedding"]) for r in vectors.means(df, ["k"]).collect()}
    assert got[1] == [0.0, 0.0] and np.allclose(got[2], [0.6, 0.8])


def test_psi(spark):
    base = np.random.default_rng(0).normal(size=1000)

    def psi(actual):
        rows = [("expected", float(v)) for v in base] + [("actual", float(v)) for v in actual]
        return monitor.psi(spark.createDataFrame(rows, "side string, value double"), "value", "side").first()[0]

    assert psi(base) < 0.01 and psi(base + 2) > 0.25 and 0.01 < psi(base + 0.3) < 0.5


def test_tracker_rules():
    t = Tracker()
    box = (0.0, 0.0, 10.0, 10.0)
    assert t.update([box, box]) == [1, 1]  # a new track stays free within its call
    assert t.update([box]) == [1]
    for _ in range(11):
        t.update([])
    assert t.update([box]) == [2]


def test_replay_buffer_has_the_set_size(spark):
    pool = spark.range(20).select((F.col("id") * 7 % 20).alias("seq"))
    assert [r["seq"] for r in monitor.replay_buffer(pool, 6, 4).collect()] == [5, 4, 3, 2]
    n = catalogue.pool(spark, "/root/testdata/sf0.01").count()
    assert 1000 < n < CONFIG.replay_buffer_size and catalogue.QUERIES["q_replay_buffer_config"](spark, "/root/testdata/sf0.01").count() == n
    assert catalogue.QUERIES["q_replay_buffer_config"](spark, "/root/testdata/sf0.1").count() == CONFIG.replay_buffer_size


def test_release_collects_garbage_on_executors(spark):
    """A task a core has its JVM collect, after the driver's own collection; here all of them are one JVM."""
    sc = spark.sparkContext
    beans = sc._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    count = lambda: sum(b.getCollectionCount() for b in beans() if "Young" not in b.getName())
    before = count()
    sc.setJobGroup("release", "release")
    try:
        stages.release(spark)
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("release")]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sum(sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds) == sc.defaultParallelism
    assert count() >= before + 2
