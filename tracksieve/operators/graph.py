"""Similarity edges and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.stages import discard, ship, written

BLOCK = 512  # vectors of a block


def _block_pairs(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    """Rows of each pair of blocks within a group: a vector goes to as many pairs as its group has blocks, so what moves is
    n * n / BLOCK rows of a group of n. All pairs are compared: angles in many dimensions give no bound that would spare
    pairs at thresholds like these, and nothing may be left out."""
    counts = df.groupBy(group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_k"))
    rows = df.join(counts, group).withColumn("_b", F.pmod(F.xxhash64(key), "_k").cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return rows.select(group, F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), "_b", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"))


def _near(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smaller id, larger id, weight) of the pairs between two blocks that reach the threshold: one matrix product."""
    ids, own = table.column("id").to_numpy(), table.column("_b").to_numpy()
    i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
    x = np.array(table.column("v").to_pylist())
    a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
    s = x[a] @ x[b].T
    p, q = np.nonzero(s >= threshold)
    left, right, w = ids[a[p]], ids[b[q]], s[p, q]
    keep = left < right if i == j else left != right
    return np.minimum(left, right)[keep], np.maximum(left, right)[keep], w[keep]


def similarity_edges(df: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", group: str = "entity") -> DataFrame:
    """(src, dst, weight) of all pairs src < dst within a group whose dot product reaches the threshold."""
    ship(df.sparkSession)

    def block(table: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("src", "dst", "weight"), _near(table, threshold))))

    return _block_pairs(df, key, vector, group).groupBy(group, "_i", "_j").applyInArrow(block, "src long, dst long, weight double")


def similar_links(df: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", group: str = "entity") -> DataFrame:
    """(src, dst): links that connect what the edges connect, but of each pair of blocks only a star for each of its own
    components: fewer than its vectors, however many of its pairs are similar."""
    ship(df.sparkSession)

    def block(table: pa.Table) -> pa.Table:
        src, dst, _ = _near(table, threshold)
        nodes, at = np.unique(np.concatenate((src, dst)), return_inverse=True)
        a, b, label = at[: len(src)], at[len(src) :], np.arange(len(nodes))
        while True:  # the least label of neighbours, then of the label's own label
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            new = new[new]
            if (new == label).all():
                break
            label = new
        rest = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"src": nodes[label[rest]].astype(np.int64), "dst": nodes[rest].astype(np.int64)})

    return _block_pairs(df, key, vector, group).groupBy(group, "_i", "_j").applyInArrow(block, "src long, dst long")


MATRIX_BYTES = 256 << 20  # of prototypes that a worker holds


def nearest(df: DataFrame, prototypes: DataFrame, name: str, key: str = "vec_id", vector: str = "embedding", mean: str = "mean_embedding") -> DataFrame:
    """(key, proto, sim): the prototype (name, mean) of the greatest dot product, the first by name of those that tie, by
    one matrix product for each batch. Prototypes are a list kept by hand or a row a label; more than MATRIX_BYTES of
    them is an error, for which their rows are counted before any is fetched."""
    ship(df.sparkSession)
    n, width = prototypes.agg(F.count("*"), F.max(F.size(mean))).first()
    if n * (width or 0) * 8 > MATRIX_BYTES:
        raise ValueError(f"{n} prototypes are too many for one matrix")
    rows = sorted(prototypes.select(name, mean).collect())
    names, matrix = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float).reshape(len(rows), width or 0).T
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows and len(names):
                sims = np.round(np.array(batch.column(1).to_pylist(), float) @ matrix, 9)
                best = sims.argmax(1)
                yield pa.record_batch([batch.column(0), pa.array(names[best]), pa.array(sims[np.arange(len(best)), best])], [key, "proto", "sim"])

    return df.select(key, vector).mapInArrow(run, f"{key} {kind}, proto long, sim double")


def star_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) edges: one (node, component) row per node, component its smallest node; written.

    Alternating large-star and small-star rounds; each is a grouped minimum with map-side combine and a join that AQE
    can split at a hot node. Every round is a written stage, whose count and checksum come with the write; the round
    before is deleted. Ends when a round changes nothing. Null ends and self loops are ignored.
    """
    live, last, state = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), None, None
    while True:
        both = live.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(live.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo < hi").distinct()
        low = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = large.join(low, large.hi == low.u).select("u", F.col("lo").alias("v"), "m")
        new = small.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(small.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).where("lo < hi").distinct()
        seen = Observation()
        live = written(new.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("s")), name)
        if last is not None:
            discard(last)
        last, now = live, (seen.get["n"], seen.get["s"])
        if now == state or not now[0]:
            break
        state = now
    # Stars: each node but a component's smallest has one edge, to that one.
    out = written(live.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(live.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()), name)
    discard(live)
    return out


def components(edges: DataFrame, nodes: DataFrame, key: str = "vec_id") -> DataFrame:
    """(key, component) of every node, component its smallest member. edges: (src, dst)."""
    label = star_components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")), "stars").withColumnRenamed("node", key)
    return nodes.select(key).join(label, key, "left").withColumn("component", F.coalesce("component", key))
