"""Track votes, gate, routes, caps, records, review queue, statistics."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scores


def track_vote(frames: DataFrame, keys: list[str], label: str, seq: str, score: str, threshold: float) -> DataFrame:
    """(keys, label, fraction, mean score, result): the most frequent label, the first seen on ties."""
    each = frames.groupBy(*keys, label).agg(F.count("*").alias("c"), F.min(seq).alias("first_seq"), F.sum(score).alias("s"))
    best = each.groupBy(*keys).agg(F.min_by(label, F.struct((-F.col("c")).alias("c"), "first_seq", label)).alias("voted_label"), F.max("c").alias("top"), F.sum("c").alias("n"), F.sum("s").alias("s"))
    fraction = F.col("top") / F.col("n")
    return best.select(*keys, "voted_label", fraction.alias("vote_fraction"), (F.col("s") / F.col("n")).alias("mean_score"), F.when(fraction >= threshold, "auto_accept").otherwise("ambiguous").alias("result"))


def gated(df: DataFrame, score: Column, config: Config) -> DataFrame:
    out = df.withColumn("gate", scores.gate(score, config.auto_accept_score, config.hitl_low_score)).withColumn("known", scores.status(score, config))
    return out.withColumn("route", scores.route(F.col("gate"), F.col("known")))


def capped(df: DataFrame, keys: list[str], order: list[str], cap: int) -> DataFrame:
    """The first `cap` rows of each key. Spark keeps at most cap rows per key and task before the shuffle
    (a group limit below the exchange), so a frequent key doesn't gather."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= cap)


def folded_reviews(log: DataFrame, keys: list[str]) -> DataFrame:
    """State of each cluster that was added: the last decision after the last add, else pending."""
    added = F.max(F.when(F.col("event") == "add", F.col("seq")))
    base = log.groupBy(*keys).agg(added.alias("added"), F.min(F.when(F.col("event") == "add", F.col("seq"))).alias("enqueued"))
    after = log.join(base, keys).where((F.col("event") != "add") & (F.col("seq") > F.col("added")))
    last = after.groupBy(*keys).agg(F.min_by(F.struct("event", "label", "reviewer"), "seq").alias("d"))
    out = base.where("added is not null").join(last, keys, "left")
    state = F.when(F.col("d.event") == "confirm", "hitl_confirmed").when(F.col("d.event") == "reject", "rejected").otherwise("hitl_pending")
    return out.select(*keys, "enqueued", state.alias("state"), F.when(state == "hitl_confirmed", F.col("d.label")).alias("hitl_label"), F.col("d.reviewer").alias("reviewed_by"))


def representatives(df: DataFrame, means: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n rows nearest each group's mean, nearest first; all of them if there are no more than n."""
    from ..functions import vectors

    near = df.join(means, keys).withColumn("sim", F.round(vectors.dot("embedding", "mean_embedding"), 9))
    return near.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("sim"), "vec_id"))).where(F.col("rn") <= n)
