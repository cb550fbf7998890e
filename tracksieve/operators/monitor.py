"""Quality monitoring: gold-set scores, drift, rolling alerts, label pool."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from .ranks import percentiles


def confusion(gold: DataFrame) -> DataFrame:
    """(label, tp, fp, fn) from (true_label, pred_label): two grouped counts brought together by label."""
    hit = F.col("true_label").eqNullSafe(F.col("pred_label"))
    sides = gold.select(F.explode(F.array(F.struct(F.col("true_label").alias("label"), F.when(hit, 1).otherwise(0).alias("tp"), F.lit(0).alias("fp"), F.when(hit, 0).otherwise(1).alias("fn")), F.struct(F.col("pred_label").alias("label"), F.lit(0).alias("tp"), F.when(hit, 0).otherwise(1).alias("fp"), F.lit(0).alias("fn")))).alias("s")).select("s.*")
    return sides.where("label is not null").groupBy("label").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")])


def class_scores(counts: DataFrame) -> DataFrame:
    p = F.col("tp") / (F.col("tp") + F.col("fp") + 1e-9)
    r = F.col("tp") / (F.col("tp") + F.col("fn") + 1e-9)
    return counts.withColumn("precision", p).withColumn("recall", r).withColumn("f1", 2 * p * r / (p + r + 1e-9))


def swapped(counts: DataFrame) -> DataFrame:
    """The counts as the reference has them: fp and fn the other way round; F1 is the same."""
    return counts.select("label", "tp", F.col("fn").alias("fp"), F.col("fp").alias("fn"))


def history(gold: DataFrame) -> DataFrame:
    """(run, label, tp, fp, fn, precision, recall, f1, delta) of gold rows with a run number: delta is the change of the
    rounded F1 against run - 1, null if that doesn't have the label. The runs are a table that is appended to."""
    hit = F.col("true_label").eqNullSafe(F.col("pred_label"))
    one = lambda label, **n: F.struct(F.col(label).alias("label"), *[x.cast("bigint").alias(k) for k, x in n.items()])
    yes, no, none = hit.cast("int"), (~hit).cast("int"), F.lit(0)
    sides = gold.select("run", F.explode(F.array(one("true_label", tp=yes, fp=none, fn=no), one("pred_label", tp=none, fp=no, fn=none))).alias("s")).select("run", "s.*")
    counts = sides.where("label is not null").groupBy("run", "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    w = Window.partitionBy("label").orderBy("run")
    out = class_scores(counts).withColumn("_r", F.round("f1", 3))
    return out.withColumn("delta", F.when(F.lag("run").over(w) == F.col("run") - 1, F.col("_r") - F.lag("_r").over(w))).drop("_r")


def report(runs: DataFrame, config: Config) -> DataFrame:
    """(run, macro_f1, alerts): labels under the floor, and labels that lost more than is allowed since the last run."""
    told = F.array_compact(F.array(
        F.when(F.col("f1") < config.gold_f1_min, F.format_string("%s below floor", F.col("label").cast("string"))),
        F.when(F.col("delta") < -config.gold_f1_drop_alert, F.format_string("%s regressed", F.col("label").cast("string"))),
    ))
    each = runs.groupBy("run").agg(F.avg("f1").alias("macro_f1"), F.array_sort(F.collect_list(F.struct("label", told.alias("told")))).alias("a"))
    return each.select("run", "macro_f1", F.flatten(F.transform("a", lambda x: x["told"])).alias("alerts"))


def wrong_labels(counts: DataFrame) -> DataFrame:
    """(true_label, pred_label, n): for each label the others with their rows, from a row a label."""
    every = counts.agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("all"))  # a row a label, as many as are known
    one = counts.select(F.col("label").alias("true_label")).join(F.broadcast(every), F.lit(True))
    return one.select("true_label", F.explode(F.filter("all", lambda x: x["label"] != F.col("true_label"))).alias("o")).select("true_label", F.col("o.label").alias("pred_label"), "o.n")


def row_mean(vector: str) -> Column:
    """The mean of a vector's values."""
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(vector)


def _edges(df: DataFrame, value: str, buckets: int) -> DataFrame:
    """One row, `e`: percentiles rounded to 6 decimals, the ends moved outwards by 1e-9."""
    cuts = percentiles(df, value, [k / buckets for k in range(buckets + 1)])
    return cuts.select(F.transform("e", lambda x, i: F.round(x, 6) + F.when(i == 0, -1e-9).when(i == buckets, 1e-9).otherwise(0.0)).alias("e"))


def psi(df: DataFrame, value: str, side: str, buckets: int = 10) -> DataFrame:
    """One-row population stability index of side 'actual' against 'expected': edges are percentiles of expected,
    rounded to 6 decimals; the last bin is closed; values outside of all bins are dropped."""
    cuts = _edges(df.where(F.col(side) == "expected"), value, buckets)
    at = df.crossJoin(F.broadcast(cuts)).withColumn("bin", F.size(F.filter("e", lambda x: x <= F.col(value))))  # one row
    last = F.when(F.col(value) == F.element_at("e", -1), buckets).otherwise(F.col("bin"))
    counts = at.withColumn("bin", last).groupBy(F.col("bin")).agg(F.count_if(F.col(side) == "expected").alias("x"), F.count_if(F.col(side) == "actual").alias("y"))
    total = df.agg(F.count_if(F.col(side) == "expected").alias("nx"), F.count_if(F.col(side) == "actual").alias("ny"))
    bins = df.sparkSession.range(1, buckets + 1).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").crossJoin(F.broadcast(total))
    a = F.greatest(F.coalesce("y", F.lit(0)) / F.col("ny"), F.lit(1e-9))
    e = F.greatest(F.coalesce("x", F.lit(0)) / F.col("nx"), F.lit(1e-9))
    return bins.agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def drift_alert(value: Column, config: Config) -> Column:
    """Strictly above the bounds; an empty week has no value and no alert."""
    return F.when(value > config.psi_alert, "severe").when(value > config.psi_warn, "warn").otherwise("ok")


def weekly_drift(values: DataFrame, config: Config, baseline: int = 2, types: tuple[str, ...] = ("logo", "face")) -> DataFrame:
    """(week, entity_type, psi, alert) for the weeks after the baseline's, of (week, entity_type, value). The first two
    weeks each replace the baseline, so it is week 2; a type without rows in a week is skipped."""
    edges = [_edges(values.where((F.col("week") == baseline) & (F.col("entity_type") == t)), "value", 10).select(F.lit(t).alias("entity_type"), "e") for t in types]
    cuts = reduce(DataFrame.unionByName, edges)  # a row a type
    at = values.where(F.col("week") >= baseline).join(F.broadcast(cuts), "entity_type")
    inside = F.when(F.col("value") == F.element_at("e", -1), 10).otherwise(F.size(F.filter("e", lambda x: x <= F.col("value"))))
    each = at.groupBy("week", "entity_type", inside.alias("bin")).agg(F.count("*").alias("y"))
    share = each.groupBy("week", "entity_type").agg(F.sum("y").alias("n"), F.map_from_entries(F.collect_list(F.struct("bin", "y"))).alias("m"))
    share = share.select("week", "entity_type", F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: F.greatest(F.coalesce(F.element_at("m", k), F.lit(0)) / F.col("n"), F.lit(1e-9))).alias("a"))
    base = share.where(F.col("week") == baseline).select("entity_type", F.col("a").alias("e"))
    terms = F.zip_with("a", "e", lambda a, e: (a - e) * F.ln(a / e))
    out = share.where(F.col("week") > baseline).join(base, "entity_type").withColumn("psi", F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))
    return out.select("week", "entity_type", "psi", drift_alert(F.col("psi"), config).alias("alert"))


def last_kept(snapshots: DataFrame, kept: int = 90) -> DataFrame:
    """The last `kept` snapshots by seq: what the monitor remembers."""
    return snapshots.orderBy(F.desc("seq")).limit(kept)


def appended(snapshots: DataFrame, path: str, kept: int = 90) -> DataFrame:
    """Appends snapshots to the table at a path and gives the last `kept` of it, on which alerts are computed."""
    snapshots.write.mode("append").parquet(path)
    return last_kept(snapshots.sparkSession.read.schema(snapshots.schema).parquet(path), kept)


def proxy_summary(kept: DataFrame, days: int = 7) -> DataFrame:
    """Mean rates of the last `days` snapshots, and how many are kept."""
    own = kept.withColumn("_back", F.row_number().over(Window.orderBy(F.desc("seq"))))  # 90 rows at most
    mean = lambda a, b, k: F.round(F.avg(F.when(F.col("_back") <= days, F.col(a) / (F.col(b) + 1e-9))), k)
    return own.agg(mean("auto_accept", "total_crops", 3).alias("avg_auto_accept_rate"), mean("hitl_routed", "total_crops", 4).alias("avg_hitl_rate"), mean("unknown_clusters", "total_clusters", 3).alias("avg_unknown_rate"), F.count("*").alias("days_tracked"))


def due(days: Column, config: Config) -> Column:
    return days >= config.fine_tune_interval_days


def fine_tune(pool: DataFrame, config: Config) -> DataFrame:
    """One row of what a learning step saw: status, counts, rows of each label, and the replay buffer's size after it.
    The step itself empties the pool: the next one starts from rows that come after."""
    each = pool.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("weight") > 1).alias("h"))
    out = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_samples"), F.coalesce(F.sum("h"), F.lit(0)).alias("hitl_confirmed"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("label_distribution"))
    return out.select(F.when(F.col("total_samples") == 0, "skipped").otherwise("completed").alias("status"), "total_samples", "hitl_confirmed", (F.col("total_samples") - F.col("hitl_confirmed")).alias("auto_accept"), "label_distribution", F.least("total_samples", F.lit(config.replay_buffer_size)).alias("replay_buffer_size"))


class Monitor:
    """The three monitors and the learning pool behind one name; each result is a DataFrame."""

    def __init__(self, config: Config, path: str):
        self.config, self.path = config, path

    def record_batch(self, snapshots: DataFrame) -> DataFrame:
        """Appends snapshots (with seq) and gives the alerts over what is kept."""
        return rolling_alerts(appended(snapshots, f"{self.path}/snapshots"), self.config.hitl_growth_alert, self.config.auto_drop_alert)

    def drift(self, values: DataFrame) -> DataFrame:
        return weekly_drift(values, self.config)

    def gold_eval(self, gold: DataFrame) -> DataFrame:
        """Appends a run's gold rows (run, true_label, pred_label) and reports on all runs."""
        gold.write.mode("append").parquet(f"{self.path}/gold")
        return report(history(gold.sparkSession.read.schema(gold.schema).parquet(f"{self.path}/gold")), self.config)

    def summary(self, spark: SparkSession) -> DataFrame:
        return proxy_summary(last_kept(spark.read.parquet(f"{self.path}/snapshots")))


def daily(df: DataFrame) -> DataFrame:
    """Snapshots by day of (ts, score): counts by gate, oldest first in seq."""
    day = df.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date_str")).agg(
        F.count("*").alias("total_crops"), F.count_if(F.col("gate") == "auto_accept").alias("auto_accept"), F.count_if(F.col("gate") == "hitl").alias("hitl_routed"), F.count_if(F.col("gate") == "discard").alias("discarded")
    )
    return day.withColumn("seq", F.row_number().over(Window.orderBy("date_str")).cast("bigint"))


def rolling_alerts(snapshots: DataFrame, growth: float, drop: float) -> DataFrame:
    """Row-framed alerts over all snapshots given (last_kept() gives the last 90): review growth week over week, accept rate against its baseline."""
    w = Window.orderBy("seq")  # a row a day: pre-aggregated
    rate = F.col("auto_accept") / (F.col("total_crops") + 1e-9)
    out = snapshots.withColumn("week", F.sum("hitl_routed").over(w.rowsBetween(-6, 0))).withColumn("before", F.sum("hitl_routed").over(w.rowsBetween(-13, -7)))
    out = out.withColumn("recent", F.avg(rate).over(w.rowsBetween(-6, 0))).withColumn("baseline", F.avg(rate).over(w.rowsBetween(-29, -7)))
    up = (F.col("week") - F.col("before")) / F.col("before")
    return out.withColumn("hitl_alert", F.coalesce((F.col("seq") >= 8) & (F.col("before") > 0) & (up >= growth), F.lit(False))).withColumn(
        "drop_alert", F.coalesce((F.col("baseline") > 0) & (F.col("baseline") - F.col("recent") > drop), F.lit(False))
    )


def replay_buffer(pool: DataFrame, appended: int, kept: int) -> DataFrame:
    """The pool's first `appended` rows by seq go in; the buffer keeps its last `kept`."""
    return pool.orderBy("seq").limit(appended).orderBy(F.desc("seq")).limit(kept)
