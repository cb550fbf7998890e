"""Ranks and percentiles over a whole order, without one task for all rows or for all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stages import written


def ranked(df: DataFrame, order: list[str], keys: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """df with its 0-based rank by `order`, within `keys` if given. Rows are dealt by ranges of keys and order; a range's
    rows are ranked in its task, and the rows before it come from the counts of ranges: a row a range and key."""
    parts = written(df.repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    each = parts.groupBy(*keys, "_p").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_p") if keys else Window.orderBy("_p")
    before = each.withColumn("_b", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(*keys, F.col("_p"), "_b")
    own = parts.withColumn("_r", F.row_number().over(Window.partitionBy("_p", *keys).orderBy(*order)) - 1)
    return own.join(before, [*keys, "_p"]).withColumn(name, (F.col("_r") + F.col("_b")).cast("bigint")).select(*df.columns, name)


def percentiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """One row, `e`: the linearly interpolated percentiles of a column, exactly. Equal values are counted first; the
    counts are dealt by ranges of values and summed up range by range; only the values at the wanted ranks are gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    parts = written(counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()), "counts")
    sums = parts.groupBy("_p").agg(F.sum("_n").alias("_s"))  # a row a range
    before = sums.select("_p", (F.sum("_s").over(Window.orderBy("_p")) - F.col("_s")).alias("_b"), F.sum("_s").over(Window.partitionBy(F.lit(1))).alias("_all"))
    own = parts.withColumn("_t", F.sum("_n").over(Window.partitionBy("_p").orderBy("_v"))).join(F.broadcast(before), "_p")
    last, first = F.col("_b") + F.col("_t") - 1, F.col("_b") + F.col("_t") - F.col("_n")  # ranks that the value has
    wanted = F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(s) * (F.col("_all") - 1)).alias("at")) for k, s in enumerate(shares)])
    parts_of = F.transform(wanted, lambda x: F.struct(x["k"].alias("k"), x["at"].alias("at"), F.floor(x["at"]).alias("lo"), F.ceil(x["at"]).alias("hi")))
    hit = lambda x: x["lo"].between(first, last) | x["hi"].between(first, last)
    found = own.select("_v", first.alias("_f"), last.alias("_l"), F.explode(F.filter(parts_of, hit)).alias("w"))
    lo, hi = F.max(F.when(F.col("w.lo").between(F.col("_f"), F.col("_l")), F.col("_v"))), F.max(F.when(F.col("w.hi").between(F.col("_f"), F.col("_l")), F.col("_v")))
    each = found.groupBy("w.k").agg(lo.alias("lo"), hi.alias("hi"), F.first(F.col("w.at") - F.col("w.lo")).alias("f"))
    value_at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("f")
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", value_at.alias("x")))), lambda p: p["x"]).alias("e"))
