"""Vector columns (array<float>, arithmetic in double)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a, guard: float = 0.0) -> Column:
    """a / (norm + guard); a zero vector stays as it is. The norm is bound outside, or it would be computed for each element."""
    return F.transform(F.array(norm(a)), lambda n: F.transform(a, lambda x: F.when(n > 0, x.cast("double") / (n + guard)).otherwise(x.cast("double"))))[0]


def sums(df: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """(keys, pos, s, q, c): sum, sum of squares and count per position, with map-side combine."""
    at = df.select(*keys, F.posexplode(vector).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    return at.groupBy(*keys, "pos").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("c"))


def means(df: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """(keys, mean_embedding): unweighted mean by position, normalised unless zero."""
    mean = sums(df, keys, vector).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", (F.col("s") / F.col("c")).alias("m")))), lambda p: p["m"]).alias("m"))
    return mean.select(*keys, unit(F.col("m")).alias("mean_embedding"))
