"""Sources: Parquet tables, and detections and review logs derived from the event table by integer arithmetic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import stem


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DETECTIONS_SQL = """SELECT event_id AS seq, concat('v', user_id % 4) AS video_path, user_id AS track_id, CAST(event_id % 7500 AS INT) AS frame_idx,
 CASE WHEN user_id % 2 = 0 THEN 'logo' ELSE 'face' END AS entity_type,
 CAST((event_id * 37) % 1200 AS DOUBLE) AS x1, CAST((event_id * 53) % 600 AS DOUBLE) AS y1,
 CAST((event_id * 37) % 1200 + 20 + (event_id * 17) % 180 AS DOUBLE) AS x2, CAST((event_id * 53) % 600 + 20 + (event_id * 29) % 120 AS DOUBLE) AS y2,
 least(value / 100, 1.0) AS det_score FROM events"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, at = table(spark, sf_dir, "events"), F.col("event_id")
    x1, y1 = (at * 37) % 1200, (at * 53) % 600
    return e.select(
        at.alias("seq"), F.concat(F.lit("v"), F.col("user_id") % 4).alias("video_path"), F.col("user_id").alias("track_id"), (at % 7500).cast("int").alias("frame_idx"),
        F.when(F.col("user_id") % 2 == 0, "logo").otherwise("face").alias("entity_type"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"),
        (x1 + 20 + (at * 17) % 180).cast("double").alias("x2"), (y1 + 20 + (at * 29) % 120).cast("double").alias("y2"), F.least(F.col("value") / 100, F.lit(1.0)).alias("det_score"),
    )


def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, video_path, cluster_id, event, label, reviewer): add, confirm or reject of clusters, from events."""
    e, at = table(spark, sf_dir, "events"), F.col("event_id")
    kind = F.when(at % 5 < 3, "add").when(at % 5 == 3, "confirm").otherwise("reject")
    return e.select(at.alias("seq"), F.concat(F.lit("v"), F.col("user_id") % 4).alias("video_path"), F.format_string("cluster_%04d", F.col("user_id")).alias("cluster_id"), kind.alias("event"), F.when(kind == "confirm", F.col("event_type")).alias("label"), F.when(kind != "add", "human").alias("reviewer"))


def cached(spark: SparkSession, path: str) -> DataFrame | None:
    """A stage's earlier result, None if there is none."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else None


def save_stage(df: DataFrame, path: str) -> DataFrame:
    """A stage's result at a path that a later run finds with cached()."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_records(records: DataFrame, path: str) -> None:
    """One folder per video, each overwritten on its own; nothing is written for a video without records."""
    out = records.withColumn("video_stem", stem("video_path"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("video_stem").parquet(path)


def cache_key(path: str, size: str, mtime: str) -> F.Column:
    return F.substring(F.md5(F.concat_ws("_", path, F.col(size).cast("string"), F.col(mtime).cast("string"))), 1, 12)
