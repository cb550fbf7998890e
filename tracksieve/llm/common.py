"""Shared pieces of the training-data operators: reading tables, bounded Arrow batches, free column names."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.graph import star_components as components  # noqa: F401
from ..plans.stages import discard, keeping, release, shared_dir, ship, written  # noqa: F401

#: Rows and bytes of one Arrow batch between the JVM and a Python worker, where the session sets none.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, columns: list[str]) -> str:
    """`name`, or it with underscores after it, so that no column has it (names are compared without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Returns freed memory of this worker to the system: workers are kept for later tasks, and what an earlier one has
    freed would stay theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """mapInArrow with batches bounded in rows and bytes, so that very long texts don't fill a worker.

    Spark reads the bounds when a plan runs, so they are set on the session, unless it has its own."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", str(BATCH_ROWS)), ("maxBytesPerBatch", str(BATCH_BYTES))):
        if not conf._jconf.contains(f"spark.sql.execution.arrow.{key}"):
            conf.set(f"spark.sql.execution.arrow.{key}", value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)
