"""Slots for models: any vectorised function from a matrix to named columns, run in Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.stages import ship


def apply_model(df: DataFrame, model: Callable, schema: str, key: str = "vec_id", vector: str = "embedding", extra: str = "entity") -> DataFrame:
    """(key, columns of schema): model(matrix, extra column) for each batch, one object per worker."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = model(np.array(batch.column(1).to_pylist(), float), batch.column(2).to_numpy(zero_copy_only=False))
                yield pa.record_batch([batch.column(0), *[pa.array(out[c]) for c in names]], [key, *names])

    return df.select(key, vector, extra).mapInArrow(run, f"{key} {kind}, {schema}")


def detect(frames: DataFrame, detector: Callable, key: str, frame: str) -> DataFrame:
    """(key, ordinal, x1, y1, x2, y2, score): none to many boxes for each row; detector gives them for a frame's value."""
    ship(frames.sparkSession)
    kind = frames.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [(k, i, *map(float, box)) for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, box in enumerate(detector(x))]
            if found:
                cols = list(zip(*found))
                yield pa.record_batch([pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.float64()) for c in cols[2:])], ["key", "ordinal", "x1", "y1", "x2", "y2", "score"])

    out = frames.select(F.col(key).alias("key"), frame).mapInArrow(run, f"key {kind}, ordinal int, x1 double, y1 double, x2 double, y2 double, score double")
    return out.withColumnRenamed("key", key)


def embed(crops: DataFrame, models: dict[str, Callable]) -> DataFrame:
    """crops with `embedding` and `quality_score`: each goes, by crop_id, to the model of its entity_type, which gives a
    vector and a quality; a type without a model has neither."""
    ship(crops.sparkSession)

    def vector_of(kinds: pa.Array, ids: pa.Array) -> pa.Array:
        told = [models[k](i) if k in models else (None, None) for k, i in zip(kinds.to_pylist(), ids.to_pylist())]
        values = pa.array([None if v is None else np.asarray(v, np.float32) for v, _ in told], pa.list_(pa.float32()))
        return pa.StructArray.from_arrays([values, pa.array([q for _, q in told], pa.float64())], ["embedding", "quality_score"])

    told = F.arrow_udf(vector_of, "struct<embedding: array<float>, quality_score: double>")("entity_type", "crop_id")
    return crops.withColumn("_e", told).select(*crops.columns, "_e.embedding", "_e.quality_score")


def stand_in_vector(crop_id: str, dim: int) -> np.ndarray:
    """A unit vector that depends on the id alone, where no model is at hand."""
    seed = int.from_bytes(hashlib.md5(crop_id.encode()).digest()[:8], "big")
    x = np.random.default_rng(seed).standard_normal(dim)
    return x / (np.linalg.norm(x) + 1e-9)
