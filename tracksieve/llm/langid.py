"""Operator 5, language identification by string kernels.

The kernel of two texts is a blend over n = 1, 2, 3 of |shared n-grams| / sqrt(|n-grams of one| |of the other|),
by presence, over letters in lower case with white space between words (n-grams are hashed into a fixed number of
buckets for each n). Nyström landmarks turn it into features, one-versus-rest kernel ridge regression into scores;
scoring a batch is two matrix products. Fitted on at most SAMPLE labelled rows, or LEAST for each language where that is
more, dealt evenly over all languages that labels have; each has landmarks of its own.

A text that is null or has no letter is `und` with score 0. Very long texts are read whole. Languages that tie go to the
first by name. Repeated rows get equal results; an empty table, or one without labelled rows, gives `und` for all. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, table
from .textvec import batches_of, buffers, mix
from .tokens import LETTERS, classes

SAMPLE, LEAST, LANDMARKS, RIDGE = 3000, 16, 160, 1e-3
BUCKETS = (512, 3584, 4096)  # for n = 1, 2, 3
WEIGHTS = (0.2, 0.4, 0.4)
OWN_MARKS = 4  # landmarks of a language at least, where it has as many rows


def presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts x buckets presence, texts that have a letter)."""
    raw, offsets = buffers(pa.array([None if t is None else t.lower() for t in texts.to_pylist()], pa.large_string()))
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    letter = np.isin(classes()[points], LETTERS)
    doc = np.searchsorted(np.searchsorted(lead, offsets), np.arange(len(points)), "right") - 1
    codes = np.where(letter, points, 32).astype(np.uint64)
    keep = np.ones(len(codes), bool)  # runs of what isn't a letter count as one space
    keep[1:] = letter[1:] | letter[:-1] | (doc[1:] != doc[:-1])
    codes, doc = codes[keep], doc[keep]
    n, base = len(offsets) - 1, 0
    out = np.zeros((n, sum(BUCKETS)), bool)
    gram = np.zeros(len(codes), np.uint64)
    for k, size in enumerate(BUCKETS):
        at = len(codes) - k
        if at > 0:
            gram = gram[:at] * np.uint64(0x110001) + codes[k:]
            same = doc[:at] == doc[k:]
            out[doc[:at][same], base + (mix(gram[same]) % np.uint64(size)).astype(np.intp)] = True
        base += size
    has = np.zeros(n, bool)
    has[doc[codes != 32]] = True
    return out, has


def weighted(bits: np.ndarray) -> np.ndarray:
    """Rows whose inner products are the blended kernel."""
    out, base = bits.astype(np.float32), 0
    for size, weight in zip(BUCKETS, WEIGHTS):
        block = out[:, base : base + size]
        block *= np.float32(weight**0.5) / np.sqrt(np.maximum(block.sum(1, keepdims=True), 1))
        base += size
    return out


@dataclass
class Model:
    langs: list[str]
    landmarks: np.ndarray  # buckets x landmarks
    coef: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def predict(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = weighted(bits) @ self.landmarks @ self.coef + self.bias
        best = margin.argmax(1)
        return best, np.clip((margin[np.arange(len(best)), best] + 1) / 2, 0, 1).astype(float)


def fit(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    names = sorted(set(langs))
    x, y = weighted(bits), np.array([names.index(v) for v in langs])
    order = np.concatenate([np.stack([np.arange(c) for c in np.bincount(y)[[k]]]).reshape(-1) for k in range(len(names))]) if len(y) else y
    turn = np.empty(len(y), int)
    turn[np.argsort(y, kind="stable")] = order
    chosen = np.lexsort((y, turn))[: max(landmarks, OWN_MARKS * len(names))]  # in turn from each language
    marks = x[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = (x @ marks.T).astype(float) @ root
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = (len(y) / (len(names) * np.bincount(y)))[y][:, None]
    mean, center = (phi * weight).sum(0) / weight.sum(), (target * weight).sum(0) / weight.sum()
    phi, target = phi - mean, target - center
    beta = np.linalg.solve(phi.T @ (phi * weight) + ridge * len(y) * np.eye(phi.shape[1]), phi.T @ (target * weight))
    return Model(names, marks.T.copy(), (root @ beta).astype(np.float32), (center - mean @ beta).astype(np.float32))


def train(labelled: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Model | None:
    """Fit on (doc_id, text, lang) rows: by hash of doc_id, as many of each language, `sample` in all or `least` each."""
    counts = labelled.groupBy("lang").count().collect()  # a row a language
    if not counts:
        return None
    each = max(least, sample // len(counts))
    # Rather more than that many, so that few are read; the first `each` by hash are taken.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1.0, 1.5 * each / r[1]))])
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = labelled.where(unit < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)))
    rows = rows.withColumn("_h", F.xxhash64("doc_id"))

    def run(batches):
        for batch in batches_of(batches):
            bits, has = presence(batch.column(1))
            packed = pa.array([b.tobytes() if k else None for b, k in zip(np.packbits(bits, axis=1), has)], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(2), packed], ["_h", "lang", "bits"])

    found = arrow_map(rows.select("_h", "text", "lang"), run, "_h long, lang string, bits binary").where("bits is not null")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "bits"))
    got = sorted(found.withColumn("_r", rank).where(F.col("_r") <= each).select("_h", "lang", "bits").collect())
    if not got:
        return None
    bits = np.unpackbits(np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(len(got), -1), axis=1, count=sum(BUCKETS))
    return fit(bits.astype(bool), [r[1] for r in got])


def predict(df: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches_of(batches, 2 << 20):
            bits, has = presence(batch.column(1))
            langs, score = ["und"] * len(has), np.zeros(len(has))
            if model is not None:
                best, score = model.predict(bits)
                langs = [model.langs[b] if h else "und" for b, h in zip(best.tolist(), has)]
                score = np.where(has, score, 0.0)
            yield pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["key", "lang_pred", "score"])

    out = arrow_map(df.select(df[key].alias("key"), df[text].alias("text")), run, f"key {kind}, lang_pred string, score double")
    return out.withColumnRenamed("key", key)


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = train(docs.where(~held & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
