"""Operator 8, toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of two hashed ones, of the word and of its first PREFIX bytes (so that unseen endings of
a known stem count); filters over one, two and three words; the maximum over the whole text; a logistic
layer. Buckets that fewer than MIN_DOCS sampled texts have share one embedding, so that rare words aren't learned by
heart. Fitted, in one executor task, on at most SAMPLE labelled rows of each class, by hash of doc_id, of at most
MAX_WORDS words each; a held-back part of the sample stops the training. `thresholds` has a threshold for each language
from the scores of all labelled rows, counted by score; `score` and `predicted` come from the text only.

Null and empty texts have the score of no word at all. Very long texts are scored whole. Rows with equal texts get equal
scores (ties, repeated rows). Without labels of both classes the score is 0 and nothing is flagged. Repeated label rows
count once (toxic if any says so). An empty table gives an empty result. Columns are carried whatever their names; the
score's gets an underscore if one has its name.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, free, table, written
from .textvec import U64, batches_of, buffers, lut, segment_hash, word_spans

SAMPLE, MAX_WORDS, MIN_DOCS, PREFIX = 2500, 4000, 4, 4
HASHED, EMBED, FILTERS, WIDTHS = 1 << 16, 12, 12, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.02, 1e-4
RARE, PAD = 0, 1
MIN_LANG = 40  # labelled rows of each class for a threshold of a language's own, else the one of all languages
BINS, LEAST, MOST = 100, 30, 90  # of scores; thresholds lie at the bounds of these

# Not part of words: ASCII other than letters, digits.
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash buckets of each word and its prefix, 2 x words; bounds)."""
    raw, offsets = buffers(texts)
    low, word = lut(_SEPARATORS)
    start, end, bounds = word_spans(raw, offsets, word)
    whole = segment_hash(raw, start, end, low) % U64(HASHED)
    prefix = segment_hash(raw, start, np.minimum(end, start + PREFIX), low) % U64(HASHED) + U64(HASHED)
    return np.stack([whole, prefix]).astype(np.int32), bounds


@dataclass
class Net:
    kept: np.ndarray  # hash bucket of a word or a prefix -> row of the embeddings
    embed: np.ndarray
    filters: dict[int, np.ndarray]  # width -> width x EMBED x FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embed @ self.filters[w][j] for j in range(w)] for w in WIDTHS]

    def pooled(self, rows: np.ndarray, bounds: np.ndarray, tables=None, where: bool = False):
        """Maximum of each filter over each text, and where it is. rows: of embeddings, two PAD after each text."""
        tables = tables or self.tables()
        n = len(bounds) - 1
        some = np.flatnonzero(np.diff(bounds) > 2)  # texts with a word
        out, at = np.zeros((n, len(WIDTHS) * FILTERS), np.float32), np.zeros((n, len(WIDTHS) * FILTERS), np.int64)
        if not len(some):
            return out, at
        size = np.diff(bounds)[some] - 2
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        pos = np.repeat(bounds[some] - first, size) + np.arange(int(size.sum()))
        for k, (w, parts) in enumerate(zip(WIDTHS, tables)):
            z = parts[0][rows[0, pos]]
            z += parts[0][rows[1, pos]]
            for j in range(1, w):
                z += parts[j][rows[0, pos + j]]
                z += parts[j][rows[1, pos + j]]
            best = np.maximum.reduceat(z, first, axis=0)
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            out[some, cols] = best
            if where:
                hit = z == np.repeat(best, size, axis=0)
                for f in range(FILTERS):
                    h = np.flatnonzero(hit[:, f])
                    doc = np.searchsorted(first, h, "right") - 1
                    _, one = np.unique(doc, return_index=True)
                    at[some, k * FILTERS + f] = pos[h[one]]
        return out, at

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.shift

    def score(self, ids: np.ndarray, bounds: np.ndarray, tables=None) -> np.ndarray:
        pooled, _ = self.pooled(*self.rows(ids, bounds), tables)
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled).astype(float), -30, 30)))

    def rows(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grown = bounds + 2 * np.arange(len(bounds))
        out = np.full((2, int(grown[-1])), PAD, np.int32)
        out[:, np.arange(ids.shape[1]) + 2 * np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))] = self.kept[ids]
        return out, grown


def gradients(net: Net, rows, bounds, at, hidden, delta, back) -> dict[str, np.ndarray]:
    """Of the loss, by the layers' names: delta is its gradient at the logits, back at the pooled values, at where each
    filter has its maximum; the maximum passes its gradient to the words it was taken over."""
    out = {"out": hidden.T @ delta, "bias": back.sum(0), "embed": np.zeros_like(net.embed), **{f"f{w}": np.zeros_like(net.filters[w]) for w in WIDTHS}}
    has = np.diff(bounds) > 2
    for k, w in enumerate(WIDTHS):
        d, where = back[has, k * FILTERS : (k + 1) * FILTERS], at[has, k * FILTERS : (k + 1) * FILTERS]
        for j in range(w):
            for row in rows[:, where + j]:  # texts x FILTERS
                out[f"f{w}"][j] += np.einsum("tf,tfe->ef", d, net.embed[row])
                np.add.at(out["embed"], row, d[:, :, None] * net.filters[w][j].T[None])
    return out


def fit(docs: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> Net:
    rng = np.random.default_rng(seed)
    seen = np.zeros(2 * HASHED, np.int32)
    for ids in docs:
        seen[np.unique(ids)] += 1
    frequent = np.flatnonzero(seen >= MIN_DOCS)
    kept = np.full(2 * HASHED, RARE, np.int32)
    kept[frequent] = np.arange(len(frequent)) + 2
    normal = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = Net(kept, 0.1 * normal(len(frequent) + 2, EMBED), {w: normal(w, EMBED, FILTERS) / (w * EMBED) ** 0.5 for w in WIDTHS}, np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.1 * normal(len(WIDTHS) * FILTERS), 0.0)
    net.embed[PAD] = 0
    order = rng.permutation(len(docs))
    held, used = order[: len(docs) // 4], order[len(docs) // 4 :]
    params = {"embed": net.embed, "bias": net.bias, "out": net.out, **{f"f{w}": net.filters[w] for w in WIDTHS}}
    m, v = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))
    step, best, best_loss, shift_m = 0, None, np.inf, [0.0, 0.0]

    def joined(which):
        ids = np.concatenate([docs[i] for i in which], axis=1) if len(which) else np.zeros((2, 0), np.int32)
        return ids, np.concatenate(([0], np.cumsum([docs[i].shape[1] for i in which]))).astype(np.int64)

    for epoch in range(EPOCHS):
        for lo in range(0, len(used), BATCH):
            which = used[lo : lo + BATCH]
            rows, bounds = net.rows(*joined(which))
            pooled, at = net.pooled(rows, bounds, where=True)
            active = pooled + net.bias
            drop = (rng.random(active.shape) > 0.2) / 0.8
            hidden = np.maximum(active, 0) * drop
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.shift, -30, 30)))
            delta = ((p - toxic[which]) / len(which)).astype(np.float32)
            back = (delta[:, None] * net.out) * (active > 0) * drop
            grads = gradients(net, rows, bounds, at, hidden, delta, back)
            step += 1
            for k, p_ in params.items():
                g = grads[k] + DECAY * p_
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                p_ -= (RATE * 0.7**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            g = float(delta.sum())
            shift_m = [0.9 * shift_m[0] + 0.1 * g, 0.99 * shift_m[1] + 0.01 * g * g]
            net.shift -= RATE * 0.7**epoch * (shift_m[0] / (1 - 0.9**step)) / ((shift_m[1] / (1 - 0.99**step)) ** 0.5 + 1e-6)
            net.embed[PAD] = 0
        score = net.score(*joined(held))
        loss = -np.mean(np.log(np.clip(np.where(toxic[held] == 1, score, 1 - score), 1e-6, 1))) if len(held) else epoch * -1.0
        if loss < best_loss:
            best_loss, best = loss, ({k: p.copy() for k, p in params.items()}, net.shift)
    if best:
        for k, p in params.items():
            p[...] = best[0][k]
        net.shift = best[1]
    return net


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Net | None:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic). The sample is a bounded broadcast; its texts' word
    ids, at most 2 * sample * MAX_WORDS of them, go to one task, and only the fitted weights come to the driver."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = one.withColumn("_h", F.xxhash64("doc_id"))
    part = lambda t: one.where(F.col("toxic") == t).orderBy("_h", "doc_id").limit(sample)
    chosen = part(1).unionByName(part(0))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("_h", "toxic", "text")

    def run(batches):
        for batch in batches_of(batches):
            ids, bounds = word_ids(batch.column(2))
            size = np.diff(bounds)
            packed = pa.array([ids[:, a:b].tobytes() if n <= MAX_WORDS else None for a, b, n in zip(bounds[:-1], bounds[1:], size)], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1).cast(pa.int32()), packed], ["_h", "toxic", "ids"])

    def learn(batches):
        got = [(r["toxic"], np.frombuffer(r["ids"], np.int32).reshape(2, -1)) for batch in batches for r in batch.to_pylist()]
        toxic = np.array([t for t, _ in got], np.float32)
        if len(got) and toxic.min() < toxic.max():
            yield pa.record_batch([pa.array([pickle.dumps(fit([ids for _, ids in got], toxic))], pa.binary())], ["net"])

    # Sorted in one task, so that the fit doesn't depend on how rows were dealt.
    sampled = arrow_map(rows, run, "_h long, toxic int, ids binary").where("ids is not null").orderBy("_h", "ids", "toxic").limit(2 * sample)
    got = arrow_map(sampled.select("toxic", "ids"), learn, "net binary").collect()
    return pickle.loads(got[0][0]) if got else None


def score(df: DataFrame, net: Net | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """The carried columns and, as `name`, the score of every row's whole text."""
    kinds = [df.schema[c].dataType.simpleString() for c in carry]
    given = [f"_{k}" for k in range(len(carry))]

    def run(batches):
        tables = net.tables() if net else None
        for batch in batches_of(batches, 2 << 20, "_text"):
            found = net.score(*word_ids(batch.column(len(carry))), tables) if net else np.zeros(batch.num_rows)
            yield pa.record_batch([*batch.columns[: len(carry)], pa.array(found, pa.float64())], [*given, "_score"])

    inner = df.select(*[df[c].alias(g) for c, g in zip(carry, given)], df[text].alias("_text"))
    out = arrow_map(inner, run, ", ".join(f"{c} {k}" for c, k in zip(given, kinds)) + ", _score double")
    return out.select(*[F.col(g).alias(c) for c, g in zip(carry, given)], F.col("_score").alias(free(name, list(carry))))


def thresholds(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, threshold) from all labelled rows of scored (doc_id, lang, score): for each language with MIN_LANG rows of
    each class the bound of a score bin with the fewest errors, the middle of those that tie; null: of all rows."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    known = scored.select("doc_id", "lang", F.floor(F.col("score") * BINS).cast("int").alias("bin")).join(one, "doc_id")
    own = F.struct("lang", F.lit(False).alias("every"))
    counts = known.groupBy("lang", "bin").agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("n"))
    counts = counts.select(F.explode(F.array(own, F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every")))).alias("k"), "bin", "p", "n")
    counts = counts.groupBy("k.every", "k.lang", "bin").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))  # BINS + 1 a language
    each = counts.groupBy("every", "lang").agg(F.sum("p").alias("ps"), F.sum("n").alias("ns"), F.collect_list(F.struct("bin", "p", "n")).alias("bins"))
    each = each.where(F.col("every") | F.col("lang").isNotNull() & (F.col("ps") >= MIN_LANG) & (F.col("ns") >= MIN_LANG))
    wrong = lambda cut: F.aggregate("bins", F.lit(0).cast("long"), lambda acc, b: acc + F.when(b["bin"] >= cut, b["n"]).otherwise(b["p"]))
    cuts = F.transform(F.sequence(F.lit(LEAST), F.lit(MOST)), lambda c: F.struct(wrong(c).alias("wrong"), c.alias("cut")))
    each = each.select("every", "lang", cuts.alias("cuts"))
    best = F.filter("cuts", lambda c: c["wrong"] == F.array_min(F.transform("cuts", lambda x: x["wrong"])))
    return each.select("every", "lang", best.alias("best")).select("every", "lang", (F.element_at("best", (F.size("best") / 2 + 0.5).cast("int"))["cut"] / float(BINS)).alias("threshold"))


def flagged(scored: DataFrame, bounds: DataFrame, lang: str = "lang", score: str = "score", name: str = "flagged") -> DataFrame:
    """scored with `name`: whether the score reaches the threshold of the row's language, else of all; false without any."""
    taken = scored.columns
    a, b, c, d = (free(x, taken) for x in ("own_lang", "own_threshold", "any_threshold", "_row"))
    own = bounds.where("not every").select(F.col("lang").alias(a), F.col("threshold").alias(b))
    every = bounds.where("every").select(F.col("threshold").alias(c), F.lit(1).alias(d))
    out = scored.join(own, scored[lang] == own[a], "left").withColumn(d, F.lit(1)).join(F.broadcast(every), d, "left")  # one row
    return out.select(*scored.columns, F.coalesce(scored[score] >= F.coalesce(b, c), F.lit(False)).alias(name))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "toxic")


def op8_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), learnable(spark, sf_dir)
    net = train(docs, labels)
    scored = written(score(docs, net, carry=("doc_id", "lang")), "scores")
    out = flagged(scored, thresholds(scored, labels))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")
