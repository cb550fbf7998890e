"""Operator 3, MinHash near-duplicates with tensored banding.

Two collections of M half-keys, each made of HALF minhashes, give M * M tables: a table's key is a pair of half-keys,
one from each collection. 2 * M * HALF = 78 minhashes serve 169 tables that would need 1,014 one by one. At a
similarity of 0.8 a pair shares no table with a probability of about 2e-4 (and less above).

Texts with equal shingle sets are one class from the start; only classes are hashed. A table's key can be shared only
where both its half-keys are, so that keys are formed from shared half-keys alone; of buckets with the same members
one is kept. Candidates are verified on full sets, in three passes over the buckets: all members against the smallest
id; against a few members of the bucket's largest component; and whoever is still outside of it against all members,
in a grid of blocks. Exact bounds from sizes and bitmaps, which come with the half-keys, rule most pairs out before any
set is made. Pairs within one component are never looked at; all others are verified or ruled out by a bound, with no
cap on buckets or partners. Copies of one set find their class by (set, salt), so that a large group is dealt out.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lowered; a text with fewer words than a shingle is one shingle; null or empty
texts have none, are linked with nothing and kept. Very long texts are read whole. Rows of one id count as one document:
it is linked with what any of its texts is linked with, and the result has every row. Ties don't arise (ids are told
apart by value). An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, components, discard, release, table, written
from .textvec import U64, batches_of, distinct_sets, mix, shingles, word_hashes

M, HALF = 13, 3
PERCENT = 80
HUBS = 4  # of a bucket's largest component, in the second pass
BITS, BLOCK = 1024, 1024  # of a bitmap; members of a block


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240)
    return rng.integers(1, 1 << 63, count, dtype=np.uint64) | U64(1), rng.integers(0, 1 << 63, count, dtype=np.uint64)


def half_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sets x 2M half-keys (sets that aren't empty)."""
    mult, add = _family(2 * M * HALF)
    first = bounds[:-1]
    out = np.zeros((len(first), 2 * M), U64)
    for k in range(2 * M * HALF):
        low = np.minimum.reduceat((values * mult[k] + add[k]) >> U64(20), first)
        out[:, k // HALF] = mix(out[:, k // HALF] * U64(0x9E3779B97F4A7C15) + low + U64(k))
    return out


def bitmaps(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """For sets of n values each: parity bitmaps of BITS bits, in words of 64."""
    at = np.repeat(np.arange(len(n)), n) * BITS + (values >> U64(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(n) * BITS) & 1).astype(bool).reshape(len(n), BITS)
    packed = pa.array(np.packbits(odd, axis=1).reshape(-1).view(np.int64))
    return pa.FixedSizeListArray.from_arrays(packed, BITS // 64).cast(pa.list_(pa.int64()))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_hi, set_lo, half, bits): per document, the set's 128-bit sum hash, half-keys and bitmap."""

    def run(batches):
        for batch in batches_of(batches, 2 << 20):
            values, bounds = distinct_sets(*shingles(*word_hashes(batch.column(1)), size))
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            hi, lo, half = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), [None] * len(n)
            if len(some):
                inner = np.concatenate((bounds[:-1][some], bounds[-1:]))
                hi[some] = np.add.reduceat(mix(values), inner[:-1]).view(np.int64)
                lo[some] = np.add.reduceat(mix(values ^ U64(0x5851F42D4C957F2D)), inner[:-1]).view(np.int64)
                for i, keys in zip(some.tolist(), half_keys(values, inner).view(np.int64)):
                    half[i] = keys
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(hi), pa.array(lo), pa.array(half, pa.list_(pa.int64())), bitmaps(values, n)], ["doc_id", "n_shingles", "set_hi", "set_lo", "half", "bits"])

    schema = "doc_id long, n_shingles long, set_hi long, set_lo long, half array<long>, bits array<long>"
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, shingles): the sorted distinct shingle hashes and their number."""

    def run(batches):
        for batch in batches_of(batches, 2 << 20):
            values, bounds = distinct_sets(*shingles(*word_hashes(batch.column(1)), size))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.record_batch([batch.column(0), pa.array(np.diff(bounds)), lists], ["doc_id", "n", "shingles"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n long, shingles array<long>")


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, doc_id), written: the keys of each class (doc_id, half) whose two half-keys both occur in other classes too."""
    halves = written(classes.select("doc_id", F.posexplode("half").alias("slot", "h")), "halves")
    shared = halves.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h")
    held = halves.join(shared, "h").groupBy("doc_id").agg(F.collect_set(F.struct("slot", "h")).alias("own"))  # 2M for each text
    side = lambda test: F.filter("own", lambda x: test(x["slot"]))
    held = held.select("doc_id", side(lambda k: k < M).alias("one"), side(lambda k: k >= M).alias("two"))
    pairs = F.flatten(F.transform("one", lambda x: F.transform("two", lambda y: F.xxhash64(x["slot"], y["slot"], x["h"], y["h"]))))
    out = written(held.select("doc_id", F.explode(F.array_distinct(pairs)).alias("key")), "keys")
    discard(halves)
    return out


def buckets(keys: DataFrame) -> DataFrame:
    """(key, doc_id, hub): buckets of two members or more, one of those with equal members; hub is the smallest."""
    sums = [F.bit_xor(F.xxhash64("doc_id", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    all_of = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("hi"), F.count("*").alias("c"), *sums).where("hub < hi")
    return keys.join(all_of.groupBy("hub", "hi", "c", "x1", "x2").agg(F.min("key").alias("key")).select("key", "hub"), "key")


def plausible(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs that sizes and bitmaps don't rule out: the bound of `_possible`."""
    left = full.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = full.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    apart = F.aggregate(F.zip_with("xa", "xb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.join(right, "b").join(left, "a").where(near).where(apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)).select("a", "b")


def verified(pairs: DataFrame, full: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs whose full sets (doc_id, n, shingles) have 100 * intersection >= percent * union."""
    left = full.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = full.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b")


def _labelled(members: DataFrame, at: DataFrame) -> DataFrame:
    """members (key, doc_id) of buckets with more than one component, with component and its size."""
    sizes = at.groupBy("component").agg(F.count("*").alias("size"))
    named = at.join(sizes, "component").select(F.col("node").alias("doc_id"), "component", "size")
    out = members.select("key", "doc_id").join(named, "doc_id", "left")
    out = out.select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"), F.coalesce("size", F.lit(1)).alias("size"))
    live = out.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return written(out.join(live, "key"), "members")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct()


def _possible(hub, doc, component, n, bits, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block of hubs and one of members, of different components, that sizes and bitmaps don't rule out:
    odd bits of two bitmaps are at most the sets' difference, and a link bounds that by the sizes."""
    one, two, found = np.flatnonzero(hub), np.flatnonzero(~hub), []
    for lo in range(0, len(one), 32):
        own = one[lo : lo + 32]
        apart = np.bitwise_count(bits[own][:, None] ^ bits[two][None]).sum(2, dtype=np.int64)
        x, y = n[own][:, None], n[two][None]
        good = (apart * (100 + percent) <= (x + y) * (100 - percent)) & (np.minimum(x, y) * 100 >= np.maximum(x, y) * percent)
        i, j = np.nonzero(good & (component[own][:, None] != component[two][None]))
        found.append((doc[own[i]], doc[two[j]]))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def _blocks(percent: int):
    """Rows sorted by (key, i, j) to (hub, doc_id) pairs: many small blocks to a batch, the last one carried over."""

    def pairs(rows: pa.Table, keep_last: bool) -> tuple[pa.RecordBatch, int]:
        ids = [rows.column(c).to_numpy() for c in ("key", "i", "j")]
        edge = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1
        cuts = [0, *edge.tolist(), *([] if keep_last else [rows.num_rows])]
        hub, doc, component, n = (rows.column(c).to_numpy() for c in ("hub", "doc_id", "component", "n"))
        bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(U64).reshape(len(doc), -1)
        found = [_possible(hub[x:y], doc[x:y], component[x:y], n[x:y], bits[x:y], percent) for x, y in zip(cuts, cuts[1:])]
        a, b = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["hub", "doc_id"]), cuts[-1]

    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows:
                held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([batch])])
                out, done = pairs(held, True)
                held = held.slice(done)
                yield out
        if held and held.num_rows:
            yield pairs(held, False)[0]

    return run


def exhausted(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different components that share a bucket and that bitmaps don't rule out. One of each pair is
    outside its bucket's largest component: those are the hubs, held against all members in a grid of blocks."""
    stats = members.groupBy("key").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("c"))
    rows = members.join(stats, "key").withColumn("outer", F.col("component") != F.col("top.component"))
    outer = rows.where("outer").groupBy("key").agg(F.count("*").alias("o"))
    rows = rows.join(outer, "key").join(full.select("doc_id", "n", "bits"), "doc_id")
    down, across = F.ceil(F.col("o") / BLOCK).cast("int"), F.ceil(F.col("c") / BLOCK).cast("int")
    spread = lambda k: F.pmod(F.xxhash64("doc_id"), k).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    cols = ("key", "doc_id", "component", "n", "bits")
    hubs = rows.where("outer").select(*cols, F.lit(True).alias("hub"), spread(down).alias("i"), every(across).alias("j"))
    rest = rows.select(*cols, F.lit(False).alias("hub"), spread(across).alias("j"), every(down).alias("i"))
    both = hubs.unionByName(rest)
    dealt = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return _pairs(arrow_map(dealt, _blocks(percent), "hub long, doc_id long"))


def grouped(classes: DataFrame, docs: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """(node, component) as all links between classes in one bucket give it. classes: (doc_id, half, n, bits)."""
    keys = table_keys(classes.select("doc_id", "half"))
    members = written(buckets(keys), "members")
    discard(keys)
    inside = written(members.select(F.col("doc_id").alias("_id")).distinct(), "inside")
    small = written(classes.select("doc_id", "n", "bits").join(inside, F.col("doc_id") == F.col("_id"), "left_semi"), "bitmaps")
    # Spark broadcasts the ids under its own threshold, else this join shuffles the texts once.
    full = written(sets(docs.join(inside, docs["doc_id"].cast("long") == inside["_id"], "left_semi"), size), "sets")
    discard(inside)
    release(docs.sparkSession)

    def checked(pairs: DataFrame) -> DataFrame:
        held = written(pairs, "pairs")
        out = written(verified(held, full, percent).distinct(), "links")
        discard(held)
        return out

    # First the smallest id of each bucket as its hub, then members of its largest component, then what is left.
    new = checked(plausible(_pairs(members.where("hub != doc_id")), small, percent))
    at = components(new, "links")
    left = _labelled(members, at)
    discard(new, members)
    pick = lambda s: F.max(F.struct("size", F.xxhash64("component", "doc_id", F.lit(s)).alias("h"), "doc_id", "component"))
    hubs = left.groupBy("key").agg(F.array_distinct(F.array(*[pick(s) for s in range(HUBS)])).alias("hubs")).select("key", F.explode("hubs").alias("h"))
    hubs = hubs.select("key", F.col("h.doc_id").alias("hub"), F.col("h.component").alias("hub_component"))
    at = _joined(at, checked(plausible(_pairs(left.join(hubs, "key").where("component != hub_component")), small, percent)))
    last = _labelled(left, at)
    discard(left)
    out = _joined(at, checked(exhausted(last, small, percent)))
    discard(last, small, full)
    release(docs.sparkSession)
    return out


def _joined(at: DataFrame, new: DataFrame) -> DataFrame:
    """The components `at` (node, component) with further links (a, b)."""
    if new.isEmpty():
        return at
    out = components(at.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new), "links")
    discard(at, new)
    return out


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text); written."""
    spark, docs = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(docs, size), "signatures")
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(salts)).alias("salt")
    some = signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "set_hi", "set_lo", salt("doc_id"))
    salted = some.groupBy("set_hi", "set_lo", "salt").agg(F.min("doc_id").alias("m"))
    classes = written(salted.join(salted.groupBy("set_hi", "set_lo").agg(F.min("m").alias("class")), ["set_hi", "set_lo"]).drop("m"), "classes")
    full, texts = signed.where("n_shingles > 0"), docs
    repeated = written(signed.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 and doc_id is not null").select("doc_id"), "repeated")
    if not repeated.isEmpty():  # one row for each different text of an id
        one = lambda df, *of: df.join(repeated, "doc_id", "left_anti").unionByName(df.join(repeated, "doc_id", "left_semi").dropDuplicates([*of]))
        full, texts = one(full, "doc_id", "set_hi", "set_lo"), one(docs, "doc_id", "text")
    own = classes.where(salt("class") == F.col("salt")).select("set_hi", "set_lo", F.col("class").alias("doc_id"))
    reps = written(full.join(own, ["set_hi", "set_lo", "doc_id"], "left_semi").select("doc_id", F.col("n_shingles").alias("n"), "half", "bits"), "reps")
    at = grouped(reps, texts, size, percent)
    named = classes.join(at.withColumnRenamed("node", "class"), "class", "left").select("set_hi", "set_lo", "salt", F.coalesce("component", "class").alias("of"))
    linked = some.join(named, ["set_hi", "set_lo", "salt"]).select("doc_id", "n_shingles", "of")
    if not repeated.isEmpty():  # an id with several texts is in the component of each: they are one
        one = linked.groupBy("doc_id").agg(F.min("of").alias("a"), F.max("of").alias("b")).where("a < b")
        ties = components(linked.join(one, "doc_id").select("a", F.col("of").alias("b")), "ties")
        linked = linked.join(ties.withColumnRenamed("node", "of"), "of", "left").select("doc_id", "n_shingles", F.coalesce("component", "of").alias("of"))
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("of"))
    out = linked.unionByName(alone).select("doc_id", "n_shingles", F.col("of").alias("component_id"), F.coalesce(F.col("of") == F.col("doc_id"), F.lit(True)).alias("kept"))
    out = written(out, "near")
    discard(signed, classes, repeated, reps, at)
    return out


def op3_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 2)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS g FROM w, range(1, greatest(len(w) - 1, 1) + 1) r(i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT a, a FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id),
comp AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""
