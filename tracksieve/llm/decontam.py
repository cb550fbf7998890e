"""Operator 6, benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

Training texts are tokenized once, into a written table. Its tokens are posted as (term, document, position) for the
terms that benchmark windows need: of each window its two rarest terms by corpus count. A window's offset-adjusted lists
are intersected from its rarest term on; the places that are left are read in the tokenized documents and compared word
by word, which stands for the window's other lists. Exact phrases (slop 0) are windows whose words follow each other;
proximity matches (slop > 0) have all words, with repeats, within the window's length plus slop.

Postings carry no text: what a token takes along is a 16-byte document key and its position. Spark broadcasts terms,
windows and places under its own threshold, and shuffles them beyond it.

Null texts have no words; very long ones are read whole. A document is a distinct (doc_id, text), null ids included:
repeated rows get equal results. An item without words has no window; repeated items are one. Ties between terms of
equal counts go to the earlier place in the window. Empty tables give empty results or no hits. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, keeping, release, table, written

WINDOW = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["k1", "k2"]


def words(text: Column) -> Column:
    """Words of a text: runs of digits, a-z (A-Z lowered) and all beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, _SEPARATORS), lambda w: w != "")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, words), written: the tokenized documents, with 128 bits that stand for (doc_id, text)."""
    key = [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("k2")]
    return written(docs.select("doc_id", *key, words(F.col("text")).alias("words")), "tokens")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window_id, window, item_id): distinct runs of `size` words of each item; a shorter item is one run."""
    own = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    first = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    runs = own.select("item_id", F.explode(F.transform(first, lambda i: F.slice("w", i, size))).alias("window")).distinct()
    return runs.withColumn("window_id", F.xxhash64("window"))


def term_counts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(term, n): corpus count of each window term (terms that don't occur are absent)."""
    terms = written(runs.select(F.explode("window").alias("term")).distinct(), "terms")
    return docs.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n")).join(terms, "term", "left_semi")


def anchors(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(window_id, window, r, term, off): the rarest term of each window (r = 1) and the next at another place (r = 2).
    Windows with a term that never occurs can't match and are gone."""
    one = runs.select("window_id", "window").distinct()
    at = one.select("window_id", F.posexplode("window").alias("off", "term")).join(counts, "term", "left")
    best = at.groupBy("window_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))), 1, 2).alias("best"))
    best = best.where(F.col("best")[0]["n"] > 0)
    out = best.join(one, "window_id").select("window_id", "window", F.posexplode("best").alias("r", "b"))
    return out.select("window_id", "window", (F.col("r") + 1).alias("r"), "b.term", "b.off")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, k1, k2, pos), in the shared folder, once, for all lists that are read from it."""
    tokens = docs.select(*KEY, F.posexplode("words").alias("pos", "term"))
    return written(tokens.join(terms, "term", "left_semi"), "postings")


def matches(docs: DataFrame, runs: DataFrame, slop: int = 0, size: int = WINDOW) -> DataFrame:
    """(k1, k2, window_id, start, length): every exact occurrence, or with slop > 0 every place where all words of a
    window lie within its length + slop of each other around its rarest term (start and length: that span).
    docs: from keyed()."""
    runs = written(runs, "windows")
    chosen = written(anchors(runs, term_counts(docs, runs)), "anchors")
    terms = written(chosen.select("term").distinct(), "terms")
    posts = index(docs, terms)
    discard(terms)
    length = F.size("window")
    first = chosen.where("r = 1").select("term", "window_id", "off", length.alias("length"))
    second = chosen.where("r = 2").select("term", "window_id", "off")
    one = posts.join(first, "term")
    two = posts.join(second, "term")
    texts = chosen.where("r = 1").select("window_id", "window")
    if slop:
        span = F.col("length") + slop
        # Places of the second term within reach of one of the first's, by blocks of `span` words.
        reach = F.explode(F.sequence(F.floor((F.col("pos") - span + 1) / span), F.floor((F.col("pos") + span - 1) / span)))
        near = one.where("length > 1").distinct().withColumn("block", reach)
        other = two.join(first.select("window_id", "length"), "window_id").select(*KEY, "window_id", F.floor(F.col("pos") / span).alias("block"), F.col("pos").alias("also")).distinct()
        near = near.join(other, [*KEY, "window_id", "block"]).where((F.abs(F.col("also") - F.col("pos")) < span) & (F.col("also") != F.col("pos")))
        cols = [*KEY, "window_id", "pos", "length"]
        found = written(near.select(*cols).unionByName(one.where("length = 1").select(*cols)).distinct(), "places")
        read = found.join(docs.select(*KEY, "words").join(found.select(*KEY).distinct(), KEY, "left_semi").dropDuplicates(KEY), KEY).join(texts, "window_id")
        lo = F.greatest(F.col("pos") - span + 1, F.lit(0))
        many = lambda list_, w: F.size(F.filter(list_, lambda x: x == w))
        fits = lambda b: F.forall("window", lambda w: many(F.slice("words", b + 1, span), w) >= many("window", w))
        begin = F.filter(F.sequence(lo, F.col("pos")), fits)
        out = read.withColumn("begin", begin).where(F.size("begin") > 0)
        return out.select(*KEY, "window_id", F.element_at("begin", 1).alias("start"), span.alias("length")).distinct()
    start = (F.col("pos") - F.col("off")).alias("start")
    one = one.select(*KEY, "window_id", start, "length").where("start >= 0")
    both = one.where("length > 1").join(two.select(*KEY, "window_id", start), [*KEY, "window_id", "start"], "left_semi")
    found = written(both.unionByName(one.where("length = 1").select(*both.columns)).distinct(), "places")
    read = docs.select(*KEY, "words").join(written(found.select(*KEY).distinct(), "found"), KEY, "left_semi").dropDuplicates(KEY)
    same = F.slice("words", F.col("start") + 1, F.col("length")) == F.col("window")
    out = found.join(read, KEY).join(texts, "window_id").where(same).select(*KEY, "window_id", "start", "length").distinct()
    out = written(out, "matches")
    discard(posts, found)
    return out


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_hit, n_items, items (sorted as strings), contaminated."""
    runs = windows(items, size)
    texts = keyed(docs)
    found = matches(texts, runs, 0, size)
    release(docs.sparkSession)
    hit = found.select(*KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("p")).distinct()
    hit = hit.groupBy(*KEY).agg(F.count("*").alias("n_hit"))
    pairs = found.select(*KEY, "window_id").distinct().join(runs.select("window_id", "item_id"), "window_id")
    named = pairs.groupBy(*KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    told = written(hit.join(named, KEY), "told")
    rows = texts.select("doc_id", *KEY, F.size("words").cast("long").alias("n_words"))
    out = rows.join(told, KEY, "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    out = out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_).cast("long").alias("n_items"), items_.alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))
    return keeping(out, texts, told)


def op6_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS g, least(len(w), 10) AS n FROM b, range(1, greatest(len(w) - 9, 1) + 1) r(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM d, sizes, range(1, len(w) - n + 2) r(i)
), m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
