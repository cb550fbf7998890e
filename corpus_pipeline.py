"""From documents to packed training sequences: each stage's result is written as Parquet and read by the next.

Toxicity judges every row by its text and language, whatever its doc_id. The next three stages go by doc_id: rows with a
null one pass, and rows that repeat one are rejected or kept together (copies under one id all stay). In these four null
and empty texts are kept, very long ones are read whole, ties go to the smallest doc_id, in lines to the earliest,
extra columns come through whatever their names, and an empty table gives an empty one. The last stage packs every row
that it gets, a null text as its end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracksieve.llm import decontam, lines, neardup, packing, toxicity
from tracksieve.llm.common import discard, free, keeping, release, table, written


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """docs less the rows whose doc_id is rejected. These ids are written, so that Spark knows how few they are: it
    broadcasts them under its own threshold, else it shuffles the texts once."""
    key = free("rejected_id", docs.columns)
    gone = written(rejected.select(F.col("doc_id").alias(key)).distinct(), "rejected")
    return keeping(docs.join(gone, docs["doc_id"].cast("long") == gone[key], "left_anti"), gone)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose score reaches the threshold of their language. The texts are scored twice, for the
    thresholds and for the result: so they are neither written in between nor shuffled, and what is written is one row
    a language."""
    labels, score, flag = toxicity.learnable(spark, sf_dir), free("score", docs.columns), free("flagged", docs.columns)
    net = toxicity.train(docs.select("doc_id", "text"), labels)
    bounds = written(toxicity.thresholds(toxicity.score(docs, net, carry=("doc_id", "lang")), labels), "bounds")
    out = toxicity.flagged(toxicity.score(docs, net, carry=tuple(docs.columns)), bounds, score=score, name=flag)
    return keeping(out.where(~F.col(flag)).select(*[F.col(f"`{c}`") for c in docs.columns]), bounds)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier one repeats, and documents of which nothing else is left; n_chars follows."""
    count = free("n_lines_dropped", docs.columns)
    out = lines.dedup(docs)
    emptied = (F.col(count) > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    chars = F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return keeping(out.where(~emptied | F.col("text").isNull()).withColumn("n_chars", chars).select(*[F.col(f"`{c}`") for c in docs.columns]), out)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group with five-word shingles at a similarity of 0.8."""
    found = neardup.near_duplicates(docs.select("doc_id", "text"), 5)
    out = without(docs, found.where(~F.col("kept")))
    discard(found)
    return out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which a benchmark window occurs."""
    found = decontam.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    out = without(docs, found.where("contaminated"))
    discard(found)  # the tokenized documents
    return out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their places in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), with_ids=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: Trained scores and tokenization aren't SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs, before = written(out, name), docs
        discard(out, before)
        release(spark)
    return docs
