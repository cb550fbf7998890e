"""Operator 4, secret scans with an incremental ledger of content-addressed blobs.

Every text version is addressed by its SHA-256. The ledger is a folder of Parquet files that has, for each blob, the
rule versions that have scanned it and what they found. `scan` takes the distinct blobs of some versions, leaves out the
blob and rule-version pairs that the ledger has, runs the rest of the rules over whole texts and appends what it found;
a scan that fails appends nothing and can be run again. `findings` joins the ledger back to every path.

Null texts are empty (no finding). Very long texts are scanned whole. Repeated rows share a blob and each get its
findings; copies of one blob are merged before the shuffle (map-side), so a frequent text doesn't gather in one task.
Spans that begin at one place (ties) come in the order of the kinds. An empty table gives an empty result and leaves an
empty ledger. Other columns are kept; those of the operator get an underscore where versions have their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import cached
from .common import arrow_map, free, shared_dir, table
from .textvec import batches_of

Finder = Callable[[str], list[tuple[int, int]]]

_ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")

#: kind -> (version, finder), in the order of kinds at equal starts. A changed finder gets a new version.
RULES: dict[str, tuple[int, Finder]] = {
    "assign": (1, lambda t: [m.span() for m in _ASSIGN.finditer(t) if m.end(1) - m.start(1) >= 8]),
    "access": (1, lambda t: [m.span() for m in _ACCESS.finditer(t)]),
    "hex": (1, lambda t: [m.span() for m in _HEX.finditer(t)]),
    "pem": (1, lambda t: [m.span() for m in _PEM.finditer(t)]),
}
BASE = ("assign", "access", "hex")

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())])
LEDGER = T.StructType([T.StructField("blob_id", T.BinaryType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))])


def named(rules: dict[str, tuple[int, Finder]]) -> dict[str, str]:
    """kind -> kind@version."""
    return {kind: f"{kind}@{version}" for kind, (version, _) in rules.items()}


def address(text: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def blobs_of(versions: DataFrame, text: str = "text") -> DataFrame:
    """(blob_id, text): the distinct texts."""
    return versions.select(address(text).alias("blob_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).groupBy("blob_id").agg(F.first("text").alias("text"))


def unseen(blobs: DataFrame, ledger: DataFrame | None, rules: dict[str, tuple[int, Finder]] = RULES) -> DataFrame:
    """(blob_id, text, todo): distinct blobs with the rule versions that the ledger doesn't have for them."""
    every = F.array(*[F.lit(n) for n in named(rules).values()])
    if ledger is None:
        return blobs.withColumn("todo", every)
    seen = ledger.select("blob_id", F.explode("rules").alias("rule")).groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
    out = blobs.join(seen, "blob_id", "left").withColumn("todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
    return out.where(F.size("todo") > 0).select("blob_id", "text", "todo")


def scan_blobs(todo: DataFrame, rules: dict[str, tuple[int, Finder]] = RULES) -> DataFrame:
    """Ledger rows for (blob_id, text, todo): each rule version run once over each whole blob."""
    finders = [(rank, kind, f"{kind}@{version}", find) for rank, (kind, (version, find)) in enumerate(rules.items())]
    span = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())])

    def run(batches):
        for batch in batches_of(batches):
            found = []
            for text, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = []
                for rank, kind, name, find in finders:
                    if name in names:
                        own += [{"start": a, "rank": rank, "kind": kind, "end": b} for a, b in find(text)]
                found.append(sorted(own, key=lambda s: (s["start"], s["rank"])))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.list_(span))], ["blob_id", "rules", "spans"])

    return arrow_map(todo.select("blob_id", "text", "todo"), run, LEDGER)


def scan(versions: DataFrame, ledger: str, rules: dict[str, tuple[int, Finder]] = RULES, text: str = "text") -> None:
    """Scans what the ledger in that folder hasn't seen of the versions' texts, and appends it there."""
    known = cached(versions.sparkSession, ledger)
    scan_blobs(unseen(blobs_of(versions, text), known, rules), rules).write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: dict[str, tuple[int, Finder]] = RULES, text: str = "text") -> DataFrame:
    """Every row of versions, without its text, with `blob_id` and `spans` (start, rank, kind, end) of the current rules."""
    paths = [c for c in versions.columns if c != text]
    blob, spans = free("blob_id", paths), free("spans", paths)
    current = named(rules)
    kinds = F.create_map(*[x for kind, name in current.items() for x in (F.lit(kind), F.lit(name))])
    # Scans of one blob at different times, without spans of older rule versions.
    own = versions.sparkSession.read.schema(LEDGER).parquet(ledger).where(F.size("spans") > 0)
    own = own.select("blob_id", F.filter("spans", lambda s: F.array_contains("rules", kinds[s["kind"]])).alias("spans"))
    own = own.groupBy("blob_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("found")).withColumnRenamed("blob_id", "_blob")
    at = versions.withColumn(blob, address(text)).select(*[F.col(f"`{c}`") for c in paths], blob)
    out = at.join(own, at[blob] == own["_blob"], "left")
    return out.select(*[at[f"`{c}`"] for c in paths], blob, F.coalesce("found", F.array().cast(T.ArrayType(SPAN))).alias(spans))


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments into a ledger of the query's own: half of the documents, then the others, of which only texts that
    the first one didn't have are scanned."""
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    late = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 1, F.lit(False))
    for increment in (docs.where(~late), docs.where(late)):
        scan(increment, ledger)
    paths = findings(docs, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return paths.select("doc_id", *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
