"""The pipeline against a brute-force version of its stages, and odd tables through each stage."""

import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tracksieve.llm import lines, packing, toxicity
from tracksieve.llm.common import shared_dir, table, written

SF = "/root/testdata/sf0.001"


def edits(a, b, most):
    """Whether two lists of words are within so many insertions, deletions and substitutions."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        if min(row) > most:
            return False
    return row[-1] <= most


def by_hand(texts, scores, flagged, bench):
    """doc_id -> text of the documents that reach packing."""
    texts = {i: t for i, t in texts.items() if not flagged(scores[i], i)}
    kept, near, out = {}, [], {}
    split = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line).split()
    for i in sorted(texts):
        left = []
        for line in (texts[i] or "").split("\n"):
            words = split(line)
            if words:
                if tuple(words) in kept:
                    continue
                kept[tuple(words)] = i
                if len(words) >= lines.MIN_NEAR:
                    two = len(words) >= lines.TWO_EDITS
                    if any(edits(words, w, 2 if two and len(w) >= lines.TWO_EDITS else 1) for w in near if abs(len(w) - len(words)) <= 2):
                        near.append(words)
                        continue
                    near.append(words)
            left.append(line)
        text = "\n".join(left)
        if texts[i] is None or text == texts[i] or text.strip():
            out[i] = texts[i] if texts[i] is None else text
    sets = {}
    for i, t in out.items():
        w = split(t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    of = {i: i for i in out}
    for _ in range(len(of)):
        before = dict(of)
        for a in of:
            for b in of:
                if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
                    of[a] = of[b] = min(of[a], of[b])
        if of == before:
            break
    out = {i: t for i, t in out.items() if of[i] == i}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[k : k + 10]) for t in bench if (w := words(t)) for k in range(max(len(w) - 9, 1))}
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    return {i: t for i, t in out.items() if not hit(words(t))}


def test_run_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    docs, labels = table(spark, SF, "documents"), toxicity.learnable(spark, SF)
    net = toxicity.train(docs.select("doc_id", "text"), labels)  # fitted again: the same sample gives the same weights
    read = lambda t: toxicity.word_ids(pa.array([t], pa.string()))
    scores = {i: float(net.score(*read(r["text"]))[0]) if net else 0.0 for i, r in rows.items()}
    bounds = {r["lang"]: r["threshold"] for r in toxicity.thresholds(spark.createDataFrame([(i, r["lang"], scores[i]) for i, r in rows.items()], "doc_id long, lang string, score double"), labels).collect()}
    flagged = lambda score, i: bool(bounds) and score >= bounds.get(rows[i]["lang"], bounds[None])
    bench = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    want = by_hand({i: r["text"] for i, r in rows.items()}, scores, flagged, bench)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(want) and len(want) < len(rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, held = defaultdict(dict), defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]][r["start"]] = r["ids"]
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in want.items():
        assert [x for _, own in sorted(pieces[i].items()) for x in own] == [*library.encode(text or "", add_special_tokens=False).ids, 0]
    for parts in held.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist() and sum(n for _, n in parts) <= packing.CAPACITY


CLASH = "score string, flagged string, n_lines_dropped long, drop_key string, rejected_id long, text_ string, words string, k1 long"


def odd_documents(spark):
    """Nulls, repeated rows and ids, a very long text, and columns with the names that the stages use."""
    docs = table(spark, SF, "documents")
    texts = [(None, "some text here"), (None, None), (7, None), (8, ""), (9, "one document, twice"), (9, "one document, twice"), (10, "\n".join(f"line {i} of a very long text with many lines" for i in range(3000)))]
    rows = [(i, t, None, None, None, "s", "f", 3, "d", 1, "t", "w", 5) for i, t in texts]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    return spark.createDataFrame(rows, f"{kinds}, {CLASH}")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_odd_and_empty_tables_pass(spark, name, stage):
    odd = odd_documents(spark)
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns
    kept = out.collect()
    assert {r["doc_id"] for r in kept} == {None, 7, 8, 9, 10} and sum(r["doc_id"] is None for r in kept) == 2
    assert all((r["score"], r["flagged"], r["n_lines_dropped"], r["k1"]) == ("s", "f", 3, 5) for r in kept)
    empty = stage(spark, odd.limit(0), SF)
    assert empty.columns == odd.columns and empty.count() == 0


def test_packed_sequences_hold_their_tokens(spark):
    rows = [(i, f"Text {i} " + "of words " * (i * 150)) for i in range(8)]
    packed = corpus_pipeline.pack_sequences(spark, written(spark.createDataFrame(rows, "doc_id long, text string"), "docs"), SF).collect()
    read = packing.words_of(public_tokenizers.path("word_bpe_49k.json"))
    ids, bounds = read.encode(pa.array([t for _, t in rows]))
    sequences, documents = {}, {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == len(sequences.setdefault(r["sequence_id"], []))
        sequences[r["sequence_id"]] += r["ids"]
        documents.setdefault(r["doc_id"], {})[r["start"]] = sequences[r["sequence_id"]][r["offset"] :]
    assert max(map(len, sequences.values())) <= 2048 < sum(map(len, sequences.values()))
    for (doc, _), a, b in zip(rows, bounds, bounds[1:]):
        assert [x for _, own in sorted(documents[doc].items()) for x in own] == [*ids[a:b].tolist(), 0]
    assert corpus_pipeline.pack_sequences(spark, spark.createDataFrame([], "doc_id long, text string"), SF).count() == 0


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_neither_shuffled_nor_written_where_few_rows_are_joined(spark, monkeypatch):
    """Thresholds and rejected ids are written, so that Spark knows how few they are; 16k is less than any text table."""
    docs, tables = table(spark, SF, "documents"), []
    for module in (corpus_pipeline, toxicity):
        monkeypatch.setattr(module, "written", lambda df, name: tables.append(df.columns) or written(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_duplicates, corpus_pipeline.drop_contaminated):
            plan = planned(stage(spark, docs, SF))
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, stage
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(tables) == 3 and not any("text" in c for c in tables)


def test_wanted_lines_are_read_without_a_shuffle_of_texts(spark, monkeypatch):
    plans = {}
    monkeypatch.setattr(lines, "written", lambda df, name: plans.update({name: planned(df)}) or written(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert lines.dropped(table(spark, SF, "documents"), edits=2).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name in ("variants", "word_lists"):  # a join stands above what reads the texts, if anywhere
        assert "Join" not in plans[name][plans[name].index("MapInArrow") :], name


def test_a_filter_has_all_of_its_lines_and_a_full_one_changes_nothing(spark, monkeypatch):
    rows = [(i * 7919 - 10**6, i % 5) for i in range(3000)]
    seen = lines.marks(written(spark.createDataFrame(rows, "doc_id long, line int"), "wanted")).value
    has = lambda doc, line: (seen[(at := lines._places(doc, line, len(seen) * 64)) >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(0)
    doc, line = (np.array(c) for c in zip(*rows))
    assert has(doc, line).all() and has(doc, line + 5).mean() < 0.02
    assert not lines.marks(written(spark.createDataFrame([], "doc_id long, line int"), "wanted")).value.any()
    text = " ".join(f"word{k}" for k in range(20))
    texts = [text, text, text.replace("word3 ", ""), text.replace("word3 ", "").replace("word17 ", ""), "one two three four five six seven eight", None, "another line of nine words that is all alone"]
    docs = spark.createDataFrame([*enumerate(texts * 20), (None, text)], "doc_id long, text string")
    told = lambda: sorted(map(tuple, lines.dropped(docs, edits=2).collect()))
    want = told()
    monkeypatch.setattr(lines, "MOST_BITS", 64)
    assert told() == want and len(want) == 6 * 20 - 3


def test_run_deletes_what_its_stages_wrote(spark, monkeypatch):
    top = Path(re.sub("^file:/*", "/", shared_dir(spark)))
    before = set(top.iterdir()) if top.exists() else set()
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    assert corpus_pipeline.run(spark, SF).count()
    left = {p.name.rsplit("-", 1)[0] for p in set(top.iterdir()) - before}
    assert "best_fit_packing" in left and not left & {"tokens", "told", "rejected", "pieces", "benchmark_decontamination"}
