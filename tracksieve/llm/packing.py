"""Operator 2, best-fit packing of token pieces into sequences with Martello-Toth dominance reduction.

The tokens of every whole text are cut into pieces of at most `capacity`. Packing sees the histogram of piece lengths
only, at most `capacity` rows at any corpus size: `plan` permanently fixes sets of up to three lengths that dominate
every other feasible set of their largest piece, with whole multiplicities at once, until none is left to fix;
best-fit decreasing packs the remainder, again by multiplicity. The plan is a bounded list of (length, rank range) ->
(sequence, offset) rules. Ranks of equal lengths are dealt by hash buckets, so no task holds a frequent length alone.
Equal words are told by their bytes, so ids are the library's for any text.

Null texts are empty (one piece, the end id). Very long texts are cut into pieces like all others. Repeated rows are
packed each; rows that agree in everything are interchangeable, so their order doesn't matter (ties). An empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, free, keeping, table, written
from .textvec import batches_of, buffers, compacted, joined_values

CAPACITY = 2048
MOST_WORDS = 500_000  # that a worker keeps the ids of; then it starts anew
# Symbol classes of the pre-tokenizer within Latin-1.
_WHITE, _LETTER, _NUMBER, _OTHER = range(4)


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    for c in (*range(65, 91), *range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 256)):
        out[c] = _LETTER
    out[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
    out[[*range(9, 14), 32, 0x85, 0xA0]] = _WHITE
    return out


def pre_tokens(points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the pre-tokens of Latin-1 code points; edges: where texts begin, and the end."""
    n = len(points)
    kind = _classes()[points]
    change = np.ones(n + 1, bool)
    change[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    change[edges] = True
    # A quote that begins a run of others, before s t m d, re ve or ll, takes them along.
    quote = np.flatnonzero((points == 39) & change[:n])
    if len(quote):
        low = np.append(points, np.zeros(3, points.dtype))
        low = np.where((low >= 65) & (low <= 90), low + 32, low)
        limit = edges[np.searchsorted(edges, quote, "right")]
        one, two = low[quote + 1], low[quote + 2]
        short = (quote + 1 < limit) & np.isin(one, [ord(c) for c in "stmd"])
        long = (quote + 2 < limit) & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
        took = quote[short | long]
        change[took + 1] = False
        change[took + np.where(long, 3, 2)[short | long]] = True
    at = np.flatnonzero(change)
    begin, end = at[:-1], at[1:]
    kept = kind[begin] != _WHITE
    return begin[kept], end[kept]


class Words:
    """Bytes of a pre-token -> row of its ids; each distinct one is asked from the library once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.values, self.at = array("I"), array("q", [0])

    def ask(self, words: list[bytes]) -> None:
        """Words that are one pre-token each, in one call: white space parts them, a word's last id ends it."""
        ids = np.array(self.library.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary doesn't mark the ends of words")
        base, row = len(self.values), len(self.at) - 1
        self.values.frombytes(ids.tobytes())
        self.at.frombytes((ends + base).astype(np.int64).tobytes())
        self.rows.update(zip(words, range(row, row + len(words))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the library's ids of all texts, bounds). Texts beyond Latin-1, or with `<|`, go to it whole."""
        if len(self.at) > MOST_WORDS:
            self.forget()  # bounded memory
        raw, offsets = buffers(texts)
        data = raw.tobytes()
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        edges = np.searchsorted(lead, offsets)
        whole = np.zeros(len(offsets) - 1, bool)
        high = np.flatnonzero(points > 255)
        whole[np.searchsorted(edges, high, "right") - 1] = True
        for found in re.finditer(rb"<\|", data):
            whole[np.searchsorted(offsets, found.start(), "right") - 1] = True
        begin, end = pre_tokens(np.where(points > 255, 32, points).astype(np.intp), edges)
        if whole.any():
            kept = ~whole[np.searchsorted(edges, begin, "right") - 1]
            begin, end = begin[kept], end[kept]
        bounds = np.searchsorted(begin, edges)
        rows = np.zeros(0, np.int64)
        if len(begin):
            cut = np.zeros(len(raw) + 1, bool)
            cut[0] = cut[-1] = cut[lead[begin]] = cut[lead[end]] = True
            cuts = np.flatnonzero(cut)
            same = joined_values(raw, cuts)
            used, index = compacted(same.indices.to_numpy(zero_copy_only=False)[np.searchsorted(cuts, lead[begin])], len(same.dictionary))
            known = same.dictionary.take(pa.array(used)).to_pylist()
            if new := [w for w in known if w not in self.rows]:
                self.ask(new)
            rows = np.fromiter(map(self.rows.__getitem__, known), np.int64, len(known))[index]
        if whole.any():
            pieces, last = [], 0
            for doc in np.flatnonzero(whole).tolist():
                ids = self.library.encode(data[offsets[doc] : offsets[doc + 1]].decode(), add_special_tokens=False).ids
                self.values.extend(ids)
                self.at.append(len(self.values))
                pieces += [rows[last : bounds[doc]], np.array([len(self.at) - 2], np.int64)]
                last = int(bounds[doc])
            rows = np.concatenate([*pieces, rows[last:]])
            bounds = bounds + np.concatenate(([0], np.cumsum(whole)))
        at = np.frombuffer(self.at, np.int64)
        length = at[rows + 1] - at[rows]
        total = np.concatenate(([0], np.cumsum(length)))
        if not total[-1]:
            return np.zeros(0, np.uint32), total[bounds]
        ids = np.frombuffer(self.values, np.uint32)[np.repeat(at[rows] - total[:-1], length) + np.arange(total[-1])]
        return ids, total[bounds]


@lru_cache(2)
def words_of(path: str) -> Words:
    return Words(path)


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row of (doc_id, text)."""

    def run(batches):
        for batch in batches_of(batches, 2 << 20):
            cols: list[list] = [[], [], [], [], [], []]
            every, bounds = words_of(path).encode(batch.column(1))
            for doc, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                ids = np.append(every[a:b], np.uint32(end_id)).astype("<u4")
                for k, lo in enumerate(range(0, len(ids), capacity)):
                    own = ids[lo : lo + capacity]
                    for col, value in zip(cols, (doc, k, lo, len(own), zlib.crc32(own.tobytes()), own)):
                        col.append(value)
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.list_(pa.uint32())).cast(pa.list_(pa.int32())))
            yield pa.record_batch(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return arrow_map(df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].alias("text")), run, schema)


def dominated(lengths: list[int], left: Counter, j: int, capacity: int) -> list[int] | None:
    """A set of j and up to two more that dominates every feasible set with j, or None if none is proved to.

    Sets of at most two others are compared: that is enough where the three smallest don't fit beside j.
    F dominates G if G's items can be split among F's so that each of F's is as long as its share of G.
    """
    room = capacity - j
    take = lambda x: left[x] - (x == j)
    least: list[int] = []  # the three smallest others
    for x in lengths:
        least += [x] * min(3 - len(least), take(x))
        if len(least) == 3 or x > room:
            break
    if not least or least[0] > room:
        return [j]
    k = bisect_right(lengths, room) - 1
    while take(lengths[k]) <= 0:
        k -= 1
    one = lengths[k]  # the longest other that fits
    if one == room or len(least) < 2 or least[0] + least[1] > room:
        return [j, one]
    if len(least) == 3 and sum(least) <= room:
        return None
    # Pairs fit, triples don't. One piece dominates each pair whose sum is no longer.
    best, a, b = 0, 0, len(lengths) - 1
    b = k
    while a <= b:
        x, y = lengths[a], lengths[b]
        if take(x) <= 0 or (a == b and take(x) < 2):
            a += 1
        elif take(y) <= 0 or x + y > room:
            b -= 1
        else:
            best = max(best, x + y)
            a += 1
    if best <= one:
        return [j, one]
    # {j, one, s} dominates if no pair has both above s.
    s = bisect_right(lengths, room - one) - 1
    while s >= 0 and take(lengths[s]) - (lengths[s] == one) <= 0:
        s -= 1
    if s < 0:
        return None
    above: list[int] = []
    for x in lengths[bisect_right(lengths, lengths[s]) :]:
        above += [x] * min(2 - len(above), take(x))
        if len(above) == 2:
            break
    return [j, one, lengths[s]] if len(above) < 2 or sum(above) > room else None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(sequences, [(length, times in each sequence)])] that use every piece: fixed sets first, then best fit."""
    left = Counter({x: n for x, n in histogram.items() if n > 0})
    out: list[tuple[int, list[tuple[int, int]]]] = []
    lengths = sorted(left)
    for j in sorted(lengths, reverse=True):
        while left[j] > 0:
            found = dominated(lengths, left, j, capacity)
            if found is None:
                break
            uses = Counter(found)
            times = min(left[x] // n for x, n in uses.items())  # it dominates while its pieces last
            out.append((times, sorted(uses.items(), reverse=True)))
            for x, n in uses.items():
                left[x] -= n * times
            lengths = [x for x in lengths if left[x] > 0]
    open_by: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # room -> groups of equal sequences
    rooms: list[int] = []

    def put(room: int, count: int, content: list[tuple[int, int]]) -> None:
        if room not in open_by:
            rooms.insert(bisect_left(rooms, room), room)
            open_by[room] = []
        open_by[room].append((count, content))

    for x in sorted((x for x in lengths if left[x] > 0), reverse=True):
        n = left[x]
        while n:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                room, count, content = capacity, n, []
            else:
                room = rooms[at]
                count, content = open_by[room].pop()
                if not open_by[room]:
                    del open_by[room]
                    rooms.pop(at)
            each = room // x  # the tightest sequence stays the tightest until it's full
            full = min(count, n // each)
            if full:
                put(room - each * x, full, [*content, (x, each)])
            n -= full * each
            count -= full
            if count and n and n < each:
                put(room - n * x, 1, [*content, (x, n)])
                n, count = 0, count - 1
            if count and content:
                put(room, count, content)
    return out + [group for groups in open_by.values() for group in groups]


def rules(groups: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (first rank, first sequence, times in each, offset in it) of each run of ranks, in rank order."""
    used: Counter = Counter()
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for count, content in groups:
        offset = 0
        for x, each in content:
            out.setdefault(x, []).append((used[x], sequence, each, offset))
            used[x] += count * each
            offset += x * each
        sequence += count
    return {x: tuple(np.array(c, np.int64) for c in zip(*rows)) for x, rows in out.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (doc_id, piece, start, length, ids_crc32[, ids]) with sequence_id and offset of every piece. Ranks and places are
    found on narrow rows under a row number; what else a piece has moves once, when its place is joined to it."""
    spark, names = cut.sparkSession, cut.columns
    row = free("row", names)
    cut = written(cut.withColumn(row, F.monotonically_increasing_id()), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # `capacity` rows at most
    placed = rules(plan(histogram, capacity))
    # A length's n pieces go to about sqrt(n) buckets, so that neither a bucket nor a length's list of buckets is long.
    share = spark.createDataFrame([(x, math.isqrt(n - 1) + 1) for x, n in histogram.items()], "length long, k int")
    wide = "ids" in names
    narrow = cut.select(*(["length", row] if wide else [*names, row]))
    dealt = narrow.join(F.broadcast(share), "length").withColumn("b", F.pmod(F.xxhash64(row), F.col("k"))).drop("k")
    each = dealt.groupBy("length", "b").agg(F.count("*").alias("n"))
    before = each.select("length", "b", (F.sum("n").over(Window.partitionBy("length").orderBy("b")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("r", F.row_number().over(Window.partitionBy("length", "b").orderBy(row)) - 1)
    ranked = ranked.join(before, ["length", "b"]).withColumn("rank", F.col("r") + F.col("before"))
    keep = [c for c in narrow.columns if wide or c != row]
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}

    def run(batches):
        for batch in batches:
            size, rank = batch.column(keep.index("length")).to_numpy(), batch.column(len(keep)).to_numpy()
            sequence, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for x in np.unique(size).tolist():
                mine = np.flatnonzero(size == x)
                first, base, times, begin = placed[x]
                k = np.searchsorted(first, rank[mine], "right") - 1
                within = rank[mine] - first[k]
                sequence[mine] = base[k] + within // times[k]
                offset[mine] = begin[k] + within % times[k] * x
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    out = arrow_map(ranked.select(*keep, "rank"), run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", sequence_id long, offset long")
    return keeping(cut.join(out.drop("length"), row).drop(row) if wide else out, cut)


def op2_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
