r"""Operator 7, line deduplication by a deletion-neighbourhood join.

A line is its words (white space between, A-Z lowered). Lines with a word that are equal are duplicates, and so are lines
of at least `min_near` words within an edit bound of one inserted, deleted or substituted word; the earliest, by document
and line number, stays. With `edits=2` two lines of at least TWO_EDITS words are also within the bound at two such edits.

Equal lines are merged first. Lines that share no half with another (one edit leaves the front or the back half of the
shorter one as it is) can't be within the bound and are done. The others emit all variants of one deletion as hashed keys.
Two lines within the bound have either equal variants at an equal place (substitution) or one equals the other's variant
(insertion): the earliest is a grouped minimum per variant, so no pairs are formed however many lines share it. Each line
that has an earlier one is then held against that one, word by word, and the edit distance is verified.

With two edits, lines that share a third at about its place are candidates, length by length. Where at most HOT lines of
one of two lengths share it, their pairs are compared. Else lines of one length emit their variants of one deletion and,
for two substitutions, where they differ from the first of them, less any two of these places; of two lengths the longer
lines emit the variants of two deletions that a line with this third may share. The earliest is again a grouped minimum.

Hashes of lines are sums of scrambled (word, place) pairs, not polynomials; two of 64 bits are compared.

Null and empty texts have no lines to drop; very long texts and lines are read whole. Ties (equal lines of one document
number and line number, in repeated rows) both stay. Rows of one id and different texts are told apart by their lines.
Rows with a null id come first and lose nothing. An empty table gives an empty result. Other columns are kept by `dedup`,
also if they have the names that it uses; `n_lines_dropped` gets an underscore if docs has one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, discard, free, keeping, release, table, written
from .textvec import SPACE_SEPARATORS, U64, batches_of, buffers, lut, mix, segment_hash, word_spans

MIN_NEAR = 8  # words of lines whose near copies are looked for
TWO_EDITS = 16  # words from which edits=2 allows two
GRID = 4  # words by which ends of lines are told apart
HOT = 32  # lines of one length and a shared third whose pairs are compared
MARK_BITS, MOST_BITS = 16, 1 << 28  # of a filter of lines: for each line, and in all
_STEP = U64(0xD1B54A32D192ED03)
SEEDS = (U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25))  # of the hash and of the one that checks it
_BACK, _BAG = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)


def _line_words(texts: pa.Array):
    """(word hashes, words before each line, text of each line, number of the line in its text)."""
    raw, offsets = buffers(texts)
    low, word = lut(SPACE_SEPARATORS)
    start, end, _ = word_spans(raw, offsets, word)
    at = np.zeros(len(raw) + 1, bool)  # where lines begin
    at[1:] = raw == 10
    at[offsets[:-1][np.diff(offsets) > 0]] = True
    begins = np.flatnonzero(at[: len(raw)])
    doc = np.searchsorted(offsets, begins, "right") - 1
    number = np.arange(len(doc)) - np.searchsorted(doc, doc)
    return segment_hash(raw, start, end, low), np.concatenate((np.searchsorted(start, begins), [len(start)])), doc, number


class Sums:
    """Running sums over the words of lines (first word, size): word and place, both scrambled, in the order of the lines.

    A line less some words has the hash of what remains: words behind d deletions count at their place less d."""

    def __init__(self, words: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.size, self.line = size, np.repeat(np.arange(len(first)), size)
        self.begin = np.concatenate(([0], np.cumsum(size)))
        self.place = np.arange(self.begin[-1]) - self.begin[:-1][self.line]
        self.own = words[first[self.line] + self.place]

    def _total(self, keyed: np.ndarray) -> np.ndarray:
        return np.concatenate(([U64(0)], np.cumsum(mix(self.own ^ keyed))))

    def _keys(self, seed: np.uint64) -> np.ndarray:
        return mix(np.arange(int(self.size.max(initial=0)) + 3, dtype=U64) * _STEP + seed)

    def behind(self, deletions: int, seed: np.uint64) -> np.ndarray:
        """Sums before each position, as if so many words had been deleted before (at most two)."""
        return self._total(self._keys(seed)[self.place + 2 - deletions])

    def from_back(self) -> np.ndarray:
        return self._total(self._keys(_BACK)[self.size[self.line] - 1 - self.place])

    def bags(self) -> np.ndarray:
        return self._total(np.full(1, _BAG))

    def whole(self, seed: np.uint64) -> np.ndarray:
        total = self.behind(0, seed)
        return mix((total[self.begin[1:]] - total[self.begin[:-1]]) ^ mix(self.size.astype(U64)))

    def less_one(self, seed: np.uint64) -> np.ndarray:
        """For each word, the hash of its line without it."""
        zero, one = self.behind(0, seed), self.behind(1, seed)
        rest = (zero[:-1] - zero[self.begin[:-1]][self.line]) + (one[self.begin[1:]][self.line] - one[1:])
        return mix(rest ^ mix(self.size[self.line].astype(U64) - U64(1)))


def half_keys(sums: Sums) -> np.ndarray:
    """Lines x 4 keys: so many words from the front, and from the back, for (n - 1) // 2 and n // 2 words; the last two are
    0 where they repeat the first. Two lines within one edit have a number in common, for which front or back are equal."""
    front, back, out = sums.behind(0, SEEDS[0]), sums.from_back(), np.zeros((len(sums.size), 4), U64)
    lo, hi = sums.begin[:-1], sums.begin[1:]
    for k in (0, 1):
        half = (sums.size - 1 + k) // 2
        tag = half.astype(U64) * U64(2)
        out[:, 2 * k] = mix((front[lo + half] - front[lo]) ^ mix(tag))
        out[:, 2 * k + 1] = mix((back[hi] - back[hi - half]) ^ mix(tag + U64(1)))
    out[sums.size % 2 == 1, 2:] = 0
    return out


def third_keys(sums: Sums) -> np.ndarray:
    """Lines x 12 keys, with repeats: a third from the front, from the back, and one from the middle shifted by -1, 0 or 1.
    Two edits that leave neither outer third as it is are one in each, so the middle one is whole. The length of a third
    is that of the longer line, even and so mostly the same for lengths that differ by two. The middle counts as a bag."""
    front, back, bags = sums.behind(0, SEEDS[0]), sums.from_back(), sums.bags()
    lo, hi, out, at = sums.begin[:-1], sums.begin[1:], np.empty((len(sums.size), 12), U64), 0
    for more, shifts in ((0, (-1, 0, 1)), (1, (-1, 0)), (2, (-1,))):
        third = (sums.size + more) // 6 * 2
        tag = mix(third.astype(U64))
        runs = [front[lo + third] - front[lo], back[hi] - back[hi - third], *(bags[lo + 2 * third + k] - bags[lo + third + k] for k in shifts)]
        for kind, run in zip((0, 1, 2, 2, 2), runs):
            out[:, at] = mix(run ^ mix(tag + U64(kind)))
            at += 1
    return out


def needed(keys: np.ndarray, n: int, hot: set[int], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the deletions i < j of a line of n words with these 12 keys of thirds, those that a partner under a hot key needs.
    Equal words at the front, or at the back, can always be kept (taking them away changes no distance); with an equal
    middle and neither outer third equal, one edit is in front of it and one behind."""
    out, at = np.zeros(len(i), bool), 0
    for more, shifts in ((0, (-1, 0, 1)), (1, (-1, 0)), (2, (-1,))):
        third = (n + more) // 6 * 2
        tests = [lambda: i >= third, lambda: j < n - third, *((lambda k=k: (i < third + k) & (j >= 2 * third + k)) for k in shifts)]
        for test in tests:
            if int(keys[at]) in hot:
                out |= test()
            at += 1
    return out


def _lists(keys: np.ndarray, has: np.ndarray) -> pa.ListArray:
    """A list of distinct keys for each line that `has` them, an empty one for the others."""
    keys = np.sort(keys.view(np.int64), axis=1)
    fresh = np.ones(keys.shape, bool)
    fresh[:, 1:] = keys[:, 1:] != keys[:, :-1]
    sizes = np.zeros(len(has) + 1, np.int64)
    sizes[1:][has] = fresh.sum(1)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(keys[fresh]))


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def occurrences(docs: DataFrame, min_near: int = MIN_NEAR, edits: int = 1) -> DataFrame:
    """(doc_id, line, hash, check, k0..k3[, thirds]): the lines with a word; half keys only for those of min_near words,
    keys of thirds only if two edits are allowed."""
    names = ["doc_id", "line", "hash", "check", "k0", "k1", "k2", "k3", *["thirds"] * (edits > 1)]

    def run(batches):
        for batch in batches_of(batches, 2 << 20):
            words, bounds, doc, number = _line_words(batch.column(1))
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            if not len(some):
                continue
            sums = Sums(words, bounds[:-1][some], size[some])
            near = sums.size >= min_near
            own = Sums(words, bounds[:-1][some][near], sums.size[near])
            keys = np.zeros((len(some), 4), U64)
            keys[near] = half_keys(own)
            cols = [batch.column(0).take(pa.array(doc[some])), pa.array(number[some].astype(np.int32)), *(pa.array(sums.whole(seed).view(np.int64)) for seed in SEEDS)]
            cols += [pa.array(np.ascontiguousarray(k).view(np.int64), mask=k == 0) for k in keys.T]
            if edits > 1:
                two = near & (sums.size >= TWO_EDITS)
                cols.append(_lists(third_keys(Sums(words, bounds[:-1][some][two], sums.size[two])), two))
            yield pa.record_batch(cols, names)

    schema = "doc_id long, line int, hash long, check long, k0 long, k1 long, k2 long, k3 long" + ", thirds array<long>" * (edits > 1)
    return arrow_map(_documents(docs), run, schema)


def wanted_lines(keys: DataFrame) -> DataFrame:
    """(doc_id, line): of lines (key, doc_id, line), those that may share a key with another.

    One shuffle by ranges of (key, place), so that a hot key is split over partitions; in each, a row is taken if its
    neighbour has its key. The neighbours of a partition's first and last row are elsewhere: those two are always
    taken, which only adds lines to look at."""

    def run(batches):
        held = None  # the last row so far, and whether it is taken
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, line = (c.to_numpy() for c in batch.columns)
            take = np.zeros(len(key), bool)
            same = key[1:] == key[:-1]
            take[1:] |= same
            take[:-1] |= same
            if held is None:
                take[0] = True
            else:
                last, taken = held
                met = last[0] == key[0]
                take[0] |= met
                if taken or met:
                    yield pa.record_batch([pa.array([last[1]], pa.int64()), pa.array([last[2]], pa.int32())], ["doc_id", "line"])
            held = (key[-1], doc[-1], line[-1]), take[-1]
            take[-1] = False
            if take.any():
                yield pa.record_batch([pa.array(doc[take]), pa.array(line[take])], ["doc_id", "line"])
        if held is not None:
            yield pa.record_batch([pa.array([held[0][1]], pa.int64()), pa.array([held[0][2]], pa.int32())], ["doc_id", "line"])

    ranged = keys.where("key is not null and doc_id is not null").repartitionByRange("key", "doc_id", "line").sortWithinPartitions("key")
    return arrow_map(ranged, run, "doc_id long, line int").distinct()


def _places(doc: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """4 x lines: which of n bits stand for each (doc_id, line)."""
    one = mix(mix(doc.astype(np.int64).view(U64)) + line.astype(U64))
    two = mix(one) | U64(1)
    return np.stack([(one + two * U64(k)) % U64(n) for k in range(4)])


def marks(wanted: DataFrame) -> Broadcast:
    """A Bloom filter of written (doc_id, line) rows, with which texts are read for their wanted lines where they are: no
    text is shuffled. It has all of the lines and by chance others (0.3 %; more from MOST_BITS on, 32 MB), which only adds
    lines to look at."""
    n = 64 * max(1, min(MOST_BITS, MARK_BITS * wanted.count()) // 64)

    def run(batches):
        for batch in batches:
            at = _places(batch.column(0).to_numpy(), batch.column(1).to_numpy(), n).reshape(-1)
            yield pa.record_batch([pa.array((at >> U64(6)).view(np.int64)), pa.array((U64(1) << (at & U64(63))).view(np.int64))], ["word", "mask"])

    got = arrow_map(wanted, run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(n // 64, U64)
    bits[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(U64)
    return wanted.sparkSession.sparkContext.broadcast(bits)


def _chosen(batch, doc: np.ndarray, number: np.ndarray, long: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Numbers of the batch's long lines whose (doc_id, line) is in a filter."""
    some = np.flatnonzero(long)
    at = _places(batch.column(0).to_numpy()[doc[some]], number[some], len(bits) * 64)
    return some[((bits[at >> U64(6)] >> (at & U64(63))) & U64(1)).all(0)]


def _words_of(words: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> list:
    return [words[bounds[k] : bounds[k + 1]].view(np.int64) for k in chosen]


def neighbourhoods(docs: DataFrame, seen: Broadcast, min_near: int = MIN_NEAR) -> DataFrame:
    """(v, check, place, doc_id, line, words): all deletion variants of the lines in a filter of marks() and, at place -1,
    themselves, there with their words."""

    def run(batches):
        bits = seen.value
        for batch in batches_of(batches, 1 << 20):
            words, bounds, doc, number = _line_words(batch.column(1))
            size = np.diff(bounds)
            chosen = _chosen(batch, doc, number, size >= min_near, bits)
            for at in range(0, len(chosen), 2000):
                part = chosen[at : at + 2000]
                sums = Sums(words, bounds[:-1][part], size[part])
                own = np.concatenate((sums.line, np.arange(len(part))))
                cols = [pa.array(np.concatenate((sums.less_one(seed), sums.whole(seed))).view(np.int64)) for seed in SEEDS]
                cols.append(pa.array(np.concatenate((sums.place, np.full(len(part), -1))).astype(np.int32)))
                told = pa.array([None] * len(sums.line) + _words_of(words, bounds, part), pa.list_(pa.int64()))
                yield pa.record_batch([*cols, batch.column(0).take(pa.array(doc[part][own])), pa.array(number[part][own].astype(np.int32)), told], ["v", "check", "place", "doc_id", "line", "words"])

    return arrow_map(_documents(docs).where("doc_id is not null"), run, "v long, check long, place int, doc_id long, line int, words array<long>")


def within(a: tuple, b: tuple, edits: int) -> np.ndarray:
    """For lists of words a and b, each (flat words, offsets), pair by pair whether at most one or two words inserted,
    deleted or substituted turn one into the other. Equal words at the front and at the back are taken away; of two edits
    one is then at the front and one at the back, and what is between them is equal."""
    (x, i), (y, j) = ((words, offsets[:-1]) for words, offsets in (a, b))
    n, m = np.diff(a[1]), np.diff(b[1])

    def differ(i, j, size):  # (pair, place) where runs of the words differ
        pair = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(pair)) - (np.cumsum(size) - size)[pair]
        bad = np.flatnonzero(x[i[pair] + place] != y[j[pair] + place])
        return pair[bad], place[bad]

    front = np.minimum(n, m)
    pair, place = differ(i, j, front)
    np.minimum.at(front, pair, place)
    back = np.minimum(n, m) - front
    pair, place = differ(i + n - back, j + m - back, back)
    last = np.full(len(n), -1)
    np.maximum.at(last, pair, place)
    back = back - 1 - last
    i, j, n, m = i + front, j + front, n - front - back, m - front - back
    out = np.maximum(n, m) <= edits
    if edits > 1:
        open_ = np.flatnonzero(~out & (np.minimum(n, m) > 0))
        for p, q in ((1, 1), (1, 0), (0, 1)):  # words of a and b that the first edit takes
            for r, s in ((1, 1), (1, 0), (0, 1)):  # and the last one
                at = open_[(n - p - r)[open_] == (m - q - s)[open_]]
                same = np.ones(len(at), bool)
                same[differ(i[at] + p, j[at] + q, n[at] - p - r)[0]] = False
                out[at] |= same
    return out


def verified(pairs: DataFrame, held: DataFrame, edits: int) -> DataFrame:
    """(first): of (first, least) pairs of places, those whose words in held (doc_id, line, words) are within the bound."""
    words = lambda at, name: held.select(F.struct("doc_id", "line").alias(at), F.col("words").alias(name))
    both = pairs.join(words("first", "a"), "first").join(words("least", "b"), "least").select("first.doc_id", "first.line", "a", "b")

    def run(batches):
        for batch in batches:
            a, b = ((c.flatten().to_numpy(), np.concatenate(([0], np.cumsum(c.value_lengths().to_numpy())))) for c in batch.columns[2:])
            yield pa.record_batch([c.filter(pa.array(within(a, b, edits))) for c in batch.columns[:2]], ["doc_id", "line"])

    return arrow_map(both, run, "doc_id long, line int").select(F.struct("doc_id", "line").alias("first"))


def close_by_one(docs: DataFrame, distinct: DataFrame, min_near: int) -> DataFrame:
    """(first): the distinct lines of min_near words or more with an earlier such line within one edit."""
    keys = distinct.select(F.explode(F.array("k0", "k1", "k2", "k3")).alias("key"), "first.doc_id", "first.line")
    wanted = written(wanted_lines(keys), "wanted")
    seen = marks(wanted)
    near = written(neighbourhoods(docs, seen, min_near), "variants")
    seen.destroy()
    discard(wanted)
    release(docs.sparkSession)
    shared = written(near.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v"), "shared")
    order = F.struct("doc_id", "line")
    live = written(near.drop("words").join(shared, "v"), "shared_variants")  # the few that may have a partner
    discard(shared)
    at = live.groupBy("v", "check", "place").agg(F.min(order).alias("least"), F.count("*").alias("c"))
    every = at.groupBy("v", "check").agg(
        F.min(F.when(F.col("place") >= 0, F.col("least"))).alias("longer"), F.min(F.when(F.col("place") < 0, F.col("least"))).alias("itself"), F.sum("c").alias("c")
    ).where("c > 1")
    rows = live.join(every.drop("c"), ["v", "check"]).join(at.drop("c"), ["v", "check", "place"])
    earliest = F.when(F.col("place") < 0, F.col("longer")).otherwise(F.least("least", "itself"))
    pairs = rows.select(order.alias("first"), earliest.alias("least")).where("least < first").distinct()
    out = written(verified(pairs, near.where("place = -1"), 1), "close_by_one")
    discard(near, live)
    return out


def _word_lists(docs: DataFrame, seen: Broadcast) -> DataFrame:
    """(doc_id, line, words, keys): word hashes and keys of thirds of the lines in a filter of marks()."""

    def run(batches):
        bits = seen.value
        for batch in batches_of(batches, 1 << 20):
            words, bounds, doc, number = _line_words(batch.column(1))
            size = np.diff(bounds)
            chosen = _chosen(batch, doc, number, size >= TWO_EDITS, bits)
            if len(chosen):
                keys = _lists(third_keys(Sums(words, bounds[:-1][chosen], size[chosen])), np.ones(len(chosen), bool))
                yield pa.record_batch([batch.column(0).take(pa.array(doc[chosen])), pa.array(number[chosen].astype(np.int32)), pa.array(_words_of(words, bounds, chosen), pa.list_(pa.int64())), keys], ["doc_id", "line", "words", "keys"])

    return arrow_map(_documents(docs).where("doc_id is not null"), run, "doc_id long, line int, words array<long>, keys array<long>")


def _two_deletions(lines: DataFrame) -> DataFrame:
    """(v, check, g, h, doc_id, line) of lines (doc_id, line, words, hot, front, back): each line less none and one word, and
    less those two words that its hot keys need, the first one within `front` words and the last one within `back` words
    from the end; g <= h are the gaps in what remains, or -1."""

    def rows(batch, k, columns):
        one = [pa.array(c.view(np.int64)) if c.dtype == U64 else pa.array(c.astype(np.int32)) for c in columns]
        same = pa.array(np.full(len(one[0]), k))
        return pa.record_batch([*one, batch.column(0).take(same), batch.column(1).take(same)], ["v", "check", "g", "h", "doc_id", "line"])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words, hot = np.array(batch.column(2)[k].as_py(), np.int64).view(U64), set(batch.column(3)[k].as_py())
                n = len(words)
                sums = Sums(words, np.array([0]), np.array([n]))
                keys = third_keys(sums)[0].view(np.int64)
                yield rows(batch, k, [*(np.append(sums.less_one(s), sums.whole(s)) for s in SEEDS), np.append(sums.place, -1), np.full(n + 1, -1)])
                if not hot:
                    continue
                totals = [[sums.behind(d, s) for d in range(3)] for s in SEEDS]
                step = max(1, (1 << 18) // n)
                front, back = batch.column(4)[k].as_py(), batch.column(5)[k].as_py()
                for at in range(0, min(front, n - 1), step):
                    every = np.arange(at, min(at + step, front, n - 1))
                    i, j = np.repeat(every, n - 1 - every), np.concatenate([np.arange(x + 1, n) for x in every.tolist()])
                    of_use = (j >= n - back) & needed(keys, n, hot, i, j)
                    i, j = i[of_use], j[of_use]
                    cut = [mix((a[i] + (b[j] - b[i + 1]) + (c[n] - c[j + 1])) ^ mix(np.array([n - 2], U64))) for a, b, c in totals]
                    yield rows(batch, k, [*cut, i, j - 1])

    return arrow_map(lines.select("doc_id", "line", "words", "hot", "front", "back"), run, "v long, check long, g int, h int, doc_id long, line int")


def _with_ends(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line, words, hot) with front and back: bounds of how many words from its front, and from its end, a line
    can keep beside another of them. As equal words at both ends can be kept, the first of two edits is where the equal
    words at the front end, and the last one where those at the end begin."""
    n = F.size("words")
    ends = F.when(n >= GRID, F.flatten(F.transform(F.sequence(F.lit(GRID), n, F.lit(GRID)), lambda k: F.array(
        F.struct(F.lit(0).alias("side"), k.alias("k"), F.xxhash64(F.slice("words", F.lit(1), k)).alias("h")), F.struct(F.lit(1).alias("side"), k.alias("k"), F.xxhash64(F.slice("words", n - k + 1, k)).alias("h"))
    ))))
    each = lines.select("doc_id", "line", F.explode(ends).alias("e")).select("doc_id", "line", "e.*")
    met = each.join(each.groupBy("side", "k", "h").agg(F.count("*").alias("c")).where("c > 1"), ["side", "k", "h"])
    most = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("k"))), F.lit(0)).alias(f"e{side}")
    out = lines.join(met.groupBy("doc_id", "line").agg(most(0), most(1)), ["doc_id", "line"], "left")
    return out.select(*lines.columns, *[(F.coalesce(f"e{side}", F.lit(0)) + GRID).alias(name) for side, name in ((0, "front"), (1, "back"))])


def _less_differences(lines: DataFrame) -> DataFrame:
    """(v, check, g, h, doc_id, line) of lines (doc_id, line, words, centre): where a line differs from its centre, a line of
    its length, less none, one and two of these places; g < h are the places, or -1. Lines of one centre that differ from
    each other at most at two places have equal rests without those places, and neither lists one at which it equals the
    centre: so a line has as many rows as pairs of differences, not of words."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                words, centre = (np.array(batch.column(c)[k].as_py(), np.int64).view(U64) for c in (2, 3))
                at = np.flatnonzero(words != centre)
                i, j = np.triu_indices(len(at), 1)
                cols = []
                for seed in SEEDS:
                    places = mix(np.arange(len(words), dtype=U64) * _STEP + seed)
                    about, each = mix(mix(centre ^ places).sum(dtype=U64) ^ _BAG), mix(words[at] ^ places[at])
                    total = each.sum(dtype=U64)
                    cols.append(pa.array(mix(np.concatenate(([total], total - each, total - each[i] - each[j])) ^ about).view(np.int64)))
                for gap in ((at, at[i]), (np.full(len(at), -1), at[j])):
                    cols.append(pa.array(np.concatenate(([-1], *gap)).astype(np.int32)))
                same = pa.array(np.zeros(len(cols[0]), np.int64) + k)
                yield pa.record_batch([*cols, batch.column(0).take(same), batch.column(1).take(same)], ["v", "check", "g", "h", "doc_id", "line"])

    return arrow_map(lines.select("doc_id", "line", "words", "centre"), run, "v long, check long, g int, h int, doc_id long, line int")


def _close_in_hot(lines: DataFrame, centred: DataFrame) -> DataFrame:
    """(first, least): lines with an earlier one within two edits, without pairs. The words deleted from two lines with one
    remainder cost, gap by gap, the larger of their numbers: at two edits, one line's gaps with two deletions hold the
    other's, or both have one deletion or none. The same goes for places at which lines differ from a centre."""
    order = F.struct("doc_id", "line")
    every = written(_two_deletions(_with_ends(lines)).unionByName(_less_differences(centred)), "two_deletions")
    shared = written(every.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v"), "two_shared")
    live = written(every.join(shared, "v"), "two_live")  # the few that may have a partner
    discard(every, shared)
    release(lines.sparkSession)
    least = lambda where: F.min(F.when(where, order))
    none, one, two = F.col("g") < 0, (F.col("g") >= 0) & (F.col("h") < 0), F.col("h") >= 0
    at = live.groupBy("v", "check").agg(least(none).alias("m0"), least(one).alias("m1"), least(two).alias("m2"), F.count("*").alias("c")).where("c > 1").drop("c")
    live = live.join(at, ["v", "check"])
    gaps = live.where("g >= 0").withColumn("gap", F.explode(F.array_distinct(F.when(two, F.array("g", "h")).otherwise(F.array("g")))))
    gaps = gaps.groupBy("v", "check", "gap").agg(least(one).alias("s1"), least(two).alias("s2"))
    both = live.where(two).groupBy("v", "check", "g", "h").agg(F.min(order).alias("d"))
    told = lambda rows, *cols: rows.select(order.alias("first"), F.least(*cols).alias("least")).where("least < first")
    whole = told(live.where(none), "m0", "m1", "m2")
    single = told(live.where(one).join(gaps.withColumnRenamed("gap", "g"), ["v", "check", "g"]), "m0", "m1", "s2")
    double = live.where(two).join(both, ["v", "check", "g", "h"]).join(gaps.select("v", "check", F.col("gap").alias("g"), F.col("s1").alias("a")), ["v", "check", "g"])
    double = told(double.join(gaps.select("v", "check", F.col("gap").alias("h"), F.col("s1").alias("b")), ["v", "check", "h"]), "m0", "a", "b", "d")
    return whole.unionByName(single).unionByName(double)


def close_by_two(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(first): the distinct lines of TWO_EDITS words or more with an earlier such line within two edits."""
    wanted = written(wanted_lines(distinct.select(F.explode("thirds").alias("key"), "first.doc_id", "first.line")), "wanted_two")
    seen = marks(wanted)
    # Without what the filter adds: copies of one line would crowd its thirds.
    held = written(_word_lists(docs, seen).join(wanted, ["doc_id", "line"], "left_semi"), "word_lists")
    seen.destroy()
    discard(wanted)
    release(docs.sparkSession)
    keyed = held.select(F.explode("keys").alias("key"), F.struct("doc_id", "line").alias("at"), F.size("words").alias("n"))
    sizes = written(keyed.groupBy("key", "n").agg(F.count("*").alias("c"), F.min("at").alias("centre")), "third_sizes")
    longer = sizes.select("key", F.col("n").alias("m"), F.col("c").alias("d"))
    classes = sizes.withColumn("m", F.explode(F.array(F.col("n"), F.col("n") + 1, F.col("n") + 2))).join(longer, ["key", "m"]).where("n < m or c > 1")
    classes = written(classes.withColumn("hot", F.least("c", "d") > HOT), "third_classes")
    keyed = written(keyed.join(classes.select("key", F.explode(F.array("n", "m")).alias("n")).distinct(), ["key", "n"]), "thirds")
    one, two = keyed.select("key", "n", F.col("at").alias("a")), keyed.select("key", F.col("n").alias("m"), F.col("at").alias("b"))
    pairs = one.join(classes.where("not hot").select("key", "n", "m"), ["key", "n"]).join(two, ["key", "m"]).where("n < m or a < b")
    pairs = pairs.select(F.greatest("a", "b").alias("first"), F.least("a", "b").alias("least")).distinct()
    crowded, words = classes.where("hot"), held.select("doc_id", "line", "words")
    # Of two lengths the longer lines need variants of two deletions; the shorter ones, and those of one length, of one.
    part = crowded.select("key", "n", F.lit(False).alias("most")).unionByName(crowded.where("n < m").select("key", F.col("m").alias("n"), F.lit(True).alias("most")))
    hot = keyed.join(part, ["key", "n"]).groupBy("at.doc_id", "at.line").agg(F.collect_set(F.when(F.col("most"), F.col("key"))).alias("hot"))
    near = keyed.join(crowded.where("n = m").select("key", "n", "centre"), ["key", "n"]).select("at.doc_id", "at.line", "centre").distinct()
    near = near.join(held.select(F.struct("doc_id", "line").alias("centre"), F.col("words").alias("_w")), "centre").select("doc_id", "line", F.col("_w").alias("centre"))
    pairs = pairs.unionByName(_close_in_hot(words.join(hot, ["doc_id", "line"]), words.join(near, ["doc_id", "line"]))).distinct()
    out = written(verified(pairs, held, 2), "close_by_two")
    discard(held, sizes, classes, keyed)
    return out


def dropped(docs: DataFrame, min_near: int = MIN_NEAR, edits: int = 1) -> DataFrame:
    """(doc_id, line, hash, near), written: the lines to drop; near is false for copies of an equal line."""
    if edits not in (1, 2):
        raise ValueError("edits must be 1 or 2")
    lines = written(occurrences(docs, min_near, edits), "lines")
    order, keys = F.struct("doc_id", "line"), ["k0", "k1", "k2", "k3", *["thirds"] * (edits > 1)]
    distinct = written(lines.groupBy("hash", "check").agg(F.min(order).alias("first"), F.count("*").alias("c"), *[F.first(k).alias(k) for k in keys]), "distinct")
    close = close_by_one(docs, distinct, min_near)
    if edits > 1:
        close = close.unionByName(close_by_two(docs, distinct))
    close = close.distinct().withColumn("near", F.lit(True))
    marked = distinct.select("hash", "check", "first", "c").join(close, "first", "left").where("c > 1 or near")
    out = lines.select("doc_id", "line", "hash", "check").join(written(marked.drop("c"), "marked"), ["hash", "check"])
    out = out.where(F.col("doc_id").isNotNull() & (F.col("near") | (order != F.col("first"))))
    out = written(out.select("doc_id", "line", "hash", (F.coalesce("near", F.lit(False)) & (order == F.col("first"))).alias("near")).distinct(), "dropped")
    discard(lines, distinct)
    release(docs.sparkSession)
    return out


def summary(drops: DataFrame) -> DataFrame:
    return drops.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"), F.count_if(~F.col("near")).alias("n_exact"), F.count_if("near").alias("n_near"))


def without_lines(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """Texts less the lines whose (number, hash) is in their list; a line of that number with other words stays."""
    gone = [None if d is None else {(x["line"], x["hash"]) for x in d} for d in drops.to_pylist()]
    words, bounds, doc, number = _line_words(texts)
    hashes = Sums(words, bounds[:-1], np.diff(bounds)).whole(SEEDS[0]).view(np.int64)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for k, (text, own) in enumerate(zip(texts.to_pylist(), gone)):
        if text is not None and own:
            mine = zip(number[at[k] : at[k + 1]].tolist(), hashes[at[k] : at[k + 1]].tolist())
            drop = {i for i, h in mine if (i, h) in own}
            text = "\n".join(part for i, part in enumerate(text.split("\n")) if i not in drop)
        out.append(text)
    return pa.array(out, pa.string())


def dedup(docs: DataFrame, min_near: int = MIN_NEAR, edits: int = 2) -> DataFrame:
    """docs with `text` less its dropped lines, and `n_lines_dropped`; other columns as they are."""
    drops = dropped(docs.select("doc_id", "text"), min_near, edits)
    key, lines, count = (free(c, docs.columns) for c in ("drop_key", "drop_lines", "n_lines_dropped"))
    each = drops.groupBy(F.col("doc_id").alias(key)).agg(F.collect_list(F.struct("line", "hash")).alias(lines))
    each = written(each, "drops")
    discard(drops)
    out = docs.join(each, docs["doc_id"].cast("long") == each[key], "left")
    cut = F.arrow_udf(without_lines, "string")(F.when(F.col(lines).isNotNull(), F.col("text")), F.col(lines))
    kept = [F.when(F.col(lines).isNull(), F.col("text")).otherwise(cut).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = out.select(*kept, F.when(F.col(lines).isNull(), 0).otherwise(F.array_size(F.array_distinct(F.transform(lines, lambda x: x["line"])))).cast("int").alias(count))
    return keeping(out, each)


def op7_deletion_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select("doc_id", F.when(F.length(F.coalesce("text", F.lit(""))) > 0, F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0).cast("long").alias("n_lines"))
    told = written(summary(dropped(docs)), "drops")
    out = counted.join(told, "doc_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_lines", zero("n_exact"), zero("n_near"), F.array_join(F.coalesce("lines", F.array().cast("array<int>")), ",").alias("dropped_lines"))


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, length(coalesce(text, '')) AS n FROM documents
), l AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, list_filter(regexp_split_to_array(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t, range(1, len(ls) + 1) r(i)),
k AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS g FROM l WHERE len(w) >= 1),
f AS (SELECT g, any_value(w) AS w, min(struct_pack(d := doc_id, l := line)) AS o FROM k GROUP BY g),
b AS (SELECT * FROM f WHERE len(w) >= 8),
v AS (SELECT g, o, CAST(i AS INTEGER) AS p, array_to_string(list_concat(w[1 : i - 1], w[i + 1 : len(w)]), ' ') AS x FROM b, range(1, len(w) + 1) r(i)),
s AS (SELECT p, x, min(o) AS o FROM v GROUP BY p, x),
a AS (SELECT x, min(o) AS o FROM v GROUP BY x),
near AS (
  SELECT DISTINCT v.g FROM v JOIN s ON s.p = v.p AND s.x = v.x WHERE s.o < v.o
  UNION SELECT v.g FROM v JOIN b ON b.g = v.x WHERE b.o < v.o
  UNION SELECT b.g FROM b JOIN a ON a.x = b.g WHERE a.o < b.o
), gone AS (
  SELECT k.doc_id, k.line, (n.g IS NOT NULL AND k.doc_id = f.o.d AND k.line = f.o.l) AS is_near
  FROM k JOIN f USING (g) LEFT JOIN near n USING (g) WHERE n.g IS NOT NULL OR k.doc_id <> f.o.d OR k.line <> f.o.l
), z AS (SELECT doc_id, count(*) FILTER (WHERE NOT is_near) AS n_exact, count(*) FILTER (WHERE is_near) AS n_near, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS dropped_lines FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN n = 0 THEN 0 ELSE len(ls) END AS BIGINT) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(dropped_lines, '') AS dropped_lines
FROM t LEFT JOIN z USING (doc_id)
"""
