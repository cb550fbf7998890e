"""Operator 9, token counts: a byte-level BPE tokenizer compiled into finite-state transducers.

Two machines in a row, both deterministic, both with emitted-token counts on their transitions:

* The pre-tokenizer reads symbol classes of code points and has twelve states. A slice of texts is cut into chunks;
  each chunk's map (state at its begin -> state at its end) is found for all twelve states, the maps compose by a
  parallel prefix scan, and a second sweep with the known entry states emits where the pre-tokens begin.
* The merge machine reads the bytes of a pre-token. Its state is all that later tokens can depend on: for each
  suffix that some vocabulary item extends, its node in the vocabulary trie, the last token before it and the
  tokens since. A transition's count is the change in the number of tokens of the prefix read so far. Reset at a
  pre-token's begin makes every map constant there, so its counts add up. States and transitions are compiled when
  first met, once per worker, into an open-addressing table that whole slices step through at once.

A token ends a prefix's encoding exactly if it is compatible with the token before it, which holds for merge
rules in rank order. Equal pre-tokens are told by their bytes, and stepped through once in a slice. Added tokens come
from the vocabulary file; a file with another model, normalizer or pre-tokenizer is refused.

Nulls are empty texts with no token. Whole texts are counted, very long ones in a slice of their own. Repeated rows,
repeated ids and null ids each get their row. An empty table gives an empty result. Other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table
from .textvec import batches_of, buffers, compacted, joined_values

# Symbol classes.
STOP, SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, ONE, R_V, ELL, E_ = range(11)
LETTERS = (LETTER, ONE, R_V, ELL, E_)
# States of the pre-tokenizer: at a text's begin; in letters, numbers, others; white space of one or more, ending in
# a space or not; after a quote that begins a token, then r or v, then l; after a contraction.
BEGIN, IN_L, IN_N, IN_O, SPACE_1, WHITE_1, SPACE_M, WHITE_M, QUOTED, QUOTED_R, QUOTED_L, DONE = range(12)
HERE, BEFORE = 1, 2  # a token begins at this symbol, at the one before
CHUNK = 128


def _from(state: int, symbol: int) -> tuple[int, int]:
    """(next state, begins emitted)."""
    if state in (QUOTED_R, QUOTED_L):
        if symbol == (E_ if state == QUOTED_R else ELL):
            return DONE, 0
        following, out = _from(IN_L, symbol)
        return following, out | BEFORE
    if symbol == STOP:
        return BEGIN, HERE
    white = state in (SPACE_1, WHITE_1, SPACE_M, WHITE_M)
    if symbol in (SPACE, WHITE):
        if white:
            return (SPACE_M if symbol == SPACE else WHITE_M), 0
        return (SPACE_1 if symbol == SPACE else WHITE_1), HERE
    late = BEFORE if state in (SPACE_M, WHITE_M) else 0
    if symbol == QUOTE:
        if state in (SPACE_1, SPACE_M):
            return IN_O, late
        return (IN_O, 0) if state == IN_O or state == QUOTED else (QUOTED, late | HERE)
    run = IN_L if symbol in LETTERS else IN_N if symbol == NUMBER else IN_O
    if state == QUOTED:
        if symbol in (ONE, R_V, ELL):
            return {ONE: DONE, R_V: QUOTED_R, ELL: QUOTED_L}[symbol], 0
        return (IN_O, 0) if run == IN_O else (run, HERE)
    if state == run or state in (SPACE_1, SPACE_M):
        return run, late
    return run, late | HERE


@lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray]:
    pairs = np.array([[_from(s, c) for c in range(11)] for s in range(12)], np.uint8)
    return pairs[:, :, 0].copy(), pairs[:, :, 1].copy()


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point, by the `regex` module's Unicode properties."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [c if not 0xD800 <= c < 0xE000 else 0 for c in range(0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    for text, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", ONE), ("rv", R_V), ("l", ELL), ("e", E_)):
        table[[ord(c) for c in text]] = kind
    return table


def compose_prefix(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps under composition, in log2(n) whole-array steps."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return maps


def _run(grid: np.ndarray, state: np.ndarray, following: np.ndarray) -> np.ndarray:
    for row in grid:
        state = following[row + state]
    return state


def begins(symbols: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each symbol; symbols[0] is STOP."""
    following, emitted = (x.T.astype(np.intp).reshape(-1) for x in machine())  # by symbol, then state
    n = len(symbols)
    chunks = -(-(n + 1) // CHUNK)
    grid = np.zeros(chunks * CHUNK, np.intp)  # STOP beyond the end
    grid[:n] = symbols
    grid *= 12
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    maps = _run(grid[:6], np.tile(np.arange(12)[:, None], chunks), following)
    known = (maps == maps[0]).all(0)  # most maps are constant after a few symbols: one state stands for all
    maps[:, known] = _run(grid[6:, known], maps[0, known], following)
    if not known.all():
        maps[:, ~known] = _run(grid[6:, ~known], maps[:, ~known], following)
    scanned = compose_prefix(np.ascontiguousarray(maps.T))
    state = np.concatenate((np.array([BEGIN]), scanned[:-1, BEGIN]))
    marks = np.empty(grid.shape, np.uint8)
    for k, row in enumerate(grid):
        at = row + state
        marks[k] = emitted[at]
        state = following[at]
    marks = marks.T.reshape(-1)
    out = (marks[:n] & HERE) > 0
    return out | ((marks[1 : n + 1] & BEFORE) > 0)


class Merges:
    """The merge machine of a vocabulary file: compiled lazily, stepped in numpy."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        split, added = whole.get("pre_tokenizer") or {}, whole.get("added_tokens") or []
        wants = (
            (model.get("type", "BPE"), "BPE"), (whole.get("normalizer"), None), (split.get("type"), "ByteLevel"), (split.get("add_prefix_space"), False), (split.get("use_regex", True), True),
            (model.get("dropout"), None), (bool(model.get("ignore_merges")), False), (model.get("end_of_word_suffix") or "", ""), (model.get("continuing_subword_prefix") or "", ""),
            (any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added), False),
        )
        if wrong := [got for got, want in wants if got != want]:
            raise ValueError(f"not a byte-level BPE file of the kind that is compiled here: {wrong}")
        self.added = re.compile(b"|".join(re.escape(t) for t in sorted((t["content"].encode() for t in added if t["content"]), key=len, reverse=True))) if added else None
        to_byte = {c: b for b, c in _byte_chars().items()}
        self.ids = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in to_byte for c in token)}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.rank = {}
        for order, (a, b) in enumerate(pairs):
            self.rank.setdefault((bytes(to_byte[c] for c in a), bytes(to_byte[c] for c in b)), order)
        self.token = {i: t for t, i in self.ids.items()}
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for text, i in self.ids.items():
            node = 0
            for b in text:
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][b]
            self.ends[node] = i
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states = {((0, -1, 0),): 0}
        self.content = [((0, -1, 0),)]
        self._room(1 << 16)

    def _room(self, size: int) -> None:
        old = getattr(self, "keys", None) if size > 1 << 16 else None
        keep = (old[old >= 0], self.to[old >= 0], self.count[old >= 0]) if old is not None else None
        self.size, self.used = size, 0
        self.keys, self.to, self.count = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int16)
        if keep is not None:
            for key, to, count in zip(*(x.tolist() for x in keep)):
                self._put(key, to, count)

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 7) & (self.size - 1)

    def _put(self, key: int, to: int, count: int) -> None:
        if 2 * self.used >= self.size:
            self._room(2 * self.size)
        at = self._slot(key)
        while self.keys[at] >= 0:
            at = (at + 1) & (self.size - 1)
        self.keys[at], self.to[at], self.count[at] = key, to, count
        self.used += 1

    def encode(self, text: bytes) -> list[bytes]:
        """Merge rules in rank order, as the definition has it."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = min((self.rank.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            pair, merged, i = (parts[at], parts[at + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def fit(self, before: int, token: int) -> bool:
        known = self.fits.get((before, token))
        if known is None:
            two = ([self.token[before]] if before >= 0 else []) + [self.token[token]]
            known = self.fits[before, token] = self.encode(b"".join(two)) == two
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change in the number of tokens) for a byte read in a state."""
        moved = []
        for node, before, behind in self.content[state]:  # from the longest suffix on
            child = self.children[node].get(byte)
            if child is not None:
                moved.append((child, before, behind))
        for child, before, behind in moved:
            token = self.ends[child]
            if token >= 0 and self.fit(before, token):
                last, delta = token, behind + 1
                break
        else:
            raise ValueError("no token ends here; the vocabulary lacks a byte")
        content = (*((c, before, behind - delta) for c, before, behind in moved if self.children[c]), (0, last, 0))
        if content not in self.states:
            self.states[content] = len(self.content)
            self.content.append(content)
        return self.states[content], delta

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.int64) * 256 + byte
        while True:
            at = self._slot(key)
            found = self.keys[at]
            wrong = np.flatnonzero(found != key)
            missing = []
            while len(wrong):
                empty = found[wrong] < 0
                missing.append(wrong[empty])
                wrong = wrong[~empty]
                at[wrong] = (at[wrong] + 1) & (self.size - 1)
                found[wrong] = self.keys[at[wrong]]
                wrong = wrong[found[wrong] != key[wrong]]
            missing = np.concatenate(missing) if missing else []
            if not len(missing):
                return self.to[at], self.count[at]
            for k in np.unique(key[missing]).tolist():
                self._put(k, *self.compile(k >> 8, k & 255))

    def counts(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token raw[start:start + length], all of positive length."""
        if len(self.content) > 450_000:
            self.reset()  # bounded memory; what is needed is compiled again
            self.fits.clear()
        order = np.argsort(-length, kind="stable")
        start, sorted_length = start[order], length[order]
        total, state = np.zeros(len(start), np.int64), np.zeros(len(start), np.int32)
        live = len(start)
        ascending = -sorted_length
        for k in range(int(sorted_length[0]) if len(start) else 0):
            live = int(np.searchsorted(ascending, -k, "left"))  # those longer than k
            to, change = self.step(state[:live], raw[start[:live] + k])
            state[:live] = to
            total[:live] += change
        out = np.empty_like(total)
        out[order] = total
        return out


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in kept}
    for extra, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + extra)
    return out


@lru_cache(2)
def merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text (null: 0); an added token in a text is one token and ends what is around it."""
    raw, offsets = buffers(texts)
    out = np.zeros(len(offsets) - 1, np.int64)
    if not len(raw):
        return out
    data, compiled = raw.tobytes(), merges(path)
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    symbols = classes()[points]
    lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # bytes where code points begin
    at = 0
    while compiled.added and (found := compiled.added.search(data, at)):
        doc = int(np.searchsorted(offsets, found.start(), "right")) - 1
        if found.end() <= offsets[doc + 1]:
            out[doc] += 1
            symbols[slice(*np.searchsorted(lead, found.span()))] = STOP
            at = found.end()
        else:
            at = found.start() + 1
    doc_at = np.searchsorted(lead, offsets[:-1])  # a STOP before each text
    spread = np.insert(symbols, doc_at, STOP)
    origin = np.insert(np.arange(len(symbols)), doc_at, -1)
    first = begins(spread)
    first &= spread != STOP
    begin_at = origin[first & (origin >= 0)]
    if not len(begin_at):
        return out
    stops = np.zeros(len(symbols) + 1, bool)
    stops[begin_at] = True
    stops[doc_at] = True
    stops[:-1] |= symbols == STOP
    stops[-1] = True
    edge = np.flatnonzero(stops)
    same = joined_values(raw, lead[edge])
    used, index = compacted(same.indices.to_numpy(zero_copy_only=False)[np.searchsorted(edge, begin_at)], len(same.dictionary))
    _, at_buffer, values = same.dictionary.buffers()
    bounds = np.frombuffer(at_buffer, np.int64, len(same.dictionary) + 1)
    tokens = compiled.counts(np.frombuffer(values, np.uint8), bounds[used], bounds[used + 1] - bounds[used])[index]
    total = np.concatenate(([0], np.cumsum(tokens)))
    return out + np.diff(total[np.searchsorted(lead[begin_at], offsets)])


def token_counts(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, with the vocabulary file at `path` on every executor."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches_of(batches, 4 << 20):
            texts = batch.column(1)
            _, offsets = buffers(texts)
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offsets)), pa.array(count_tokens(texts, path))], ["key", "n_bytes", "n_tokens"])

    out = arrow_map(df.select(df[key].alias("key"), df[text].alias("text")), run, f"key {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("key", key)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
