"""Vectorised text primitives over Arrow string buffers (numpy, whole texts, no per-word Python).

Every function takes a pyarrow string array (nulls count as empty) and works on its UTF-8 bytes at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: Bytes that end a word for the white-space word rule `[^\x20\x09-\x0D]+`.
SPACE_SEPARATORS = bytes([0x20, *range(0x09, 0x0E)])


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: an invertible scramble of each value."""
    h = h ^ (h >> U64(30))
    h = h * _M1
    h ^= h >> U64(27)
    h *= _M2
    h ^= h >> U64(31)
    return h


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, offsets as int64 with len + 1 entries), nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return raw[lo:hi], offsets - lo


def lut(separators: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(byte -> byte with A-Z lowered, byte -> is part of a word)."""
    low = np.arange(256, dtype=np.uint8)
    if lower:
        low[65:91] += 32
    word = np.ones(256, bool)
    word[np.frombuffer(separators, np.uint8)] = False
    return low, word


def word_spans(raw: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each text): byte spans of the words; a word never crosses a text's end."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[raw]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # the first k bytes of eight
LONG = 2048  # bytes of a segment from which a digest of the whole is taken


def segment_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each raw[start:end], case folded by `low`.

    Eight bytes at a time go through the finaliser, each on top of what came before, so the hash isn't a sum over
    places and has no algebraic collisions; segments of up to eight bytes and one length never collide.
    """
    if not len(start):
        return np.zeros(0, U64)
    data = np.zeros(len(raw) + 8, np.uint8)
    data[: len(raw)] = raw if low is None else low[raw]
    words = np.ndarray((len(raw) + 1,), "<u8", data, strides=(1,))  # the eight bytes from each position on
    size = end - start
    out = mix(size.astype(U64) * _BASE)
    if len(size):
        out = mix(out ^ (words[start] & _MASKS[np.minimum(size, 8)]))
    live = np.flatnonzero((size > 8) & (size <= LONG))
    at = 8
    while len(live):
        out[live] = mix(out[live] * _BASE ^ (words[start[live] + at] & _MASKS[np.minimum(size[live] - at, 8)]))
        at += 8
        live = live[size[live] > at]
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def joined_values(texts_raw: np.ndarray, edges: np.ndarray) -> pa.DictionaryArray:
    """The stretches texts_raw[edges[i]:edges[i + 1]] as an exact dictionary of their bytes; edges ascend from 0 to the end."""
    offsets = pa.py_buffer(np.ascontiguousarray(edges, np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(texts_raw))]).dictionary_encode()


def compacted(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(the values below `size` that occur in index, ascending; index in terms of their places)."""
    seen = np.zeros(size, bool)
    seen[index] = True
    place = np.cumsum(seen) - 1
    return np.flatnonzero(seen), place[index]


def word_hashes(texts: pa.Array, separators: bytes = SPACE_SEPARATORS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, A-Z lowered; words before each text)."""
    raw, offsets = buffers(texts)
    low, word = lut(separators)
    start, end, bounds = word_spans(raw, offsets, word)
    return segment_hash(raw, start, end, low), bounds


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of runs of `size` words, runs before each text); a shorter text, if not empty, is one run."""
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    at = np.concatenate(([0], np.cumsum(runs)))
    pos = np.repeat(bounds[:-1] - at[:-1], runs) + np.arange(at[-1])
    if not len(pos):
        return np.zeros(0, U64), at
    width = np.repeat(np.minimum(counts, size), runs)
    out = np.zeros(len(pos), U64)
    for k in range(size):
        more = width > k
        step = words[np.minimum(pos + k, len(words) - 1)] * U64(2 * k + 1) + U64(k)
        out = np.where(more, mix(out * _BASE + step), out)
    return out, at


def distinct_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their bounds."""
    parts, sizes = [], np.zeros(len(bounds), np.int64)
    for i in range(len(bounds) - 1):
        if bounds[i + 1] > bounds[i]:
            own = np.sort(values[bounds[i] : bounds[i + 1]])
            own = own[np.append(True, own[1:] != own[:-1])]
            parts.append(own)
            sizes[i + 1] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), np.cumsum(sizes)


def batches_of(table_batches, budget_bytes: int = 8 << 20, column: str = "text"):
    """Slice record batches so that each slice holds about budget_bytes of text at most (one text at least)."""
    for batch in table_batches:
        if not batch.num_rows:
            continue
        arr = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
        _, off, _ = arr.buffers()
        offsets = np.frombuffer(off, np.int64, len(arr) + 1, arr.offset * 8)
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(offsets, offsets[i] + budget_bytes, "right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            yield batch.slice(i, j - i)
            i = j
