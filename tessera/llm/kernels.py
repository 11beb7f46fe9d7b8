"""Vectorised text kernels used inside Arrow tasks: words, hashes and word windows of many texts at once.

Words are maximal runs of bytes other than space and 0x09-0x0D. Hashes are 64-bit, seeded by
constants of this file, so they agree across tasks, runs and machines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BLOCK = 1 << 17  # bytes hashed at a time: bounds the temporary arrays (some 50 bytes for each), not the texts


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string column (null: empty) and each text's offsets."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text (a longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    ink = ~SPACE[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[off] = True
    start = ink.copy()
    start[1:] &= ~ink[:-1] | edge[1:n]
    end = ink.copy()
    end[:-1] &= ~ink[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans given in ascending order, block by block."""
    out = np.empty(len(starts), U64)
    table = _BYTE_LOWER if lower else _BYTE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse = _power(hi - lo + 1)
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(table[data[lo:hi]] * power[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U64))
        i = j
    return out


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive values of ``h`` (len(h) - k + 1 of them), by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = 0xF1357AEA2E62A9C5
    done, size, part, width, bits = None, 0, h, 1, k
    while bits:
        if bits & 1:
            done = part if done is None else done[:len(done) - width] * U64(pow(base, width, 1 << 64)) + part[size:size + len(done) - width]
            size += width
        bits >>= 1
        if bits:
            part = part[:len(part) - width] * U64(pow(base, width, 1 << 64)) + part[width:]
            width *= 2
    return mix(done[:n])


def shingles(data: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed k-word shingles of each text after folding A-Z, sorted within the text, and
    their offsets. A text of fewer words gives its whole word sequence as one; none without words."""
    starts, ends, first = word_bounds(data, off)
    h = span_hashes(data, starts, ends, lower=True)
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    full = windows(h, k)
    inside = text_of[:len(full)] == text_of[k - 1:k - 1 + len(full)] if len(full) else np.zeros(0, bool)
    values, owner = full[inside], text_of[:len(full)][inside]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        extra = np.array([windows(h[first[i]:first[i + 1]], int(counts[i]))[0] ^ U64(counts[i]) for i in few], U64)
        values, owner = np.concatenate([values, extra]), np.concatenate([owner, few])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def text_bytes_of(blobs: pa.Array) -> memoryview:
    """The bytes of a binary column without nulls, one value after the other."""
    off = np.frombuffer(blobs.buffers()[1], np.int64 if pa.types.is_large_binary(blobs.type) else np.int32)
    lo, hi = int(off[blobs.offset]), int(off[blobs.offset + len(blobs)])
    return memoryview(blobs.buffers()[2] or b"")[lo:hi]
