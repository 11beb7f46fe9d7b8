"""Repeated 20-word windows across the corpus, found by recompression.

Rounds name the word sequence of every text bottom-up: first maximal runs of one word, then twice pairs of
neighbouring symbols whose names fall on the left and on the right side (a bit of the name, other bits
each round). Names are 64-bit hashes of their parts, so all tasks give equal names without a dictionary to share. A cut between
two symbols depends only on the symbols beside it, so two equal windows get the same symbols inside, apart
from the edges; which ones are surely the same follows from the window's own words.

Of its sure symbols a window chooses the one with the smallest priority, and is posted under that symbol with
three words of context on either side: equal windows meet under one key, and about seven windows share a posting. A
window without a sure symbol (long runs) is posted under its own hash. Where a key meets, the windows' hashes (64 + 48 bits)
tell whether the 20 words are equal; all but the earliest are repeats. Repeats within one slice of a task are settled there, so
a passage held by a third of all documents posts once a slice.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

WINDOW = 20
EDGE = 3  # words on either side of a sure symbol that lie in the window at least
BUCKET_BYTES = 8 << 20  # text bytes whose postings form one bucket
LEAST_BUCKETS = 256
_ODD = np.uint64(0xD1342543DE82EF95)


def _named(parts: np.ndarray, starts: np.ndarray, merged: np.ndarray, seed: int) -> np.ndarray:
    """Names of the symbols at ``starts``: of one part, or of two where ``merged``."""
    names = parts[starts].copy()
    names[merged] = K.mix(parts[starts[merged]] * _ODD + parts[starts[merged] + 1] + np.uint64(seed))
    return names


def sure_symbols(h: np.ndarray, text_of: np.ndarray, p: np.ndarray, window: int = WINDOW):
    """Level-two symbols of a word-hash sequence and, for windows at ``p``, the range of sure ones.

    Returns names, first words (with the end appended), and ranges lo, hi (hi <= lo: none).
    """
    n = len(h)
    fresh = np.ones(n, bool)
    fresh[1:] = (h[1:] != h[:-1]) | (text_of[1:] != text_of[:-1])
    begin = np.flatnonzero(fresh)
    length = np.diff(np.append(begin, n))
    names = np.where(length > 1, K.mix(h[begin] * _ODD + length.astype(np.uint64)), h[begin])
    upto = np.cumsum(fresh)  # run starts at or before a word
    lo, hi = upto[p], upto[p + window - 1] - 1  # first and last run border inside the window
    for level in (1, 2):
        side = (names >> np.uint64(7 * level)) & np.uint64(1)
        owner = text_of[begin]
        joins = np.zeros(len(names), bool)  # this symbol takes the next one
        joins[:-1] = (side[:-1] == 0) & (side[1:] == 1) & (owner[1:] == owner[:-1])
        border = np.ones(len(names), bool)
        border[1:] = ~joins[:-1]
        keep = np.flatnonzero(border)
        names = _named(names, keep, joins[keep], level)
        begin = begin[keep]
        upto = np.cumsum(border)
        ok = hi - lo >= 2
        a, b = np.where(ok, lo, 0), np.where(ok, hi, 1)
        lo, hi = np.where(ok, upto[a], 0), np.where(ok, upto[b - 1] - 1, 0)
    return names, np.append(begin, n), lo, hi


def _smallest(priority: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the leftmost smallest priority in each range lo..hi-1 (all non-empty)."""
    span = hi - lo
    tables = [np.arange(len(priority))]
    while (1 << len(tables)) <= int(span.max(initial=1)):
        t, w = tables[-1], 1 << (len(tables) - 1)
        left, right = t[:len(t) - w], t[w:]
        tables.append(np.where(priority[left] <= priority[right], left, right))
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(lo), np.int64)
    for k, t in enumerate(tables):
        mine = np.flatnonzero(level == k)
        left, right = t[lo[mine]], t[hi[mine] - (1 << k)]
        out[mine] = np.where(priority[left] <= priority[right], left, right)
    return out


def anchors(h: np.ndarray, first: np.ndarray, window: int = WINDOW):
    """Windows of all texts: places p (word numbers), key of each and its window hash.

    ``first`` gives each text's first word. Windows lie inside one text.
    """
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    each = np.maximum(counts - window + 1, 0)
    p = np.repeat(first[:-1] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    if not len(p):
        return p, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    whole = K.windows(h, window)[p]
    names, begin, lo, hi = sure_symbols(h, text_of, p, window)
    sure = np.flatnonzero(hi > lo)
    key = K.mix(whole + np.uint64(99))
    if len(sure):
        a = _smallest(K.mix(names * _ODD + np.uint64(5)), lo[sure], hi[sure])
        s, e = begin[a] - EDGE, begin[a + 1] + EDGE
        power, inverse = K._power(len(h) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:len(h)])])
        key[sure] = K.mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
    return p, key, whole


_HEAD = "<qq"  # numbers of postings and of settled repeats


def _six(x: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each hash as six bytes."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]


def _pack(docs, texts, starts, counts, keys, hashes, gone) -> bytes:
    """Postings (document, first window, number of windows, key, window hashes) and settled repeats."""
    n, g = len(keys), len(gone[0])
    return b"".join([struct.pack(_HEAD, n, g), docs.astype("<i8").tobytes(), texts.astype("<i8").tobytes(), starts.astype("<i4").tobytes(),
                     counts.astype("<i4").tobytes(), keys.astype("<u8").tobytes(), _six(hashes).tobytes(),
                     gone[0].astype("<i8").tobytes(), gone[1].astype("<i8").tobytes(), gone[2].astype("<i4").tobytes(), gone[3].astype("<i4").tobytes()])


def _unpack(blob: memoryview):
    n, g = struct.unpack_from(_HEAD, blob)
    at = struct.calcsize(_HEAD)

    def take(kind, k):
        nonlocal at
        x = np.frombuffer(blob, kind, k, at)
        at += x.nbytes
        return x

    docs, texts, starts, counts, keys = take("<i8", n), take("<i8", n), take("<i4", n), take("<i4", n), take("<u8", n)
    six = take(np.uint8, 6 * int(counts.sum())).reshape(-1, 6)
    full = np.zeros((len(six), 8), np.uint8)
    full[:, 2:] = six
    return docs, texts, starts, counts, keys, full.view("<u8").ravel(), (take("<i8", g), take("<i8", g), take("<i4", g), take("<i4", g))


def _runs(docs, texts, starts):
    """Consecutive starts of one document as (document, text, first start, last start)."""
    order = np.lexsort((starts, texts, docs))
    d, t, s = docs[order], texts[order], starts[order]
    new = np.ones(len(s), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > s[:-1] + 1)
    b = np.flatnonzero(new)
    e = np.append(b[1:], len(s)) - 1
    return (d[b], t[b], s[b], s[e]) if len(s) else (d, t, s, s)


def _later(groups: np.ndarray, docs: np.ndarray, texts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices of all windows but the earliest (document, start) of each group of equal ones."""
    order = np.argsort(groups, kind="stable")
    g = groups[order]
    same = np.zeros(len(g) + 1, bool)
    same[1:-1] = g[1:] == g[:-1]
    some = order[same[1:] | same[:-1]]  # in groups of two or more
    if not len(some):
        return some
    some = some[np.lexsort((starts[some], texts[some], docs[some], groups[some]))]
    g = groups[some]
    return some[1:][g[1:] == g[:-1]]


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, text_hash, first, last): window starts whose words also start earlier, as runs.

    ``docs``: doc long (not null), text string, text_hash long.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_BYTES)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            data, off = K.text_bytes(batch.column("text"))
            starts, ends, first = K.word_bounds(data, off)
            p, key, whole = anchors(K.span_hashes(data, starts, ends), first, window)
            if not len(p):
                continue
            row = np.searchsorted(first, p, "right") - 1
            doc, text = batch.column("doc").to_numpy()[row], batch.column("text_hash").to_numpy()[row]
            place = (p - first[row]).astype(np.int64)
            same = K.mix(key * _ODD + whole)
            again = _later(same, doc, text, place)
            new = np.ones(len(p), bool)
            new[again] = False
            # windows of one anchor that follow each other form a posting
            left = np.flatnonzero(new)
            cut = np.ones(len(left), bool)
            cut[1:] = (key[left[1:]] != key[left[:-1]]) | (left[1:] != left[:-1] + 1) | (row[left[1:]] != row[left[:-1]])
            b = np.flatnonzero(cut)
            size = np.diff(np.append(b, len(left)))
            at = left[b]
            bucket = (key[at] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            gone = _runs(doc[again], text[again], place[again])
            gone_bucket = (K.mix(gone[0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            gone_order = np.argsort(gone_bucket, kind="stable")
            gone = tuple(x[gone_order] for x in gone)
            numbers = np.union1d(bucket, gone_bucket)
            lo, hi = np.searchsorted(bucket[order], numbers), np.searchsorted(bucket[order], numbers, "right")
            glo, ghi = np.searchsorted(gone_bucket[gone_order], numbers), np.searchsorted(gone_bucket[gone_order], numbers, "right")
            blobs = []
            for i in range(len(numbers)):
                own = order[lo[i]:hi[i]]
                k = size[own]
                w = left[np.repeat(b[own] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
                blobs.append(_pack(doc[at[own]], text[at[own]], place[at[own]], k, key[at[own]], whole[w], [x[glo[i]:ghi[i]] for x in gone]))
            for i in range(0, len(blobs), 512):
                yield pa.RecordBatch.from_arrays([pa.array(numbers[i:i + 512]), pa.array(blobs[i:i + 512], pa.binary())], names=["bucket", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; one bucket is held at a time."""
        held, at = [], None

        def settled():
            parts = [_unpack(memoryview(x)) for x in held]
            docs, texts, starts, counts, keys, hashes = (np.concatenate([x[i] for x in parts]) for i in range(6))
            inside = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            doc, text = np.repeat(docs, counts), np.repeat(texts, counts)
            place = np.repeat(starts, counts) + inside
            again = _later(K.mix(np.repeat(K.mix(keys), counts) + hashes), doc, text, place)
            found = _runs(doc[again], text[again], place[again])
            every = [np.concatenate([f, *[x[6][i] for x in parts]]) for i, f in enumerate(found)]
            for i in range(0, len(every[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + (1 << 16)].astype(np.int64)) for x in every], names=["doc", "text_hash", "first", "last"])

        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                if bucket != at and held:
                    yield from settled()
                    held = []
                at = bucket
                held.append(blob)
        if held:
            yield from settled()

    posted = docs.mapInArrow(post, "bucket long, blob binary")
    return posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "doc long, text_hash long, first long, last long")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans and (if ``keep_text``) kept_text.

    A word is removed when a ``window``-word window over it also starts earlier: in a document of smaller
    id, or earlier in the same one. ``spans`` are the removed word ranges [from, to); kept words are joined by one space.
    Null and empty texts have no words (the hash of nothing). Texts shorter than the window lose nothing. A null id counts
    as smaller than all others; rows of equal id are ordered by the text's hash, and rows equal in both are one document whose
    result each of them gets. An empty table gives none. Other columns are ignored whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.col(id_col).cast("long")
    src = docs.select(own.alias("doc_id"), F.coalesce(own, F.lit(-(1 << 63)).cast("long")).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    found = repeats(src.select("doc", "text", "text_hash").where("length(text) > 0"), window)
    listed = found.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("gone"))
    joined = src.join(listed, ["doc", "text_hash"], "left").select("doc_id", "text", "gone")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            n_words, n_removed, sums, spans, kept = [], [], [], [], []
            gone = batch.column("gone")
            off, flat = gone.offsets.to_numpy(), gone.values
            firsts, lasts = flat.field("first").to_numpy(zero_copy_only=False), flat.field("last").to_numpy(zero_copy_only=False)
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.encode().split()
                ranges = []
                if gone[i].is_valid:
                    order = np.argsort(firsts[off[i]:off[i + 1]], kind="stable")
                    for a, b in zip(firsts[off[i]:off[i + 1]][order].tolist(), lasts[off[i]:off[i + 1]][order].tolist()):
                        if ranges and a <= ranges[-1][1]:
                            ranges[-1][1] = max(ranges[-1][1], b + window)
                        else:
                            ranges.append([a, b + window])
                n_words.append(len(words))
                if ranges:
                    edges = [0, *(x for r in ranges for x in r), len(words)]
                    words = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                n_removed.append(n_words[-1] - len(words))
                out = b" ".join(words)
                sums.append(hashlib.sha256(out).hexdigest())
                spans.append([{"from": a, "to": b} for a, b in ranges])
                if keep_text:
                    kept.append(out.decode())
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sums),
                       pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.string())] * keep_text, names=names + ["kept_text"] * keep_text)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<from: long, to: long>>"
    return joined.mapInArrow(rebuild, schema + ", kept_text string" * keep_text)
