"""Token ids of whole texts with a public tokenizer file, many texts at a time.

The byte-level tokenizer cuts a text before it merges bytes, and always cuts in front of a space or line break
that follows a printable character. So a text is cut there, each different chunk is encoded once by
the tokenizers library, and the ids are gathered from a bounded cache kept by the Python worker. The ids equal those of the whole text
(tests compare them). Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

END_ID = 0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


SLICE = 1 << 17  # text bytes encoded at a time; what the library holds of them takes some hundred times as much
#: Bytes that begin UTF-8 forms of white space beyond ASCII, among other characters.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class ChunkCache:
    """Ids of text chunks by their hash: a direct-mapped table over a pool of ids, both bounded."""

    SLOTS = 1 << 20
    POOL = 1 << 22

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # the alphabet writes one character for each byte of a token
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)
        self.clear()

    def clear(self) -> None:
        self.tag = np.zeros(self.SLOTS, np.uint64)
        self.start = np.zeros(self.SLOTS, np.int32)
        self.length = np.zeros(self.SLOTS, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after the other, and their numbers.

        Chunks that begin with a space before a visible character are put into long texts, since the tokenizer always cuts
        there; the bytes that each id stands for show where a chunk ends. The others are encoded one by one.
        """
        second = data[np.minimum(starts + 1, len(data) - 1)]
        joins = (data[starts] == 32) & (ends - starts > 1) & (second > 32) & (second != 127) & ~_MAYBE_SPACE[second]
        raw = data.tobytes()
        chunks = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        counts = np.zeros(len(chunks), np.int64)
        parts: list[np.ndarray] = []
        order: list[np.ndarray] = []
        some = np.flatnonzero(joins)
        size = (ends - starts)[some]
        group = np.cumsum(size) // 4096
        cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(some) else np.zeros(0, np.int64)
        groups = [some[a:b] for a, b in zip(cuts, cuts[1:])]
        texts = [b"".join([chunks[i] for i in g.tolist()]).decode() for g in groups]
        single = np.flatnonzero(~joins).tolist()
        for g, ids in zip(groups, self._plain(texts)):
            ids = np.array(ids, np.int32)
            at = np.cumsum(self.width[ids])
            end = np.cumsum(ends[g] - starts[g])
            last = np.searchsorted(at, end)
            if len(ids) and last[-1] < len(at) and np.array_equal(at[last], end):
                counts[g] = np.diff(last, prepend=-1)
                parts.append(ids)
                order.append(g)
            else:  # not cut as expected
                single += g.tolist()
        if single:
            found = self._plain([chunks[i].decode() for i in single])
            counts[single] = [len(x) for x in found]
            parts.append(np.fromiter((i for x in found for i in x), np.int32))
            order.append(np.array(single))
        # from the order of encoding to the order of the chunks
        flat, where = np.concatenate(parts), np.concatenate(order)
        begin = np.empty(len(chunks), np.int64)
        begin[where] = np.cumsum(counts[where]) - counts[where]
        out = np.cumsum(counts) - counts
        return flat[np.repeat(begin - out, counts) + np.arange(counts.sum())], counts

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        starts = chunk_starts(data, off)
        ends = np.append(starts[1:], len(data))
        h = K.span_hashes(data, starts, ends)
        if self.used > self.POOL:
            self.clear()
        slot = (h & np.uint64(self.SLOTS - 1)).astype(np.int64)
        at, size = self.start[slot].astype(np.int64), self.length[slot].astype(np.int64)
        missing = np.flatnonzero((self.tag[slot] != h) | (size == 0))
        if len(missing):
            new, first, inverse = np.unique(h[missing], return_index=True, return_inverse=True)
            where = missing[first]
            flat, lengths = self._encode(data, starts[where], ends[where])
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.int32)])
            self.pool[self.used:self.used + len(flat)] = flat
            begin = self.used + np.cumsum(lengths) - lengths
            self.used += len(flat)
            at[missing], size[missing] = begin[inverse], lengths[inverse]
            to = slot[where]
            self.tag[to], self.start[to], self.length[to] = new, begin, lengths
        total = np.concatenate([[0], np.cumsum(size)])
        out = self.pool[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        return out, np.diff(total[np.searchsorted(starts, off)])


def chunk_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions where the tokenizer's own cutting surely begins a new piece (all text starts too).

    In front of a space or line feed after a printable ASCII byte; in front of a space between a
    non-ASCII byte and a printable one; after a single line feed between printable bytes.
    """
    n = len(data)
    printable = (data > 32) & (data < 127)
    cut = np.zeros(n + 1, bool)
    here = data[1:]
    cut[1:n] = ((here == 32) | (here == 10)) & printable[:-1]
    if n > 2:
        inner = np.zeros(n + 1, bool)
        inner[1:n - 1] = (data[1:-1] == 32) & (data[:-2] > 127) & printable[2:]
        inner[off[1:] - 1] = False  # the last byte of a text has no next one
        cut |= inner
        cut[2:n] |= (data[1:-1] == 10) & printable[:-2] & printable[2:]
    cut[off] = True
    return np.flatnonzero(cut[:n])


def worker_cache(path: str) -> ChunkCache:
    """The cache of this Python worker process, kept between tasks."""
    holder = sys.modules.setdefault("_tessera_token_cache", types.ModuleType("_tessera_token_cache"))
    if getattr(holder, "path", None) != path:
        holder.path, holder.cache = path, ChunkCache(path)
    return holder.cache


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each text's ids; the new ids and their offsets."""
    off = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(off[-1], end_id, np.int32)
    keep = np.ones(off[-1], bool)
    keep[off[1:] - 1] = False
    out[keep] = ids
    return out, off


def crc(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
            end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids array<int>): ids of the whole text (null: empty) and the end id."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(path)
        for batch in K.slices(batches, "text", SLICE):
            ids, off = with_end(*cache.ids(*K.text_bytes(batch.column("text"))), end_id)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids))],
                                             names=["doc_id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids array<int>")
