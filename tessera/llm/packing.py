"""Best-fit packing of token pieces into sequences: bin completion with branch and bound.

Only the lengths decide a packing, and there are at most ``capacity`` different ones. So Spark counts
the pieces of each length (a partial aggregate), the search runs on that bounded table, and its
fillings, each with the number of sequences that use it, are given back to the pieces by the rank
of a piece among those of its length. No piece passes through the driver or a single task.

The search takes the largest remaining length and completes its sequence. Completions are enumerated best
fit first, along the sums that the pieces can make, so without dead ends; one is dominated, and skipped, if exchanging a
piece of it for a longer unused one, or adding one, still fits. The first descent, best fit throughout, is the incumbent;
then packings with one sequence less are sought, branches being cut when they waste more than that allows. The search ends at
the lower bound, when a tree is empty, or after ``nodes`` lists of at most ``WIDTH`` completions: the problem is NP-hard.
"""

from __future__ import annotations

import bisect
import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import tokens
from .common import numbered_within

CAPACITY = 2048
NODES = 12_000  # completion lists of one search
TURN = 1500  # of these, for one order of equally full completions
WIDTH = 8  # completions a list
TRIES = 4 * WIDTH  # fillings looked at for one list


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least, by dual feasible functions: a length is rounded so that no sequence's lengths can
    sum to more than before. Up to a border, short pieces count nothing and what leaves less than the border
    counts whole; the rest counts itself or its share in steps of 1/k."""
    lengths, held = np.array(sorted(counts.items()), np.int64).T
    best = 0
    for border in [0, *(n for n in sorted(counts) if 2 * n <= capacity)]:
        x = np.where(lengths > capacity - border, capacity, np.where(lengths < border, 0, lengths))
        best = max(best, -(-int((x * held).sum()) // capacity))
        for k in range(1, 12):
            share = np.where(x * (k + 1) % capacity == 0, x * k, x * (k + 1) // capacity * capacity)
            best = max(best, -(-int((share * held).sum()) // (k * capacity)))
    return best


def reached(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """For each number of first lengths the sums up to ``room`` that their pieces can make, as bits."""
    table, mask = [1], (1 << (room + 1)) - 1
    for n in lengths:
        bits, left, step = table[-1], min(counts[n], room // n), 1
        while left > 0:
            bits |= bits << n * min(step, left) & mask
            left -= step
            step *= 2
        table.append(bits)
    return table


def fillings(lengths: list[int], counts: dict[int, int], table: list[int], total: int) -> Iterator[tuple[int, ...]]:
    """All choices of pieces that sum to ``total``, longest pieces first; ``table`` leads past dead ends."""
    stack: list[tuple[int, int, tuple[int, ...]]] = [(len(lengths), total, ())]
    while stack:
        j, rest, chosen = stack.pop()
        if not rest:
            yield chosen
            continue
        j = bisect.bisect_right(lengths, rest, 0, j)
        while True:
            n = lengths[j - 1]
            fits = [m for m in range(min(counts[n], rest // n) + 1) if table[j - 1] >> rest - m * n & 1]
            if fits != [0]:
                break
            j -= 1
        stack.extend((j - 1, rest - m * n, chosen + (n,) * m) for m in fits)


def completions(lengths: list[int], counts: dict[int, int], room: int, least: int = 0, width: int = WIDTH) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` with a sum of ``least`` or more, fullest first (``lengths`` ascending)."""
    lengths = lengths[:bisect.bisect_right(lengths, room)]
    table = reached(lengths, counts, room)
    sums, found, tries = table[-1], [], TRIES
    while sums and tries > 0 and len(found) < width:
        total = sums.bit_length() - 1
        if total < least:
            break
        sums ^= 1 << total
        slack = room - total
        for f in fillings(lengths, counts, table, total):
            tries -= 1
            longer = (lengths[i] for n in set(f) for i in range(bisect.bisect_right(lengths, n), bisect.bisect_right(lengths, n + slack)))
            unused = f and slack >= lengths[0] and any(counts[n] > f.count(n) for n in lengths[:bisect.bisect_right(lengths, slack)])
            if not unused and all(counts[n] <= f.count(n) for n in longer):
                found.append(f)
            if len(found) >= width or tries <= 0:
                break
    return found


class _Search:
    """Depth-first search for a packing in at most ``target`` sequences.

    A node is the pieces left; its options complete the longest of them, as often as possible or once. Options whose
    waste is more than ``target`` allows are cut, and so are pieces left that failed before with no more waste."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts, self.capacity = counts, capacity
        self.total = sum(n * c for n, c in counts.items())
        rng = random.Random(5)
        self.marks = {n: rng.getrandbits(120) for n in counts}

    def options(self, left: dict[int, int], slack: int | None, width: int, rng: random.Random | None = None) -> list[tuple[tuple[int, ...], int]]:
        lengths = sorted(left)
        top = lengths[-1]
        room = self.capacity - top
        rest = dict(left)
        rest[top] -= 1
        if not rest[top]:
            del rest[top]
            lengths.pop()
        out = []
        found = completions(lengths, rest, room, 0 if slack is None else room - slack, width)
        if rng:
            rng.shuffle(found)
            found.sort(key=sum, reverse=True)
        for f in found:
            pattern = (top, *f)
            waste = room - sum(f)
            times = min(left[n] // pattern.count(n) for n in set(pattern))
            if slack is not None and waste:
                times = min(times, slack // waste)
            out += [(pattern, times)] + [(pattern, 1)] * (times > 1 and width > 1)
        return out

    def take(self, left: dict[int, int], option: tuple[tuple[int, ...], int], sign: int) -> int:
        """Use an option's pieces (or give them back); the change of the node's mark."""
        mark = 0
        for n in set(option[0]):
            k = option[0].count(n) * option[1] * sign
            left[n] = left.get(n, 0) - k
            mark -= k * self.marks[n]
            if not left[n]:
                del left[n]
        return mark

    def greedy(self) -> list[tuple[tuple[int, ...], int]]:
        """Best fit first: the first incumbent."""
        left, plan = dict(self.counts), []
        while left:
            plan.append(self.options(left, None, 1)[0])
            self.take(left, plan[-1], 1)
        return plan

    def within(self, target: int, nodes: int) -> tuple[list[tuple[tuple[int, ...], int]] | None, int, bool]:
        """(packing or None, nodes left, whether the whole tree was searched): paths with one choice other than
        the best fit first, then with two, and so on; of these the latest first. Each round takes equally full completions
        in another order, and after ``TURN`` lists the next round begins."""
        for turns in itertools.count(1):
            rng, stop = random.Random(turns) if turns > 1 else None, max(0, nodes - TURN * turns)
            left, plan, slack, mark, cut = dict(self.counts), [], target * self.capacity - self.total, 0, False
            dead: dict[int, tuple[int, int]] = {}
            frames = [(self.options(left, slack, WIDTH, rng), 0, turns, mark, slack)]
            while frames:
                options, i, free, mark, slack = frames.pop()
                if i >= len(options) or (i and not free):
                    cut |= i < len(options)
                    dead[mark] = max(dead.get(mark, (-1, -1)), (slack, free))
                    if plan:
                        self.take(left, plan.pop(), -1)
                    continue
                frames.append((options, i + 1, free, mark, slack))
                option, free = options[i], free - (i > 0)
                after = mark + self.take(left, option, 1)
                plan.append(option)
                if not left:
                    return plan, nodes, False
                slack -= (self.capacity - sum(option[0])) * option[1]
                known = dead.get(after)
                if known and known[0] >= slack and known[1] >= free:
                    cut = True  # perhaps cut there
                    self.take(left, plan.pop(), -1)
                    continue
                nodes -= 1
                if nodes <= 0:
                    return None, 0, False
                if nodes <= stop:
                    cut = True
                    break
                frames.append((self.options(left, slack, WIDTH, rng), 0, free, after, slack))
            if not cut:
                return None, nodes, True
        raise AssertionError


def fill(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Fillings (lengths of one sequence, number of such sequences) that use up ``counts``."""
    counts = {n: c for n, c in counts.items() if c > 0}
    if not counts:
        return []
    bound = lower_bound(counts, capacity)
    search = _Search(counts, capacity)
    best = search.greedy()
    empty = False
    while nodes > 0 and not empty and (size := sum(t for _, t in best)) > bound:
        found, nodes, empty = search.within(size - 1, nodes)
        best = found or best
    return best


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of each document: doc_id, piece, start, length, ids_crc32 (and ids).

    A document longer than ``capacity`` is cut into pieces of ``capacity`` ids, the first of which may be shorter.
    """
    path = path or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tokens.worker_cache(path)
        for batch in K.slices(batches, "text", tokens.SLICE):
            ids, off = tokens.with_end(*cache.ids(*K.text_bytes(batch.column("text"))), tokens.END_ID)
            n = np.diff(off)
            parts = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            head = n - (parts - 1) * capacity
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            begin = off[:-1][doc] + start
            sums = [tokens.crc(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)),
                       pa.array(length.astype(np.int64)), pa.array(sums, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, off[-1]).astype(np.int32)), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return src.mapInArrow(run, schema)


def assign(rows: DataFrame, order: list, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Give rows with a ``length`` (1 to ``capacity``) a ``sequence_id`` and an ``offset`` in it.

    Sequences are filled gapless from 0. Rows of equal length are exchangeable; ``order`` ranks them.
    """
    ranked = numbered_within(rows, "length", order, "_rank")
    counts = {r["length"]: r["c"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()}  # at most `capacity` rows
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    used = dict.fromkeys(counts, 0)
    table = []  # length, first rank, first sequence, pieces of this length in a sequence, offset of the first
    sequence = 0
    for pattern, times in fill(counts, capacity, nodes):
        offset = 0
        for n in dict.fromkeys(pattern):
            k = pattern.count(n)
            table.append((n, used[n], sequence, k, offset))
            used[n] += k * times
            offset += n * k
        sequence += times
    grid = np.array(sorted(table), np.int64).reshape(-1, 5)
    lengths, first = np.unique(grid[:, 0], return_index=True)
    last = np.append(first[1:], len(grid))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            row = np.empty(len(n), np.int64)
            for length in np.unique(n):
                i = np.searchsorted(lengths, length)
                mine = np.flatnonzero(n == length)
                row[mine] = first[i] + np.searchsorted(grid[first[i]:last[i], 1], rank[mine], "right") - 1
            at = rank - grid[row, 1]
            sequence_id, offset = grid[row, 2] + at // grid[row, 3], grid[row, 4] + at % grid[row, 3] * n
            kept = [i for i, name in enumerate(batch.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(sequence_id), pa.array(offset)],
                                             names=[*(batch.schema.names[i] for i in kept), "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    return ranked.select(*[f"`{c}`" for c in rows.columns], "_rank").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False, nodes: int = NODES) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and offset.

    A null or empty text is one piece holding only the end id. Rows with a repeated or null doc_id
    are documents of their own. An empty table gives no rows. Other columns are ignored.
    """
    return assign(pieces(docs, capacity, path, id_col, text_col, with_ids), [F.col("doc_id"), F.col("piece")], capacity, nodes)
