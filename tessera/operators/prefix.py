"""Prefix scans over ordered groups: one range exchange, carries instead of joins.

Rows are range-partitioned and sorted by (group, order), so a group of any size spreads over partitions and only a partition's first
and last group can reach beyond it. A first pass gives one small summary a partition: what its first group
does to a state that comes in, and the state in which its last group goes out. Folding the summaries in
order gives each partition the state it starts with; a second pass over the same (checkpointed) partitions then scans
rows as a stream. Nothing is joined or shuffled again, and nothing larger than one summary per partition leaves the tasks.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .ordering import range_count


def ordered(df: DataFrame, by: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` sorted by (by, order) in checkpointed ranges; column ``_part`` is the range's number."""
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or range_count(df)
    rows = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order).checkpoint(eager=True)
    return rows.withColumn("_part", F.spark_partition_id())


def segments(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Row numbers at which a new group begins (equal nulls are one group)."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for b in by:
        codes = batch.column(b).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def key_at(batch: pa.RecordBatch, by: list[str], i: int) -> tuple:
    return tuple(batch.column(b)[i].as_py() for b in by)


@dataclass
class Carry:
    """What a partition is told: the state of its first group (None: it begins here) and whether its
    last group goes on in a later partition."""
    state: object = None
    goes_on: bool = False


def carries(rows: DataFrame, summarise: Callable, fold: Callable) -> dict[int, Carry]:
    """``summarise(batches)`` gives (first key, first summary, last key, last state) of a partition; a partition
    with one group has no last state. ``fold(state, summary)`` is the state after a first group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None

        def noted():
            nonlocal part
            for batch in batches:
                if batch.num_rows:
                    part = batch.column("_part")[0].as_py() if part is None else part
                    yield batch

        found = summarise(noted())
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pickle.dumps(found)], pa.binary())], names=["part", "found"])

    parts = sorted((r.part, pickle.loads(r.found)) for r in rows.mapInArrow(run, "part int, found binary").collect())
    out: dict[int, Carry] = {}
    before, key, state = None, None, None
    for part, (first_key, summary, last_key, last_state) in parts:
        joined = before is not None and key == first_key
        out[part] = Carry(state if joined else None)
        if joined:
            out[before].goes_on = True
        after = fold(out[part].state, summary)
        before, key, state = part, last_key, after if last_state is None else last_state
    return out


# ---- running aggregates

class _Running:
    """Segmented running sum, max or min. Spark's order holds: NaN is the largest value, nulls don't count."""

    def __init__(self, how: str, whole: bool):
        info = np.iinfo(np.int64)
        self.dtype = np.int64 if whole else np.float64
        self.op, self.fill = {"sum": (np.add, 0), "max": (np.maximum, info.min if whole else -np.inf),
                              "min": (np.minimum if whole else np.fmin, info.max if whole else np.nan)}[how]

    def scan(self, column: pa.Array, starts: np.ndarray, carry: tuple | None) -> tuple[np.ndarray, np.ndarray]:
        """Running values and whether any value was seen, the first segment continuing ``carry``."""
        seen = ~np.asarray(column.is_null())
        values = np.where(seen, column.fill_null(0).to_numpy(zero_copy_only=False), self.fill).astype(self.dtype)
        n = len(values)
        group = np.zeros(n, np.int64)
        group[starts[1:]] = 1
        group = np.cumsum(group)
        step, longest = 1, int(np.max(np.diff(np.append(starts, n))))
        while step < longest:
            same = group[step:] == group[:-step]
            values[step:] = np.where(same, self.op(values[step:], values[:-step]), values[step:])
            seen[step:] |= same & seen[:-step]
            step *= 2
        if carry is not None:
            first = slice(0, starts[1] if len(starts) > 1 else n)
            values[first], seen[first] = self.op(values[first], self.dtype(carry[0])), seen[first] | carry[1]
        return values, seen

    def fold(self, state: tuple | None, summary: tuple) -> tuple:
        return summary if state is None else (self.op(self.dtype(state[0]), self.dtype(summary[0])).item(), state[1] or summary[1])


def running_agg(df: DataFrame, value, order: list, by: list, how: str = "sum", out: str = "running",
                inclusive: bool = True, partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Running ``sum``/``max``/``min`` of ``value`` per group ``by`` in ``order``, equal to the plain window, without putting
    a hot group in one task.

    Whole numbers give longs, other numbers doubles; the frame is null until it holds a value. ``inclusive=False`` leaves out
    the current row. Adds ``out`` to all columns, or to ``by``, ``order`` and ``keep`` if that is given: only these are written."""
    v = F.col(value) if isinstance(value, str) else value
    kept = df.columns if keep is None else list(dict.fromkeys([*by, *order, *keep]))
    narrow = df.select(*kept, v.alias("_value"))
    whole = isinstance(narrow.schema["_value"].dataType, T.IntegralType)
    narrow = narrow.withColumn("_value", F.col("_value").cast("long" if whole else "double"))
    rows = ordered(narrow, by, order, partitions)
    kernel = _Running(how, whole)

    def scanned(batches: Iterator[pa.RecordBatch], start: tuple | None):
        """(batch, starts, values, seen, what came in) with the last group's state handed on."""
        key, state = None, start
        for batch in batches:
            starts = segments(batch, by)
            first = key_at(batch, by, 0)
            into = state if key is None or first == key else None
            values, seen = kernel.scan(batch.column("_value"), starts, into)
            yield batch, starts, values, seen, into
            key, state = key_at(batch, by, int(starts[-1])), (values[-1].item(), bool(seen[-1]))

    def summarise(batches: Iterator[pa.RecordBatch]):
        first_key = summary = last_key = last = None
        for batch, starts, values, seen, _ in scanned(batches, None):
            keys = key_at(batch, by, 0), key_at(batch, by, int(starts[-1]))
            first_key = keys[0] if first_key is None else first_key
            if keys[0] == first_key:
                end = (int(starts[1]) if len(starts) > 1 else batch.num_rows) - 1
                summary = values[end].item(), bool(seen[end])
            last_key, last = keys[1], (values[-1].item(), bool(seen[-1]))
        return first_key, summary, last_key, None if last_key == first_key else last

    known = carries(rows, summarise, kernel.fold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        start = known[head.column("_part")[0].as_py()].state
        stream = (b for part in ([head], batches) for b in part)
        for batch, starts, values, seen, into in scanned(stream, start):
            if not inclusive:
                values, seen = np.roll(values, 1), np.roll(seen, 1)
                seen[starts] = False
                if into is not None:
                    values[0], seen[0] = into
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(values, mask=~seen)], names=[*kept, out])

    schema = T.StructType([*(narrow.schema[c] for c in kept), T.StructField(out, T.LongType() if whole else T.DoubleType())])
    return rows.mapInArrow(run, schema)


# ---- early stopping

@dataclass(frozen=True)
class StopRule:
    """Early stopping check by check. A state is (best, checks waited, improved, stopped at, reason)."""
    patience: int = 3
    min_delta: float = 0.0
    mode: str = "min"
    check_finite: bool = True
    stopping_threshold: float | None = None
    divergence_threshold: float | None = None

    def better(self, a: float, b: float) -> bool:
        return a < b if self.mode == "min" else a > b

    def improves(self, value: float, best: float) -> bool:
        return self.better(value + self.min_delta if self.mode == "min" else value - self.min_delta, best)

    def start(self) -> tuple:
        return (math.inf if self.mode == "min" else -math.inf), 0, False, None, None

    def forced(self, value: float) -> str | None:
        """Why a value stops a run whatever came before."""
        if self.check_finite and not math.isfinite(value):
            return "non_finite"
        if self.stopping_threshold is not None and self.better(value, self.stopping_threshold):
            return "threshold"
        if self.divergence_threshold is not None and self.better(-value, -self.divergence_threshold):
            return "divergence"
        return None

    def step(self, state: tuple, at, value: float) -> tuple:
        best, wait, improved, _, reason = state
        if reason:
            return state
        if why := self.forced(value):
            return best, wait, improved, at, why
        if self.improves(value, best):
            return value, 0, True, None, None
        return best, wait + 1, improved, *((at, "patience") if wait + 1 >= self.patience else (None, None))


@dataclass
class StopSummary:
    """What a block of one run's checks does to any state that comes in.

    A first improvement must come within ``patience`` checks and be better than all checks of the block before it, whatever
    the best so far; the block's end is followed from each such check, since it no longer depends on what came in. If none improves,
    the run stops at a forced check or when its patience ends, so the first ``patience`` checks suffice."""
    rule: StopRule
    n: int = 0  # checks before the first forced one
    ats: list = field(default_factory=list)
    ends: list = field(default_factory=list)  # [place, value, state at the end]
    stop: tuple | None = None  # (place, at, reason) of the first forced check
    lowest: float | None = None

    def add(self, at, value: float) -> bool:
        """False once further checks can't matter."""
        rule = self.rule
        for end in self.ends:
            end[2] = rule.step(end[2], at, value)
        if self.stop is None:
            if why := rule.forced(value):
                self.stop = self.n, at, why
            else:
                if self.n < max(1, rule.patience):
                    self.ats.append(at)
                    if not math.isnan(value) and (self.lowest is None or rule.better(value, self.lowest)):
                        self.lowest = value
                        self.ends.append([self.n, value, (value, 0, True, None, None)])
                self.n += 1
        return any(not e[2][4] for e in self.ends) or (self.stop is None and self.n < max(1, rule.patience))

    def packed(self) -> tuple:
        """The fields that ``after`` needs, as plain values."""
        return self.n, self.ats, self.ends, self.stop

    def after(self, state: tuple | None) -> tuple:
        best, wait, improved, at, reason = state = state or self.rule.start()
        if reason:
            return state
        left = max(1, self.rule.patience - wait)
        for place, value, end in self.ends:
            if place < left and self.rule.improves(value, best):
                return end
        if self.stop and self.stop[0] < left:
            return best, wait, improved, *self.stop[1:]
        if self.n >= left:
            return best, wait + left, improved, self.ats[left - 1], "patience"
        return best, wait + self.n, improved, None, None


def early_stop_scan(df: DataFrame, value: str, order: str, by: list[str], rule: StopRule, partitions: int | None = None) -> DataFrame:
    """One row per run: ``by``, stop_at, reason, best. A run of any number of checks is scanned in pieces."""
    narrow = df.select(*by, order, F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("_value"))
    rows = ordered(narrow, by, [order], partitions)

    def groups(batches: Iterator[pa.RecordBatch]):
        """(key, checks) for each group's piece of each batch."""
        for batch in batches:
            starts = [*segments(batch, by).tolist(), batch.num_rows]
            ats, values = batch.column(order), batch.column("_value").to_numpy()
            for a, b in zip(starts, starts[1:]):
                yield key_at(batch, by, a), ats.slice(a, b - a).to_pylist(), values[a:b].tolist()

    def summarise(batches: Iterator[pa.RecordBatch]):
        first_key = last_key = state = None
        summary, open_ = StopSummary(rule), True
        for key, ats, values in groups(batches):
            first_key = key if first_key is None else first_key
            if key == first_key:
                for at, v in zip(ats, values):
                    if not open_:
                        break
                    open_ = summary.add(at, v)
            else:
                state = rule.start() if key != last_key else state
                for at, v in zip(ats, values):
                    if state[4]:
                        break
                    state = rule.step(state, at, v)
            last_key = key
        return first_key, summary.packed(), last_key, state

    known = carries(rows, summarise, lambda state, packed: StopSummary(rule, *packed).after(state))
    schema = T.StructType([*(narrow.schema[b] for b in by), T.StructField("stop_at", narrow.schema[order].dataType),
                           T.StructField("reason", T.StringType()), T.StructField("best", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        carry = known[head.column("_part")[0].as_py()]
        types = [head.schema.field(c).type for c in [*by, order]] + [pa.string(), pa.float64()]
        key, state, told, done = None, carry.state or rule.start(), bool(carry.state and carry.state[4]), []

        def result(key, state):
            return (*key, state[3], state[4], state[0] if state[2] else None)

        def out():
            return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=schema.names)

        for now, ats, values in groups(b for part in ([head], batches) for b in part):
            if key is not None and now != key:
                if not told:
                    done.append(result(key, state))
                state, told = rule.start(), False
            key = now
            for at, v in zip(ats, values):
                if state[4]:
                    break
                state = rule.step(state, at, v)
            if state[4] and not told:
                done.append(result(key, state))
                told = True
            if len(done) >= 10_000:
                yield out()
                done.clear()
        if not told and not carry.goes_on:
            done.append(result(key, state))
        if done:
            yield out()

    return rows.mapInArrow(run, schema)


# ---- looking back in a byte stream

SPAN = 512  # places of one packed run: the most that an exchange can't split
SLICE_ROWS = 1 << 17  # rows unpacked at once


def _packs(heads: list[pa.Array], by: list[str], starts: np.ndarray, places: pa.Array, stops: np.ndarray, sizes: np.ndarray, data: bytes) -> pa.RecordBatch:
    """Rows as runs that begin at ``starts``: one row for each, with the values' bytes in one piece.

    Places that count up by one are kept as the first of them, values of one byte each without their sizes."""
    n = len(sizes)
    bounds = np.append(starts, n)
    odd = np.zeros(n, bool)  # places that do not follow the one before
    if pa.types.is_integer(places.type) and not places.null_count:
        odd[1:] = np.diff(places.to_numpy().astype(np.int64)) != 1
        odd[starts] = False
    else:
        odd[:] = True

    def lists(wanted: np.ndarray, items: pa.Array) -> pa.Array:
        """The items of the runs that hold a wanted row; empty for the others (not null: Spark looks through all nulls of a batch
        again for each row that it adds)."""
        runs = np.logical_or.reduceat(wanted, starts)
        length = np.where(runs, np.diff(bounds), 0)
        off = pa.array(np.append(0, np.cumsum(length)), pa.int32())
        return pa.ListArray.from_arrays(off, items.filter(pa.array(np.repeat(runs, np.diff(bounds)))) if runs.any() else items.slice(0, 0))

    at = np.append(0, np.cumsum(sizes, dtype=np.int64))[bounds].astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays(
        [*heads, places.take(pa.array(starts)), pa.array(np.diff(bounds), pa.int32()),
         lists(odd, places), lists(sizes != 1, pa.array(sizes)), lists(stops, pa.array(stops)), blob],
        names=[*by, "_block", "_first", "_n", "_places", "_sizes", "_stops", "_bytes"])


def _packer(by: list[str], order: str):
    """Batches of rows as runs: neighbours of one group and block are one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = segments(batch, [*by, "_block"])
            values = batch.column("value").cast(pa.binary()).fill_null(b"")
            sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int32)
            data = b"".join(b for b in values.buffers()[2:] if b is not None)
            yield _packs([batch.column(c).take(pa.array(starts)) for c in [*by, "_block"]], by, starts, batch.column(order),
                         batch.column("_stop").to_numpy(zero_copy_only=False), sizes, data)
    return run


def _list_packer(by: list[str], items: str, values: list[bytes], stop: int):
    """Batches of lists of codes, cut into blocks, as runs: the code at each place stands for its value."""
    known = len(values)
    lengths = np.array([*map(len, values), 0], np.int32)
    first = np.append(0, np.cumsum(lengths, dtype=np.int64))[:-1]
    every = np.frombuffer(b"".join(values) or b"\0", np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(items)
            numbers = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            code = np.where((codes >= 0) & (codes < known), codes, known)
            sizes, stops = lengths[code], codes == stop
            row = np.repeat(np.arange(len(numbers)), numbers)
            places = np.arange(len(codes)) - np.repeat(np.cumsum(numbers) - numbers, numbers) + batch.column("_block").to_numpy().astype(np.int64)[row] * SPAN
            kept = (sizes > 0) | stops
            if not kept.all():
                code, sizes, stops, row, places = (x[kept] for x in (code, sizes, stops, row, places))
            if not len(row):
                continue
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            if sizes.min() == 1 == sizes.max():
                data = every[first[code]]
            else:
                data = every[np.repeat(first[code] - (np.cumsum(sizes, dtype=np.int64) - sizes), sizes) + np.arange(sizes.sum())]
            yield _packs([batch.column(c).take(pa.array(row[starts])) for c in [*by, "_block"]], by, starts, pa.array(places, pa.int64()),
                         stops, sizes, data.tobytes())
    return run


def _unpack(packs: pa.RecordBatch, by: list[str], order: str) -> pa.RecordBatch:
    """The rows of packed runs, in order inside each group and block."""
    n = packs.column("_n").to_numpy().astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)

    def spread_lists(name: str, default: pa.Array) -> pa.Array:
        """Each row's item: of its run's list, else of ``default``."""
        column = packs.column(name)
        if not len(column.flatten()):
            return default
        listed = np.repeat(pc.list_value_length(column).to_numpy() > 0, n)
        items = column.flatten()
        index = np.where(listed, np.cumsum(listed) - 1, len(items) + np.arange(len(run)))
        return pa.concat_arrays([items, default]).take(pa.array(index))

    first = packs.column("_first")
    if pa.types.is_integer(first.type):
        counted = first.fill_null(0).to_numpy().astype(np.int64)[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        bare = (pc.list_value_length(packs.column("_places")).to_numpy() == 0)[run]  # others' numbers are not used and may be out of range
        default = pa.array(np.where(bare, counted, 0), first.type)
    else:
        default = pa.nulls(len(run), first.type)
    places = spread_lists("_places", default)
    sizes = spread_lists("_sizes", pa.array(np.ones(len(run), np.int32))).to_numpy()
    stops = spread_lists("_stops", pa.array(np.zeros(len(run), bool)))
    data = b"".join(packs.column("_bytes").to_pylist())
    at = np.append(0, np.cumsum(sizes, dtype=np.int64)).astype(np.int32)
    values = pa.Array.from_buffers(pa.binary(), len(run), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])
    rows = pa.RecordBatch.from_arrays([*(packs.column(b).take(pa.array(run)) for b in by), places, values, stops], names=[*by, order, "value", "_stop"])
    group = np.zeros(len(n), np.int64)
    group[segments(packs, [*by, "_block"])] = 1
    group = np.cumsum(group)[run]
    if pa.types.is_integer(places.type):  # else a block is one place
        held = places.fill_null(0).to_numpy().astype(np.int64)  # a block of nulls holds nothing else
        if ((np.diff(held) < 0) & (np.diff(group) == 0)).any():
            rows = rows.take(pa.array(np.lexsort((held, group))))
    return rows


def _unpacked(batches: Iterator[pa.RecordBatch], by: list[str], order: str) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted stream of packed runs, some ``SLICE_ROWS`` at a time, with ``_part``; a block is never cut."""
    held: pa.RecordBatch | None = None
    part = None

    def rows(packs: pa.RecordBatch) -> pa.RecordBatch:
        out = _unpack(packs, by, order)
        return out.append_column("_part", pa.array(np.full(out.num_rows, part, np.int32)))

    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("_part")[0].as_py()
        packs = batch.drop_columns(["_part"])
        packs = packs if held is None else pa.concat_batches([held, packs])
        starts = segments(packs, [*by, "_block"])
        rows_before = np.append(0, np.cumsum(packs.column("_n").to_numpy(), dtype=np.int64))[starts]
        a = 0
        while a < len(starts) - 1:
            b = max(a + 1, min(int(np.searchsorted(rows_before, rows_before[a] + SLICE_ROWS, side="right")) - 1, len(starts) - 1))
            yield rows(packs.slice(starts[a], starts[b] - starts[a]))
            a = b
        held = packs.slice(starts[-1])
    if held is not None:
        yield rows(held)


def _last_bytes(packs: pa.RecordBatch, by: list[str], order: str, width: int) -> bytes:
    rows = _unpack(packs, by, order)
    return b"".join(rows.column("value").slice(max(0, rows.num_rows - width)).to_pylist())[-width:] if width else b""


def _ends(batches: Iterator[pa.RecordBatch], by: list[str], order: str, width: int) -> tuple:
    """(first key, (ended, last bytes) of the first group, last key, those of the last group if it is another) of sorted packed
    runs. Only a group's last blocks are unpacked."""
    first_key = summary = key = held = None
    ended = False
    for batch in batches:
        packs = batch.drop_columns(["_part"])
        starts = segments(packs, by)
        bounds = [*starts.tolist(), packs.num_rows]
        for a in dict.fromkeys((0, len(starts) - 1)):  # groups between them lie in this batch
            now, own = key_at(packs, by, bounds[a]), packs.slice(bounds[a], bounds[a + 1] - bounds[a])
            if now != key:
                if key is not None and summary is None:
                    first_key, summary = key, (ended, _last_bytes(held, by, order, width))
                key, held, ended = now, None, False
            ended = ended or bool(pc.any(own.column("_stops").flatten(), min_count=0).as_py())
            own = own if held is None else pa.concat_batches([held, own])
            blocks = segments(own, [*by, "_block"])
            after = np.append(0, np.cumsum(pc.binary_length(own.column("_bytes")).to_numpy()))
            enough = np.flatnonzero(after[-1] - after[blocks] >= width)
            held = own.slice(blocks[enough[-1]] if len(enough) else 0)
    if key is None:  # no rows
        return None, None, None, None
    last = ended, _last_bytes(held, by, order, width)
    return (key, last, key, None) if summary is None else (first_key, summary, key, last)


def look_back(df: DataFrame, by: list[str], order: str, value: Column, stop: Column, width: int, out: str = "before",
              partitions: int | None = None) -> DataFrame:
    """(by, order, value, out) of a group's rows before its first ``stop``, with the last ``width`` bytes of the group's values
    before each row. Rows with a null or empty ``value`` are left out. A group of any length is scanned in pieces.

    Rows are packed before they are exchanged: neighbours of one group whose places share a block of ``SPAN`` are one row, so what
    is written to disk is little more than the values' bytes. A block goes to one range whole, and its runs are put in order there."""
    schema, packs = _row_packs(df, by, order, value, stop)

    def whole(batch: pa.RecordBatch, before: Callable) -> pa.RecordBatch:
        return batch.append_column(out, before(np.arange(batch.num_rows)))

    return _scan_packs(packs, by, order, width, whole, T.StructType([*schema, T.StructField(out, T.BinaryType())]), partitions or range_count(df))


def _row_packs(df: DataFrame, by: list[str], order: str, value: Column, stop: Column) -> tuple[list[T.StructField], DataFrame]:
    """Fields (by, order, value) and packed runs of rows."""
    narrow = (df.select(*by, order, value.cast("binary").alias("value"), F.coalesce(stop, F.lit(False)).alias("_stop"))
              .filter(F.col("_stop") | (F.octet_length("value") > 0)))
    place = narrow.schema[order].dataType
    block = F.expr(f"`{order}` div {SPAN}") if isinstance(place, T.IntegralType) else F.col(order)
    blocked = narrow.withColumn("_block", block)
    return [narrow.schema[c] for c in [*by, order, "value"]], blocked.mapInArrow(_packer(by, order), _pack_schema(blocked, by, place))


def _list_packs(df: DataFrame, by: list[str], order: str, items: str, values: list[bytes], stop: int) -> tuple[list[T.StructField], DataFrame]:
    """As ``_row_packs`` of lists whose items are the rows, ``order`` (long) counting from 0: nothing is written out item by item."""
    cut = (df.where(F.size(items) > 0).select(*by, items, F.explode(F.expr(f"sequence(0L, (size(`{items}`) - 1) div {SPAN})")).alias("_block"))
           .select(*by, "_block", F.expr(f"slice(`{items}`, cast(_block * {SPAN} + 1 as int), {SPAN})").alias(items)))
    fields = [*(df.schema[b] for b in by), T.StructField(order, T.LongType()), T.StructField("value", T.BinaryType())]
    return fields, cut.mapInArrow(_list_packer(by, items, values, stop), _pack_schema(cut, by, T.LongType()))


def _pack_schema(df: DataFrame, by: list[str], place: T.DataType) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in [*by, "_block"]), T.StructField("_first", place), T.StructField("_n", T.IntegerType()),
                         T.StructField("_places", T.ArrayType(place)), T.StructField("_sizes", T.ArrayType(T.IntegerType())),
                         T.StructField("_stops", T.ArrayType(T.BooleanType())), T.StructField("_bytes", T.BinaryType())])


def _scan_packs(packs: DataFrame, by: list[str], order: str, width: int, then: Callable, schema: T.StructType, partitions: int) -> DataFrame:
    """``then(batch, before)`` of the rows (by, order, value) before the first stop; ``before(i)`` gives the last ``width`` bytes before
    rows i. Choosing the ranges reads the runs once more, so they are written first, lest what makes them run twice."""
    spark = packs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    names = [f"c{i}" for i in range(len(packs.columns))]  # a file's column names are less free
    packs.toDF(*names).write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(packs.toDF(*names).schema).parquet(path).toDF(*packs.columns)
    rows = ordered(stored, by, ["_block"], partitions)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    def fold(state: tuple | None, summary: tuple) -> tuple:
        return summary if state is None else (state[0] or summary[0], (state[1] + summary[1])[-width:] if width else b"")

    known = carries(rows, lambda batches: _ends(batches, by, order, width), fold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in _unpacked((b for b in batches if b.num_rows), by, order):
            if key is None:
                state = known[batch.column("_part")[0].as_py()].state
            starts, n = segments(batch, by), batch.num_rows
            into = state if key is None or key_at(batch, by, 0) == key else None
            ended, held = into or (False, b"")
            values, stops = batch.column("value"), batch.column("_stop").to_numpy(zero_copy_only=False)
            sizes = np.diff(np.append(starts, n))
            over = np.zeros(n, bool)
            if stops.any():
                seen = np.cumsum(stops)
                over = seen - np.repeat(seen[starts] - stops[starts], sizes) > 0
            over[:sizes[0]] |= ended

            def before(i: np.ndarray, values=values, starts=starts, first=int(sizes[0]), held=held) -> pa.Array:
                begin, shifted = starts[np.searchsorted(starts, i, side="right") - 1], []
                for k in range(width, 0, -1):  # each value before the stop has a byte, so `width` rows are enough
                    shifted.append(values.take(pa.array(i - k, mask=i - k < begin)).fill_null(b""))
                found = pc.binary_slice(pc.binary_join_element_wise(*shifted, b""), -width, None) if width else pa.array([b""] * len(i), pa.binary())
                early = np.flatnonzero(i < min(width, first)) if held else []
                if len(early):
                    new = [(held + found[j].as_py())[-width:] for j in early.tolist()]
                    found = pc.replace_with_mask(found, pa.array(np.isin(np.arange(len(i)), early)), pa.array(new, found.type))
                return found

            last = np.array([n - 1])
            key, state = key_at(batch, by, n - 1), (bool(over[-1]), (before(last)[0].as_py() + values[n - 1].as_py())[-width:] if width else b"")
            whole = batch.select([*by, order, "value"])
            if over.any():
                left = np.flatnonzero(~over)
                yield then(whole.take(pa.array(left)), lambda i, left=left, before=before: before(left[i]))
            else:
                yield then(whole, before)

    return rows.mapInArrow(run, schema)
