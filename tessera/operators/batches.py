"""Exact split, epoch shuffle, batches, subsets, plans and shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import dense_index, hash_key

SPLIT_SEED = 42  # fixed value: the reference seeds its split with 42 whatever the run seed is


DIGITS = 4  # hex digits of the order key counted at a time: at most 65,536 rows come to the driver
FEW = 10_000  # rows of the last bucket, whose keys are sorted


def _unique(ranked: DataFrame, id_col: str) -> DataFrame:
    """The ranked ids, or an error when an id is repeated (a position would not belong to one row). Equal ids have equal
    keys, so they are neighbours in one range: no shuffle is needed to find them."""
    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = [], False
        for batch in batches:
            if batch.num_rows:
                column = batch.column(0)
                codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                found |= bool(np.any(codes[1:] == codes[:-1])) or last == [column[0].as_py()]
                last = [column[-1].as_py()]
        yield pa.RecordBatch.from_arrays([pa.array([found])], names=["repeated"])

    if ranked.select(id_col).mapInArrow(repeats, "repeated boolean").filter("repeated").take(1):
        raise ValueError(f"'{id_col}' must be unique")
    return ranked


def _kth_key(rows: DataFrame, key: Column, id_col: str, choose) -> tuple | None:
    """(key, id) of the row at position ``choose(n) - 1`` in (key, id) order, n being the number of rows; None where that is negative.

    Selection by digits: count rows by the key's next digits, go on in the bucket that holds the position, and sort only a
    bucket of ``FEW`` rows. Rows are read a few times and never shuffled. Raises if an id is repeated around the position."""
    left, prefix = None, ""
    while True:
        inside = rows.filter(key.startswith(prefix)) if prefix else rows
        counts = sorted(map(tuple, inside.groupBy(F.substring(key, len(prefix) + 1, DIGITS)).count().collect()))
        if left is None:
            left = choose(sum(c for _, c in counts))
            if left <= 0:
                return None
        for digits, n in counts:
            if left <= n:
                break
            left -= n
        prefix += digits
        if n <= FEW or len(prefix) >= 32:
            break
    if n > FEW:  # a whole key shared by so many rows
        raise ValueError(f"'{id_col}' must be unique")
    last = sorted(map(tuple, rows.filter(key.startswith(prefix)).select(key, id_col).collect()))
    if len(set(last)) < len(last):
        raise ValueError(f"'{id_col}' must be unique")
    return last[left - 1]


def exact_split(df: DataFrame, id_col: str, rate: float = 0.05, seed: int = SPLIT_SEED) -> DataFrame:
    """G1: ``val`` holds exactly ``int(n * rate)`` rows, chosen by a seeded hash order.

    The row at position ``val_len - 1`` of that order is found by counting hash digits (two or three aggregates of the id
    column, see ``_kth_key``); the split itself is a narrow comparison on the input, so nothing is shuffled or
    checkpointed for it. Ids must be unique; repeated ids around the threshold, where they could not be split exactly, raise."""
    key = hash_key(seed, id_col)
    thr = _kth_key(df.select(id_col), key, id_col, lambda n: int(n * rate))
    if thr is None:
        return df.withColumn("split", F.lit("train"))
    in_val = (key < F.lit(thr[0])) | ((key == F.lit(thr[0])) & (F.col(id_col) <= F.lit(thr[1])))
    return df.withColumn("split", F.when(in_val, "val").otherwise("train"))


def split_view(df: DataFrame, name: str) -> DataFrame:
    """``train``, ``val``, or ``test`` (the test set is the validation set)."""
    return df.filter(F.col("split") == ("val" if name in ("val", "test") else name))


def epoch_order(df: DataFrame, id_col: str, epoch: int, seed: int = SPLIT_SEED, shuffle: bool = True,
                out: str = "pos", partitions: int | None = None) -> DataFrame:
    """A fresh seeded order for every epoch (``shuffle=False`` keeps ``id_col`` order).

    Only the ``(key, id)`` projection is ranked and checkpointed; positions join back on the
    unique id (no hot keys), so wide training rows are shuffled once and never written twice."""
    key = hash_key(seed, F.lit(epoch), id_col) if shuffle else F.col(id_col)
    ranked, _ = dense_index(df.select(F.col(id_col), key.alias("_k")), ["_k", id_col], out, partitions)
    return df.join(_unique(ranked, id_col).select(id_col, out), id_col)


def assign_batches(df: DataFrame, size: int, pos: str = "pos", out: str = "batch_id") -> DataFrame:
    """Fixed-size batches in position order; the last partial batch is kept."""
    return df.withColumn(out, F.floor(F.col(pos) / size).cast("long"))


def collate(df: DataFrame, cols: list[str], batch: str = "batch_id", pos: str = "pos") -> DataFrame:
    """One row per batch with each column stacked in position order (groups hold <= size rows)."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_p"), *[F.col(c) for c in cols])))
    agg = df.groupBy(batch).agg(rows.alias("_rows"))
    def field(c):
        return F.transform("_rows", lambda r: r[c]).alias(c)
    return agg.select(batch, F.size("_rows").alias("n_rows"), *[field(c) for c in cols])


def limit_batches(df: DataFrame, spec, batch: str = "batch_id") -> DataFrame:
    """A fraction of the batches (``int(n_batches * spec)``) or the first ``spec`` batches."""
    if isinstance(spec, float):
        n_batches = df.agg(F.max(batch)).first()[0]
        n_batches = 0 if n_batches is None else n_batches + 1
        keep = int(n_batches * spec)
    else:
        keep = int(spec)
    return df.filter(F.col(batch) < keep)


def epoch_plan(rows, batch_size: int, accumulate: int = 1, epochs: int = 1,
               warmup_ratio: float = 0.0, world: int = 1):
    """Batches per epoch, optimizer steps and warm-up steps as columns (``rows`` may be a
    column or a number). Devices see ``ceil(rows / world)`` rows each."""
    r = F.col(rows) if isinstance(rows, str) else F.lit(rows)
    per_device = F.ceil(r / world)
    batches = F.ceil(per_device / batch_size)
    steps = F.ceil(batches / accumulate) * max(epochs, 1)
    warmup = F.greatest(F.lit(1), F.floor(steps * float(warmup_ratio)))
    return [batches.cast("long").alias("batches_per_epoch"), steps.cast("long").alias("total_steps"),
            warmup.cast("long").alias("warmup_steps")]


def shard(df: DataFrame, world: int, n_rows: int, pos: str = "pos", out: str = "rank") -> DataFrame:
    """One shard per device; positions are dealt round-robin and the tail is padded by
    wrapping around to the first rows, so every shard has ``ceil(n / world)`` rows."""
    total = math.ceil(n_rows / world) * world if n_rows else 0
    copies = F.sequence(F.col(pos), F.lit(max(total - 1, 0)).cast("long"), F.lit(max(n_rows, 1)).cast("long"))
    exploded = df.withColumn("_slot", F.explode(F.when(F.col(pos) < total, copies)))
    return (exploded.withColumn(out, (F.col("_slot") % world).cast("int"))
            .withColumn("slot", F.col("_slot")).drop("_slot"))
