"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are runs of letters, digits or other signs. Features are hashed 1- and 2-grams of the folded
tokens and 1- to 3-grams of their shapes (kind, case, length, whether a token repeats the one before); a feature's value is its share
of the text's n-grams of that family. The model is fitted on at most ``sample`` labelled documents (a stated bound, drawn by a hash
of the id) in one task; scoring is a sparse dot product over all texts, with the weights (2^18 numbers) sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import free_names

BITS = 18
SAMPLE = 8000
SCALE = 6.0
FAMILIES = (("word", 1), ("word", 2), ("shape", 1), ("shape", 2), ("shape", 3))
_KIND = np.full(256, 3, np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1


def held_out(doc_id: Column) -> Column:
    """Rows that a model never learns from: crc32 of the id's text modulo 5 is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the feature numbers of all texts and each text's offsets among them."""
    n = len(data)
    texts = len(off) - 1
    if not n:
        return [(np.zeros(0, np.int64), np.zeros(texts + 1, np.int64))] * len(FAMILIES)
    kind = _KIND[data]
    begin = np.ones(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    begin[off[off < n]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    ink = kind[starts] > 0
    starts, ends = starts[ink], ends[ink]
    first = np.searchsorted(starts, off)
    text_of = np.repeat(np.arange(texts), np.diff(first))
    word = K.span_hashes(data, starts, ends, lower=True)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    ups, length = upper[ends] - upper[starts], ends - starts
    case = np.where(ups == 0, 0, np.where(ups * 2 > length, 2, 1))
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (text_of[1:] == text_of[:-1])
    shape = K.mix((kind[starts].astype(np.uint64) * np.uint64(1000) + case.astype(np.uint64) * np.uint64(100)
                   + np.minimum(length, 12).astype(np.uint64) * np.uint64(4) + same.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    out = []
    for f, (name, k) in enumerate(FAMILIES):
        grams = K.windows(word if name == "word" else shape, k)
        m = len(grams)
        inside = text_of[:m] == text_of[k - 1:k - 1 + m]
        number = (K.mix(grams[inside] + np.uint64(f)) >> np.uint64(64 - BITS)).astype(np.int64)
        out.append((number, np.searchsorted(text_of[:m][inside], np.arange(texts + 1))))
    return out


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse vector (feature numbers, shares) of each text."""
    found = features(*K.text_bytes(batch.column("text")))
    for i in range(batch.num_rows):
        numbers, values = [], []
        for x, o in found:
            own = x[o[i]:o[i + 1]]
            if len(own):
                u, c = np.unique(own, return_counts=True)
                numbers.append(u)
                values.append(c * (SCALE / len(own)))
        yield (np.concatenate(numbers), np.concatenate(values)) if numbers else (np.zeros(0, np.int64), np.zeros(0))


def fit_weights(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 0.3, beta: float = 1.0,
                l1: float = 0.02, l2: float = 0.5) -> np.ndarray:
    """FTRL-proximal logistic regression over (label, numbers, values); the last weight is the bias."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for label, numbers, values in rows:
            # numbers may repeat between families; unique within one update
            i, at = np.unique(np.append(numbers, size), return_inverse=True)
            x = np.bincount(at, np.append(values, 1.0))
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    return weights(np.arange(size + 1)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> np.ndarray:
    """Weights fitted on the ``sample`` labelled, not held-out documents with the smallest id hash.

    Ids labelled differently by several rows, null labels and labels other than 0 and 1 are left out. Of documents with
    equal ids, the one with the smallest text hash counts. Without any usable row the weights are zero (every score 0.5).
    """
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    named = named.where((F.col("y").isin(0, 1)) & ~held_out(F.col("id")))
    one = named.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top")
    chosen = one.withColumn("r", F.xxhash64("id")).orderBy("r", "id").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # one row of a repeated id, so that `sample` bounds the documents too
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "r", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, "text"):
            xs = list(_vectors(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("r"), batch.column("y"), pa.array([x.astype(np.int32) for x, _ in xs], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in xs], pa.list_(pa.float32()))], names=["r", "y", "i", "v"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            i, v = batch.column("i"), batch.column("v")
            off = i.offsets.to_numpy()
            numbers, values = i.values.to_numpy(), v.values.to_numpy()
            for k, y in enumerate(batch.column("y").to_pylist()):
                rows.append((y, numbers[off[k]:off[k + 1]], values[off[k]:off[k + 1]].astype(float)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([fit_weights(rows).tobytes()])], names=["w"])

    table = rows.mapInArrow(vectors, "r long, y int, i array<int>, v array<float>")
    got = table.repartition(1).sortWithinPartitions("r", F.xxhash64("i")).mapInArrow(fit, "w binary").collect()
    return np.frombuffer(got[0]["w"], np.float32) if got else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``name``: the probability of label 1.

    Null and empty texts get the bias alone. A column called ``name`` is replaced. An empty table gives none.
    """
    kept = [c for c in docs.columns if c != name]
    body = free_names(docs, "_scored")[0]
    weights = np.asarray(weights, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, body):
            total = np.full(batch.num_rows, float(weights[-1]))
            for numbers, off in features(*K.text_bytes(batch.column(body))):
                sums = np.concatenate([[0.0], np.cumsum(weights[numbers], dtype=np.float64)])
                count = np.diff(off)
                total += np.where(count > 0, (sums[off[1:]] - sums[off[:-1]]) * SCALE / np.maximum(count, 1), 0.0)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=[*kept, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != name) + f", `{name}` double"
    return docs.select(*[f"`{c}`" for c in kept], F.col(text_col).cast("string").alias(body)).mapInArrow(run, schema)
