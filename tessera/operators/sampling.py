"""Sampling over score tables and generated-token tables (I1-I6), JVM-side but for the text pieces.

Randomness comes from md5 of ``seed:row`` rather than ``rand()``, so a draw does not depend on
partitioning or on recomputation after an executor loss.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import drop_specials
from ..functions.text import EOS_ID, N_SPECIAL, col_
from .ordering import hash_uniform, range_count
from .prefix import _list_packs, _row_packs, _scan_packs


def temperature(logits, t) -> Column:
    """Divide scores by ``t``; skipped when ``t`` is 0, None or 1."""
    if not t or t == 1.0:
        return col_(logits)
    return F.transform(col_(logits), lambda v: v.cast("double") / float(t))


def top_k(logits, k: int = 5, clamp: bool = True) -> Column:
    """The ``k`` best ``struct(score double, id int)`` in score order (ties: lower id).
    ``clamp`` keeps k within [1, n_classes], as the interactive sampler does."""
    x = col_(logits)
    ranked = F.array_sort(F.transform(x, lambda v, i: F.struct((-v.cast("double")).alias("neg"), i.alias("id"))))
    kk = F.least(F.greatest(F.lit(k), F.lit(1)), F.size(x)) if clamp else F.lit(k)
    return F.transform(F.slice(ranked, 1, kk), lambda e: F.struct((-e["neg"]).alias("score"), e["id"].alias("id")))


def softmax_topk(top) -> Column:
    """Probabilities over the retained scores (max-shifted)."""
    t = col_(top)
    # retained scores are sorted, so the first one is the max; z is computed once per row by
    # zipping it in as an array instead of referencing it inside the lambda
    m = F.element_at(t, 1)["score"]
    z = F.aggregate(t, F.lit(0.0).cast("double"), lambda acc, e: acc + F.exp(e["score"] - m))
    zs = F.array_repeat(z, F.size(t))
    return F.zip_with(t, zs, lambda e, s: F.struct(e["id"].alias("id"), (F.exp(e["score"] - m) / s).alias("p")))


def sample_topk(probs, seed: int, *row_key) -> Column:
    """I4: inverse-CDF draw of one id from ``softmax_topk`` output with a hash uniform."""
    u = hash_uniform(seed, *row_key)
    init = F.struct(F.lit(0.0).cast("double").alias("cum"), F.lit(-1).alias("pick"))
    folded = F.aggregate(col_(probs), init, lambda acc, e: F.struct(
        (acc["cum"] + e["p"]).alias("cum"),
        F.when((acc["pick"] < 0) & (acc["cum"] + e["p"] > u), e["id"]).otherwise(acc["pick"]).alias("pick")))
    last = F.element_at(col_(probs), -1)["id"]
    return F.when(folded["pick"] >= 0, folded["pick"]).otherwise(last)


def decode_bytes(ids, vocab_hex: Column, skip_special: bool = True) -> Column:
    """Token ids to their concatenated bytes through a literal id-indexed array of hex strings
    (``encode.vocab_map``): each token's hex is looked up by index, joined, and decoded once,
    so the work is linear in the output size."""
    c = drop_specials(ids) if skip_special else col_(ids)
    parts = F.transform(c, lambda i: F.coalesce(
        F.when(i >= 0, F.try_element_at(vocab_hex, i + 1)), F.lit("")))
    return F.unhex(F.array_join(parts, ""))


def bytes_to_text(b) -> Column:
    """UTF-8 decode with U+FFFD for malformed sequences (like ``errors='replace'``)."""
    return F.call_function("make_valid_utf8", col_(b).cast("string"))


#: The end of bytes that starts a character and lacks bytes of it (one U+FFFD when decoded).
_UNFINISHED = re.compile(rb"(?:[\xC2-\xF4]|\xE0[\xA0-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]|\xED[\x80-\x9F]"
                         rb"|\xF0[\x90-\xBF]|[\xF1-\xF3][\x80-\xBF]|\xF4[\x80-\x8F]|\xF0[\x90-\xBF][\x80-\xBF]"
                         rb"|[\xF1-\xF3][\x80-\xBF][\x80-\xBF]|\xF4[\x80-\x8F][\x80-\xBF])\Z")


def _delta(before: bytes, value: bytes) -> bytes:
    """What a step adds to the text: its bytes decoded with the unfinished character before them."""
    held = _UNFINISHED.search(before)
    text = ((held[0] if held else b"") + value).decode("utf-8", "replace")
    return (text[1:] if held else text).encode()


def _delta_batch(gen: str, step: str):
    """(gen, step, delta) of (gen, step, value): a value of one ASCII byte is its own delta, of others each different pair with the
    bytes before it is decoded once."""
    def run(batch: pa.RecordBatch, before) -> pa.RecordBatch:
        values = batch.column("value")
        at = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1]
        data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
        high = np.append(0, np.cumsum(data >= 0x80))
        other = np.flatnonzero((np.diff(at) != 1) | (high[at[1:]] > high[at[:-1]]))
        if len(other):
            own, prior = values.take(pa.array(other)).dictionary_encode(), before(other).dictionary_encode()
            pair = prior.indices.to_numpy().astype(np.int64) * len(own.dictionary) + own.indices.to_numpy()
            pairs, which = np.unique(pair, return_inverse=True)
            texts = pa.array([_delta(prior.dictionary[int(p)].as_py(), own.dictionary[int(v)].as_py())
                              for p, v in zip(*np.divmod(pairs, len(own.dictionary)))], pa.binary())
            mask = np.zeros(len(values), bool)
            mask[other] = True
            values = pc.replace_with_mask(values, pa.array(mask), texts.take(pa.array(which)))
        out = pa.RecordBatch.from_arrays([batch.column(gen), batch.column(step), values.cast(pa.string())], names=[gen, step, "delta"])
        if len(other) and not pc.all(pc.greater(pc.binary_length(values), 0)).as_py():
            out = out.filter(pc.greater(pc.binary_length(values), 0))
        return out
    return run


def text_deltas(df: DataFrame, vocab_hex: Column, gen: str = "gen_id", step: str = "step",
                token: str = "token_id", eos_id: int = EOS_ID, max_new: int | None = None, ids: str | None = None) -> DataFrame:
    """Streamed text pieces of a generation: at each step the new suffix of the decoded
    prefix (Python-slice semantics, so a completed multi-byte character can replace an earlier
    U+FFFD without being emitted); steps at or after the first EOS and, if given, beyond
    ``max_new`` are cut, and empty pieces are dropped. A step is decoded with the unfinished
    character before it (at most 3 bytes), so the work is linear in the output size. A prefix scan carries
    these bytes and the end from range to range, so a generation of any length spreads over tasks.

    With ``ids`` a row holds a list of tokens, whose steps (``step long``) are their places from 0, as ``posexplode`` gives them."""
    if ids is not None and max_new is not None:
        df, ids = df.select(gen, F.posexplode(ids).alias(step, token)).withColumn(step, F.col(step).cast("long")), None
    if max_new is not None:
        # a row_number filter that Spark applies map-side (window group limit)
        order = Window.partitionBy(gen).orderBy(step)
        df = df.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= max_new)
    # steps without bytes emit nothing
    if ids is None:
        own = F.unhex(F.when(F.col(token) >= N_SPECIAL, F.try_element_at(vocab_hex, F.col(token) + 1)))
        fields, packs = _row_packs(df, [gen], step, own, F.col(token) == eos_id)
    else:
        vocab = df.sparkSession.range(1).select(vocab_hex.alias("v")).first().v
        values = [b"" if i < N_SPECIAL or x is None else bytes.fromhex(x) for i, x in enumerate(vocab)]
        fields, packs = _list_packs(df.select(gen, F.col(ids).cast("array<int>").alias(ids)), [gen], step, ids, values, eos_id)
    schema = T.StructType([*fields[:2], T.StructField("delta", T.StringType())])
    return _scan_packs(packs, [gen], step, 3, _delta_batch(gen, step), schema, range_count(df))
